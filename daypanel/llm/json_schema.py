"""JSON that can be stored and compared, and a check of values against schemas that never ends in an error.

``read`` takes strict JSON: no NaN or infinity, no lone surrogates, at most ``DEEPEST`` levels, no whole numbers of more
digits than Python converts. Of a name that repeats in an object the last counts.

``check`` knows these keywords: type, enum, const, minimum, maximum, exclusiveMinimum, exclusiveMaximum, multipleOf,
minLength, maxLength, pattern, minItems, maxItems, uniqueItems, items, properties, patternProperties,
additionalProperties, required, minProperties, maxProperties, anyOf, oneOf, allOf, not, and $ref within the document.
Words that only describe (``NOTES``) are passed over. Any other word, a word whose value is not of its kind, and a
reference that leads nowhere or in a circle is not checked but reported. Patterns are Python's.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from fractions import Fraction

DEEPEST = 100

#: Words of a schema that ask nothing of a value.
NOTES = {
    "$schema", "$id", "$comment", "$defs", "definitions", "title", "description", "default", "examples", "format",
    "deprecated", "readOnly", "writeOnly",
}


def canonical(value) -> str:
    """Sorted names, no blanks, characters as they are."""
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)


def _no_constant(name: str):
    raise ValueError(f"{name} is no JSON")


def _too_deep(value) -> bool:
    level = [value]
    for _ in range(DEEPEST + 1):
        level = [x for v in level if isinstance(v, (dict, list)) for x in (v.values() if isinstance(v, dict) else v)]
        if not level:
            return False
    return True


def read(raw: str):
    """The value of a JSON text; ValueError for whatever is not strict JSON that can be written again."""
    try:
        value = json.loads(raw, parse_constant=_no_constant)
    except RecursionError:
        raise ValueError("nested too deep") from None
    if _too_deep(value):
        raise ValueError("nested too deep")
    canonical(value).encode()  # a number beyond all bounds or a lone surrogate
    return value


def _number(value) -> bool:
    return isinstance(value, (int, float)) and not isinstance(value, bool)


def same(a, b) -> bool:
    """Equal as JSON: 1 is 1.0 but not true."""
    if isinstance(a, dict) and isinstance(b, dict):
        return a.keys() == b.keys() and all(same(a[k], b[k]) for k in a)
    if isinstance(a, list) and isinstance(b, list):
        return len(a) == len(b) and all(map(same, a, b))
    return isinstance(a, bool) == isinstance(b, bool) and a == b


def _key(value) -> str:
    """Equal texts for equal values."""
    if isinstance(value, dict):
        return "{" + ",".join(f"{json.dumps(k)}:{_key(value[k])}" for k in sorted(value)) + "}"
    if isinstance(value, list):
        return "[" + ",".join(map(_key, value)) + "]"
    return str(int(value)) if isinstance(value, float) and value.is_integer() else json.dumps(value)


_KINDS: dict[str, Callable[[object], bool]] = {
    "object": lambda v: isinstance(v, dict),
    "array": lambda v: isinstance(v, list),
    "string": lambda v: isinstance(v, str),
    "boolean": lambda v: isinstance(v, bool),
    "null": lambda v: v is None,
    "integer": lambda v: _number(v) and (isinstance(v, int) or v.is_integer()),
    "number": _number,
}


def _count(value) -> bool:
    return _KINDS["integer"](value) and value >= 0


def _schema(value) -> bool:
    return isinstance(value, (dict, bool))


def _schemas(value) -> bool:
    return isinstance(value, list) and bool(value) and all(map(_schema, value))


def _named(value) -> bool:
    return isinstance(value, dict) and all(map(_schema, value.values()))


def _pattern(value) -> bool:
    try:
        return isinstance(value, str) and bool(re.compile(value))
    except (re.error, OverflowError, RecursionError):
        return False


def _types(value) -> bool:
    listed = value if isinstance(value, list) else [value]
    return bool(listed) and all(isinstance(x, str) and x in _KINDS for x in listed)


def _multiple(value, step) -> bool:
    """In decimals as written, so that 0.3 is a multiple of 0.1."""
    return Fraction(repr(value)) % Fraction(repr(step)) == 0


#: word -> (its value is well formed, values it speaks of, holds, what is said if not)
_PLAIN = {
    "enum": (lambda s: isinstance(s, list), lambda v: True, lambda v, s: any(same(v, x) for x in s), "enum"),
    "const": (lambda s: True, lambda v: True, same, "const"),
    "minimum": (_number, _number, lambda v, s: v >= s, "bounds"),
    "maximum": (_number, _number, lambda v, s: v <= s, "bounds"),
    "exclusiveMinimum": (_number, _number, lambda v, s: v > s, "bounds"),
    "exclusiveMaximum": (_number, _number, lambda v, s: v < s, "bounds"),
    "multipleOf": (lambda s: _number(s) and s > 0, _number, _multiple, "multiple"),
    "minLength": (_count, _KINDS["string"], lambda v, s: len(v) >= s, "length"),
    "maxLength": (_count, _KINDS["string"], lambda v, s: len(v) <= s, "length"),
    "pattern": (_pattern, _KINDS["string"], lambda v, s: re.search(s, v) is not None, "pattern"),
    "minItems": (_count, _KINDS["array"], lambda v, s: len(v) >= s, "length"),
    "maxItems": (_count, _KINDS["array"], lambda v, s: len(v) <= s, "length"),
    "uniqueItems": (
        _KINDS["boolean"], _KINDS["array"], lambda v, s: not s or len({_key(x) for x in v}) == len(v), "repeated",
    ),
    "minProperties": (_count, _KINDS["object"], lambda v, s: len(v) >= s, "length"),
    "maxProperties": (_count, _KINDS["object"], lambda v, s: len(v) <= s, "length"),
}
#: word -> its value is well formed; these hold schemas, or speak of the members of an object
_NESTED = {
    "type": _types, "items": _schema, "properties": _named, "additionalProperties": _schema, "not": _schema,
    "patternProperties": lambda s: _named(s) and all(map(_pattern, s)), "anyOf": _schemas, "oneOf": _schemas, "allOf": _schemas,
    "required": lambda s: isinstance(s, list) and all(isinstance(x, str) for x in s), "$ref": lambda s: isinstance(s, str),
}


class _Work:
    """Steps of one check. Schemas can refer to themselves so often that no check would end."""

    def __init__(self, size: int):
        self.left = 100_000 + 100 * size

    def step(self, depth: int) -> None:
        self.left -= 1
        if self.left < 0 or depth > 250:
            raise OverflowError


def check(value, schema) -> tuple[list[str], list[str]]:
    """(where the value breaks the schema, which words of the schema were not checked), both sorted and distinct.

    A schema that takes too many steps or levels for the size of the value is not checked at all: ``size``.
    """
    try:
        wrong, unchecked = _check(value, schema, schema, "$", (), 0, _Work(len(canonical(value))))
    except OverflowError:
        return [], ["size"]
    return sorted(set(wrong)), sorted(set(unchecked))


def problems(value, schema) -> list[str]:
    return check(value, schema)[0]


def _target(root, reference: str):
    """The schema that a local reference names, or None."""
    here = root
    if reference != "#" and not reference.startswith("#/"):
        return None
    for part in reference.split("/")[1:]:
        part = part.replace("~1", "/").replace("~0", "~")
        if isinstance(here, dict) and part in here:
            here = here[part]
        elif isinstance(here, list) and part.isascii() and part.isdigit() and len(part) < 10 and int(part) < len(here):
            here = here[int(part)]
        else:
            return None
    return here if _schema(here) else None


def _check(
    value, schema, root, path: str, followed: tuple[str, ...], depth: int, work: _Work
) -> tuple[list[str], list[str]]:
    """``followed``: the references on the way to this schema that were taken at this very value."""
    work.step(depth)
    if schema is True:
        return [], []
    if schema is False:
        return [f"{path}: not allowed"], []
    if not isinstance(schema, dict):
        return [], ["schema"]
    wrong: list[str] = []
    unchecked: list[str] = []

    def inside(x, part, where: str, same_value: bool = False) -> list[str]:
        found, left = _check(x, part, root, where, followed if same_value else (), depth + 1, work)
        unchecked.extend(left)
        return found

    known = {}
    for word, says in schema.items():
        formed = _PLAIN[word][0] if word in _PLAIN else _NESTED.get(word)
        if formed is not None and formed(says):
            known[word] = says
        elif word not in NOTES:
            unchecked.append(word)

    if "type" in known:
        listed = known["type"] if isinstance(known["type"], list) else [known["type"]]
        if not any(_KINDS[kind](value) for kind in listed):
            return [f"{path}: type"], unchecked
    for word, says in known.items():
        if word in _PLAIN:
            _, about, holds, said = _PLAIN[word]
            if about(value) and not holds(value, says):
                wrong.append(f"{path}: {said}")
    if "$ref" in known:
        reference = known["$ref"]
        part = _target(root, reference)
        if part is None or reference in followed:
            unchecked.append("$ref")
        else:
            found, left = _check(value, part, root, path, (*followed, reference), depth + 1, work)
            wrong += found
            unchecked += left
    for part in known.get("allOf", ()):
        wrong += inside(value, part, path, True)
    if "anyOf" in known and all(inside(value, part, path, True) for part in known["anyOf"]):
        wrong.append(f"{path}: any of")
    if "oneOf" in known and sum(not inside(value, part, path, True) for part in known["oneOf"]) != 1:
        wrong.append(f"{path}: one of")
    if "not" in known and not inside(value, known["not"], path, True):
        wrong.append(f"{path}: not")
    if isinstance(value, list) and "items" in known:
        for i, x in enumerate(value):
            wrong += inside(x, known["items"], f"{path}[{i}]")
    if isinstance(value, dict):
        wrong += [f"{path}.{name}: missing" for name in known.get("required", ()) if name not in value]
        named, shaped = known.get("properties", {}), known.get("patternProperties", {})
        for name, x in value.items():
            parts = [named[name]] if name in named else []
            parts += [part for pattern, part in shaped.items() if re.search(pattern, name)]
            for part in parts:
                wrong += inside(x, part, f"{path}.{name}")
            if not parts and known.get("additionalProperties") is False:
                wrong.append(f"{path}.{name}: unknown")
            elif not parts and "additionalProperties" in known:
                wrong += inside(x, known["additionalProperties"], f"{path}.{name}")
    return wrong, unchecked
