"""Exact sums and quotients of numbers of any length, as texts of SQL expressions.

A number is cut into limbs of ``WIDE`` digits, counted from the point: limb 0 holds the lowest digits of the whole part,
limb -1 the first ones behind the point. Limbs of the same place are added up as decimals, with partial sums wherever they
are grouped; what a place carries over is settled once, at the end. Everything is built-in expressions on short arrays of
(limb, piece), so numbers that fit elsewhere never come here.

Texts go in and come out, for ``F.expr``: the expressions are deep, and one text is read much faster than they can be put
together call by call. Values used twice are bound by a ``transform`` over one element, which is also interpreted and so
does not swell the generated code. Columns named in an argument must not have the name of a new column beside them.
"""

from __future__ import annotations

WIDE = 15
_WHOLE = "decimal(38,0)"
_BASE = f"1{'0' * WIDE}BD"
_ZERO = f"cast(0 as {_WHOLE})"


def _let(name: str, value: str, body: str) -> str:
    return f"transform(array({value}), {name} -> {body})[0]"


def _whole(value: str) -> str:
    return f"cast({value} as {_WHOLE})"


def limb(place: str, piece: str) -> str:
    return f"named_struct('limb', {place}, 'piece', {_whole(piece)})"


def pieces(text: str) -> str:
    """The limbs of a number written as digits with an optional sign in front and an optional point; always a limb 0."""
    left = f"cast(substring(lpad(x.w, x.n * {WIDE}, '0'), (x.n - k - 1) * {WIDE} + 1, {WIDE}) as decimal(15,0))"
    right = f"cast(substring(rpad(x.b, x.m * {WIDE}, '0'), k * {WIDE} + 1, {WIDE}) as decimal(15,0))"
    cut = (
        f"concat(transform(array_repeat(0, x.n), (z, k) -> {limb('k', f'x.s * {left}')}), "
        f"transform(array_repeat(0, x.m), (z, k) -> {limb('-k - 1', f'x.s * {right}')}))"
    )
    parts = "named_struct('s', if(startswith(t, '-'), -1BD, 1BD), 'w', substring_index(ltrim('+-', t), '.', 1), 'b', regexp_extract(t, '[.](.*)', 1))"
    sized = (
        f"named_struct('s', y.s, 'w', y.w, 'b', y.b, 'n', greatest(int(ceil(length(y.w) / {WIDE})), 1), "
        f"'m', int(ceil(length(y.b) / {WIDE})))"
    )
    return f"if({text} is null, null, {_let('t', text, _let('y', parts, _let('x', sized, cut)))})"


def _dense(limbs: str, low: str) -> str:
    """The sum of each place from ``low`` up, and three places above for what is carried there."""
    top = f"greatest(coalesce(array_max(transform({limbs}, x -> x.limb)), 0), 0)"
    mine = f"aggregate(filter({limbs}, x -> x.limb = k + {low}), {_ZERO}, (u, x) -> {_whole('u + x.piece')})"
    return f"transform(array_repeat(0, {top} - {low} + 4), (z, k) -> {mine})"


def _settled(dense: str) -> str:
    """``out``: every place between 0 and the base; ``carry``: what is left, -1 if the number is negative."""
    start = f"named_struct('carry', {_ZERO}, 'out', cast(array() as array<{_WHOLE}>))"
    rest = f"named_struct('carry', {_whole(f'{_whole('v - r')} / {_BASE}')}, 'out', concat(s.out, array(r)))"
    step = _let("v", _whole("s.carry + p"), _let("r", _whole(f"pmod(v, {_whole(_BASE)})"), rest))
    return f"aggregate({dense}, {start}, (s, p) -> {step})"


def _signed(dense: str) -> str:
    """``negative`` and ``out``, the places of the absolute value."""
    negated = _settled(f"transform(d, q -> {_whole('-q')})")
    both = f"named_struct('negative', e.carry < 0, 'out', if(e.carry < 0, {negated}.out, e.out))"
    return _let("d", dense, _let("e", _settled("d"), both))


def _plain(digits: str) -> str:
    """Without zeros in front."""
    return f"regexp_replace({digits}, '^0+(?=[0-9])', '')"


def total_text(limbs: str) -> str:
    """The number that the limbs add up to, as text; a point only where a place behind it is held."""
    digits = f"array_join(transform(reverse(g.out), q -> lpad(cast(q as string), {WIDE}, '0')), '')"
    whole = _plain(f"substring(h, 1, length(h) + low * {WIDE})")
    written = f"concat(if(g.negative, '-', ''), {whole}, if(low < 0, concat('.', substring(h, length(h) + low * {WIDE} + 1)), ''))"
    lowest = "least(coalesce(array_min(transform(a, x -> x.limb)), 0), 0)"
    size = _let("g", _signed(_dense("a", "low")), _let("h", digits, written))
    return _let("a", limbs, _let("low", lowest, size))


def rounded_quotient_text(limbs: str, count: str) -> str:
    """The whole number nearest to the sum of the limbs, none behind the point, over ``count``, as text; halves away from 0."""
    n = f"cast(nullif(cast({count} as bigint), 0L) as decimal(19,0))"
    twice = f"transform(concat(g.out, array({_ZERO})), (q, k) -> {_whole('q * 2 + if(k = 0, c.n, cast(0 as decimal(19,0)))')})"
    start = f"named_struct('rest', {_ZERO}, 'out', '')"
    part = f"lpad(cast({_whole(f'{_whole("v - r")} / c.m')} as string), {WIDE}, '0')"
    step = _let(
        "v", _whole(f"s.rest * {_BASE} + p"), _let("r", _whole("v % c.m"), f"named_struct('rest', r, 'out', concat(s.out, {part}))")
    )
    whole = _plain(f"aggregate(reverse({_settled(twice)}.out), {start}, (s, p) -> {step}).out")
    signed = _let("w", whole, "concat(if(g.negative and w <> '0', '-', ''), w)")
    counts = _let("o", n, "named_struct('n', o, 'm', cast(o * 2BD as decimal(20,0)))")
    return _let("a", limbs, _let("c", counts, _let("g", _signed(_dense("a", "0")), signed)))


_SHAPE = r"r'^[\x00-\x20]*([+-]?)([0-9]*)(?:[.]([0-9]*))?(?:[eE]([+-]?[0-9]{1,3}))?[\x00-\x20]*$'"
_NUMBER = r"r'^[\x00-\x20]*[+-]?(?:[0-9]+[.]?[0-9]*|[.][0-9]+)(?:[eE][+-]?[0-9]{1,3})?[\x00-\x20]*\z'"
_UNSIGNED = r"r'^[0-9]+(?:[.][0-9]*)?\z'"


def is_number(text: str) -> str:
    """Digits with an optional point, sign and exponent of up to three digits, spaces around it."""
    return f"({text} rlike {_NUMBER})"


def rounded_units(text: str, scale: str) -> str:
    """A number as text, times 10^scale and rounded to whole, halves away from zero; null if the text is no number.

    Digits behind the scale only decide the rounding, so the first of them is enough. Digits without sign and exponent and
    with no more places than the scale, nearly all numbers, only have zeros put behind; the others are taken apart.
    """
    names = ("s", "w", "b", "e")
    read = ", ".join(f"'{name}', regexp_extract(t, {_SHAPE}, {k})" for k, name in enumerate(names, 1))
    point = f"length(x.w) + coalesce(int(nullif(x.e, '')), 0) + {scale}"
    moved = f"named_struct('s', x.s, 'd', concat(x.w, x.b), 'p', {point})"
    cut = (
        "named_struct('s', y.s, 'kept', concat('0', if(y.p > 0, rpad(substring(y.d, 1, y.p), y.p, '0'), '')), "
        "'up', y.p >= 0 and substring(y.d, y.p + 1, 1) >= '5')"
    )
    # One more: the last digit below 9 grows, the nines behind it become zeros.
    head = _let("h", "rtrim('9', c.kept)", "concat(substring(h, 1, length(h) - 1), string(int(right(h, 1)) + 1))")
    size = _plain(f"if(c.up, rpad({head}, length(c.kept), '0'), c.kept)")
    signed = _let("w", size, "concat(if(c.s = '-' and w <> '0', '-', ''), w)")
    parsed = _let("x", f"named_struct({read})", _let("y", moved, _let("c", cut, signed)))
    whole = f"substring_index({text}, '.', 1)"
    behind = f"substring({text}, length({whole}) + 2)"
    plain = f"concat({whole}, rpad({behind}, {scale}, '0'))"
    plain = f"if(startswith({text}, '0'), {_plain(plain)}, {plain})"
    is_plain = f"{text} rlike {_UNSIGNED} and length({behind}) <= {scale}"
    return f"case when {is_plain} then {plain} when {is_number(text)} then {_let('t', text, parsed)} end"
