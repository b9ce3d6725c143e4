"""The 30 signals: item codes, text rules and scale of each."""

from __future__ import annotations

from dataclasses import dataclass

# How a rule looks at the text. Texts are folded to lower case first; the patterns that the pipelines match as written
# hold no letters, so folding changes nothing for them.
IS = "is"  # the whole text
HAS = "has"  # contains
LEADS = "leads"  # starts with

# What a rule does besides writing a constant.
MISSING = None  # the reading has no value
STRIP = "strip"  # take out the words of UPPER_BOUND
PERCENT = "percent"  # a fraction written ".5" or ".25" becomes 50 or 25

# The text shapes the readings are known to take.
NUMERIC_TEXT = r"^([0-9]+[.]?[0-9]*|[.][0-9]+)\z"
PLAIN_TEXT = r"^[0-9]+([.][0-9]*)?\z"  # what nearly every reading looks like
SHORT_TEXT = r"^[0-9]{1,7}([.][0-9]*)?\z"  # plain, and fewer than 10^9 units at any scale
UPPER_BOUND = "GREATER THAN "
GLUCOSE_MARKS = ("cs", "fs", "\\")
CELSIUS_ITEMS = (223762, 676)
HEIGHT_ITEM = 226730
WEIGHT_ITEM = 3693

@dataclass(frozen=True)
class Signal:
    """One output column of the panel.

    ``rules`` are tried in order and the first that matches decides; a text that matches none is kept.
    ``numeric_only`` drops what is not plain digits afterwards, ``marks`` are taken out of the folded text first and
    ``drop_missing`` removes readings without a value instead of filling them.
    """

    name: str
    source: str
    items: tuple[int, ...]
    scale: int = 2
    rules: tuple[tuple[str, str, str | None], ...] = ()
    numeric_only: bool = True
    marks: tuple[str, ...] = ()
    drop_missing: bool = False


def _chart(name, *items, **more):
    return Signal(name, "chart", items, scale=0, **{"numeric_only": False, **more})


def _lab(name, *items, **more):
    return Signal(name, "lab", items, **more)


_DASH = (IS, "-", MISSING)
_BOUND = (HAS, "g", STRIP)

# Names, item codes and text rules of the signals, in pipeline order.
SIGNALS: tuple[Signal, ...] = (
    _chart("heart_rate", 211, 220045),
    _chart("respiratory_rate", 618, 615, 220210, 224690, rules=((HAS, ">60", "60"),)),
    _chart("diastolic_blood_pressure", 8368, 8440, 8441, 8555, 220180, 220051),
    _chart("systolic_blood_pressure", 51, 442, 455, 6701, 220179, 220050),
    _chart("body_temperature", 223762, 676, 223761, 678),
    _chart(
        "blood_glucose", 807, 811, 1529, 3745, 3744, 225664, 220621, 226537,
        rules=(
            (IS, "", MISSING),
            (HAS, ",", MISSING),
            (HAS, "``", MISSING),
            (IS, "'174", "174"),
        ),
        numeric_only=True, marks=GLUCOSE_MARKS, drop_missing=True,
    ),
    _chart("spo2", 646, 220277),
    _chart("glascow_coma_scale", 198),
    _chart("fio2", 3420, 190, 3422, 3421, 8517, 186, 185, 189, rules=((LEADS, ".", PERCENT),)),
    _lab("blood_oxygen_saturation", 50817, 50816, scale=0, rules=((HAS, "dis", MISSING),)),
    _lab("ph", 50820, rules=((HAS, "c", MISSING), _BOUND)),
    _lab("po", 50821, rules=((HAS, "q", MISSING), _BOUND)),
    _lab("pco", 50818, rules=((HAS, "e", MISSING), _BOUND)),
    _lab("co", 50804, rules=(_DASH, (HAS, "-", MISSING), _BOUND)),
    _lab("agap", 50868, rules=(_DASH, (HAS, "-", MISSING), _BOUND)),
    _lab("albu", 50862, rules=(
        _DASH, (HAS, "add", MISSING), (HAS, "less than", "1.00"), (HAS, "<1", "1.00"), _BOUND)),
    _lab("bica", 50882, rules=(
        _DASH, (HAS, "un", MISSING), (HAS, "less than 5", "5.00"), (HAS, "greater than 50", "50.00"),
        (HAS, "greater than 45", "45.00"), (HAS, ">50", "50.00"), _BOUND)),
    _lab("sodi", 50983, rules=(
        _DASH, (HAS, "disre", MISSING), (HAS, "less than 10", "10.00"), (HAS, "greater than 180", "180.00"),
        (HAS, "greater than 45", "45.00"), (HAS, ">180", "180.00"), _BOUND)),
    _lab("pota", 50971, rules=(
        _DASH, (HAS, "e", MISSING), (HAS, "less than 10", "10.00"), (HAS, "greater than 10", "10.00"),
        (HAS, "greater than 45", "45.00"), (HAS, "<1.0", "1.0"), _BOUND)),
    _lab("chlor", 50902, rules=(
        _DASH, (HAS, "e", MISSING), (HAS, "less than 10", "10.00"), (HAS, "greater than 140", "140.00"),
        (HAS, "greater than 45", "45.00"), (HAS, ">140", "140.0"), _BOUND)),
    _lab("lacta", 50813, rules=(
        _DASH, (HAS, "unab", MISSING), (HAS, "less than 10", "10.00"), (HAS, "greater than 30", "30.00"),
        (HAS, "greater than 45", "45.00"), (HAS, ">30", "30.0"), _BOUND)),
    _lab("creatin", 50912, rules=(
        _DASH, (HAS, "v", MISSING), (HAS, "less than 0.6", "0.60"), (HAS, "greater than 30", "30.00"),
        (HAS, "greater than 45", "45.00"), (HAS, "<0.5", "0.50"), _BOUND)),
    _lab("ureanit", 51006, rules=(
        _DASH, (HAS, "una", MISSING), (HAS, "less than 0.6", "0.60"), (HAS, "greater than 30", "30.00"),
        (HAS, "greater than 45", "45.00"), (HAS, "<0.5", "0.50"), _BOUND)),
    _lab("partialt", 51275, rules=(
        _DASH, (HAS, "e", MISSING), (HAS, "less than 0.6", "0.60"), (HAS, "greater than 30", "30.00"),
        (HAS, "greater than 45", "45.00"), (HAS, "26..", "26.00"), _BOUND)),
    _lab("interrat", 51237, rules=(
        _DASH, (HAS, "a", MISSING), (HAS, "less than 0.6", "0.60"), (HAS, "greater than 15.7", "15.70"),
        (HAS, "greater than 45", "45.00"), (HAS, ">23.", "23.70"), _BOUND)),
    _lab("bilirut", 50885, rules=(
        _DASH, (HAS, "a", MISSING), (HAS, "less than 2.0", "2.00"), (HAS, "greater than 2.0", "2.00"),
        (HAS, "greater than 45", "45.00"), (HAS, ">23.", "23.70"), _BOUND)),
    _lab("hemogt", 51222, rules=(
        _DASH, (HAS, "e", MISSING), (HAS, "less than 2.0", "2.00"), (HAS, "greater than 2.0", "2.00"),
        (HAS, "greater than 45", "45.00"), (HAS, ">23.", "23.70"), _BOUND)),
    _lab("hematt", 51221, rules=(
        _DASH, (HAS, "e", MISSING), (HAS, "less than 2.0", "2.00"), (HAS, "greater than 2.0", "2.00"),
        (HAS, "greater than 45", "45.00"), (HAS, ">23.", "23.70"), _BOUND)),
    _lab("wbcet", 51301, rules=(
        _DASH, (HAS, "e", MISSING), (HAS, "less than 2.0", "2.00"), (HAS, "greater than 2.0", "2.00"),
        (HAS, "greater than 45", "45.00"), (HAS, "<0.1", "0.10"), _BOUND)),
    _lab("calc", 50893),
)

CODE_OF = {signal.name: code for code, signal in enumerate(SIGNALS)}
NAME_OF = dict(enumerate(signal.name for signal in SIGNALS))
