"""Readings: extraction, text cleaning, mean fill and daily means.

A reading is carried as a whole number of units: the value times 10**scale of its signal. Up to nine digits, nearly all
readings, are a long in ``units``; longer ones, of any length, are digits in ``long_units``, and are added up limb by limb.
Sums of units are exact, so every later mean is one division and does not depend on the order in which tasks add up.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daypanel.functions import digits, limbs
from daypanel.functions.numbers import rounded_quotient
from daypanel.operators import registry as R
from daypanel.session import spread
from daypanel.sources.schemas import KEYS

SPINE_BITS = 1 << 24  # of the filter of days: 262,144 words of 64

NO_SIGNAL = -1  # stands for "this day is on the spine"

_SLOTS = max(len(spec.rules) for spec in R.SIGNALS)
_FENCE = "\u0003"
_SHORT_DIGITS = 9
_LONG_FAHRENHEIT = limbs.rounded_quotient_text(
    f"concat(transform({limbs.pieces('_digits')}, x -> {limbs.limb('x.limb', 'x.piece * 18BD')}), array({limbs.limb('0', '320')}))",
    "10",
)
#: All limbs of a tally: the sum of the short readings belongs to limb 0.
_SUM = f"concat(array({limbs.limb('0', 'coalesce(total, 0)')}), long_limbs)"
_STAY_SUM = f"concat(array({limbs.limb('0', 'coalesce(_stay_total, 0)')}), _stay_limbs)"
_KEEP = "keep"
_DROPPING = [code for code, spec in enumerate(R.SIGNALS) if spec.drop_missing]
_DROPPING_CONSTANTS = [
    pattern for code in _DROPPING for kind, pattern, outcome in R.SIGNALS[code].rules if kind == R.IS and outcome
]


def signal_items(readings: DataFrame, source: str | None = None) -> DataFrame:
    """Item code -> signal code, a few dozen rows."""
    pairs = [
        f"({item}, {code})"
        for code, spec in enumerate(R.SIGNALS)
        if source in (None, spec.source)
        for item in spec.items
    ]
    return readings.sparkSession.sql(f"select * from values {', '.join(pairs)} as items(itemid, signal)")


def tag_signals(readings: DataFrame, source: str | None = None, dictionary: DataFrame | None = None) -> DataFrame:
    """Readings of the registered items with their signal code and calendar day.

    All signals of a source are taken from one scan: the item list reaches the scan as a filter, the code comes from a
    broadcast of the fixed item table. With ``dictionary`` the item must be listed there; after the item filter that
    side has no more rows than the registry has items. A reading without admission or time can meet no day and is left
    out here.
    """
    items = signal_items(readings, source)
    if dictionary is not None:
        listed = dictionary.filter(F.col("itemid").isin(_codes(source))).select("itemid").distinct()
        items = items.join(F.broadcast(listed), "itemid", "left_semi")
    return (
        readings.filter(F.col("itemid").isin(_codes(source)))
        .filter(F.col("hadm_id").isNotNull() & F.col("charttime").isNotNull())
        .join(F.broadcast(items), "itemid")
        .withColumn("startdate", F.to_date("charttime"))
    )


def _codes(source: str | None) -> list[int]:
    return [item for spec in R.SIGNALS if source in (None, spec.source) for item in spec.items]


def on_spine(tagged: DataFrame, spine: DataFrame) -> DataFrame:
    """Readings taken on a day of the spine. A day with very many readings is split over tasks by the adaptive join."""
    return tagged.join(spine, KEYS, "left_semi")


def near_spine(tagged: DataFrame, spine: DataFrame, bits: int = SPINE_BITS) -> DataFrame:
    """Readings whose day may be on the spine: all that are, and a few others.

    A Bloom filter with one hash, in words of 64 bits: at most ``bits / 64`` rows are broadcast, however many days there
    are. It stands in front of the cleaning, so that texts of other days are not cleaned; what uses the readings still
    restricts them to the spine itself. A share of days over ``bits`` of the others passes, so with more days than bits
    the filter only costs its look-up.
    """
    bit = F.pmod(F.xxhash64(*KEYS), F.lit(bits))
    word, place = F.shiftright(bit, 6).alias("_word"), (bit % 64).cast("int").alias("_place")
    words = spine.select(word, place).groupBy("_word").agg(F.bit_or(F.expr("shiftleft(1L, _place)")).alias("_set"))
    met = tagged.select("*", word, place).join(F.broadcast(words), "_word")
    return met.filter("shiftright(_set, _place) & 1 = 1").select(*tagged.columns)


def _quoted(text: str | None) -> str:
    return "cast(null as string)" if text is None else "r'" + text + "'" if "'" not in text else f'r"{text}"'


def rule_table(readings: DataFrame) -> DataFrame:
    """One row per signal with its rules side by side, 30 rows.

    Rule k is a ``needle_k`` to look for and an ``outcome_k``. All rule kinds become one kind of search by fencing the
    text: the needle of "is" has a fence on both sides, that of "leads" one in front.
    """
    fence = {R.IS: (_FENCE, _FENCE), R.LEADS: (_FENCE, ""), R.HAS: ("", "")}
    rows = []
    for code, spec in enumerate(R.SIGNALS):
        cells = [str(code), str(spec.scale), str(spec.numeric_only).lower(), str(bool(spec.marks)).lower()]
        for k in range(_SLOTS):
            kind, pattern, outcome = spec.rules[k] if k < len(spec.rules) else (None, None, None)
            needle = None if kind is None else fence[kind][0] + pattern + fence[kind][1]
            cells += [_quoted(needle), _quoted(outcome)]
        rows.append(f"({', '.join(cells)})")
    names = ["signal", "_scale", "_numeric_only", "_marked"]
    names += [f"_{part}_{k}" for k in range(_SLOTS) for part in ("needle", "outcome")]
    return readings.sparkSession.sql(f"select * from values {', '.join(rows)} as rules({', '.join(names)})")


def _without_marks(value: Column) -> Column:
    text = F.lower(value)
    for mark in R.GLUCOSE_MARKS:
        text = F.replace(text, F.lit(mark), F.lit(""))
    return text


def clean_units(tagged: DataFrame, strict: bool = False) -> DataFrame:
    """Add ``units`` and ``long_units`` to tagged readings, without those whose signal does not keep missing values.

    A text that is no number after its rules gives null, or an error with ``strict``. What is dropped is decided on the
    raw text: a filter on ``units`` would be pushed down by copying all of the cleaning into the filter.
    """
    text = _without_marks(F.col("value"))
    usable = text.rlike(R.NUMERIC_TEXT) | text.isin(*_DROPPING_CONSTANTS)
    return with_units(tagged.filter(~F.col("signal").isin(_DROPPING) | usable), strict)


def with_units(tagged: DataFrame, strict: bool = False) -> DataFrame:
    """Add ``units`` and ``long_units``, one of them null, and keep every reading.

    The rules come as columns of a broadcast table, so the generated code holds one short chain of searches instead of
    one chain per signal. No rule of any signal matches digits that start with a digit, so short texts of that kind,
    nearly all of them, pass after one test and are read as small decimals; only the others are folded, fenced and
    searched, and only what is not short after its rule is taken apart digit by digit.
    """
    text, fenced = F.col("_text"), F.col("_fenced")
    ruled = tagged.join(F.broadcast(rule_table(tagged)), "signal").withColumn(
        "_text", F.when(F.col("_marked"), _without_marks(F.col("value"))).otherwise(F.col("value"))
    )
    odd = F.when(~text.rlike(R.SHORT_TEXT), F.concat(F.lit(_FENCE), F.lower(text), F.lit(_FENCE)))
    hit = F.when(fenced.isNull(), F.lit(_KEEP))
    for k in range(_SLOTS):
        hit = hit.when(fenced.contains(F.col(f"_needle_{k}")), F.col(f"_outcome_{k}"))
    hit = hit.when(~F.col("_numeric_only") | text.rlike(R.NUMERIC_TEXT), F.lit(_KEEP))

    stripped = F.replace(text, F.lit(R.UPPER_BOUND), F.lit(""))
    fraction = F.regexp_extract(text, "^[.][0-9]{1,2}", 0).try_cast("decimal(4,2)")
    outcome = F.col("_hit")
    settled = (
        F.when(outcome == _KEEP, text)
        .when(outcome == R.STRIP, F.when(stripped.rlike(R.NUMERIC_TEXT), stripped))
        .when(outcome == R.PERCENT, (fraction * 100).cast("string"))
        .otherwise(outcome)
    )

    kept, scale, number = F.col("_settled"), F.col("_scale"), F.col("_number")
    whole = kept.try_cast("decimal(8,0)").cast("bigint")
    hundredths = (kept.try_cast("decimal(10,2)") * 100).cast("bigint")
    quick = F.when(scale == 0, whole).otherwise(hundredths)
    units = F.expr(limbs.rounded_units("_settled", "_scale"))
    if strict:  # the cast of a text that is no number raises
        fine = kept.isNull() | F.expr(limbs.is_number("_settled"))
        units = F.when(fine, units).otherwise(kept.cast("decimal(38,2)").cast("string"))
    long = F.col("_digits")
    is_long = F.length(long) > _SHORT_DIGITS

    # After rounding: Celsius to Fahrenheit, rounded again, and a fraction of one written as "1" is the full percentage.
    celsius = F.col("itemid").isin(*R.CELSIUS_ITEMS)
    one = (F.col("signal") == R.CODE_OF["fio2"]) & (number == 1)
    fahrenheit = rounded_quotient(number * 18 + 320, F.lit(10))
    final = F.when(celsius, fahrenheit).when(one, F.lit(100).cast("bigint")).otherwise(number)
    return (
        ruled.withColumn("_fenced", odd)
        .withColumn("_hit", hit)
        .withColumn("_settled", settled)
        .withColumn("_quick", F.coalesce(F.col("_fenced").isNull() | kept.rlike(R.SHORT_TEXT), F.lit(False)))
        .withColumn("_digits", F.when(~F.col("_quick"), units))
        .withColumn("_number", F.when(F.col("_quick"), quick).when(~is_long, long.cast("bigint")))
        .withColumn("_long", F.when(is_long & celsius, F.expr(_LONG_FAHRENHEIT)).when(is_long, long))
        .select(*tagged.columns, final.alias("units"), F.col("_long").alias("long_units"))
    )


def in_doubles(units: Column, long_units: Column, signal: Column) -> Column:
    """The value of a reading."""
    return F.coalesce(units.cast("double"), long_units.cast("double")) / unit_size(signal).cast("double")


def unit_size(signal: Column) -> Column:
    """Units per one, from the scale of the signal."""
    whole = [code for code, spec in enumerate(R.SIGNALS) if spec.scale == 0]
    return F.when(signal.isin(whole), F.lit(1)).otherwise(F.lit(100)).cast("bigint")


def signal_name(signal: Column) -> Column:
    return F.element_at(F.array(*[F.lit(spec.name) for spec in R.SIGNALS]), signal + 1)


def _limb_tally(cleaned: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Per key and limb the sum of the pieces of long readings, and with limb 0 what there is of the others.

    Short units add up in 64 bits, which hold a billion of them; only a long reading becomes several rows. Partial sums are
    made before the shuffle.
    """
    units, long, cut = F.col("units"), F.col("long_units"), F.col("_cut.limb")
    return (
        cleaned.select("*", F.explode_outer(F.expr(limbs.pieces("long_units"))).alias("_cut"))
        .groupBy(*keys, F.coalesce(cut, F.lit(0)).alias("limb"))
        .agg(
            F.sum(units).alias("total"),
            F.sum("_cut.piece").cast("decimal(38,0)").alias("piece"),
            (F.count(units) + F.count_if(cut == 0)).alias("n_valued"),
            F.count_if(units.isNull() & long.isNull() & ~F.col("signal").isin(_DROPPING)).alias("n_missing"),
        )
    )


def _limbs_over(window) -> Column:
    """The limbs of the long readings of all rows of a window; none where every reading is short."""
    return F.collect_list(F.when(F.col("piece").isNotNull(), F.struct("limb", "piece"))).over(window)


def reading_tally(cleaned: DataFrame, keys: Iterable[str] = ("hadm_id", "startdate", "signal")) -> DataFrame:
    """Sum of units, readings with and without a value per key.

    The sum is ``total`` for the short readings and, where there are long ones, ``long_totals``; see ``tally_digits``. Rows
    of a key are added up chunk by chunk before the shuffle, the long ones as whole numbers, so a key with very many
    readings sends a row for each chunk. No reading is cut into limbs.
    """
    keys = list(keys)
    missing = F.col("units").isNull() & F.col("long_units").isNull() & ~F.col("signal").isin(_DROPPING)
    rows = cleaned.select(*keys, "units", "long_units", missing.cast("bigint").alias("_missing"))
    sums = "total bigint, long_total string, n_valued bigint, n_missing bigint"
    schema = T.StructType([*rows.select(*keys).schema, *T.StructType.fromDDL(sums)])

    def add(batches):
        for chunk in digits.chunks(batches):
            is_long = pc.is_valid(chunk["long_units"])
            parts = chunk.filter(pc.invert(is_long)).group_by(keys, use_threads=False)
            parts = parts.aggregate([("units", "sum"), ("units", "count"), ("_missing", "sum")])
            yield from as_sums(parts, parts["units_sum"], None, parts["units_count"], parts["_missing_sum"])
            parts = chunk.filter(is_long).group_by(keys, use_threads=False)
            parts = parts.aggregate([("long_units", "list"), ("long_units", "count")])
            totals = digits.added(parts["long_units_list"].combine_chunks())
            yield from as_sums(parts, None, totals, parts["long_units_count"], np.zeros(len(totals), np.int64))

    def as_sums(parts, total, long_total, n_valued, n_missing):
        cells = [
            pa.nulls(parts.num_rows, pa.int64()) if total is None else total,
            pa.nulls(parts.num_rows, pa.string()) if long_total is None else long_total,
            n_valued,
            n_missing,
        ]
        return pa.table([*(parts[key] for key in keys), *cells], names=schema.fieldNames()).to_batches()

    return (
        rows.mapInArrow(add, schema)
        .groupBy(*keys)
        .agg(
            F.sum("total").alias("total"),
            F.collect_list("long_total").alias("long_totals"),
            F.sum("n_valued").alias("n_valued"),
            F.sum("n_missing").alias("n_missing"),
        )
    )


def tally_digits(tally: DataFrame) -> DataFrame:
    """``reading_tally`` with ``digits``, the sum, and ``rounded_mean``, the mean rounded to whole units, as text."""
    total = F.col("total")
    mean = rounded_quotient(total, F.col("n_valued"))
    quick = tally.withColumns({"digits": total.cast("string"), "rounded_mean": mean.cast("string")})

    def settle(batches):
        for batch in batches:
            is_long = pc.greater(pc.list_value_length(batch["long_totals"]), 0)
            long = batch.filter(is_long)
            found = digits.totals_and_means(*(long[name] for name in ("long_totals", "total", "n_valued")))
            for name, texts in zip(("digits", "rounded_mean"), found):
                cells = pc.replace_with_mask(batch[name], is_long, pa.array(texts, pa.string()))
                batch = batch.set_column(batch.schema.get_field_index(name), name, cells)
            yield batch

    return quick.mapInArrow(settle, quick.schema)


def spine_tally(cleaned: DataFrame, spine: DataFrame) -> DataFrame:
    """The tally of readings on spine days with the admission's mean of the signal rounded to its scale.

    The mean is ``fill``, or digits in ``long_fill`` for a stay with long readings. Every spine day also has one row with
    signal ``NO_SIGNAL``, readings or not. The spine comes in as such rows of the same table instead of through a join, so
    that one exchange by admission serves the restriction to spine days, the fill, and whatever is grouped or joined by
    admission or by day afterwards. An admission has at most one row per calendar day and signal here, and a few more for
    long readings, however many readings it has, which bounds the window partitions. The exchange has as many partitions as
    the stored size asks for, so that the memory of the three sorts of a task does not grow with the input.
    """
    nothing = F.lit(0).cast("bigint")
    days = spine.select(
        *KEYS,
        F.lit(NO_SIGNAL).alias("signal"),
        F.lit(0).alias("limb"),
        F.lit(None).cast("bigint").alias("total"),
        F.lit(None).cast("decimal(38,0)").alias("piece"),
        nothing.alias("n_valued"),
        nothing.alias("n_missing"),
    )
    cell, day, stay = Window.partitionBy(*KEYS, "signal"), Window.partitionBy(*KEYS), Window.partitionBy("hadm_id", "signal")
    short, mean = F.size("_stay_limbs") == 0, rounded_quotient(F.col("_stay_total"), F.col("_stay_valued"))
    rows = _limb_tally(cleaned, [*KEYS, "signal"]).unionByName(days)
    return (
        spread(rows, "hadm_id", cleaned, spine)
        .withColumns({"long_limbs": _limbs_over(cell), "_on_spine": F.max(F.col("signal") == NO_SIGNAL).over(day)})
        .filter("_on_spine")
        .withColumns(
            {
                "_stay_total": F.sum("total").over(stay),
                "_stay_valued": F.sum("n_valued").over(stay),
                "_stay_limbs": _limbs_over(stay),
            }
        )
        .filter("limb = 0")
        .withColumns(
            {
                "fill": F.when(short, mean),
                "long_fill": F.when(~short, F.expr(limbs.rounded_quotient_text(_STAY_SUM, "_stay_valued"))),
            }
        )
        .select(*KEYS, "signal", "total", "long_limbs", "n_valued", "n_missing", "fill", "long_fill")
    )


def mean_after_fill(tally: DataFrame) -> Column:
    """Mean of a day in which every missing reading counts as the fill; null when the admission has no value at all."""
    total, missing, fill = (F.coalesce(tally[name], F.lit(0).cast("bigint")) for name in ("total", "n_missing", "fill"))
    size, n = unit_size(tally["signal"]), tally["n_valued"] + missing
    fills = f"transform({limbs.pieces('long_fill')}, x -> {limbs.limb('x.limb', 'x.piece * n_missing')})"
    long = F.expr(limbs.total_text(f"concat({_SUM}, {fills})")).cast("double")
    filled = F.when(tally["long_fill"].isNotNull(), long).otherwise((total + missing * fill).cast("double"))
    known = tally["fill"].isNotNull() | tally["long_fill"].isNotNull()
    return F.when((n > 0) & known, filled / (n * size).cast("double"))


def spine_means(cleaned: DataFrame, spine: DataFrame) -> DataFrame:
    """Mean per (admission, day, signal) on spine days, missing readings filled first; keeps the ``NO_SIGNAL`` rows."""
    tally = spine_tally(cleaned, spine)
    return tally.select(*KEYS, "signal", mean_after_fill(tally).alias("mean"))


def daily_signal_mean(cleaned: DataFrame, spine: DataFrame) -> DataFrame:
    """Mean per (admission, day, signal) on spine days, missing readings filled first."""
    return spine_means(cleaned, spine).filter(F.col("signal") != NO_SIGNAL)


def filled_readings(cleaned: DataFrame, spine: DataFrame) -> DataFrame:
    """Every reading on a spine day, missing values replaced by the admission's rounded mean of the signal.

    One join brings both the spine restriction and the fill; its right side has one row per (admission, day, signal),
    and a key with very many readings is split over tasks by the adaptive join.
    """
    keys = [*KEYS, "signal"]
    filled = spine_tally(cleaned, spine).filter(F.col("signal") != NO_SIGNAL).select(*keys, "fill", "long_fill")
    known = F.col("units").isNotNull() | F.col("long_units").isNotNull()
    return cleaned.join(filled, keys).withColumns(
        {
            "units": F.when(known, F.col("units")).otherwise(F.col("fill")),
            "long_units": F.when(known, F.col("long_units")).otherwise(F.col("long_fill")),
        }
    )


def reject_report(tagged: DataFrame) -> DataFrame:
    """Per signal: readings, readings without text, and texts that gave no number."""
    rejected = F.col("value").isNotNull() & F.col("units").isNull() & F.col("long_units").isNull()
    return (
        with_units(tagged)
        .groupBy("signal")
        .agg(
            F.count(F.lit(1)).alias("n_readings"),
            F.count_if(F.col("value").isNull()).alias("n_blank"),
            F.count_if(rejected).alias("n_rejected"),
        )
        .withColumn("signal", signal_name(F.col("signal")))
    )
