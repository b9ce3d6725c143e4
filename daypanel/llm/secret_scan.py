"""Secrets in text: fixed patterns, and character Markov models of random strings against ordinary identifiers.

All of it is DataFrame code. A pattern's matches and the gaps between them come from ``regexp_extract_all`` and
``split``; their places are running sums of lengths over the few rows of texts that have a match.

The models hold, for random strings and for ordinary identifiers, the probability of each character after the one
before, smoothed towards the frequency of the character alone (``BACK_OFF`` pairs). They are trained from labelled samples (``value``, ``label``): by default the
values that the base patterns find in the corpus, all of them, against the identifiers of a bounded sample of its
documents (``SAMPLE_DOCUMENTS``, chosen by hash). A candidate, a long stretch of identifier characters with a letter,
is a secret if its log-likelihood ratio is above ``THRESHOLD`` for each character, unless it touches a base span.

Places are code points, ends exclusive. A null or empty text has no secret. Rows that repeat an id and its text each
get their result. Without labelled samples the models are uniform and add nothing. Extra columns are ignored, or
carried by ``redact``.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import staged
from .textscan import keyed

#: The base patterns in their order, the group that is the secret itself, and its least length. For access
#: and hex the length stands in the pattern: each match is a whole stretch of its characters, and inside one that is too
#: short no other can be long enough, so nothing changes but the short matches, which are many, are never made.
PATTERNS: dict[str, tuple[str, int, int]] = {
    "assign": (r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    "access": (r"AKIA[A-Z0-9]{12,}", 0, 16),
    "hex": (r"[0-9a-f]{32,}", 0, 32),
}
CANDIDATE = r"[A-Za-z0-9+/_=-]{16,}"
ADDED = "random"
KINDS = [*PATTERNS, ADDED]
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"
THRESHOLD = 1.0
BACK_OFF = 5.0
SAMPLE_DOCUMENTS = 4000
ORDINARY = r"[A-Za-z_][A-Za-z0-9_]{3,}"


def _ratio(value: Column, table: list[float]) -> Column:
    """The mean log-likelihood ratio of a string's character pairs; pairs outside the alphabet count as zero."""
    n = len(ALPHABET)
    ratios = F.array(*(F.lit(x) for x in [0.0, *table]))

    def at(i):
        return F.call_function("locate", F.substring(value, i, F.lit(1)), F.lit(ALPHABET))

    def step(total, i):
        one, two = at(i), at(i + 1)
        return total + F.get(ratios, F.when((one > 0) & (two > 0), (one - 1) * n + two).otherwise(0))

    total = F.aggregate(F.sequence(F.lit(1), F.length(value) - 1), F.lit(0.0), step)
    return F.when(F.length(value) > 1, total / (F.length(value) - 1)).otherwise(F.lit(0.0))


def places(rows: DataFrame, pattern: str, kind: str, group: int = 0, least: int = 0) -> DataFrame:
    """(d, k, kind, start, end, value): the matches of a pattern, leftmost and not overlapping, by code points.

    Those whose ``group`` is shorter than ``least`` are dropped afterwards, without another try.
    """
    some = rows.filter(F.col("text").rlike(pattern)).select(
        "d",
        "k",
        F.split("text", pattern, -1).alias("gaps"),
        F.regexp_extract_all("text", F.lit(pattern), F.lit(0)).alias("found"),
        F.regexp_extract_all("text", F.lit(pattern), F.lit(group)).alias("value"),
    )
    return _places(some, kind, F.length("value") >= least)


def _places(some: DataFrame, kind: str, keep: Column) -> DataFrame:
    """From gaps, found and value of each row. Rows that come twice count once."""
    zipped = F.arrays_zip(
        F.transform("found", lambda m, i: F.length(F.get("gaps", i))).alias("gap"),
        F.transform("found", F.length).alias("size"),
        "value",
    )
    each = some.select("d", "k", F.posexplode(zipped).alias("i", "m")).select(
        "d", "k", "i", F.col("m.gap").alias("gap"), F.col("m.size").alias("size"), F.col("m.value").alias("value")
    )
    each = each.dropDuplicates(["d", "k", "i"])
    before = Window.partitionBy("d", "k").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.col("gap") + F.col("size")).over(before)
    return each.withColumn("end", end).filter(keep).select(
        "d", "k", F.lit(kind).alias("kind"), (F.col("end") - F.col("size")).alias("start"), "end", "value"
    )


def base_spans(rows: DataFrame) -> DataFrame:
    """(d, k, kind, start, end, value) of the base patterns, over rows of (d, k, text)."""
    parts = [places(rows, pattern, kind, group, least) for kind, (pattern, group, least) in PATTERNS.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def samples(rows: DataFrame, base: DataFrame, documents: int = SAMPLE_DOCUMENTS) -> DataFrame:
    """(value, label): secrets of the base patterns (1), and identifiers of about ``documents`` texts (0).

    A text with a base span is no source of ordinary identifiers.
    """
    share = max(1, math.ceil(rows.count() / documents))
    some = rows.filter(F.pmod(F.xxhash64("d", "k", F.lit("ordinary")), F.lit(share)) == 0)
    clean = some.join(base.select("d", "k").distinct(), ["d", "k"], "left_anti")
    words = clean.select(F.explode(F.regexp_extract_all("text", F.lit(ORDINARY), F.lit(0))).alias("value"))
    return base.select("value", F.lit(1).alias("label")).unionByName(words.select("value", F.lit(0).alias("label")))


def train(labelled: DataFrame) -> list[float]:
    """Log-likelihood ratios of all pairs of ``ALPHABET``, row by row; at most ``2 * len(ALPHABET) ** 2`` counts come back."""
    inside = f"^[{re.escape(ALPHABET)}]+$"
    pairs = (
        labelled.filter(F.col("value").rlike(inside) & (F.length("value") > 1))
        .select("label", "value", F.explode(F.sequence(F.lit(1), F.length("value") - 1)).alias("i"))
        .groupBy("label", F.substring("value", F.col("i"), F.lit(2)).alias("pair"))
        .count()
    )
    n = len(ALPHABET)
    place = {c: i for i, c in enumerate(ALPHABET)}
    counts = {label: [[0.0] * n for _ in range(n)] for label in (0, 1)}
    for label, pair, count in pairs.collect():
        counts[label][place[pair[0]]][place[pair[1]]] += count
    if not all(any(map(any, rows)) for rows in counts.values()):
        return [0.0] * (n * n)
    chance = {}
    for label, rows in counts.items():
        single = [0.5 + sum(r[b] for r in rows) for b in range(n)]
        single = [x / sum(single) for x in single]
        chance[label] = [(r[b] + BACK_OFF * single[b]) / (sum(r) + BACK_OFF) for r in rows for b in range(n)]
    return [math.log(one / other) for one, other in zip(chance[1], chance[0])]


def added_spans(rows: DataFrame, base: DataFrame, table: list[float], threshold: float = THRESHOLD) -> DataFrame:
    """(d, k, kind, start, end, value): candidates that the models call random and that touch no base span."""
    if not any(table):
        return base.limit(0)
    found = rows.filter(F.col("text").rlike(CANDIDATE)).select(
        "d", "k", "text", F.regexp_extract_all("text", F.lit(CANDIDATE), F.lit(0)).alias("found")
    )
    random = lambda s: F.when(s.rlike("[A-Za-z]"), _ratio(s, table) > threshold).otherwise(False)
    marked = found.withColumn("value", F.transform("found", lambda s: F.when(random(s), s)))
    some = marked.filter(F.exists("value", lambda s: s.isNotNull())).select(
        "d", "k", F.split("text", CANDIDATE, -1).alias("gaps"), "found", "value"
    )
    new = _places(some, ADDED, F.col("value").isNotNull())
    other = base.groupBy("d", "k").agg(F.collect_set(F.struct("start", "end")).alias("others"))
    touches = F.exists("others", lambda o: (o["start"] < F.col("end")) & (F.col("start") < o["end"]))
    clear = new.join(other, ["d", "k"], "left").filter(F.col("others").isNull() | ~touches)
    return clear.select("d", "k", "kind", "start", "end", "value")


def secrets(documents: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """(d, k, kind, start, end, value) of all secrets, base and added."""
    rows = keyed(documents).select("d", "k", "text")
    base = staged(base_spans(rows), "secrets-base")
    table = train(samples(rows, base) if labelled is None else labelled)
    return base.unionByName(added_spans(rows, base, table))


def _listed(spans: DataFrame) -> DataFrame:
    """(d, k, spans): the spans of a text by start, then kind as listed."""
    order = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    one = F.struct("start", order.alias("nth"), "kind", "end")
    return spans.groupBy("d", "k").agg(F.array_sort(F.collect_list(one)).alias("spans"))


def digest(documents: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, n_random, base_sha256, spans."""
    rows = keyed(documents).select("doc_id", "d", "k")
    found = rows.join(_listed(secrets(documents, labelled)), ["d", "k"], "left")
    found = found.withColumn("spans", F.coalesce("spans", F.array()))
    number = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    text = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter("spans", lambda s: s["kind"] != ADDED)
    return found.select(
        "doc_id",
        *(number(kind).alias(f"n_{kind}") for kind in KINDS),
        F.sha2(text(base), 256).alias("base_sha256"),
        text("spans").alias("spans"),
    )


def redact(documents: DataFrame, labelled: DataFrame | None = None, mask: str = "[SECRET]") -> DataFrame:
    """The documents, all columns, with each secret replaced; overlapping ones by one mask. Others are unchanged.

    ``n_chars``, if there is such a column, follows the new text.
    """
    text = F.col("document")["text"]
    key = [F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))), F.coalesce(F.xxhash64("text"), F.lit(0))]
    whole = documents.select(
        F.struct(*(documents[c] for c in documents.columns)).alias("document"), key[0].alias("d"), key[1].alias("k")
    )
    listed = _listed(secrets(documents, labelled))
    # Sorted spans with the furthest end so far; one that starts behind it opens a new gap.
    reach = F.aggregate(
        "spans",
        F.struct(F.lit(0).cast("long").alias("end"), F.array().cast("array<struct<from: bigint, to: bigint>>").alias("gaps")),
        lambda s, x: F.struct(
            F.greatest(s["end"], x["end"].cast("long")).alias("end"),
            F.when(
                (x["start"] > s["end"]) | (F.size(s["gaps"]) == 0),
                F.concat(s["gaps"], F.array(F.struct(s["end"].alias("from"), x["start"].cast("long").alias("to")))),
            )
            .otherwise(s["gaps"])
            .alias("gaps"),
        ),
    )
    joined = whole.join(listed, ["d", "k"], "left").withColumn("cut", reach)
    piece = lambda a, b: F.substring(text, (a + 1).cast("int"), (b - a).cast("int"))
    gaps = F.transform("cut.gaps", lambda g: piece(g["from"], g["to"]))
    rest = F.array(piece(F.col("cut.end"), F.length(text).cast("long")))
    new = F.when(F.col("spans").isNull(), text).otherwise(F.array_join(F.concat(gaps, rest), mask))
    changed = {"text": F.col("new")}
    if "n_chars" in documents.columns:
        length = F.length("new").cast(documents.schema["n_chars"].dataType)
        changed["n_chars"] = F.when(F.col("spans").isNull(), F.col("document")["n_chars"]).otherwise(length)
    joined = joined.withColumn("new", new)
    return joined.select(*(changed.get(c, F.col("document")[c]).alias(c) for c in documents.columns))


def brute_force(text: str | None) -> list[tuple[int, int, int]]:
    """The base spans (start, kind's place, end) with the patterns as given, for tests."""
    plain = [(PATTERNS["assign"][0], 2, 8), ("AKIA[A-Z0-9]+", 0, 16), ("[0-9a-f]+", 0, 32)]
    out = []
    for nth, (pattern, group, least) in enumerate(plain):
        for m in re.finditer(pattern, text or ""):
            if len(m[group]) >= least:
                out.append((m.start(), nth, m.end()))
    return sorted(out)
