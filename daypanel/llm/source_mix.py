"""Mixing sources to target weights: iterative proportional fitting, then a sample by calibrated probabilities.

Documents are counted into cells of (source, lang, topic) with their tokens. Raking scales the cells to each target
marginal in turn, ``ROUNDS`` times; a cell's ratio of wanted to present share is the weight of its documents. The
probability of a document is its weight times a factor, 1 at most; the factor is calibrated so that the expected tokens
are the ``BUDGET`` share of all. A document stays if a number made from its id is below its probability, so a rerun
draws the same sample.

Targets are tempered shares of what is there (``TARGETS``: the exponent of each marginal), or given as shares by value.
A given value that no document has cannot be met and is left out, as are values without a target: they get weight 0.

Tokens are counted as a quarter of the code points, rounded up. A null or empty text has none and weight as its cell.
``fit_report`` tells which targets were met; after ``ROUNDS`` rounds some may not be, and contradicting ones never are.
Null sources or languages are cells of their own, named ``(none)``. Rows that repeat an id fall together. Extra columns
are ignored, or carried by ``mix``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import staged

MARGINS = ("source", "lang", "topic")
#: Exponents of the observed shares; below 1 they favour what is rare.
TARGETS = {"source": 0.5, "lang": 0.7, "topic": 0.8}
ROUNDS = 8
CALIBRATIONS = 12
BUDGET = 0.5
LONG = 4000

#: The topic is the form of a text; the same expression serves Spark and DuckDB.
TOPIC = (
    f"case when text like '%icensed under%' then 'licence' when text like '% | %' then 'table' "
    f"when length(text) >= {LONG} then 'long' else 'prose' end"
)
TOKENS = "cast(floor((coalesce(length(text), 0) + 3) / 4) as bigint)"


def _draw(doc_id: Column) -> Column:
    text = F.coalesce(doc_id.cast("string"), F.lit("(none)"))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("double") / float(1 << 32)


def _features(documents: DataFrame) -> list[Column]:
    none = F.lit("(none)")
    return [
        F.coalesce(F.col("source").cast("string"), none).alias("source"),
        F.coalesce(F.col("lang").cast("string"), none).alias("lang"),
        F.expr(TOPIC).alias("topic"),
        F.expr(TOKENS).alias("n_tokens"),
    ]


def targets(cells: DataFrame, margin: str, exponent: float = 1.0, shares: dict[str, float] | None = None) -> DataFrame:
    """(margin, target): the wanted share of each value that is there."""
    there = cells.groupBy(margin).agg(F.sum("tokens").cast("double").alias("tokens")).filter("tokens > 0")
    if shares is None:
        raw = there.select(margin, F.pow("tokens", F.lit(exponent)).alias("raw"))
    else:
        given = F.create_map(*(x for v, s in shares.items() for x in (F.lit(v), F.lit(float(s)))))
        raw = there.select(margin, F.element_at(given, F.col(margin)).alias("raw")).filter("raw > 0")
    total = raw.agg(F.sum("raw")).first()[0] or 1.0
    return raw.select(margin, (F.col("raw") / F.lit(total)).alias("target"))


def rake(cells: DataFrame, wanted: dict[str, DataFrame], rounds: int = ROUNDS) -> DataFrame:
    """The cells with ``share``: fitted to every marginal in turn.

    The targets are joined once; a marginal is then a sum over the cells that share a value. Each round is written, so
    plans stay short.
    """
    out = cells.withColumn("share", F.col("tokens").cast("double"))
    for margin, target in wanted.items():
        out = out.join(target.withColumnRenamed("target", f"{margin}_target"), margin, "left")
    out = staged(out, "mix-round")
    for _ in range(rounds):
        for margin in wanted:
            present = F.sum("share").over(Window.partitionBy(margin))
            scaled = F.col("share") * F.col(f"{margin}_target") / F.nullif(present, F.lit(0.0))
            out = out.withColumn("share", F.coalesce(scaled, F.lit(0.0)))
        out = staged(out, "mix-round")
    return out.drop(*(f"{margin}_target" for margin in wanted))


def calibrated(cells: DataFrame, budget: float = BUDGET) -> DataFrame:
    """source, lang, topic, weight and probability of each cell.

    The factor grows until the cells that are not taken whole make up for those that are.
    """
    total, share = cells.agg(F.sum("tokens"), F.sum("share")).first()
    total, share = float(total or 0), float(share or 0)
    weight = F.when(F.col("tokens") > 0, F.col("share") / F.lit(share or 1.0) * F.lit(total) / F.col("tokens"))
    weighted = cells.withColumn("weight", F.coalesce(weight, F.lit(0.0)))
    factor = budget
    for _ in range(CALIBRATIONS):
        whole = F.col("weight") * F.lit(factor) >= 1
        full, rest = weighted.agg(
            F.sum(F.when(whole, F.col("tokens")).otherwise(0)), F.sum(F.when(whole, 0.0).otherwise(F.col("tokens") * F.col("weight")))
        ).first()
        if not rest:
            break
        factor = max(factor, (budget * total - float(full)) / float(rest))
    return weighted.select(*MARGINS, "weight", F.least(F.lit(1.0), F.col("weight") * F.lit(factor)).alias("probability"))


def _fitted(documents: DataFrame, shares: dict[str, dict[str, float]] | None) -> tuple[DataFrame, dict[str, DataFrame]]:
    """The raked cells, and the targets they were raked to."""
    rows = documents.select(*_features(documents))
    cells = staged(rows.groupBy(*MARGINS).agg(F.sum("n_tokens").alias("tokens")), "mix-cells")
    wanted = {m: staged(targets(cells, m, TARGETS[m], (shares or {}).get(m)), "mix-target") for m in MARGINS}
    return rake(cells, wanted), wanted


def cell_probabilities(documents: DataFrame, shares: dict[str, dict[str, float]] | None = None, budget: float = BUDGET) -> DataFrame:
    return staged(calibrated(_fitted(documents, shares)[0], budget), "mix-probability")


def fit_report(documents: DataFrame, shares: dict[str, dict[str, float]] | None = None, tolerance: float = 0.01) -> DataFrame:
    """margin, value, target, share, met: how near the raked tokens come to every target, a row for each.

    A target is met if the share is within ``tolerance`` of it. Targets that contradict each other leave some of the first
    marginals unmet, since the last one is scaled last. Here a given value that no document has keeps its target, so it is
    unmet, and so may be the others of its marginal.
    """
    cells, wanted = _fitted(documents, shares)
    total = cells.agg(F.sum("share").alias("total"))
    out = None
    for margin, target in wanted.items():
        given = (shares or {}).get(margin)
        if given:
            sum_ = float(sum(given.values())) or 1.0
            target = documents.sparkSession.createDataFrame(
                [(value, share / sum_) for value, share in given.items()], f"{margin} string, target double"
            )
        there = cells.groupBy(margin).agg(F.sum("share").alias("share"))
        both = there.join(target, margin, "full").select(
            F.lit(margin).alias("margin"),
            F.col(margin).alias("value"),
            F.coalesce("target", F.lit(0.0)).alias("target"),
            F.coalesce(F.col("share") / F.nullif(total.scalar(), F.lit(0.0)), F.lit(0.0)).alias("share"),
        )
        out = both if out is None else out.unionByName(both)
    return out.withColumn("met", F.abs(F.col("share") - F.col("target")) <= tolerance)


def weighted(documents: DataFrame, **options) -> DataFrame:
    """``document`` (all columns as a struct), source, lang, topic, n_tokens, weight, probability, kept.

    The join with the cells is left to size-based planning: a broadcast for the few cells there are as a rule.
    """
    cells = cell_probabilities(documents, **options)
    whole = F.struct(*(documents[c] for c in documents.columns)).alias("document")
    joined = documents.select(whole, *_features(documents)).join(cells, list(MARGINS))
    return joined.withColumn("kept", _draw(F.col("document")["doc_id"]) < F.col("probability"))


def digest(documents: DataFrame) -> DataFrame:
    rows = weighted(documents.select("doc_id", "text", "source", "lang"))
    return rows.select(
        "document.doc_id", *MARGINS, "n_tokens",
        F.round("weight", 6).alias("weight"), F.round("probability", 6).alias("probability"), "kept",
    )


def mix(documents: DataFrame, **options) -> DataFrame:
    """The documents that are drawn, all columns, with ``mix_topic`` and ``mix_weight`` behind them.

    Columns of these two names that the documents have already are replaced.
    """
    rows = weighted(documents.drop("mix_topic", "mix_weight"), **options).filter("kept")
    return rows.select("document.*", F.col("topic").alias("mix_topic"), F.round("weight", 6).alias("mix_weight"))


def oracle_sql(table: str = "documents") -> str:
    """DuckDB text for ``digest`` with its default targets: every round is a common table expression."""
    parts = [
        f"r as (select doc_id, coalesce(cast(source as varchar), '(none)') source, "
        f"coalesce(cast(lang as varchar), '(none)') lang, {TOPIC} topic, {TOKENS} n_tokens from {table})",
        "c0 as (select source, lang, topic, sum(n_tokens) tokens, cast(sum(n_tokens) as double) share "
        "from r group by all)",
    ]
    for m in MARGINS:
        parts.append(
            f"t_{m} as (select {m}, raw / sum(raw) over () target from (select {m}, pow(cast(sum(tokens) as double), "
            f"{TARGETS[m]}) raw from c0 group by {m} having sum(tokens) > 0))"
        )
    n = 0
    for _ in range(ROUNDS):
        for m in MARGINS:
            parts.append(
                f"c{n + 1} as materialized (select c.source, c.lang, c.topic, c.tokens, coalesce(c.share * t.target / "
                f"nullif(sum(c.share) over (partition by c.{m}), 0), 0) share from c{n} c left join t_{m} t on t.{m} = c.{m})"
            )
            n += 1
    parts.append(
        f"w as materialized (select *, case when tokens > 0 then share / (select sum(share) from c{n}) * "
        f"(select sum(tokens) from c{n}) / tokens else 0 end weight from c{n})"
    )
    parts.append(f"f0 as (select cast({BUDGET} as double) f)")
    for i in range(CALIBRATIONS):
        parts.append(
            f"f{i + 1} as materialized (select greatest(f, coalesce(({BUDGET} * (select sum(tokens) from w) - sum(case when "
            f"weight * f >= 1 then tokens else 0 end)) / nullif(sum(case when weight * f >= 1 then 0 else tokens * weight "
            f"end), 0), f)) f from w, f{i} group by f)"
        )
    parts.append(
        f"p as (select source, lang, topic, weight, least(1.0, weight * f) probability from w, f{CALIBRATIONS})"
    )
    draw = "cast(('0x' || substr(md5(coalesce(cast(doc_id as varchar), '(none)')), 1, 8)) as bigint) / 4294967296.0"
    return (
        "with " + ",\n".join(parts) + "\nselect doc_id, source, lang, topic, n_tokens, round(weight, 6) weight, "
        f"round(probability, 6) probability, {draw} < probability kept from r join p using (source, lang, topic)"
    )
