"""The registered queries: every operator over the whole stand-in relations, with plain tabular results."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daypanel.functions.numbers import bucket_hash
from daypanel.operators import encode, impute, label_model, metrics, panel, scoring, signals, statics
from daypanel.operators import registry as R
from daypanel.operators import sequences as S
from daypanel.operators import vocabulary as V
from daypanel.plans import settings as P
from daypanel.plans.flow import EventRelations, Flow
from daypanel.session import shared_dir
from daypanel.sources.schemas import CATEGORIES, DRUG_USE, KEYS, SIGNAL_ORDER, STATIC_ORDER
from daypanel.sources.standins import view
from daypanel.sources.tables import StageStore, read_csv_checked

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def flow(spark: SparkSession, sf_dir: str) -> Flow:
    return Flow(EventRelations(spark, sf_dir), P.N_DRUGS, block_rows=P.BLOCK_ROWS)


def line_spine_of(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    icu = V.icu_prescriptions(view(spark, sf_dir, "fx_line_prescriptions"))
    top = V.top_drugs(icu, P.LINE_DRUGS)
    return top, V.spine(V.in_vocabulary(icu, top))


def line_tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signals.tag_signals(view(spark, sf_dir, "fx_line_readings"))


def _bits(vector: Column) -> Column:
    return F.array_join(vector, "")


def _listed(positions: Column) -> Column:
    return F.array_join(positions, ",")


def _as_values(readings: DataFrame, *columns: str) -> DataFrame:
    signal = F.col("signal")
    value = signals.in_doubles(F.col("units"), F.col("long_units"), signal)
    return readings.select(*columns, signals.signal_name(signal).alias("signal"), value.alias("value"))


# Drugs and days


@query
def icu_prescriptions(spark, sf_dir):
    return flow(spark, sf_dir).icu.select("hadm_id", "startdate", "drug", "icustay_id")


@query
def top_drugs(spark, sf_dir):
    return flow(spark, sf_dir).vocabulary


@query
def vocabulary_sizes(spark, sf_dir):
    return V.vocabulary_sizes(flow(spark, sf_dir).icu, P.VOCABULARY_SIZES)


@query
def daily_drug_use(spark, sf_dir):
    return V.daily_drug_use(flow(spark, sf_dir).icu)


@query
def vocabulary_filter(spark, sf_dir):
    return V.daily_drug_use(flow(spark, sf_dir).use)


@query
def spine(spark, sf_dir):
    return flow(spark, sf_dir).spine


@query
def line_top_drugs(spark, sf_dir):
    return line_spine_of(spark, sf_dir)[0]


@query
def line_spine(spark, sf_dir):
    return line_spine_of(spark, sf_dir)[1]


# Static attributes


@query
def admission_height(spark, sf_dir):
    r = flow(spark, sf_dir).relations
    return statics.admission_body(r.admissions, r.body).select("subject_id", "hadm_id", "height", "weight")


@query
def patient_age(spark, sf_dir):
    r = flow(spark, sf_dir).relations
    return statics.patient_age(r.admissions, r.patients)


@query
def patient_static(spark, sf_dir):
    r = flow(spark, sf_dir).relations
    return statics.patient_static(r.admissions, r.patients, r.body)


@query
def static_imputation(spark, sf_dir):
    return flow(spark, sf_dir).static


@query
def normalise_categories(spark, sf_dir):
    return statics.normalise_categories(flow(spark, sf_dir).static).select("hadm_id", *CATEGORIES)


@query
def adult_cohort(spark, sf_dir):
    return statics.adult_cohort(flow(spark, sf_dir).static)


@query
def cohort_flag(spark, sf_dir):
    return flow(spark, sf_dir).cohort.select("hadm_id", "age", "hospital_expire_flag")


# Readings


@query
def signal_readings(spark, sf_dir):
    f = flow(spark, sf_dir)
    return signals.on_spine(f.relations.tagged, f.spine).select(
        *KEYS, "itemid", "charttime", "value", signals.signal_name(F.col("signal")).alias("signal")
    )


@query
def clean_values(spark, sf_dir):
    return _as_values(flow(spark, sf_dir).cleaned, *KEYS, "itemid")


@query
def line_clean_values(spark, sf_dir):
    return _as_values(signals.clean_units(line_tagged(spark, sf_dir)), *KEYS, "itemid")


def _one_signal(spark, sf_dir, name):
    mine = line_tagged(spark, sf_dir).filter(F.col("signal") == R.CODE_OF[name])
    return signals.clean_units(mine).select(
        *KEYS, "itemid", F.col("value").alias("raw"), F.col("units").cast("bigint").alias("value")
    )


@query
def clean_temperature(spark, sf_dir):
    return _one_signal(spark, sf_dir, "body_temperature")


@query
def clean_fraction(spark, sf_dir):
    return _one_signal(spark, sf_dir, "fio2")


@query
def clean_long_numbers(spark, sf_dir):
    """Numbers of up to 250 digits, a third of them on one day: exact totals and rounded means, as text."""
    tally = signals.reading_tally(signals.clean_units(signals.tag_signals(view(spark, sf_dir, "fx_long_readings"))))
    name = signals.signal_name(F.col("signal")).alias("signal")
    return signals.tally_digits(tally).select(
        *KEYS, name, F.col("digits").alias("total"), "n_valued", "n_missing", "rounded_mean"
    )


@query
def long_body_means(spark, sf_dir):
    """Body readings of up to 250 digits, some with many places behind the point."""
    return statics.body_measures(view(spark, sf_dir, "fx_long_body")).select("hadm_id", "height", "weight")


@query
def reject_report(spark, sf_dir):
    return signals.reject_report(line_tagged(spark, sf_dir))


@query
def group_mean_fill(spark, sf_dir):
    f = flow(spark, sf_dir)
    return _as_values(signals.filled_readings(f.cleaned, f.spine), *KEYS, "itemid", "charttime")


@query
def line_group_mean_fill(spark, sf_dir):
    cleaned = signals.clean_units(line_tagged(spark, sf_dir))
    return _as_values(signals.filled_readings(cleaned, line_spine_of(spark, sf_dir)[1]), *KEYS, "itemid")


@query
def daily_signal_mean(spark, sf_dir):
    f = flow(spark, sf_dir)
    means = signals.daily_signal_mean(f.cleaned, f.spine)
    return means.select(*KEYS, signals.signal_name(F.col("signal")).alias("signal"), "mean")


# Panel and modelling table


@query
def wide_panel(spark, sf_dir):
    return flow(spark, sf_dir).panel


@query
def wide_panel_near_spine(spark, sf_dir):
    """The same panel with the texts of days off the spine left uncleaned."""
    f = flow(spark, sf_dir)
    return panel.wide_panel(signals.clean_units(signals.near_spine(f.relations.tagged, f.spine)), f.spine)


@query
def line_wide_panel(spark, sf_dir):
    cleaned = signals.clean_units(line_tagged(spark, sf_dir))
    return panel.wide_panel(cleaned, line_spine_of(spark, sf_dir)[1])


@query
def aligned_keys(spark, sf_dir):
    return flow(spark, sf_dir).keys


@query
def dataset(spark, sf_dir):
    return flow(spark, sf_dir).dataset


@query
def admission_days(spark, sf_dir):
    return flow(spark, sf_dir).stays


@query
def line_admission_days(spark, sf_dir):
    return panel.admission_days(line_spine_of(spark, sf_dir)[1])


@query
def null_audit(spark, sf_dir):
    return encode.null_audit(flow(spark, sf_dir).dataset, [*SIGNAL_ORDER, *STATIC_ORDER])


def _stages(spark: SparkSession) -> StageStore:
    return StageStore(spark, f"{shared_dir(spark)}/daypanel/stages-{uuid.uuid4().hex}")


@query
def null_audit_of_write(spark, sf_dir):
    """The null audit as counted by the write of the modelling table, without a scan of its own."""
    f, store = flow(spark, sf_dir), _stages(spark)
    store.stage("dataset", lambda: f.dataset, audit=encode.null_counts([*SIGNAL_ORDER, *STATIC_ORDER]))
    return spark.createDataFrame(sorted(store.audit("dataset").items()), "column_name string, n_null bigint")


@query
def sequence_stats_of_write(spark, sf_dir):
    f, store = flow(spark, sf_dir), _stages(spark)
    store.stage("sequences", lambda: S.sequences(f.labelled_days), audit=S.sequence_counts(), bucketed=["hadm_id"])
    counts = store.audit("sequences")
    return spark.createDataFrame([counts], ", ".join(f"{name} bigint" for name in counts))


@query
def stored_sequences(spark, sf_dir):
    """Sequences written in buckets and read by a second run, which finds them in the manifest."""
    f, store = flow(spark, sf_dir), _stages(spark)
    marks = f.relations.marks("events")

    def run(store: StageStore) -> DataFrame:
        days = store.stage("days", lambda: f.labelled_days, options=marks, bucketed=KEYS)
        return store.stage("sequences", lambda: S.sequences(days), ["days"], bucketed=["hadm_id"])

    run(store)
    return _sequence_texts(run(StageStore(spark, store.root)))


# Exchange files


@query
def csv_quarantine(spark, sf_dir):
    """Lines written as text and read as an exchange file: whole rows, and the broken ones with their reason."""
    lines = view(spark, sf_dir, "fx_csv_lines").select("line")
    path = f"{shared_dir(spark)}/daypanel/csv-{uuid.uuid4().hex}"
    lines.write.text(path)
    rows, broken = read_csv_checked(spark, path, DRUG_USE, header=False)
    nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in DRUG_USE]
    return rows.select(*rows.columns, F.lit(None).cast("string").alias("record"), F.lit(None).cast("string").alias("reason")).unionByName(
        broken.select(*nothing, "record", "reason")
    )


# Encoding


@query
def drug_multihot(spark, sf_dir):
    hot = _bits(encode.multi_hot(F.col("drugs"), P.N_DRUGS))
    return flow(spark, sf_dir).drug_sets.select(*KEYS, hot.alias("hot"))


@query
def drug_multihot_join(spark, sf_dir):
    f = flow(spark, sf_dir)
    hot = _bits(encode.multi_hot(F.col("drugs"), P.N_DRUGS))
    return encode.with_drugs(f.dataset, f.drug_sets).select(*KEYS, "heart_rate", hot.alias("hot"))


@query
def onehot_static(spark, sf_dir):
    f = flow(spark, sf_dir)
    dictionary = f.layout.dictionary
    rows = encode.with_places(statics.normalise_categories(f.cohort), dictionary)
    vectors = [bits.alias(f"{name}_hot") for name, bits in zip(CATEGORIES, encode.one_hot_bits(dictionary))]
    return rows.select("hadm_id", *vectors)


@query
def feature_groups(spark, sf_dir):
    """Cells set per day in each group of the layout: drugs alone, signals, static part, static part without outcome."""
    f = flow(spark, sf_dir)
    rows = f.layout.placed(encode.with_drugs(f.dataset, f.drug_sets))
    only_static = f.layout.without("signals")
    return rows.select(
        *KEYS,
        F.size("drugs").cast("bigint").alias("n_drugs"),
        f.layout.without("statics").n_set().alias("n_signals"),
        only_static.n_set().alias("n_statics"),
        only_static.without("outcome").n_set().alias("n_without_outcome"),
    )


# Imputation


@query
def impute_blocks(spark, sf_dir):
    f = flow(spark, sf_dir)
    n_rows = f.keys.agg(F.count(F.lit(1))).scalar()
    return impute.assign_blocks(f.keys, n_rows, P.BLOCK_ROWS).select(*KEYS, "block")


def _live_features(f: Flow) -> list[Column]:
    names = list(f.layout.signals)
    live = ("body_temperature", "heart_rate", "lacta", "pota", "respiratory_rate")
    return [F.round(F.col("features")[names.index(name)], 6).alias(name) for name in live]


@query
def knn_impute(spark, sf_dir):
    f = flow(spark, sf_dir)
    return f.imputed.select(*KEYS, *_live_features(f))


@query
def model_matrix(spark, sf_dir):
    f = flow(spark, sf_dir)
    hot = _bits(encode.multi_hot(F.col("drugs"), P.N_DRUGS))
    return f.matrix.select(*KEYS, *_live_features(f), hot.alias("hot"))


# Sequences


@query
def next_day_labels(spark, sf_dir):
    return flow(spark, sf_dir).labelled_days.select(
        *KEYS, "step", _listed(F.col("drugs")).alias("drugs"), _listed(F.col("label")).alias("label")
    )


@query
def sequence_stats(spark, sf_dir):
    return S.sequence_stats(S.sequences(flow(spark, sf_dir).labelled_days))


def _sequence_texts(seqs: DataFrame) -> DataFrame:
    def along(of) -> Column:
        return F.array_join(F.transform("steps", of), "|")

    return seqs.select(
        "hadm_id",
        F.size("steps").alias("n_steps"),
        along(lambda s: F.date_format(s["startdate"], "yyyy-MM-dd")).alias("days"),
        along(lambda s: _listed(s["drugs"])).alias("drugs"),
        along(lambda s: _listed(s["label"])).alias("labels"),
    )


@query
def sequences(spark, sf_dir):
    return _sequence_texts(S.sequences(flow(spark, sf_dir).labelled_days))


@query
def split_admissions(spark, sf_dir):
    return flow(spark, sf_dir).stays.select("hadm_id", S.split_of(F.col("hadm_id")).alias("split"))


_SHOWN = ["heart_rate", "lacta"]


def _shown_sequences(spark, sf_dir) -> DataFrame:
    """Sequences whose features are two signals of the panel, 0 where not measured."""
    f = flow(spark, sf_dir)
    shown = F.array(*[F.coalesce(F.col(name), F.lit(0.0)) for name in _SHOWN])
    days = f.drug_sets.join(f.panel.select(*KEYS, shown.alias("features")), KEYS)
    return S.sequences(S.next_day_labels(days, f.stays))


def _shown(features: Column) -> list[Column]:
    return [features[k].alias(name) for k, name in enumerate(_SHOWN)]


def _padded_rows(spark, sf_dir, as_int: bool) -> DataFrame:
    padded = S.pad_truncate(_shown_sequences(spark, sf_dir), len(_SHOWN), P.PAD_STEPS, as_int)
    cells = padded.select("hadm_id", F.posexplode(F.arrays_zip("drugs", "features", "labels")).alias("at", "cell"))
    return cells.select(
        "hadm_id",
        (F.col("at") + 1).alias("position"),
        _listed(F.col("cell.drugs")).alias("drugs"),
        _listed(F.col("cell.labels")).alias("labels"),
        *_shown(F.col("cell.features")),
    )


@query
def pad_truncate(spark, sf_dir):
    return _padded_rows(spark, sf_dir, as_int=False)


@query
def pad_truncate_whole(spark, sf_dir):
    return _padded_rows(spark, sf_dir, as_int=True)


@query
def dual_sequence(spark, sf_dir):
    padded = S.pad_truncate(_shown_sequences(spark, sf_dir), len(_SHOWN), P.SCORED_STEPS)
    dual = S.dual_sequence(padded, P.N_DRUGS)
    cells = dual.select("hadm_id", F.posexplode(F.arrays_zip("seqx1", "seqx2", "y")).alias("at", "cell"))
    return cells.select(
        "hadm_id",
        (F.col("at") + 1).alias("position"),
        _bits(F.col("cell.seqx1")).alias("seqx1"),
        *_shown(F.col("cell.seqx2")),
        _bits(F.col("cell.y")).alias("y"),
    )


# Whole feature vectors, as text: place and value, in millionths, of every feature that is not 0


def _vector_text(features: Column) -> Column:
    cells = F.transform(
        features, lambda v, place: F.struct(place.alias("place"), F.round(v * 1000000).cast("bigint").alias("value"))
    )
    shown = F.filter(cells, lambda cell: cell["value"] != 0)
    return F.array_join(F.transform(shown, lambda c: F.concat_ws(":", c["place"].cast("string"), c["value"].cast("string"))), ",")


@query
def imputed_features(spark, sf_dir):
    return flow(spark, sf_dir).imputed.select(*KEYS, _vector_text(F.col("features")).alias("features"))


@query
def matrix_features(spark, sf_dir):
    matrix = flow(spark, sf_dir).matrix
    return matrix.select(*KEYS, _vector_text(F.col("features")).alias("features"), _listed(F.col("drugs")).alias("drugs"))


@query
def sequence_features(spark, sf_dir):
    def along(of) -> Column:
        return F.array_join(F.transform("steps", of), "|")

    return flow(spark, sf_dir).sequences.select(
        "hadm_id",
        F.size("steps").alias("n_steps"),
        along(lambda s: _listed(s["drugs"])).alias("drugs"),
        along(lambda s: _listed(s["label"])).alias("labels"),
        along(lambda s: _vector_text(s["features"])).alias("features"),
    )


def _padded_features(spark, sf_dir, as_int: bool) -> DataFrame:
    f = flow(spark, sf_dir)
    padded = S.pad_truncate(f.sequences, f.layout.n_features, P.PAD_STEPS, as_int)
    cells = padded.select("hadm_id", F.posexplode(F.arrays_zip("drugs", "features", "labels")).alias("at", "cell"))
    return cells.select(
        "hadm_id",
        (F.col("at") + 1).alias("position"),
        _listed(F.col("cell.drugs")).alias("drugs"),
        _listed(F.col("cell.labels")).alias("labels"),
        _vector_text(F.col("cell.features")).alias("features"),
    )


@query
def padded_features(spark, sf_dir):
    return _padded_features(spark, sf_dir, as_int=False)


@query
def padded_features_whole(spark, sf_dir):
    return _padded_features(spark, sf_dir, as_int=True)


@query
def dual_features(spark, sf_dir):
    f = flow(spark, sf_dir)
    padded = S.pad_truncate(f.sequences, f.layout.n_features, P.SCORED_STEPS)
    dual = S.dual_sequence(padded, P.N_DRUGS)
    cells = dual.select("hadm_id", F.posexplode(F.arrays_zip("seqx1", "seqx2", "y")).alias("at", "cell"))
    return cells.select(
        "hadm_id",
        (F.col("at") + 1).alias("position"),
        _bits(F.col("cell.seqx1")).alias("seqx1"),
        _bits(F.col("cell.y")).alias("y"),
        _vector_text(F.col("cell.seqx2")).alias("features"),
    )


# Metrics, on the true next-day labels and scores made by a hash


def _hash_scored(spark, sf_dir) -> DataFrame:
    padded = S.pad_truncate(S.sequences(_without_features(flow(spark, sf_dir))), 0, P.SCORED_STEPS)
    hadm_id = F.col("hadm_id").cast("string")
    seeds = F.transform(
        F.sequence(F.lit(1), F.lit(P.SCORED_STEPS)),
        lambda position: bucket_hash(F.concat_ws(":", hadm_id, position.cast("string"))),
    )
    cells = padded.select("hadm_id", F.posexplode(F.arrays_zip("labels", seeds.alias("seeds"))).alias("at", "cell"))
    steps = cells.select(
        "hadm_id", (F.col("at") + 1).alias("position"), F.col("cell.labels").alias("label"), F.col("cell.seeds").alias("seed")
    )

    def chance(place: Column) -> Column:
        return F.pmod(F.col("seed") * (place * 2 + 1) + place * place, F.lit(101)) / F.lit(100.0)

    places = F.sequence(F.lit(0), F.lit(P.N_DRUGS - 1))
    return steps.select(
        "hadm_id",
        "position",
        encode.multi_hot(F.col("label"), P.N_DRUGS).alias("truth"),
        F.transform(places, chance).alias("score"),
    )


def _without_features(f: Flow) -> DataFrame:
    return f.labelled_days.withColumn("features", F.array().cast("array<double>"))


@query
def metric_steps(spark, sf_dir):
    steps = metrics.labelled_steps(_hash_scored(spark, sf_dir))
    return steps.select("hadm_id", "position", F.size(F.filter("truth", lambda t: t > 0)).cast("bigint").alias("n_true"))


@query
def metric_jaccard(spark, sf_dir):
    return metrics.jaccard(_hash_scored(spark, sf_dir))


@query
def metric_lrap(spark, sf_dir):
    return metrics.ranking_precision(_hash_scored(spark, sf_dir))


@query
def metric_micro_f1(spark, sf_dir):
    return metrics.micro_f1(_hash_scored(spark, sf_dir))


@query
def metric_pooled_jaccard(spark, sf_dir):
    return metrics.pooled_jaccard(_hash_scored(spark, sf_dir))


@query
def metric_soft_jaccard(spark, sf_dir):
    return metrics.soft_jaccard(_hash_scored(spark, sf_dir))


@query
def run_report(spark, sf_dir):
    return metrics.run_report(_hash_scored(spark, sf_dir), "hash", 0.0)


# Models


def _scored(spark, sf_dir, cell: str) -> DataFrame:
    padded = S.pad_truncate(_shown_sequences(spark, sf_dir), len(_SHOWN), P.SCORED_STEPS)
    weights = scoring.random_weights(cell, P.N_DRUGS, len(_SHOWN), **P.SMALL_MODEL)
    scored = scoring.score_sequences(padded, cell, weights)
    best = F.array_max("score")
    return scored.select(
        "hadm_id",
        "step",
        _listed(F.col("label")).alias("label"),
        (F.array_position("score", best) - 1).alias("best_place"),
        F.round(best, 6).alias("best_score"),
        F.round(F.aggregate("score", F.lit(0.0), lambda total, s: total + s), 6).alias("total_score"),
    )


@query
def score_rnn(spark, sf_dir):
    return _scored(spark, sf_dir, "rnn")


@query
def score_lstm(spark, sf_dir):
    return _scored(spark, sf_dir, "lstm")


@query
def score_gru(spark, sf_dir):
    return _scored(spark, sf_dir, "gru")


def _learned(spark, sf_dir, passes: int, patience: int | None) -> tuple[DataFrame, label_model.Learned, tuple[int, int, int]]:
    f = flow(spark, sf_dir)
    sizes = (P.N_DRUGS, P.N_DRUGS, f.layout.n_features)
    vectors = label_model.step_vectors(f.steps, P.N_DRUGS)
    return vectors, label_model.train(vectors, *sizes, passes=passes, patience=patience), sizes


@query
def label_model_scores(spark, sf_dir):
    """Scores of all labels for the test admissions after a fixed number of passes from zero weights."""
    vectors, learned, sizes = _learned(spark, sf_dir, P.LEARN_PASSES, None)
    scored = label_model.score(vectors.filter("split = 'test'"), learned, *sizes)
    return scored.select("hadm_id", "step", F.posexplode(F.arrays_zip("truth", "score")).alias("place", "cell")).select(
        "hadm_id", "step", "place", F.col("cell.truth").alias("truth"), F.round("cell.score", 4).alias("score")
    )


@query
def early_stopping(spark, sf_dir):
    """The monitor after each pass, which passes raised it, and the one whose weights are kept."""
    _, learned, _ = _learned(spark, sf_dir, P.STOP_PASSES, P.LEARN_PATIENCE)
    rows, highest = [], -1.0
    for step, loss, jaccard in learned.history:
        rows.append((step, loss, jaccard, jaccard > highest, step == learned.kept))
        highest = max(highest, jaccard)
    passes = spark.createDataFrame(rows, "step int, loss double, jaccard double, better boolean, kept boolean")
    return passes.withColumns({"loss": F.round("loss", 6), "jaccard": F.round("jaccard", 8)})
