"""The whole job as stages on storage: base relations in, exchange files, sequences and run reports out.

Each stage is written once and read by the later ones, so nothing is computed twice and a lost executor or a failed
run costs one stage: a run that is started again goes on behind the last stage that is whole. Run it with ``python -m daypanel.plans.job BASE_DIR OUT_DIR``.
"""

from __future__ import annotations

import sys
import time
from collections.abc import Mapping
from functools import cache

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daypanel.operators import encode, impute, label_model, metrics, scoring, sequences, signals, vocabulary
from daypanel.plans.flow import VOCABULARY, BaseRelations, Flow
from daypanel.session import build_session, size_shuffles
from daypanel.sources.schemas import KEYS, SIGNAL_ORDER, STATIC_ORDER
from daypanel.sources.tables import StageStore, write_csv

LABEL_MODEL = "label model"
MODEL_NAMES = {"rnn": "cross-attention RNN", "lstm": "cross-attention LSTM", "gru": "cross-attention GRU"}


def prepare(store: StageStore, relations: BaseRelations, n_drugs: int = VOCABULARY, **flow_options) -> Flow:
    """Clean, assemble and encode; export the exchange tables. Leaves every stage in ``store``.

    Stages whose sources and options have not changed are read, not made again. Those with an admission number are
    bucketed by it, so that they meet without an exchange.
    """
    flow = Flow(relations, n_drugs, **flow_options)
    stage, stay = store.stage, KEYS[:1]
    drugs = {**relations.marks("prescriptions"), "n_drugs": n_drugs}
    flow.vocabulary = stage("vocabulary", lambda: flow.vocabulary, options=drugs)
    flow.use = stage("drug_use", lambda: vocabulary.daily_drug_use(flow.use), ["vocabulary"], bucketed=KEYS)
    flow.spine = stage("spine", lambda: flow.spine, ["drug_use"], bucketed=KEYS)
    flow.cleaned = signals.clean_units(signals.near_spine(relations.tagged, flow.spine))
    people = relations.marks("admissions", "patients", "chartevents")
    flow.static = stage("static", lambda: flow.static, options=people, bucketed=stay)
    readings = relations.marks("chartevents", "labevents", "d_items", "d_labitems")
    flow.panel = stage("panel", lambda: flow.panel, ["spine"], options=readings, bucketed=KEYS)
    counts = encode.null_counts([*SIGNAL_ORDER, *STATIC_ORDER])
    flow.dataset = stage("dataset", lambda: flow.dataset, ["panel", "static"], options=people, audit=counts, bucketed=KEYS)
    flow.keys = flow.dataset.select(*KEYS)
    bounds = {"stay_days": flow.stay_days}
    flow.stays = stage("admission_days", lambda: flow.stays, ["dataset"], options=bounds, bucketed=stay)
    for name, df in (("drug_use", flow.use), ("admission_days", flow.stays), ("dataset", flow.dataset)):
        store.once(f"csv/{name}", lambda name=name, df=df: store.export(name, df), [name])

    flow.layout = encode.FeatureLayout(stage("categories", lambda: flow.layout.dictionary, ["static", "spine"], options=people))
    matrix = stage("onehot", lambda: encode.feature_matrix(flow.dataset, flow.layout), ["dataset", "categories"])
    store.once(
        "csv/dataset_onehot",
        lambda: write_csv(encode.flat_frame(matrix, flow.layout), store.path("csv/dataset_onehot")),
        ["onehot"],
    )

    def imputed() -> DataFrame:
        return impute.knn_impute(impute.assign_blocks(matrix, flow.keys.count(), flow.block_rows))

    flow.imputed = stage("imputed", imputed, ["onehot"], options={"block_rows": flow.block_rows}, bucketed=KEYS)

    def export_imputed() -> None:
        drugs = [row.drug for row in flow.positions.orderBy("position").collect()]  # the vocabulary, at most n_drugs names
        write_csv(encode.flat_frame(flow.matrix, flow.layout, drugs), store.path("csv/dataset_imputed"))

    store.once("csv/dataset_imputed", export_imputed, ["imputed", "drug_use"])
    split = sequences.split_of(F.col("hadm_id")).alias("split")
    stage(
        "sequences",
        lambda: flow.sequences.select("hadm_id", split, "steps"),
        ["imputed", "drug_use", "admission_days"],
        audit=sequences.sequence_counts(),
        bucketed=stay,
    )
    return flow


def learn(store: StageStore, flow: Flow, passes: int = label_model.PASSES, patience: int | None = label_model.PATIENCE) -> DataFrame:
    """Train the label model on the stored sequences, score the test admissions and store the run report.

    Weights and scales are stages, so they can be read by a later run. A run that is done again with the same sequences
    and options reads its scores and has one report.
    """
    start = time.monotonic()
    n_labels, n_features = flow.n_drugs, flow.layout.n_features

    @cache
    def vectors() -> DataFrame:
        steps = store.read("sequences").select("hadm_id", F.inline("steps"))
        return label_model.step_vectors(steps, n_labels)

    def weigh() -> DataFrame:
        return label_model.train(vectors(), n_labels, n_labels, n_features, passes, patience).weights

    rule = {"n_labels": n_labels, "passes": passes, "patience": patience}
    scales = store.stage("label_scales", lambda: label_model.scales_of(vectors(), n_labels), ["sequences"], options=rule)
    weights = store.stage("label_weights", weigh, ["sequences"], options=rule)

    def scores() -> DataFrame:
        learned = label_model.Learned(weights, scales, [], 0)
        return label_model.score(vectors().filter("split = 'test'"), learned, n_labels, n_labels, n_features)

    scored = store.stage("scored_label_model", scores, ["sequences", "label_weights", "label_scales"])
    run = f"label_model-{store.fingerprint('scored_label_model')[:12]}"
    store.once(
        f"report-{run}",
        lambda: store.report("reports", run, metrics.run_report(scored, LABEL_MODEL, time.monotonic() - start)),
        ["scored_label_model"],
    )
    return scored


def score(
    store: StageStore,
    cell: str,
    weights: Mapping[str, np.ndarray],
    n_drugs: int,
    n_features: int,
    as_int: bool = False,
) -> DataFrame:
    """Score the test admissions with given weights, store the run report and return the scored steps."""
    start = time.monotonic()
    test = store.read("sequences").filter(F.col("split") == "test")
    padded = sequences.pad_truncate(test, n_features, as_int=as_int)
    scored = scoring.score_sequences(padded, cell, dict(weights)).withColumn(
        "truth", encode.multi_hot(F.col("label"), n_drugs)
    )
    scored = store.write(f"scored_{cell}", scored)
    store.report("reports", cell, metrics.run_report(scored, MODEL_NAMES[cell], time.monotonic() - start))
    return scored


def run(spark: SparkSession, base_dir: str, out_dir: str, n_drugs: int = VOCABULARY) -> None:
    """Base relations to reports. Networks are not scored here, since their weights come from outside: see ``score``."""
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")  # days meet in the buckets of their admission
    store = StageStore(spark, out_dir)
    relations = BaseRelations(spark, base_dir)
    size_shuffles(spark, relations.prescriptions, *relations.events)
    learn(store, prepare(store, relations, n_drugs))


if __name__ == "__main__":
    run(build_session(), sys.argv[1], sys.argv[2])
