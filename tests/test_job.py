"""Files, stages and the whole job on base relations."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from daypanel import session
from daypanel.operators import registry as R
from daypanel.operators import encode, panel, scoring, sequences, statics
from daypanel.plans import job
from daypanel.plans.flow import BaseRelations, EventRelations, Flow
from daypanel.sources import schemas, tables
from daypanel.sources.schemas import SIGNAL_ORDER, STATIC_ORDER
from daypanel.sources.standins import view


@pytest.fixture(scope="module")
def base(spark, sf_dir, tmp_path_factory):
    """The seven base relations as parquet, filled from the stand-ins."""
    root = str(tmp_path_factory.mktemp("base"))
    lab = [item for spec in R.SIGNALS if spec.source == "lab" for item in spec.items]
    readings = view(spark, sf_dir, "fx_readings")
    body = view(spark, sf_dir, "fx_body").withColumn("charttime", F.lit("2024-01-01").cast("timestamp_ntz"))
    items = view(spark, sf_dir, "fx_items")
    is_lab = F.col("itemid").isin(lab)
    frames = {name: view(spark, sf_dir, f"fx_{name}") for name in ("admissions", "patients", "prescriptions")}
    frames["chartevents"] = readings.filter(~is_lab).unionByName(body)
    frames["labevents"] = readings.filter(is_lab)
    frames["d_items"], frames["d_labitems"] = items.filter(~is_lab), items.filter(is_lab)
    for name, df in frames.items():
        columns = [F.col(f.name).cast(f.dataType) for f in schemas.BASE[name]]
        df.select(*columns).write.parquet(f"{root}/{name}")
    return root


@pytest.fixture(scope="module")
def done(spark, base, tmp_path_factory):
    store = tables.StageStore(spark, str(tmp_path_factory.mktemp("out")))
    flow = job.prepare(store, BaseRelations(spark, base), 40, block_rows=50)
    return store, flow


def test_base_relations_give_the_stand_in_dataset(spark, sf_dir, done):
    store, _ = done
    wanted = Flow(EventRelations(spark, sf_dir), 40).dataset
    got = store.read("dataset")
    assert got.count() == wanted.count() > 0
    assert got.exceptAll(wanted).count() == 0


def test_csv_round_trip(done):
    store, flow = done
    assert store.import_csv("dataset").exceptAll(flow.dataset).count() == 0
    assert store.import_csv("admission_days").schema == schemas.ADMISSION_DAYS
    assert store.import_csv("drug_use").exceptAll(flow.use.select("hadm_id", "startdate", "drug")).count() == 0


def test_stages_are_whole(done):
    store, flow = done
    imputed = store.read("imputed")
    assert imputed.count() == flow.keys.count()
    assert imputed.filter(F.exists("features", lambda v: v.isNull())).count() == 0
    seqs = store.read("sequences")
    days = store.read("admission_days")
    assert seqs.count() == days.count()
    sizes = seqs.join(days, "hadm_id").filter(F.size("steps") != F.col("num") - 1)
    assert sizes.count() == 0


def test_scoring_and_reports_append(spark, done):
    store, flow = done
    n = len(flow.layout.names)
    for cell in ("rnn", "gru"):
        weights = scoring.random_weights(cell, 40, n, embedding=4, units=4, dense=4)
        scored = job.score(store, cell, weights, 40, n)
        test = store.read("sequences").filter("split = 'test'").count()
        assert scored.count() == 35 * test
    reports = store.read("reports").collect()
    assert sorted(r.model for r in reports) == ["cross-attention GRU", "cross-attention RNN"]
    assert all(0 <= r.jaccard <= 1 and 0 <= r.lrap <= 1 for r in reports)


def test_learning_reports_append(done):
    store, flow = done
    before = store.read("reports").count()
    scored = job.learn(store, flow, passes=3, patience=None)
    assert store.read("label_weights").count() == 40 * (1 + 40 + len(flow.layout.names))
    steps = store.read("sequences").filter("split = 'test'").select(F.explode("steps")).count()
    assert scored.count() == steps
    assert store.read("reports").count() == before + 1


def test_a_run_done_again_replaces_its_report(spark, tmp_path):
    store = tables.StageStore(spark, str(tmp_path))
    for run, value in (("a", 1), ("b", 2), ("a", 3)):
        store.report("reports", run, spark.range(value, value + 1).toDF("n"))
    assert sorted((r.run, r.n) for r in store.read("reports").collect()) == [("a", 3), ("b", 2)]


def test_broken_records_are_held_back(spark, tmp_path):
    lines = [
        "hadm_id,startdate,drug", "1,2024-01-02,a", "2,2024-01-03", "x,2024-01-03,b", "3,2024-13-03,b", "4,,", "5,2024-01-04,c,d",
        '6,2024-01-05,"e,f"', ",,",
    ]
    (tmp_path / "use.csv").write_text("\n".join(lines) + "\n")
    rows, broken = tables.read_csv_checked(spark, str(tmp_path / "use.csv"), schemas.DRUG_USE)
    assert rows.schema == schemas.DRUG_USE
    assert sorted((r.hadm_id or 0, str(r.startdate), r.drug) for r in rows.collect()) == [
        (0, "None", None), (1, "2024-01-02", "a"), (4, "None", None), (6, "2024-01-05", "e,f"),
    ]
    held = {(r.record, r.reason) for r in broken.collect()}
    assert held == {
        ("2,2024-01-03", "columns"), ("x,2024-01-03,b", "value of hadm_id"), ("3,2024-13-03,b", "value of startdate"),
        ("5,2024-01-04,c,d", "columns"),
    }
    assert all(r.file.endswith("use.csv") for r in broken.collect())
    counts = {r.reason: r.n for r in tables.quarantine_report(broken).collect()}
    assert counts == {"columns": 2, "value of hadm_id": 1, "value of startdate": 1}


def test_blank_cells_are_null(spark, tmp_path):
    (tmp_path / "x.csv").write_text("hadm_id,num\n1,\n2,5\n")
    rows = tables.read_csv(spark, str(tmp_path / "x.csv"), schemas.ADMISSION_DAYS).orderBy("hadm_id").collect()
    assert [(r.hadm_id, r.num) for r in rows] == [(1, None), (2, 5)]


class NamedFolder:
    """A cluster session as far as the folder lookup sees it."""

    def __init__(self, folder):
        self.conf = {"spark.checkpoint.dir": folder} if folder else {}
        self.sparkContext = type("Context", (), {"master": "spark://host:7077", "applicationId": "x"})


def test_midnight_stamps_are_read_as_days(spark, tmp_path):
    (tmp_path / "use.csv").write_text("hadm_id,startdate,drug\n1,2101-10-20 00:00:00,a\n")
    row = tables.read_csv(spark, str(tmp_path / "use.csv"), schemas.DRUG_USE).first()
    assert str(row.startdate) == "2101-10-20"


def test_shared_folder(spark, tmp_path):
    assert session.shared_dir(NamedFolder(str(tmp_path))) == str(tmp_path)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(NamedFolder(None))
    assert session.shared_dir(spark) == session.shared_dir(spark)


def test_shuffles_grow_with_the_input(spark, base, monkeypatch):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        chart, lab = BaseRelations(spark, base).events
        assert session.size_shuffles(spark, chart, lab) == int(before)
        monkeypatch.setattr(session, "PARTITION_BYTES", 500)
        assert session.size_shuffles(spark, chart, lab) > int(before)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_staged_cuts_the_lineage(spark):
    df = session.staged(spark.range(5).toDF("n"), "numbers")
    assert df.count() == 5
    assert df._jdf.queryExecution().executedPlan().toString().count("Range") == 0


def test_flat_exchange_frames(spark, done):
    store, flow = done
    frame = spark.read.option("header", True).option("inferSchema", True).csv(store.path("csv/dataset_imputed"))
    names = frame.columns
    assert names[:2] == ["hadm_id", "startdate"] and all(name.startswith("drug_") for name in names[2:42])
    assert names[2:42] == sorted(names[2:42]) and names[42:] == flow.layout.names
    assert frame.count() == flow.keys.count()
    assert frame.filter(" or ".join(f"`{name}` is null" for name in names)).count() == 0
    onehot = spark.read.option("header", True).csv(store.path("csv/dataset_onehot"))
    assert onehot.columns == ["hadm_id", "startdate", *flow.layout.names]


def test_the_job_audits_what_it_writes(done):
    store, _ = done
    wanted = {row.column_name: row.n_null for row in encode.null_audit(store.read("dataset"), [*SIGNAL_ORDER, *STATIC_ORDER]).collect()}
    assert store.audit("dataset") == wanted
    assert store.audit("sequences") == sequences.sequence_stats(store.read("sequences")).first().asDict()


def test_stored_days_meet_without_an_exchange_by_admission(spark, done):
    """Panel to modelling table, features and drugs to sequences, with no side broadcast but the vocabulary."""
    store, flow = done
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    try:
        table = panel.modelling_table(flow.panel, statics.adult_cohort(flow.static).withColumn("hospital_expire_flag", F.lit(0.0)))
        sets = encode.drug_sets(flow.use, F.broadcast(flow.positions))
        steps = sequences.next_day_labels(encode.with_drugs(flow.imputed, sets), flow.stays)
        whole = sequences.sequences(steps)
        for df in (table, whole):
            text = df._jdf.queryExecution().executedPlan().toString()
            assert "hashpartitioning(hadm_id" not in text and "Bucketed: true" in text
        assert whole.count() == store.read("sequences").count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.requireAllClusterKeysForCoPartition")


def test_job_can_run_again(spark, base, done):
    """Nothing has changed, so nothing is written; another block size makes the stages from there on anew."""
    store, flow = done
    reports = store.read("reports").count()
    again = tables.StageStore(spark, store.root)
    same = job.prepare(again, BaseRelations(spark, base), 40, block_rows=50)
    scored = job.learn(again, same, passes=3, patience=None)
    assert again.written == [] and again.read("reports").count() == reports
    assert same.dataset.exceptAll(flow.dataset).count() == 0 and scored.count() > 0
    other = tables.StageStore(spark, store.root)
    job.prepare(other, BaseRelations(spark, base), 40, block_rows=60)
    assert other.written == ["imputed", "csv/dataset_imputed", "sequences"]


# Below: jobs of their own, since they change what they read.


@pytest.fixture
def two_rows(spark, tmp_path):
    source = str(tmp_path / "source")
    spark.range(10).toDF("n").write.parquet(source)
    return source, tables.StageStore(spark, str(tmp_path / "out"))


def test_a_stage_is_made_once(spark, two_rows):
    source, store = two_rows

    def make():
        mark = {"source": tables.snapshot(spark, source)}
        small = store.stage("small", lambda: spark.read.parquet(source).filter("n < 5"), options=mark)
        return store.stage("sum", lambda: small.agg(F.sum("n").alias("n")), ["small"]).first().n

    assert make() == 10 and store.written == ["small", "sum"]
    assert make() == 10 and store.written == ["small", "sum"]  # nothing changed
    spark.createDataFrame([(-7,)], "n long").write.mode("append").parquet(source)
    assert make() == 3 and store.written == ["small", "sum"] * 2  # the source changed


def test_a_killed_run_goes_on_at_the_stage_it_died_in(spark, two_rows):
    source, store = two_rows

    def make(store, broken):
        first = store.stage("first", lambda: spark.read.parquet(source))
        fault = F.when(F.col("n") == 9, F.raise_error(F.lit("killed"))).otherwise(F.col("n"))
        second = store.stage("second", lambda: first.select(fault.alias("n") if broken else F.col("n")), ["first"])
        return store.stage("third", lambda: second.agg(F.count("n").alias("n")), ["second"]).first().n

    with pytest.raises(Exception, match="killed"):
        make(store, True)
    assert store.written == ["first"]
    later = tables.StageStore(spark, store.root)
    assert make(later, False) == 10 and later.written == ["second", "third"]


def test_an_unfinished_write_is_not_believed(spark, two_rows):
    """With its old options again, too: the files may be those of the new ones."""
    source, store = two_rows
    store.stage("s", lambda: spark.range(3).toDF("n"), options={"size": 3})
    with pytest.raises(ZeroDivisionError):
        store.stage("s", lambda: 1 / 0, options={"size": 4})
    again = tables.StageStore(spark, store.root)
    assert again.stage("s", lambda: spark.range(3).toDF("n"), options={"size": 3}).count() == 3
    assert again.written == ["s"]
    with pytest.raises(KeyError):
        again.fingerprint("nothing")


def test_the_write_counts(spark, two_rows):
    source, store = two_rows
    counts = {"rows": F.count(F.lit(1)), "sum": F.sum("n"), "none": F.count_if(F.col("n").isNull())}
    store.stage("s", lambda: spark.range(5).toDF("n"), audit=counts)
    assert store.audit("s") == {"rows": 5, "sum": 10, "none": 0}
    assert tables.StageStore(spark, store.root).audit("s") == {"rows": 5, "sum": 10, "none": 0}
    store.stage("e", lambda: spark.range(0).toDF("n"), audit=counts)
    assert store.audit("e") == {"rows": 0, "sum": None, "none": 0}
    assert store.audit("unknown") == {}


def test_buckets_meet_without_an_exchange(spark, two_rows):
    _, store = two_rows
    days = spark.range(300).select((F.col("id") % 50).alias("hadm_id"), F.col("id").alias("day"))
    days = store.stage("days", lambda: days, bucketed=["hadm_id", "day"])
    people = spark.range(50).select(F.col("id").alias("hadm_id"), (F.col("id") * 2).alias("age"))
    people = store.stage("people", lambda: people, bucketed=["hadm_id"])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        met = days.join(people, "hadm_id").groupBy("hadm_id").agg(F.count("day").alias("n"), F.max("age").alias("age"))
        assert "Exchange" not in met._jdf.queryExecution().executedPlan().toString()
        assert met.filter("n = 6 and age = 2 * hadm_id").count() == 50
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_buckets_are_known_to_a_new_session(spark, two_rows):
    _, store = two_rows
    frame = spark.range(20).select("id", F.array(F.struct(F.col("id").alias("x"))).alias("parts"))
    store.stage("s", lambda: frame, bucketed=["id"])
    spark.sql(f"drop table {store._table('s')}")  # as a session that never saw it
    again = tables.StageStore(spark, store.root)
    got = again.stage("s", lambda: 1 / 0, bucketed=["id"])
    assert got.schema.simpleString() == frame.schema.simpleString() and got.count() == 20
    assert "Bucketed: true" in got.groupBy("id").count()._jdf.queryExecution().executedPlan().toString()
    spark.sql(f"drop table {store._table('s')}")
    third = tables.StageStore(spark, store.root)
    assert third.stage("s", lambda: frame.filter("id < 7"), options={"new": 1}, bucketed=["id"]).count() == 7
