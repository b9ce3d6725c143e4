"""Base relations, CSV exchange files and staged tables."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daypanel.sources.schemas import BASE, EXPORTS


def read_base(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One base relation from parquet, with its declared schema."""
    return spark.read.schema(BASE[name]).parquet(f"{root}/{name}")


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A CSV exchange file with header; blanks are null, never NaN."""
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)


_CORRUPT, _FILE = "_corrupt_record", "_file"


def read_csv_checked(
    spark: SparkSession, path: str, schema: T.StructType, header: bool = True
) -> tuple[DataFrame, DataFrame]:
    """(rows, quarantine) of a CSV exchange file: what can be read whole, and every other record with a reason.

    The quarantine has the record as it stands in the file, the file and the ``reason``: ``columns`` (too few or too many
    cells), or ``value of`` and the first column whose text is not of its type. Both sides come from one lazy read, which
    is to be stored before either is used twice. A blank cell is null on both sides; a header that does not name the
    columns is an error, as in ``read_csv``.
    """
    texts = T.StructType([T.StructField(f.name, T.StringType()) for f in schema] + [T.StructField(_CORRUPT, T.StringType())])
    options = {"header": header, "enforceSchema": False, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    raw = spark.read.schema(texts).options(**options).csv(path).withColumn(_FILE, F.input_file_name())
    typed = {f.name: F.col(f"`{f.name}`").try_cast(f.dataType) for f in schema}
    reason = F.when(F.col(_CORRUPT).isNotNull(), F.lit("columns"))
    for field in schema:
        text = F.col(f"`{field.name}`")
        reason = reason.when(text.isNotNull() & typed[field.name].isNull(), F.lit(f"value of {field.name}"))
    judged = raw.withColumn("_reason", reason)
    rows = judged.filter(F.col("_reason").isNull()).select(*[typed[f.name].alias(f.name) for f in schema])
    cells = F.concat_ws(",", *[F.coalesce(F.col(f"`{f.name}`"), F.lit("")) for f in schema])
    broken = judged.filter(F.col("_reason").isNotNull()).select(
        F.coalesce(F.col(_CORRUPT), cells).alias("record"), F.col(_FILE).alias("file"), F.col("_reason").alias("reason")
    )
    return rows, broken


def quarantine_report(broken: DataFrame) -> DataFrame:
    """reason, n: how many records are held back for each."""
    return broken.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def write_csv(df: DataFrame, path: str) -> None:
    """A folder of CSV parts with header and without an index column; many writers, no single merged file."""
    df.write.mode("overwrite").option("header", True).csv(path)


def snapshot(spark: SparkSession, path: str) -> str:
    """A digest of the files below ``path``: names, lengths and times of change. Lists them, opens none."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    seen = files.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("length").alias("bytes"),
        F.bit_xor(F.xxhash64("path", "length", "modificationTime")).alias("mark"),
    ).first()
    return f"{seen.n}:{seen.bytes}:{seen.mark}"


_ENTRY = "fingerprint string, schema string, metrics map<string,bigint>"


class StageStore:
    """Named stage outputs under one root, and a manifest that tells which of them are still true.

    ``write`` replaces a stage in any case. ``stage`` does so only where the fingerprint of its inputs and options is not
    the one the manifest has, so a job that is run again, or was killed, goes on at the first stage that is not true any
    more. The entry of a stage is emptied before its files are touched and filled when they are all there.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.written: list[str] = []  # by this object, in order
        self._prints: dict[str, str] = {}

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def write(self, name: str, df: DataFrame) -> DataFrame:
        df.write.mode("overwrite").parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def read(self, name: str, schema: T.StructType | None = None) -> DataFrame:
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        return reader.parquet(self.path(name))

    def stage(
        self,
        name: str,
        build: Callable[[], DataFrame],
        after: Iterable[str] = (),
        options: Mapping[str, object] | None = None,
        audit: Mapping[str, Column] | None = None,
        bucketed: Sequence[str] = (),
    ) -> DataFrame:
        """The stage ``name``: read where the manifest has it, built and written otherwise.

        ``after`` names the stages it is made from, ``options`` whatever else decides its rows (sizes, ``snapshot`` of
        sources). ``audit`` names aggregates without distinct, whole numbers, which the write itself takes along instead of
        a second scan; the manifest keeps them, and tells them apart by name. ``bucketed`` names columns: the first deals the rows to as
        many buckets as there are shuffle partitions, all sort them there, so that stages bucketed alike meet in joins and
        groups on that column without an exchange.
        """
        buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions")) if bucketed else 0
        shape = {"audit": sorted(audit or {}), "bucketed": [buckets, *bucketed]}
        entry = self._due(name, after, {**(options or {}), **shape})
        if entry is None:
            df = build()
            schema = df.schema
            seen = Observation()
            watched = df.observe(seen, *[column.alias(what) for what, column in audit.items()]) if audit else df
            if bucketed:
                self._write_buckets(name, watched, buckets, bucketed)
            else:
                watched.write.mode("overwrite").parquet(self.path(name))
            self._done(name, schema, seen.get if audit else {})
        else:
            schema = T.StructType.fromJson(json.loads(entry.schema))
        return self._buckets(name, schema, buckets, bucketed) if bucketed else self.read(name, schema)

    def once(
        self, name: str, act: Callable[[], None], after: Iterable[str] = (), options: Mapping[str, object] | None = None
    ) -> None:
        """For outputs that no stage reads, exchange files and reports: ``act`` runs where the manifest does not have it."""
        if self._due(name, after, options or {}) is None:
            act()
            self._done(name, T.StructType(), {})

    def _due(self, name: str, after: Iterable[str], options: Mapping[str, object]):
        """The manifest's entry if it is true; otherwise None, and the entry is emptied."""
        told = {"stage": name, "after": {other: self.fingerprint(other) for other in after}, "options": options}
        wanted = hashlib.sha256(json.dumps(told, sort_keys=True, default=str).encode()).hexdigest()
        entry = self._entry(name)
        self._prints[name] = wanted
        if entry is not None and entry.fingerprint == wanted:
            return entry
        self._note(name, "", T.StructType(), {})
        return None

    def _done(self, name: str, schema: T.StructType, metrics: dict) -> None:
        self._note(name, self._prints[name], schema, metrics)
        self.written.append(name)

    def fingerprint(self, name: str) -> str:
        """Of a stage that is there."""
        if name not in self._prints:
            entry = self._entry(name)
            if entry is None or not entry.fingerprint:
                raise KeyError(f"no stage {name} under {self.root}")
            self._prints[name] = entry.fingerprint
        return self._prints[name]

    def audit(self, name: str) -> dict[str, int | None]:
        """What the write of a stage counted."""
        entry = self._entry(name)
        return dict(entry.metrics) if entry and entry.fingerprint else {}

    def _entry(self, name: str):
        try:
            return self.spark.read.schema(_ENTRY).json(f"{self.root}/manifest/{name}").first()
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def _note(self, name: str, fingerprint: str, schema: T.StructType, metrics: dict) -> None:
        row = self.spark.createDataFrame([(fingerprint, schema.json(), metrics)], _ENTRY)
        row.coalesce(1).write.mode("overwrite").option("ignoreNullFields", False).json(f"{self.root}/manifest/{name}")

    def _table(self, name: str) -> str:
        """Its name in the catalog of the session; the files are under the root, the catalog only knows their buckets."""
        return f"stage_{hashlib.sha256(self.root.encode()).hexdigest()[:12]}_{name}"

    def _write_buckets(self, name: str, df: DataFrame, buckets: int, columns: Sequence[str]) -> None:
        """The exchange deals rows as buckets do, so each bucket is one file."""
        self.spark.sql(f"drop table if exists {self._table(name)}")
        dealt = df.repartition(buckets, columns[0]).write.mode("overwrite").bucketBy(buckets, columns[0])
        dealt.sortBy(*columns).option("path", self.path(name)).format("parquet").saveAsTable(self._table(name))

    def _buckets(self, name: str, schema: T.StructType, buckets: int, columns: Sequence[str]) -> DataFrame:
        cells = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        order = ", ".join(f"`{c}`" for c in columns)
        self.spark.sql(
            f"create table if not exists {self._table(name)} ({cells}) using parquet "
            f"clustered by (`{columns[0]}`) sorted by ({order}) into {buckets} buckets location '{self.path(name)}'"
        )
        return self.spark.table(self._table(name))

    def report(self, name: str, run: str, df: DataFrame) -> None:
        """Reports collect over runs, one folder each; a run that is done again replaces its own."""
        df.write.mode("overwrite").parquet(f"{self.path(name)}/run={run}")

    def export(self, name: str, df: DataFrame) -> None:
        """One of the three exchange tables as CSV, columns in the declared order."""
        write_csv(df.select(*EXPORTS[name].fieldNames()), self.path(f"csv/{name}"))

    def import_csv(self, name: str) -> DataFrame:
        return read_csv(self.spark, self.path(f"csv/{name}"), EXPORTS[name])
