"""Blocked nearest-neighbour imputation."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daypanel.functions.numbers import bucket_hash

BLOCK_ROWS = 5_000
NEIGHBOURS = 10

# Distances are kept within [NEAREST, FARTHEST * the largest one] before they become weights.
NEAREST = 1e-6
FARTHEST = 1e6

_CHUNK = 64  # rows whose distances to the block are held at once
_PREFIX = 128  # nearest rows looked at first


def assign_blocks(rows: DataFrame, n_rows: int | Column, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Deal the rows over ``ceil(n_rows / block_rows)`` blocks, at least one, by a hash of the admission.

    No order over the whole table is needed, and sizes vary around ``block_rows``. A stay is cut at calendar marks
    ``block_rows`` days apart, so that whatever an admission adds to one block is at most ``block_rows`` rows.
    """
    total = n_rows if isinstance(n_rows, Column) else F.lit(n_rows)
    blocks = F.greatest(F.lit(1).cast("bigint"), F.ceil(total / block_rows))
    stretch = F.floor(F.unix_date("startdate") / block_rows)
    key = F.concat_ws(":", F.col("hadm_id").cast("string"), stretch.cast("string"))
    return rows.withColumn("block", F.pmod(bucket_hash(key), blocks))


class _Block:
    """Mean squared differences between rows over the features both have.

    Complete 0/1 features are counted by one matrix product, which is exact on whole numbers; the others are summed
    feature by feature, always in the same order, so that equal rows get equal distances.
    """

    def __init__(self, x: np.ndarray, seen: np.ndarray):
        flags = seen.all(axis=0) & ((x == 0) | (x == 1)).all(axis=0)
        self.flags, self.ones = x[:, flags], x[:, flags].sum(axis=1)
        self.seen = seen.astype(float)
        others = np.flatnonzero(~flags & seen.any(axis=0))
        self.rest = [(x[:, j].copy(), self.seen[:, j].copy()) for j in others]

    def distances(self, rows: slice) -> np.ndarray:
        """From some rows to all rows; inf where they share no feature."""
        total = self.ones[rows, None] + self.ones - 2.0 * (self.flags[rows] @ self.flags.T)
        for value, has in self.rest:
            mine = np.flatnonzero(has[rows])
            gap = np.subtract.outer(value[rows][mine], value)
            gap *= gap
            gap *= has
            total[mine] += gap
        shared = self.seen[rows] @ self.seen.T
        return np.where(shared > 0, total / np.maximum(shared, 1.0), np.inf)


def _nearest(d: np.ndarray, width: int) -> np.ndarray:
    """The ``width`` nearest rows of each row of ``d`` in order of distance, equal distances in row order."""
    if width >= d.shape[1]:
        return np.argsort(d, axis=1, kind="stable")
    limit = np.partition(d, width - 1, axis=1)[:, width - 1]
    order = np.empty((len(d), width), dtype=np.int64)
    for k, row in enumerate(d):
        near = np.flatnonzero(row <= limit[k])
        order[k] = near[np.argsort(row[near], kind="stable")[:width]]
    return order


def _mean_of_nearest(near, d, value, has, k):
    """Weighted mean over the first ``k`` rows of ``near`` that have the value, and how many were found."""
    usable = has[near]
    picked = usable & (np.cumsum(usable, axis=1) <= k)
    weight = np.where(picked, 1.0 / np.take_along_axis(d, near, axis=1), 0.0)
    return (weight * value[near]).sum(axis=1) / np.maximum(weight.sum(axis=1), 1e-300), picked.sum(axis=1)


def fill_block(x: np.ndarray, k: int = NEIGHBOURS) -> np.ndarray:
    """Fill the gaps (NaN) of one block, rows in key order; equal distances go to the earlier key.

    A gap becomes the mean over the nearest ``k`` rows that have the feature, weighted by 1 / distance; with no such row
    it becomes 0.
    """
    seen = ~np.isnan(x)
    plain = np.where(seen, x, 0.0)
    filled = plain.copy()
    block = _Block(plain, seen)
    gaps = seen.any(axis=0) & ~seen.all(axis=0)
    parts = [slice(i, min(i + _CHUNK, len(x))) for i in range(0, len(x), _CHUNK)]
    far, largest = np.inf, 1.0
    if not seen.all(axis=0).any():  # some rows may share no feature: their distance depends on the largest one
        for rows in parts:
            d = block.distances(rows)
            largest = max(largest, d[np.isfinite(d)].max(initial=0.0))
        far = FARTHEST * largest
    for rows in parts:
        if seen[rows][:, gaps].all():
            continue
        d = np.clip(block.distances(rows), NEAREST, far)
        nearest = _nearest(d, _PREFIX)
        for j in np.flatnonzero(gaps):
            wanted = min(k, int(seen[:, j].sum()))
            todo = np.flatnonzero(~seen[rows, j])
            mean, found = _mean_of_nearest(nearest[todo], d[todo], plain[:, j], seen[:, j], k)
            filled[rows.start + todo, j] = mean
            todo = todo[found < wanted]  # too few among the nearest: look at all rows
            if len(todo):
                mean, _ = _mean_of_nearest(_nearest(d[todo], len(x)), d[todo], plain[:, j], seen[:, j], k)
                filled[rows.start + todo, j] = mean
    return filled


def knn_impute(blocked: DataFrame, k: int = NEIGHBOURS, key_as_feature: bool = False) -> DataFrame:
    """Fill the gaps of ``features`` within each block; input and output have one row per (admission, day).

    One block is one group of a task: about ``BLOCK_ROWS`` rows, with the distances of a few dozen rows in memory at a
    time. Blocks are small in bytes and long in work, so they are dealt to the shuffle partitions in turn; left to
    hashing and size-based merging, some tasks would get several more of them than others. ``key_as_feature`` lets the
    admission number take part in the distance.
    """
    parts = int(blocked.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    wanted = blocked.select("hadm_id", "startdate", "features", "block")
    schema = T.StructType(wanted.schema.fields[:3])
    dealt = wanted.withColumn("part", F.pmod("block", F.lit(parts)).cast("int")).repartitionById(parts, F.col("part"))

    def fill(block: pa.Table) -> pa.Table:
        block = block.sort_by([("hadm_id", "ascending"), ("startdate", "ascending")])
        cells = block["features"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
        x = cells.reshape(block.num_rows, -1).astype(float)
        if key_as_feature:
            x = np.column_stack([block["hadm_id"].to_numpy(), x])
        done = fill_block(x, k)[:, 1 if key_as_feature else 0 :]
        ends = np.arange(block.num_rows + 1, dtype=np.int32) * done.shape[1]
        features = pa.ListArray.from_arrays(ends, np.ascontiguousarray(done).ravel())
        return pa.table([block["hadm_id"], block["startdate"], features], names=schema.fieldNames())

    return dealt.groupBy("part", "block").applyInArrow(fill, schema)
