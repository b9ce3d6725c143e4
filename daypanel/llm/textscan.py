"""Scanning Arrow text columns with numpy: words, Rabin-Karp hashes and anchored windows.

Everything works on blocks of a few megabytes cut from the Arrow batches, so memory follows the longest text and not
the batch. Separators of words are single ASCII bytes, so words of UTF-8 bytes are the words of the code points.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_BYTES = 1 << 19
SPANS = "array<struct<low: int, high: int>>"
_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2^64
_LOW = np.uint64(0xFFFFFFFF)
_HIGH = np.uint64(0xFFFFFFFF00000000)
_POWERS: dict[str, np.ndarray] = {}


def frugal(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``run`` for ``mapInArrow``, with free memory given back to the system when the task ends.

    Workers live on between tasks, several of them on one executor, and the C library keeps what large arrays leave
    behind. Where the library has no such call, ``run`` runs as it is.
    """

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ctypes

        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            library = ctypes.CDLL(None)
            if hasattr(library, "malloc_trim"):
                library.malloc_trim(0)

    return wrapped


class Block(NamedTuple):
    """Texts of some rows, end to end. ``offsets`` has one entry more than rows; a null text is empty."""

    batch: pa.RecordBatch
    data: np.ndarray
    offsets: np.ndarray

    def column(self, name: str) -> np.ndarray:
        return self.batch.column(name).to_numpy(zero_copy_only=False)

    def row_of(self, places: np.ndarray, offsets: np.ndarray | None = None) -> np.ndarray:
        return np.searchsorted(self.offsets if offsets is None else offsets, places, "right") - 1


def text_blocks(batches: Iterable[pa.RecordBatch], limit: int = BLOCK_BYTES, text: str = "text") -> Iterator[Block]:
    for batch in batches:
        if not batch.num_rows:
            continue
        column = pc.fill_null(batch.column(text).cast(pa.large_binary()), b"")
        ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
        data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
        at = 0
        while at < len(column):
            to = max(at + 1, int(np.searchsorted(ends, ends[at] + limit, "right")) - 1)
            yield Block(batch.slice(at, to - at), data[ends[at] : ends[to]], ends[at : to + 1] - ends[at])
            at = to


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values; a bijection."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def byte_values(seed: int) -> np.ndarray:
    """A fixed pseudo-random 64-bit value for each byte."""
    return mix(mix(np.arange(1, 257, dtype=np.uint64)) + np.full(1, seed, np.uint64) * _BASE)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS["up"]) < n:
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        for name, base in (("up", _BASE), ("down", inverse)):
            steps = np.full(max(n, BLOCK_BYTES + 1), base, np.uint64)
            steps[0] = 1
            _POWERS[name] = np.cumprod(steps, dtype=np.uint64)
    return _POWERS["up"], _POWERS["down"]


class Rolling:
    """Rabin-Karp hashes of any stretch of a sequence of 64-bit values, from prefix sums."""

    def __init__(self, values: np.ndarray):
        up, self.down = _powers(len(values) + 1)
        self.sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * up[: len(values)], out=self.sums[1:])

    def stretch(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.down[starts])

    def grams(self, n: int) -> np.ndarray:
        """The hash of every ``n`` consecutive values."""
        count = max(0, len(self.sums) - n)
        return mix((self.sums[n : n + count] - self.sums[:count]) * self.down[:count])


class Words(NamedTuple):
    starts: np.ndarray
    ends: np.ndarray
    offsets: np.ndarray  # of each row's words


def table_of(*ranges: tuple[int, int]) -> np.ndarray:
    """A flag for each byte: True inside one of the ranges, ends included."""
    flags = np.zeros(256, bool)
    for low, high in ranges:
        flags[low : high + 1] = True
    return flags


NOT_SPACE = ~table_of((0x20, 0x20), (0x09, 0x0D))  # [^\x20\x09-\x0D]
ALNUM = ~table_of((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))  # [^\x00-\x2F\x3A-\x60\x7B-\x7F], after lower()


def lower(data: np.ndarray) -> np.ndarray:
    """A-Z to a-z, other bytes as they are."""
    shift = np.arange(256, dtype=np.uint8)
    shift[65:91] += 32
    return shift[data]


def words(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray = NOT_SPACE) -> Words:
    """The maximal stretches of ``inside`` bytes; none crosses a row."""
    hit = inside[data]
    if not len(hit):
        empty = np.zeros(0, np.int64)
        return Words(empty, empty, np.zeros(len(offsets), np.int64))
    before, after = np.empty_like(hit), np.empty_like(hit)
    before[0] = after[-1] = False
    before[1:], after[:-1] = hit[:-1], hit[1:]
    before[offsets[:-1][offsets[:-1] < len(hit)]] = False
    after[offsets[1:][offsets[1:] > 0] - 1] = False
    starts = np.flatnonzero(hit & ~before)
    return Words(starts, np.flatnonzero(hit & ~after) + 1, np.searchsorted(starts, offsets))


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while size * 2 <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    rest = width - size
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


class Runs(NamedTuple):
    """Consecutive windows with the same anchor: the windows that start at ``low`` to ``high``, both included."""

    anchor: np.ndarray
    low: np.ndarray
    high: np.ndarray


def anchored_runs(grams: np.ndarray, gram: int, offsets: np.ndarray, window: int) -> Runs:
    """Every window of ``window`` tokens inside a row, grouped by its anchor.

    The anchor of a window is the leftmost of its grams with the smallest hash, so it follows from the window's tokens
    alone: equal windows have equal grams at the same distance from their start. Anchors move right only, so the
    windows of one anchor are consecutive; about one gram in ``(window - gram) / 2`` becomes an anchor.
    """
    empty = np.zeros(0, np.int64)
    n = int(offsets[-1])
    if n < window:
        return Runs(empty, empty, empty)
    least = sliding_min((grams & _HIGH) | np.arange(len(grams), dtype=np.uint64), window - gram + 1)
    inside = np.ones(n - window + 1, bool)
    for end in offsets[1:-1]:
        inside[max(0, end - window + 1) : end] = False
    start = np.flatnonzero(inside)
    if not len(start):
        return Runs(empty, empty, empty)
    anchor = (least[start] & _LOW).astype(np.int64)
    new = np.ones(len(start), bool)
    new[1:] = anchor[1:] != anchor[:-1]
    first = np.flatnonzero(new)
    return Runs(anchor[first], start[first], start[np.append(first[1:], len(start)) - 1])


def as_long(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64).view(np.int64)


def batch_of(**columns: np.ndarray | pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x) for x in columns.values()], names=list(columns))


def gathered(batches: Iterable[pa.RecordBatch]) -> pa.Table | None:
    """All rows of a task's partition, which the shuffle keeps to a bounded size; None if there are none."""
    kept = [b for b in batches if b.num_rows]
    return pa.Table.from_batches(kept) if kept else None


def stretches(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """``start, start + 1, ...`` of each stretch, end to end."""
    total = int(lengths.sum())
    shift = np.repeat(starts - np.concatenate(([0], np.cumsum(lengths)[:-1])), lengths)
    return np.arange(total, dtype=np.int64) + shift


def keyed(documents: DataFrame, *more: str) -> DataFrame:
    """``doc_id`` and ``text`` with a key that joins can use: ``d`` (a null id is the smallest) and ``k`` (of the text).

    Rows that repeat both id and text are one document for every count, and each of them gets its result.
    """
    return documents.select(
        "doc_id",
        "text",
        *more,
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))).alias("d"),
        F.coalesce(F.xxhash64("text"), F.lit(0)).alias("k"),
    )


def merged(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Overlapping or touching intervals as maximal ones."""
    if not len(low):
        return low, high
    order = np.argsort(low, kind="stable")
    low, reach = low[order], np.maximum.accumulate(high[order])
    new = np.append(True, low[1:] > reach[:-1])
    return low[new], reach[np.append(np.flatnonzero(new)[1:] - 1, len(low) - 1)]


def with_spans(documents: DataFrame, spans: DataFrame) -> DataFrame:
    """The documents, every row, with ``spans``: the intervals of its (d, k), or null."""
    lists = spans.groupBy("d", "k").agg(F.collect_list(F.struct("low", "high")).alias("spans"))
    return keyed(documents).join(lists, ["d", "k"], "left").select("doc_id", "d", "k", "text", "spans")


def spans_of(batch: pa.RecordBatch, name: str = "spans") -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The merged intervals of each row of an Arrow batch."""
    lists = batch.column(name)
    flat = lists.flatten()
    low, high = flat.field("low").to_numpy(), flat.field("high").to_numpy()
    at = 0
    for n in lists.value_lengths().fill_null(0).to_pylist():
        yield merged(low[at : at + n], high[at : at + n])
        at += n
