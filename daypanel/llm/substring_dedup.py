"""Removal of word passages that occur more than once, by Rabin-Karp hashes of every window of words.

A window of 35 words can only repeat where its anchor, a gram of five words chosen by the window's own content,
repeats. So the hashes go through Spark in two steps:

1. The anchors of all windows are counted by their hash, each once for a document. What has no repeated anchor cannot
   repeat.
2. Windows of repeated anchors are hashed. Those that share an anchor travel as one row (their hashes packed), to the
   task of that anchor, where equal hashes are counted. Rows with all windows equal are folded into one first, already
   in the block of documents that they come from, so a passage copied a million times sends one row from each block.

Windows that repeat become intervals, and overlapping intervals of a document merge. Anchor and window hash have 64
bits each and must both agree.

Null and empty texts have no words. Rows that repeat an id and its text count as one document; the same text under
another id is a repetition. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textscan import (
    SPANS,
    Block,
    Rolling,
    Words,
    anchored_runs,
    as_long,
    batch_of,
    byte_values,
    gathered,
    keyed,
    mix,
    spans_of,
    stretches,
    text_blocks,
    with_spans,
    words,
)

WINDOW = 35
GRAM = 5
_BYTES = byte_values(6)


def _hashes(data: np.ndarray, found: Words) -> np.ndarray:
    return Rolling(_BYTES[data]).stretch(found.starts, found.ends)


def _runs(block, window: int):
    found = words(block.data, block.offsets)
    rolling = Rolling(_hashes(block.data, found))
    gram = min(GRAM, window)
    grams = rolling.grams(gram)
    return found, rolling, grams, anchored_runs(grams, gram, found.offsets, window)


ANCHORS = "anchor long, d long, k long, twice boolean"


def anchors_of(block: Block, code: np.ndarray, row: np.ndarray) -> pa.RecordBatch:
    """One row for each anchor hash of a document; ``twice`` if the document has it at several places."""
    order = np.lexsort((code, row))
    new = np.append(True, (code[order[1:]] != code[order[:-1]]) | (row[order[1:]] != row[order[:-1]]))[: len(order)]
    first = np.flatnonzero(new)
    row = row[order[first]]
    return batch_of(
        anchor=as_long(code[order[first]]),
        d=block.column("d")[row],
        k=block.column("k")[row],
        twice=np.diff(np.append(first, len(order))) > 1,
    )


def repeated(found: DataFrame) -> DataFrame:
    """From rows of ``ANCHORS`` those that repeat, as a list of ``anchors`` for each (d, k)."""

    def pick(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = gathered(batches)
        if table is None:
            return
        anchor = table.column("anchor").to_numpy()
        order = np.argsort(anchor)
        same = anchor[order[1:]] == anchor[order[:-1]]
        again = table.column("twice").to_numpy()[order]
        again[1:] |= same
        again[:-1] |= same
        yield from table.select(["d", "k", "anchor"]).take(pa.array(np.sort(order[again]))).to_batches()

    dealt = found.repartition("anchor").mapInArrow(pick, "d long, k long, anchor long")
    return dealt.groupBy("d", "k").agg(F.collect_set("anchor").alias("anchors"))


def wanted_runs(block: Block, code: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Places of the runs whose anchor hash is in the row's list. A false one among 2^64 does no harm."""
    lists = block.batch.column("anchors")
    owner = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy())
    listed = lists.flatten().to_numpy().view(np.uint64) ^ mix(owner.astype(np.uint64))
    return np.flatnonzero(np.isin(code ^ mix(row.astype(np.uint64)), listed))


def joined_runs(row: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Intervals in the order of rows and places, those that touch as one."""
    new = np.append(True, (row[1:] != row[:-1]) | (low[1:] > high[:-1]))[: len(row)]
    first = np.flatnonzero(new)
    return row[first], low[first], high[np.append(first[1:] - 1, len(row) - 1)[: len(first)]]


def fold(
    codes: np.ndarray, d: np.ndarray, k: np.ndarray, low: np.ndarray, flag: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Groups of equal rows: order by (codes, d, k, low) without repeated rows, the group of each, first of each group.

    ``codes`` is a list of arrays that are equal where rows are equal. Of repeated rows one with a ``flag`` stays, if
    any has it.
    """
    order = np.lexsort((*(() if flag is None else (~flag,)), low, k, d, *codes[::-1]))
    equal = np.ones(max(0, len(order) - 1), bool)
    for x in codes:
        equal &= x[order[1:]] == x[order[:-1]]
    same = equal.copy()
    for x in (d, k, low):
        same &= x[order[1:]] == x[order[:-1]]
    keep = np.append([True] * bool(len(order)), ~same).astype(bool)
    group = np.cumsum(np.append([True] * bool(len(order)), ~equal).astype(bool)) - 1
    order, group = order[keep], group[keep]
    first = np.append([True] * bool(len(order)), group[1:] != group[:-1]).astype(bool)
    return order, group, first


def _spans_schema() -> str:
    return "d long, k long, low int, high int"


def repeated_windows(documents: DataFrame, window: int = WINDOW) -> DataFrame:
    """(d, k, low, high): stretches of words, end exclusive, covered by windows that also start anywhere else."""
    rows = keyed(documents)

    def anchors(batches):
        for block in text_blocks(batches):
            found, _, grams, runs = _runs(block, window)
            yield anchors_of(block, grams[runs.anchor], block.row_of(runs.low, found.offsets))

    def hashed(batches):
        for block in text_blocks(batches):
            found, rolling, grams, runs = _runs(block, window)
            row = block.row_of(runs.low, found.offsets)
            low = runs.low - found.offsets[row]
            pick = wanted_runs(block, grams[runs.anchor], row)
            if not len(pick):
                continue
            row, low, count = row[pick], low[pick].astype(np.int32), (runs.high - runs.low + 1)[pick]
            anchor = as_long(grams[runs.anchor[pick]])
            at = stretches(runs.low[pick], count)
            each = rolling.stretch(at, at + window)
            whole = as_long(Rolling(each).stretch(np.cumsum(count) - count, np.cumsum(count)))
            d, k = block.column("d")[row], block.column("k")[row]
            order, group, first = fold([anchor, whole, count], d, k, low)
            size = np.bincount(group)
            open_ = np.zeros(len(pick), bool)
            many = np.zeros(len(pick), bool)
            open_[order[first]] = True
            many[order] = size[group] > 1
            # What is settled here needs no anchor any more; its intervals are joined and dealt by document.
            settled = np.zeros(len(pick), bool)
            settled[order[~first]] = True
            at, begin, end = joined_runs(row[settled], low[settled], (low + count + window - 1)[settled])
            none = np.zeros(len(at), np.int64)
            yield batch_of(
                anchor=block.column("k")[at], whole=none, d=block.column("d")[at], k=block.column("k")[at],
                low=begin.astype(np.int32), n=(end - begin).astype(np.int32), many=none.astype(bool),
                hashes=pa.nulls(len(at), pa.binary()),
            )
            packed = each.tobytes()
            ends = np.cumsum(count) * 8
            yield batch_of(
                anchor=anchor[open_], whole=whole[open_], d=d[open_], k=k[open_], low=low[open_],
                n=count[open_].astype(np.int32), many=many[open_],
                hashes=pa.array([packed[e - 8 * n : e] for e, n in zip(ends[open_], count[open_])], pa.binary()),
            )

    def counted(batches):
        table = gathered(batches)
        if table is None:
            return
        done = table.filter(pa.compute.is_null(table.column("hashes")))
        table = table.filter(pa.compute.is_valid(table.column("hashes"))).combine_chunks()
        d, k, low, n, many, anchor, whole = (
            table.column(x).to_numpy() for x in ("d", "k", "low", "n", "many", "anchor", "whole")
        )
        yield batch_of(
            d=done.column("d").to_numpy(),
            k=done.column("k").to_numpy(),
            low=done.column("low").to_numpy(),
            high=done.column("low").to_numpy() + done.column("n").to_numpy(),
        )
        if not table.num_rows:
            return
        order, group, first = fold([anchor, whole, n], d, k, low, many)
        size = np.bincount(group)
        several = np.bincount(group, many[order]) > 0
        full = (size > 1) | several
        hit = order[full[group]]
        yield batch_of(d=d[hit], k=k[hit], low=low[hit], high=(low[hit] + n[hit] + window - 1).astype(np.int32))
        # One row of each group goes on, where its anchor has groups with other windows.
        lead = order[first]
        other = np.unique(anchor[lead], return_inverse=True, return_counts=True)
        lead, full = lead[other[2][other[1]] > 1], full[other[2][other[1]] > 1]
        if not len(lead):
            return
        each = np.frombuffer(b"".join(table.column("hashes").take(pa.array(lead)).to_pylist()), np.uint64)
        of = np.repeat(np.arange(len(lead)), n[lead])
        code = each ^ mix(anchor[lead].view(np.uint64))[of]
        order = np.lexsort((anchor[lead][of], code))
        same = (code[order[1:]] == code[order[:-1]]) & (anchor[lead][of[order[1:]]] == anchor[lead][of[order[:-1]]])
        again = np.zeros(len(order), bool)
        again[order[1:][same]] = True
        again[order[:-1][same]] = True
        again &= ~full[of]
        at = np.flatnonzero(again)
        place = low[lead][of[at]] + at - (np.cumsum(n[lead]) - n[lead])[of[at]]
        yield batch_of(
            d=d[lead][of[at]],
            k=k[lead][of[at]],
            low=place.astype(np.int32),
            high=(place + window).astype(np.int32),
        )

    # The same columns as in ``with_spans``, so that Spark can use one exchange of the texts for both joins.
    runs = rows.join(repeated(rows.mapInArrow(anchors, ANCHORS)), ["d", "k"]).select("doc_id", "d", "k", "text", "anchors")
    packed = runs.mapInArrow(
        hashed, "anchor long, whole long, d long, k long, low int, n int, many boolean, hashes binary"
    )
    return packed.repartition("anchor").mapInArrow(counted, _spans_schema())


def remove_repeated(documents: DataFrame, window: int = WINDOW) -> DataFrame:
    """Each document without its repeated windows.

    Returns doc_id, n_words, n_removed, kept_text (the words that stay, one space between them; empty for a null text)
    and removed (maximal intervals of words).
    """

    def cut(batches):
        for batch in batches:
            n_words, n_removed, kept, removed = [], [], [], []
            for text, (low, high) in zip(batch.column("text").cast(pa.large_binary()), spans_of(batch)):
                found = (text.as_py() or b"").split()  # bytes.split() parts at space and \x09-\x0D alone
                n_words.append(len(found))
                n_removed.append(int((high - low).sum()))
                removed.append([{"low": int(a), "high": int(b)} for a, b in zip(low, high)])
                for a, b in zip(low[::-1], high[::-1]):
                    del found[a:b]
                kept.append(b" ".join(found))
            yield batch_of(
                doc_id=batch.column("doc_id"),
                n_words=pa.array(n_words, pa.int64()),
                n_removed=pa.array(n_removed, pa.int64()),
                kept_text=pa.array(kept, pa.binary()).cast(pa.string()),
                removed=pa.array(removed, pa.list_(pa.struct([("low", pa.int32()), ("high", pa.int32())]))),
            )

    schema = f"doc_id long, n_words long, n_removed long, kept_text string, removed {SPANS}"
    return with_spans(documents, repeated_windows(documents, window)).mapInArrow(cut, schema)


def digest(documents: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256."""
    kept = remove_repeated(documents, window)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def brute_force(texts: dict[int, str | None], window: int = WINDOW) -> dict[int, tuple[int, int, str]]:
    """The definition, for tests."""
    split = {i: (t or "").encode().split() for i, t in texts.items()}
    count: dict[tuple, int] = {}
    for found in split.values():
        for s in range(len(found) - window + 1):
            key = tuple(found[s : s + window])
            count[key] = count.get(key, 0) + 1
    out = {}
    for i, found in split.items():
        gone = {
            p
            for s in range(len(found) - window + 1)
            if count[tuple(found[s : s + window])] > 1
            for p in range(s, s + window)
        }
        kept = b" ".join(w for p, w in enumerate(found) if p not in gone)
        out[i] = (len(found), len(gone), hashlib.sha256(kept).hexdigest())
    return out
