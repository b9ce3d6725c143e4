"""Removal of 100-byte strings that also start earlier, by a range-partitioned sparse suffix array.

A full suffix array has an entry for each byte. Here only anchors have one: the 32-byte gram with the smallest hash in
a window, so that equal windows hold equal anchors at the same distance. One byte in about forty is an anchor.

1. Anchors are counted by the hash of their gram; what has no repeated anchor cannot repeat.
2. Each repeated anchor sends its suffix: the bytes from the anchor to the end of the last window that it stands for,
   then those before it (the context of its windows). Equal contexts from one block of documents are folded into the
   earliest one first, so copies send one suffix from each block.
3. Splitters from a bounded sample (``SAMPLE_LEADS`` anchors of about ``SAMPLE_DOCUMENTS`` documents) range-partition
   the suffixes by their leading bytes, ties by document and place. A leading gram of very many suffixes so runs over
   several buckets. The sample decides on balance only, not on the result.
4. Each bucket sorts its suffixes by multikey quicksort on 8-byte keys: what ties by one key is sorted by the next.
   Suffixes with the same leading gram stand together then; among them equal contexts are settled at once and the
   windows of the others one by one: all but the earliest of equal windows are repetitions.
5. The first and last leading gram of a bucket may go on in its neighbours. Their windows, one of each kind from each
   bucket, are compared across the buckets by hash.

Windows are compared by two 64-bit hashes. Offsets are UTF-8 bytes. "Earlier" is a smaller id (a null id is smallest),
or for equal ids the smaller key of the text, or an earlier start. Null and empty texts have no bytes; rows that repeat
an id and its text count as one document; extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .substring_dedup import ANCHORS, anchors_of, fold, joined_runs, repeated, wanted_runs
from .textscan import (
    SPANS,
    Rolling,
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
)

WINDOW = 100
GRAM = 32
SAMPLE_DOCUMENTS = 4000
SAMPLE_LEADS = 40_000
PORTION = 400_000
_ONE, _TWO = byte_values(101), byte_values(102)
_SPANS = "d long, k long, low int, high int, one long, two long"


def load_keys(data: np.ndarray, at: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Eight bytes from each place as a number that sorts like them; bytes from ``ends`` on are zero."""
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    view = np.ndarray((len(data) + 1,), ">u8", padded, strides=(1,))
    left = np.clip(ends - at, 0, 8)
    keys = view[np.minimum(at, len(data))].astype(np.uint64)
    shift = ((8 - left) * 8).astype(np.uint64)
    return np.where(left > 0, keys >> np.minimum(shift, np.uint64(63)) << np.minimum(shift, np.uint64(63)), np.uint64(0))


def multikey_order(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of byte strings by their first ``depth`` bytes, and a flag where one differs from the one before.

    Multikey quicksort with 8-byte keys: only strings that tie so far are sorted by their next key.
    """
    order = np.arange(len(starts))
    new = np.zeros(len(starts), bool)
    new[:1] = True
    slots = np.arange(len(starts))
    for level in range(-(-depth // 8)):
        if not len(slots):
            break
        group = np.cumsum(new)[slots]
        keys = load_keys(data, starts[order[slots]] + 8 * level, np.minimum(ends, starts + depth)[order[slots]])
        by = np.lexsort((keys, group))
        order[slots] = order[slots][by]
        keys = keys[by]
        differ = np.append(True, (keys[1:] != keys[:-1]) | (group[1:] != group[:-1]))
        new[slots[differ]] = True
        tie = ~new[slots]
        tie[:-1] |= ~new[slots[1:]] & (slots[1:] == slots[:-1] + 1)
        slots = slots[tie]
    return order, new


def _runs(block, window: int):
    gram = min(GRAM, window)
    rolling = Rolling(_ONE[block.data])
    grams = rolling.grams(gram)
    return rolling, grams, anchored_runs(grams, gram, block.offsets, window)


def earlier_repeats(documents: DataFrame, window: int = WINDOW) -> DataFrame:
    """(d, k, low, high): byte stretches, end exclusive, covered by windows that also start earlier."""
    gram = min(GRAM, window)
    rows = keyed(documents)

    def anchors(batches):
        for block in text_blocks(batches):
            _, grams, runs = _runs(block, window)
            yield anchors_of(block, grams[runs.anchor], block.row_of(runs.low))

    def suffixes(batches):
        edges = splitters.value
        for block in text_blocks(batches):
            rolling, grams, runs = _runs(block, window)
            row = block.row_of(runs.low)
            pick = wanted_runs(block, grams[runs.anchor], row)
            if not len(pick):
                continue
            row, start, stop, at = row[pick], runs.low[pick], runs.high[pick] + window, runs.anchor[pick]
            low = start - block.offsets[row]
            d, k = block.column("d")[row], block.column("k")[row]
            code = rolling.stretch(start, stop) ^ mix((at - start).astype(np.uint64))
            order, _, first = fold([grams[at], code, stop - start], d, k, low)
            open_, settled = np.zeros(len(pick), bool), np.zeros(len(pick), bool)
            open_[order[first]] = True
            settled[order[~first]] = True
            at_row, begin, end = joined_runs(row[settled], low[settled], (low + stop - start)[settled])
            owner = block.column("k")[at_row]
            yield batch_of(
                bucket=(owner % (len(edges) + 1)).astype(np.int32), context=pa.nulls(len(owner), pa.binary()),
                before=np.zeros(len(owner), np.int32), d=block.column("d")[at_row], k=owner,
                low=begin.astype(np.int32), high=end.astype(np.int32),
            )
            raw = block.data.tobytes()
            places = zip(at[open_].tolist(), start[open_].tolist(), stop[open_].tolist())
            context = [raw[a:e] + raw[s:a] for a, s, e in places]
            d, k, low = d[open_], k[open_], low[open_]
            yield batch_of(
                bucket=np.searchsorted(edges, _place_keys([c[:gram] for c in context], d, k, low), "right").astype(np.int32),
                context=pa.array(context, pa.binary()),
                before=(at - start)[open_].astype(np.int32),
                d=d, k=k, low=low.astype(np.int32), high=np.full(len(d), -1, np.int32),
            )

    def leads(batches):
        """Leading bytes and place of some anchors of sampled documents."""
        for block in text_blocks(batches):
            _, grams, runs = _runs(block, window)
            row = block.row_of(runs.low)
            raw = block.data.tobytes()
            low = runs.low - block.offsets[row]
            d, k = block.column("d")[row], block.column("k")[row]
            keys = _place_keys([raw[a : a + gram] for a in runs.anchor.tolist()], d, k, low)
            yield batch_of(draw=as_long(mix(grams[runs.anchor] ^ d.view(np.uint64))), key=pa.array(keys.tolist(), pa.binary()))

    def buckets(batches):
        table = gathered(batches)
        if table is None:
            return
        which = table.column("bucket").to_numpy()
        for b in np.unique(which):
            yield from bucket(table.filter(pa.array(which == b)))

    def bucket(table):
        settled = pa.compute.greater_equal(table.column("high"), 0)
        done, table = table.filter(settled), table.filter(pa.compute.invert(settled)).combine_chunks()
        none = np.zeros(done.num_rows, bool)
        yield _out(*(done.column(x).to_numpy() for x in ("d", "k", "low", "high")), none, np.zeros(len(none)), np.zeros(len(none)))
        if not table.num_rows:
            return
        d, k, low, before = (table.column(x).to_numpy() for x in ("d", "k", "low", "before"))
        contexts = table.column("context").combine_chunks().cast(pa.large_binary())
        contexts = contexts.chunk(0) if isinstance(contexts, pa.ChunkedArray) else contexts
        bounds = np.frombuffer(contexts.buffers()[1], np.int64)[contexts.offset : contexts.offset + len(contexts) + 1]
        data = np.frombuffer(contexts.buffers()[2], np.uint8)[bounds[0] : bounds[-1]]
        bounds = bounds - bounds[0]
        starts, ends = bounds[:-1], bounds[1:]
        order, new = multikey_order(data, starts, ends, int((ends - starts).max()))
        # Equal bytes with another anchor place are other contexts; equal ones stand in the order of their documents.
        equal = np.cumsum(new)
        size = (ends - starts)[order]
        by = np.lexsort((low[order], k[order], d[order], size, before[order], equal))
        order, equal, size = order[by], equal[by], size[by]
        d, k, low, before, starts, ends = (x[order] for x in (d, k, low, before, starts, ends))
        fresh = np.append(True, (equal[1:] != equal[:-1]) | (before[1:] != before[:-1]) | (size[1:] != size[:-1]))
        twin = np.append(False, ~fresh[1:] & (d[1:] == d[:-1]) & (k[1:] == k[:-1]) & (low[1:] == low[:-1]))
        hit = np.flatnonzero(~fresh & ~twin)
        # A row that comes twice follows its twin; if that one is the earliest, the row is no repetition.
        first = np.maximum.accumulate(np.where(fresh, np.arange(len(fresh)), 0))
        own = (d == d[first]) & (k == k[first]) & (low == low[first])
        hit = hit[~own[hit]]
        yield _out(d[hit], k[hit], low[hit], (low + size)[hit], np.zeros(len(hit), bool), np.zeros(len(hit)), np.zeros(len(hit)))
        lead = np.stack([load_keys(data, starts + 8 * i, np.minimum(ends, starts + gram)) for i in range(-(-gram // 8))])
        group = np.cumsum(np.append(True, (lead[:, 1:] != lead[:, :-1]).any(axis=0)))
        edge = (group == 1) | (group == group[-1])
        several = np.bincount(group[fresh], minlength=group[-1] + 1)[group] > 1
        pick = np.flatnonzero(fresh & (edge | several))
        rank = np.lexsort((low[pick], k[pick], d[pick]))
        pick = pick[rank]
        yield from _windows(data, d, k, low, before, starts, ends, group, edge, pick)

    def _windows(data, d, k, low, before, starts, ends, group, edge, pick):
        """The windows of contexts that share their leading gram with others, or may do so in another bucket."""
        # Whole leading grams together, in portions, so that memory is bounded by the largest of them.
        groups, index = np.unique(group[pick], return_inverse=True)
        count = (ends - starts)[pick] - window + 1
        load = np.cumsum(np.bincount(index, count).astype(np.int64))
        portion = (load // PORTION)[index]
        for p in np.unique(portion):
            some = pick[portion == p]
            size = (ends - starts)[some]
            text = data[stretches(starts[some], size)]
            first = np.cumsum(size) - size
            n = size - window + 1
            of = np.repeat(np.arange(len(some)), n)
            t = stretches(np.zeros(len(some), np.int64), n)
            tail = (first + size - before[some])[of] + t
            right = first[of] + window - before[some][of] + t
            codes = []
            for rolling in (Rolling(_ONE[text]), Rolling(_TWO[text])):
                left = rolling.stretch(tail, (first + size)[of])
                codes.append(rolling.stretch(first[of], right) ^ mix(left + (before[some][of] - t).astype(np.uint64)))
            # Windows lie in the order of their places, so a stable order leaves the earliest in front.
            by = np.lexsort((codes[1], codes[0]))
            same = (codes[0][by[1:]] == codes[0][by[:-1]]) & (codes[1][by[1:]] == codes[1][by[:-1]])
            later = np.zeros(len(of), bool)
            later[by[1:][same]] = True
            joined = np.zeros(len(of), bool)
            joined[1:] = later[1:] & later[:-1] & (of[1:] == of[:-1])
            begin = np.flatnonzero(later & ~joined)
            stop = np.flatnonzero(later & ~np.append(joined[1:], False))
            at = low[some][of] + t
            zero = np.zeros(len(begin))
            yield _out(d[some][of[begin]], k[some][of[begin]], at[begin], at[stop] + window, zero.astype(bool), zero, zero)
            open_ = np.flatnonzero(~later & edge[some][of])
            yield _out(
                d[some][of[open_]], k[some][of[open_]], at[open_], at[open_] + window, np.ones(len(open_), bool),
                as_long(codes[0][open_]), as_long(codes[1][open_]),
            )

    def _out(d, k, low, high, open_, one, two):
        return batch_of(
            d=d,
            k=k,
            low=low.astype(np.int32),
            high=high.astype(np.int32),
            one=pa.array(one.astype(np.int64), mask=~open_),
            two=pa.array(two.astype(np.int64), mask=~open_),
        )

    def across(batches):
        """Of equal windows from several buckets all but the earliest; the intervals of a document as maximal ones."""
        table = gathered(batches)
        if table is None:
            return
        done = table.filter(pa.compute.is_null(table.column("one"))).combine_chunks()
        d, k, low, high = (done.column(x).to_numpy() for x in ("d", "k", "low", "high"))
        order = np.lexsort((low, k, d))
        d, k, low, high = d[order], k[order], low[order], high[order]
        row = np.cumsum(np.append(True, (d[1:] != d[:-1]) | (k[1:] != k[:-1]))[: len(d)])
        # The furthest end so far in the document; rows that repeat a place would break a plain comparison.
        reach = np.maximum.accumulate(high + row * (1 << 32)) - row * (1 << 32)
        _, begin, end = joined_runs(row, low, reach)
        at = np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (low[1:] > reach[:-1]))[: len(row)])
        yield batch_of(d=d[at], k=k[at], low=begin, high=end.astype(np.int32))
        open_ = table.filter(pa.compute.is_valid(table.column("one"))).combine_chunks()
        d, k, low, high, one, two = (open_.column(x).to_numpy() for x in ("d", "k", "low", "high", "one", "two"))
        order, group, first = fold([one, two], d, k, low)
        later = order[~first]
        yield batch_of(d=d[later], k=k[later], low=low[later], high=high[later])

    n = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    share = max(1, -(-rows.count() // SAMPLE_DOCUMENTS))
    sampled = rows.filter(F.pmod(F.xxhash64("d", "k", F.lit("splitter")), F.lit(share)) == 0).mapInArrow(
        leads, "draw long, key binary"
    )
    keys = sorted(r.key for r in sampled.orderBy("draw").limit(SAMPLE_LEADS).collect())
    edges = [keys[len(keys) * i // n] for i in range(1, n)] if keys else []
    splitters = documents.sparkSession.sparkContext.broadcast(np.array(edges, f"S{gram + 20}"))

    # The same columns as in ``with_spans``, so that Spark can use one exchange of the texts for both joins.
    picked = rows.join(repeated(rows.mapInArrow(anchors, ANCHORS)), ["d", "k"]).select("doc_id", "d", "k", "text", "anchors")
    found = picked.mapInArrow(suffixes, "bucket int, context binary, before int, d long, k long, low int, high int")
    spans = found.repartitionById(n, F.col("bucket")).mapInArrow(buckets, _SPANS)
    return spans.repartition(F.coalesce("one", F.xxhash64("d", "k"))).mapInArrow(across, "d long, k long, low int, high int")


def _place_keys(lead: list[bytes], d: np.ndarray, k: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Strings that sort by leading bytes, then document, then place."""
    sign = np.uint64(1 << 63)
    tail = np.rec.fromarrays(
        [(d.view(np.uint64) ^ sign).astype(">u8"), (k.view(np.uint64) ^ sign).astype(">u8"), low.astype(">u4")]
    ).tobytes()
    size = max(map(len, lead), default=0) + 20
    return np.array([x + tail[20 * i : 20 * i + 20] for i, x in enumerate(lead)], f"S{size}")


def remove_earlier_repeats(documents: DataFrame, window: int = WINDOW) -> DataFrame:
    """Each document without its repeated bytes: doc_id, n_bytes, n_removed, kept (binary), removed (maximal runs)."""

    def cut(batches):
        for batch in batches:
            sizes, gone, kept, removed = [], [], [], []
            for text, (low, high) in zip(batch.column("text").cast(pa.large_binary()), spans_of(batch)):
                raw = text.as_py() or b""
                edges = [0, *np.stack((low, high), 1).ravel().tolist(), len(raw)]
                kept.append(b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2])) if len(low) else raw)
                sizes.append(len(raw))
                gone.append(len(raw) - len(kept[-1]))
                removed.append([{"low": int(a), "high": int(b)} for a, b in zip(low, high)])
            yield batch_of(
                doc_id=batch.column("doc_id"),
                n_bytes=pa.array(sizes, pa.int64()),
                n_removed=pa.array(gone, pa.int64()),
                kept=pa.array(kept, pa.binary()),
                removed=pa.array(removed, pa.list_(pa.struct([("low", pa.int32()), ("high", pa.int32())]))),
            )

    schema = f"doc_id long, n_bytes long, n_removed long, kept binary, removed {SPANS}"
    return with_spans(documents, earlier_repeats(documents, window)).mapInArrow(cut, schema)


def digest(documents: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    return remove_earlier_repeats(documents, window).select(
        "doc_id",
        "n_bytes",
        "n_removed",
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def brute_force(texts: dict[int, str | None], window: int = WINDOW) -> dict[int, tuple[int, int, int, str]]:
    """The definition, for tests."""
    seen: set[bytes] = set()
    out = {}
    for i in sorted(texts):
        raw = (texts[i] or "").encode()
        gone = bytearray(len(raw))
        for s in range(len(raw) - window + 1):
            piece = raw[s : s + window]
            if piece in seen:
                gone[s : s + window] = b"\1" * window
            seen.add(piece)
        runs = sum(1 for p in range(len(gone)) if gone[p] and (p == 0 or not gone[p - 1]))
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        out[i] = (len(raw), sum(gone), runs, hashlib.sha256(kept).hexdigest())
    return out
