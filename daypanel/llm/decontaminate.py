"""Removal of benchmark passages from training text, by an FM-index of each training shard.

The test phrases are all windows of 10 words of the benchmark items. Each task cuts its documents into shards, builds
the FM-index of a shard's words (suffix array, Burrows-Wheeler transform, wavelet matrix, every eighth suffix position
kept) and searches all phrases in it at once, backwards, by wavelet ranks. Found places are traced to kept suffix
positions, and the words that they cover merge into removal spans.

Words outside the benchmark's vocabulary cannot take part in an occurrence, nor can a stretch of vocabulary words that
is shorter than the shortest phrase; so a shard's index holds the longer stretches alone.

The benchmark is dealt into blocks of a bounded size (``BLOCK_BYTES`` of text). Each block is collected, shipped to
the tasks and searched in all documents, one pass over them for each block, whose results are written before the next
block is collected; a benchmark of test sets has one block.

Words are lower-cased (A-Z) alphanumeric stretches. An item of fewer than 10 words, but not none, is one phrase. Null
texts have no words; an item with a null id marks words but is not listed; items that share an id count once.
Repeated rows each get their result. Extra columns are ignored, or carried by ``decontaminate``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import staged
from .textscan import (
    ALNUM,
    SPANS,
    Block,
    Rolling,
    batch_of,
    byte_values,
    frugal,
    keyed,
    lower,
    spans_of,
    stretches,
    text_blocks,
    words,
)

PHRASE = 10
SHARD_BYTES = 1 << 20
BLOCK_BYTES = 8 << 20
SAMPLE = 8
_BYTES = byte_values(8)


class WaveletMatrix:
    """Ranks of symbols in a sequence, one bit plane per level."""

    def __init__(self, symbols: np.ndarray, n_symbols: int):
        self.levels = max(1, int(n_symbols - 1).bit_length())
        self.zeros, self.ranks, self.planes = [], [], []
        for level in reversed(range(self.levels)):
            bits = (symbols >> level) & 1
            rank = np.zeros(len(bits) + 1, np.int64)
            np.cumsum(bits == 0, out=rank[1:])
            self.planes.append(bits.astype(bool))
            self.ranks.append(rank)
            self.zeros.append(rank[-1])
            symbols = np.concatenate((symbols[bits == 0], symbols[bits == 1]))

    def _down(self, level: int, at: np.ndarray, bit: np.ndarray) -> np.ndarray:
        zeros = self.ranks[level][at]
        return np.where(bit, self.zeros[level] + at - zeros, zeros)

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often ``symbol`` stands before ``at``."""
        begin = np.zeros_like(at)
        for level in range(self.levels):
            bit = ((symbol >> (self.levels - 1 - level)) & 1).astype(bool)
            begin, at = self._down(level, begin, bit), self._down(level, at, bit)
        return at - begin

    def symbol_and_rank(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at ``at`` and how often it stands before."""
        begin, symbol = np.zeros_like(at), np.zeros_like(at)
        for level in range(self.levels):
            bit = self.planes[level][at]
            symbol = symbol << 1 | bit
            begin, at = self._down(level, begin, bit), self._down(level, at, bit)
        return symbol, at - begin


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """By prefix doubling; the last symbol must be smaller than all others and stand there only."""
    n = len(symbols)
    rank = np.unique(symbols, return_inverse=True)[1].astype(np.int64)
    width = 1
    while True:
        key = rank * (n + 1)
        key[: n - width] += rank[width:] + 1
        order = np.argsort(key, kind="stable")
        new = np.append(0, np.cumsum(key[order[1:]] != key[order[:-1]]))
        rank = np.empty(n, np.int64)
        rank[order] = new
        if new[-1] == n - 1:
            return order
        width *= 2


class FMIndex:
    """Backward search and location in a sequence of symbols from 1 on."""

    def __init__(self, symbols: np.ndarray, n_symbols: int, sample: int = SAMPLE):
        text = np.append(symbols, 0).astype(np.int64)
        order = suffix_array(text)
        self.less = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=n_symbols + 1))))
        self.wavelet = WaveletMatrix(text[order - 1], n_symbols + 1)
        marked = (order % sample == 0) | (order == 0)
        self.mark_rank = np.concatenate(([0], np.cumsum(marked)))
        self.marked, self.position = marked, order[marked]

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each row of symbols, the range of suffixes that begin with it."""
        low = self.less[phrases[:, -1]]
        high = self.less[phrases[:, -1] + 1]
        for column in phrases[:, -2::-1].T:
            low = self.less[column] + self.wavelet.rank(column, low)
            high = self.less[column] + self.wavelet.rank(column, high)
        return low, np.maximum(low, high)

    def locate(self, suffixes: np.ndarray) -> np.ndarray:
        """The position of each suffix: back through the transform to one that was kept."""
        place = np.empty(len(suffixes), np.int64)
        left, at, steps = np.arange(len(suffixes)), suffixes, 0
        while len(left):
            there = self.marked[at]
            place[left[there]] = self.position[self.mark_rank[at[there]]] + steps
            left, at = left[~there], at[~there]
            symbol, rank = self.wavelet.symbol_and_rank(at)
            at = self.less[symbol] + rank
            steps += 1
        return place


def _word_hashes(data: np.ndarray, offsets: np.ndarray):
    found = words(lower(data), offsets, ALNUM)
    return found, Rolling(_BYTES[lower(data)]).stretch(found.starts, found.ends)


class Phrases:
    """The windows of some items: symbols of their words, grouped by length, and the items of each."""

    def __init__(self, items: list[tuple[str | None, str]], size: int):
        texts = [text.encode() for _, text in items]
        offsets = np.cumsum([0, *map(len, texts)])
        found, hashes = _word_hashes(np.frombuffer(b"".join(texts), np.uint8), offsets)
        self.vocabulary, symbol = np.unique(hashes, return_inverse=True)
        self.ids = np.array(sorted({i for i, _ in items if i is not None}), object)
        number = {i: n for n, i in enumerate(self.ids)}
        windows: dict[tuple[int, ...], set[int]] = {}
        for (item, _), low, high in zip(items, found.offsets[:-1], found.offsets[1:]):
            row = (symbol[low:high] + 2).tolist()  # 0 ends the text, 1 parts its stretches
            for s in range(max(1, len(row) - size + 1)) if row else ():
                windows.setdefault(tuple(row[s : s + size]), set()).update([number[item]] if item is not None else [])
        by_length: dict[int, list] = {}
        for window, of in windows.items():
            by_length.setdefault(len(window), []).append((window, sorted(of)))
        self.groups = []
        for rows in by_length.values():
            lists = [of for _, of in rows]
            self.groups.append(
                (
                    np.array([window for window, _ in rows], np.int64),
                    np.array([i for of in lists for i in of], np.int64),
                    np.array([len(of) for of in lists], np.int64),
                )
            )
        self.shortest = min(by_length, default=0)

    def find(self, block: Block):
        """Of a block: its words, a flag for each word that a phrase covers, and (row, item number) pairs."""
        found, hashes = _word_hashes(block.data, block.offsets)
        covered = np.zeros(len(hashes), bool)
        pairs = np.zeros((0, 2), np.int64)
        if not self.groups or not len(hashes):
            return found, covered, pairs
        near = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        known = self.vocabulary[near] == hashes
        # Stretches of known words inside a row, if long enough for a phrase.
        edge = np.ones(len(known), bool)
        edge[1:] = known[1:] != known[:-1]
        edge[found.offsets[:-1][found.offsets[:-1] < len(known)]] = True
        start = np.flatnonzero(edge)
        length = np.diff(np.append(start, len(known)))
        use = known[start] & (length >= self.shortest)
        start, length = start[use], length[use]
        if not len(start):
            return found, covered, pairs
        at = stretches(start, length + 1)  # one place more for the mark between stretches
        at = np.minimum(at, len(near) - 1)
        symbols = near[at] + 2
        symbols[np.cumsum(length + 1) - 1] = 1
        index = FMIndex(symbols, len(self.vocabulary) + 2)
        hits = []
        change = np.zeros(len(hashes) + 1, np.int64)
        for phrases, items, sizes in self.groups:
            low, high = index.search(phrases)
            live = np.flatnonzero(high > low)
            count = (high - low)[live]
            place = at[index.locate(stretches(low[live], count))]
            np.add.at(change, place, 1)
            np.add.at(change, place + phrases.shape[1], -1)
            which = np.repeat(live, count)
            begin = (np.cumsum(sizes) - sizes)[which]
            row = np.repeat(np.searchsorted(found.offsets, place, "right") - 1, sizes[which])
            hits.append(np.stack((row, items[stretches(begin, sizes[which])]), 1))
        covered = np.cumsum(change[:-1]) > 0
        return found, covered, np.unique(np.concatenate(hits), axis=0)


def benchmark_blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[list[tuple[str | None, str]]]:
    """The items as (id, text), in blocks of about ``block_bytes`` each. A block is collected when it is asked for."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), "text").filter("text is not null").distinct()
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, math.ceil(total / block_bytes))
    block = F.pmod(F.xxhash64("item", "text"), F.lit(n))
    for b in range(n):
        yield [tuple(r) for r in items.filter(block == b).collect()]


#: What a document's row says: words, words hit, the items found, and the byte spans to remove.
RESULT = "n_words long, n_hit long, items array<string>, spans array<struct<low: int, high: int>>"


def _search(documents: DataFrame, phrases: Phrases, shard_bytes: int) -> DataFrame:
    def scan(batches):
        for block in text_blocks(batches, shard_bytes):
            found, covered, pairs = phrases.find(block)
            total = np.concatenate(([0], np.cumsum(covered)))
            begins = np.ones(len(covered) + 1, bool)  # at the words where a row begins, and behind the last one
            begins[1:-1] = False
            begins[found.offsets] = True
            first, last = covered.copy(), covered.copy()
            first[1:] &= ~covered[:-1] | begins[1:-1]
            last[:-1] &= ~covered[1:] | begins[1:-1]
            low, high = np.flatnonzero(first), np.flatnonzero(last) + 1
            row = np.searchsorted(found.offsets, low, "right") - 1
            begin = block.offsets[row]
            n = len(block.offsets) - 1
            span = pa.StructArray.from_arrays(
                [pa.array((found.starts[low] - begin).astype(np.int32)), pa.array((found.ends[high - 1] - begin).astype(np.int32))],
                names=["low", "high"],
            )
            yield batch_of(
                document=block.batch.column("document"),
                n_words=np.diff(found.offsets),
                n_hit=np.diff(total[found.offsets]),
                items=pa.ListArray.from_arrays(
                    pa.array(np.searchsorted(pairs[:, 0], np.arange(n + 1)).astype(np.int32)),
                    pa.array(phrases.ids[pairs[:, 1]].tolist(), pa.string()),
                ),
                spans=pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(n + 1)).astype(np.int32)), span),
            )

    whole = T.StructField("document", documents.schema, False)
    schema = T.StructType([whole, *T._parse_datatype_string(RESULT).fields])
    columns = F.struct(*(documents[name] for name in documents.columns))
    return documents.select(columns.alias("document"), "text").mapInArrow(frugal(scan), schema)


def contamination(documents: DataFrame, benchmark: DataFrame, phrase: int = PHRASE, shard_bytes: int = SHARD_BYTES,
                  block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``document`` (all columns as a struct), n_words, n_hit, items (sorted ids) and spans (of bytes, end exclusive).

    With more than one block of the benchmark, each is searched in a pass of its own, and what it finds is written before
    the next block is collected; so the driver and the tasks hold one block at a time. Each document's spans and items are
    then united, and the words that they cover are counted.
    """
    blocks = benchmark_blocks(benchmark, block_bytes)
    first, second = next(blocks), next(blocks, None)
    if second is None:
        return _search(documents, Phrases(first, phrase), shard_bytes)
    passes = [_found(documents, Phrases(block, phrase), shard_bytes) for block in chain([first, second], blocks)]
    return _united(documents, passes)


def _found(documents: DataFrame, phrases: Phrases, shard_bytes: int) -> DataFrame:
    """(d, k, items, spans) of the documents in which a block's phrases occur, written."""
    found = _search(keyed(documents), phrases, shard_bytes).filter(F.size("spans") > 0)
    return staged(found.select("document.d", "document.k", "items", "spans").dropDuplicates(["d", "k"]), "benchmark-found")


def _united(documents: DataFrame, passes: list[DataFrame]) -> DataFrame:
    found = reduce(DataFrame.unionByName, passes).groupBy("d", "k").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.flatten(F.collect_list("spans")).alias("spans"),
    )
    key = [F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))).alias("d"), F.coalesce(F.xxhash64("text"), F.lit(0)).alias("k")]
    whole = documents.select(F.struct(*(documents[c] for c in documents.columns)).alias("document"), "text", *key)
    joined = whole.join(found, ["d", "k"], "left").select(
        "document",
        F.lit(0).cast("long").alias("n_words"),
        F.lit(0).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.coalesce("spans", F.array().cast(SPANS)).alias("spans"),
    )

    def count(batches):
        for batch in batches:
            sizes, hits, spans = [], [], []
            texts = batch.column("document").field("text").cast(pa.large_binary())
            for text, (low, high) in zip(texts, spans_of(batch)):
                raw = np.frombuffer(text.as_py() or b"", np.uint8)
                found = words(lower(raw), np.array([0, len(raw)]), ALNUM)
                sizes.append(len(found.starts))
                hits.append(int((np.searchsorted(found.starts, high) - np.searchsorted(found.starts, low)).sum()))
                spans.append([{"low": int(a), "high": int(b)} for a, b in zip(low, high)])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("document"), pa.array(sizes, pa.int64()), pa.array(hits, pa.int64()), batch.column("items"),
                    pa.array(spans, batch.column("spans").type),
                ],
                joined_names,
            )

    joined_names = joined.columns
    return joined.mapInArrow(frugal(count), joined.schema)


#: The text without its spans, which are in order, do not touch and lie between characters.
_CUT = """
if(size(spans) = 0, document.text, array_join(transform(array(cast(document.text as binary)), t ->
  transform(sequence(0, size(spans)), i -> cast(substring(t, if(i = 0, 0, spans[i - 1].high) + 1,
    if(i = size(spans), octet_length(t), spans[i].low) - if(i = 0, 0, spans[i - 1].high)) as string)))[0], ''))
"""


def decontaminate(documents: DataFrame, benchmark: DataFrame, phrase: int = PHRASE) -> DataFrame:
    """The documents, all columns, without the benchmark's passages; others keep their text byte for byte.

    ``n_chars``, if there is such a column, follows the new text.
    """
    found = contamination(documents, benchmark, phrase)

    new = found.select("document", F.expr(_CUT).alias("kept"))
    changed = {"text": F.col("kept")}
    if "n_chars" in documents.columns:
        was = F.col("document")["n_chars"]
        length = F.length("kept").cast(documents.schema["n_chars"].dataType)
        changed["n_chars"] = F.when(F.col("document")["text"] == F.col("kept"), was).otherwise(length)
    return new.select(*(changed.get(c, F.col("document")[c]).alias(c) for c in documents.columns))


def digest(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    return contamination(documents, benchmark).select(
        "document.doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def brute_force(texts: list[str | None], items: list[tuple[str | None, str | None]], phrase: int = PHRASE) -> list[tuple]:
    """(n_words, n_hit, sorted items) of each text by the definition, for tests."""
    import re

    def split(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))

    windows: dict[tuple, set] = {}
    for item, text in items:
        row = split(text)
        for s in range(max(1, len(row) - phrase + 1)) if row else ():
            windows.setdefault(tuple(row[s : s + phrase]), set()).add(item)
    sizes = {len(w) for w in windows}
    out = []
    for text in texts:
        row, hit, found = split(text), set(), set()
        for n in sizes:
            for s in range(len(row) - n + 1):
                if (w := tuple(row[s : s + n])) in windows:
                    hit.update(range(s, s + n))
                    found |= windows[w]
        out.append((len(row), len(hit), sorted(i for i in found if i is not None)))
    return out
