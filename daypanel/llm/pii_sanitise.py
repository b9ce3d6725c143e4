"""Personal data, and the words beside it that give it away although it is masked.

Fixed patterns find e-mail addresses, IP addresses, card and telephone numbers: the protected entities. A word of a
document that names an entity, wherever it stands, discloses it as far as the corpus says so: with the number of
documents that have the pair, the word and the entity,

    share = pair / word                                 how likely the entity is where the word stands
    bits  = log2(pair * documents / (word * entity))    their pointwise mutual information
    own   = log2(documents / entity)                    what the entity itself says, the most that ``bits`` can be

A word whose pair stands in ``SUPPORT`` different texts or more, with ``bits`` of at least ``INFORMATION`` of ``own``, is
generalised from a share of ``GENERALISE`` on and removed from ``REMOVE`` on. An entity of all documents says nothing. Only documents that name the entity are changed, at every place of the word, so documents without personal data stay as
they are. Words may have any length.

Pairs are listed only for entities that stand in ``SUPPORT`` different texts, since no other pair can have so many.

Counts cover all documents, rows that repeat one once. Words are counted where a fixed-size bitmap (``BITMAP`` bits) says that they may belong to
a pair with enough support, and joined with the pairs exactly afterwards.

Places are code points, ends exclusive. Null and empty texts have no spans. Rows that repeat an id and its text are one
document for the counts, and each gets its result. Extra columns are ignored, or carried by ``sanitise``.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import staged
from .textscan import ALNUM, Rolling, as_long, batch_of, byte_values, keyed, lower, text_blocks, words

KINDS = ("email", "ip", "card", "phone")
ADDED = ("general", "removed")
SUPPORT = 3
INFORMATION = 0.5
GENERALISE = 0.5
REMOVE = 0.9
BITMAP = 1 << 20
_BYTES = byte_values(9)

# The patterns. The local part of an address is found backwards from its "@", so that a long stretch
# without one costs no more than its length; for the same reason an IP address begins where its digits begin.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")


def emails(text: str):
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            done = found.end()
        at = text.find("@", max(at + 1, done))


def luhn(digits: str) -> bool:
    total = 0
    for place, c in enumerate(reversed(digits)):
        n = int(c) << (place & 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def base_spans(text: str):
    """(kind's place, start, end), by kind, then start."""
    if "@" in text:
        for start, end in emails(text):
            yield 0, start, end
    if not DIGIT.search(text):
        return
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            yield 1, m.start(), m.end()
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                yield 2, m.start(), m.end()
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                yield 3, m.start(), m.end()


def _entity(kind: int, value: str) -> str:
    """One spelling of an entity: addresses in lower case, numbers by their digits."""
    return f"{kind}:{value.lower() if kind == 0 else value if kind == 1 else re.sub('[^0-9]', '', value)}"


SPANS = "array<struct<kind: int, low: int, high: int>>"
PLACES = "array<struct<word: long, low: int, high: int>>"


def _scan(rows: DataFrame) -> DataFrame:
    """(doc_id, d, k, spans, entities, places) of every document; places are all words of one that names an entity."""
    span_type = pa.list_(pa.struct([("kind", pa.int32()), ("low", pa.int32()), ("high", pa.int32())]))

    def places(text: str, spans: list[tuple[int, int, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        raw = np.frombuffer(text.encode(), np.uint8)
        data = lower(raw)
        found = words(data, np.array([0, len(data)]), ALNUM)
        points = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))  # code points before each byte
        low, high = points[found.starts], points[found.ends]
        code = as_long(Rolling(_BYTES[data]).stretch(found.starts, found.ends))
        open_ = np.ones(len(low), bool)
        for _, start, end in spans:
            open_[np.searchsorted(high, start, "right") : np.searchsorted(low, end, "left")] = False
        return code[open_], low[open_].astype(np.int32), high[open_].astype(np.int32)

    none = np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.int32)

    def scan(batches):
        for batch in batches:
            spans, entities, open_ = [], [], [none]
            ends = [0]
            for text in batch.column("text").to_pylist():
                found = list(base_spans(text)) if text else []
                spans.append([{"kind": n, "low": a, "high": b} for n, a, b in found])
                entities.append(sorted({_entity(n, text[a:b]) for n, a, b in found}))
                if found:
                    open_.append(places(text, found))
                ends.append(ends[-1] + (len(open_[-1][0]) if found else 0))
            each = [pa.array(np.concatenate(x)) for x in zip(*open_)]
            yield batch_of(
                doc_id=batch.column("doc_id"), d=batch.column("d"), k=batch.column("k"),
                spans=pa.array(spans, span_type), entities=pa.array(entities, pa.list_(pa.string())),
                places=pa.ListArray.from_arrays(
                    pa.array(ends, pa.int32()), pa.StructArray.from_arrays(each, names=["word", "low", "high"])
                ),
            )

    key = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, d long, k long"
    return staged(rows.mapInArrow(scan, f"{key}, spans {SPANS}, entities array<string>, places {PLACES}"), "personal")


def _bitmap(bits: DataFrame):
    """``bits`` (bit), below ``BITMAP``, as flags that every task gets."""
    packed = bits.distinct().groupBy(F.floor(F.col("bit") / 32).alias("at")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("bit") % 32).cast("int"))).alias("bits")
    )
    bitmap = np.zeros(BITMAP // 32, np.uint32)
    for at, value in packed.collect():  # BITMAP / 32 rows at most
        bitmap[at] = value
    return bits.sparkSession.sparkContext.broadcast(bitmap)


def _flags(shipped) -> np.ndarray:
    return np.unpackbits(shipped.value.view(np.uint8), bitorder="little").astype(bool)


def _word_counts(rows: DataFrame, scanned: DataFrame, pairs: DataFrame) -> DataFrame:
    """(word, n): documents with the word, for every word of ``pairs``.

    Each block adds up its documents. Those that may have several rows, by a bitmap of their keys, are listed instead,
    so that each counts once wherever its rows are.
    """
    wanted = _bitmap(pairs.select(F.pmod("word", F.lit(BITMAP)).alias("bit")))
    again = scanned.groupBy("d", "k").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")
    repeated = _bitmap(again.select(F.pmod(F.col("d").bitwiseXOR(F.col("k")), F.lit(BITMAP)).alias("bit")))

    def count(batches):
        flags, several = _flags(wanted), _flags(repeated)
        for block in text_blocks(batches):
            data = lower(block.data)
            found = words(data, block.offsets, ALNUM)
            code = as_long(Rolling(_BYTES[data]).stretch(found.starts, found.ends))
            at = np.flatnonzero(flags[code % BITMAP])
            row = np.searchsorted(found.offsets, at, "right") - 1
            once = np.unique(np.stack((code[at], block.column("d")[row], block.column("k")[row])), axis=1)
            listed = several[(once[1] ^ once[2]) % BITMAP]
            word, n = np.unique(once[0][~listed], return_counts=True)
            none = pa.nulls(len(word), pa.int64())
            yield batch_of(word=word, d=none, k=none, n=n)
            word, d, k = once[:, listed]
            yield batch_of(word=word, d=d, k=k, n=np.ones(len(word), np.int64))

    found = rows.select("d", "k", "text").mapInArrow(count, "word long, d long, k long, n long")
    found = found.groupBy("word", "d", "k").agg(F.when(F.col("d").isNull(), F.sum("n")).otherwise(F.lit(1)).alias("n"))
    return found.groupBy("word").agg(F.sum("n").alias("n")).join(pairs.select("word").distinct(), "word")


def _named(scanned: DataFrame) -> DataFrame:
    """(d, k, entity): the documents that name each entity."""
    return scanned.select("d", "k", F.explode("entities").alias("entity")).distinct()


def _words(scanned: DataFrame) -> DataFrame:
    """(d, k, words): the distinct words of each document that names an entity."""
    own = scanned.filter(F.size("entities") > 0).select("d", "k", F.array_distinct("places.word").alias("words"))
    return own.dropDuplicates(["d", "k"])


def _pairs(scanned: DataFrame, named: DataFrame) -> DataFrame:
    """(d, k, entity, word): each entity of ``named`` with each word of the document."""
    lists = named.groupBy("d", "k").agg(F.collect_list("entity").alias("entities"))
    met = _words(scanned).join(lists, ["d", "k"])
    return met.select("d", "k", "words", F.explode("entities").alias("entity")).select(
        "d", "k", "entity", F.explode("words").alias("word")
    )


def disclosing_words(rows: DataFrame, scanned: DataFrame) -> DataFrame:
    """(entity, word, kind): pairs above the thresholds; kind 0 is generalised, 1 removed."""
    named = _named(scanned)
    texts = named.groupBy("entity", "k").agg(F.count(F.lit(1)).alias("n"))
    entities = texts.groupBy("entity").agg(F.sum("n").alias("documents"), F.count(F.lit(1)).alias("texts"))
    entities = staged(entities.filter(F.col("texts") >= SUPPORT).select("entity", "documents"), "personal-entities")
    listed = _pairs(scanned, named.join(entities, "entity"))
    texts = listed.groupBy("entity", "word", "k").agg(F.count(F.lit(1)).alias("n"))
    pairs = texts.groupBy("entity", "word").agg(F.sum("n").alias("pair"), F.count(F.lit(1)).alias("texts"))
    # A word stands in as many documents at least as name any entity and have it, so its share is no higher than this.
    inside = _words(scanned).select(F.explode("words").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("least"))
    pairs = pairs.filter(F.col("texts") >= SUPPORT).join(inside, "word")
    pairs = staged(pairs.filter(F.col("pair") / F.col("least") >= GENERALISE).drop("least"), "personal-pairs")
    total = scanned.agg(F.count_distinct("d", "k")).first()[0]
    judged = pairs.join(entities, "entity").join(_word_counts(rows, scanned, pairs), "word")
    share = F.least(F.col("pair") / F.col("n"), F.lit(1.0))
    bits = F.log2(F.col("pair") * F.lit(float(total)) / (F.col("n") * F.col("documents")))
    own = F.log2(F.lit(float(total)) / F.col("documents"))
    found = judged.withColumn("share", share).withColumn("bits", bits).withColumn("own", own)
    found = found.filter((F.col("share") >= GENERALISE) & (F.col("own") > 0) & (F.col("bits") >= INFORMATION * F.col("own")))
    return found.select("entity", "word", (F.col("share") >= REMOVE).cast("int").alias("kind"))


def personal_data(documents: DataFrame) -> DataFrame:
    """doc_id, d, k, spans (base, by kind and start) and added (kind 0 generalised, 1 removed; by start)."""
    rows = keyed(documents)
    scanned = _scan(rows)
    words_ = staged(disclosing_words(rows, scanned), "personal-words")
    named = _named(scanned).join(words_.select("entity").distinct(), "entity")
    judged = _pairs(scanned, named).join(words_, ["entity", "word"]).groupBy("d", "k", "word").agg(F.max("kind").alias("kind"))
    places = scanned.filter(F.size("entities") > 0).select("d", "k", F.explode("places").alias("p")).select("d", "k", "p.*")
    hit = places.join(judged, ["d", "k", "word"]).groupBy("d", "k", "low", "high").agg(F.max("kind").alias("kind"))
    added = hit.groupBy("d", "k").agg(F.array_sort(F.collect_list(F.struct("kind", "low", "high"))).alias("added"))
    found = scanned.select("doc_id", "d", "k", "spans").join(added, ["d", "k"], "left")
    return found.withColumn("added", F.coalesce("added", F.array().cast(SPANS)))


def _text(spans, kinds):
    names = F.array(*map(F.lit, kinds))
    return F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["low"], s["high"]))


def digest(documents: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, n_general, n_removed, base_sha256, spans."""
    number = lambda spans, nth: F.size(F.filter(spans, lambda s: s["kind"] == nth)).cast("long")
    base, added = _text("spans", KINDS), _text("added", ADDED)
    return personal_data(documents).select(
        "doc_id",
        *(number("spans", nth).alias(f"n_{kind}") for nth, kind in enumerate(KINDS)),
        *(number("added", nth).alias(f"n_{kind}") for nth, kind in enumerate(ADDED)),
        F.sha2(F.array_join(base, ","), 256).alias("base_sha256"),
        F.array_join(F.concat(base, added), ",").alias("spans"),
    )


def sanitise(documents: DataFrame) -> DataFrame:
    """The documents, all columns: entities become ``[EMAIL]`` and so on, words ``[WORD]`` or nothing."""
    masks = [f"[{kind.upper()}]" for kind in KINDS]
    found = personal_data(documents).select("d", "k", "spans", "added").dropDuplicates(["d", "k"])
    whole = documents.select(
        F.struct(*(documents[c] for c in documents.columns)).alias("document"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))).alias("d"),
        F.coalesce(F.xxhash64("text"), F.lit(0)).alias("k"),
    )

    def mask(batches):
        for batch in batches:
            out = []
            rows = zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist(), batch.column("added").to_pylist())
            for text, spans, added in rows:
                cuts = [(s["low"], s["high"], masks[s["kind"]]) for s in spans]
                cuts += [(s["low"], s["high"], "" if s["kind"] else "[WORD]") for s in added]
                at, parts = 0, []
                for low, high, name in sorted(cuts):
                    if low >= at:
                        parts += [text[at:low], name]
                    at = max(at, high)
                out.append("".join(parts) + text[at:] if parts else text)
            yield batch_of(document=batch.column("document"), new=pa.array(out, pa.string()))

    joined = whole.join(found, ["d", "k"]).select("document", "document.text", "spans", "added")
    schema = T.StructType([joined.schema["document"], T.StructField("new", T.StringType())])
    new = joined.mapInArrow(mask, schema)
    changed = {"text": F.col("new")}
    if "n_chars" in documents.columns:
        length = F.length("new").cast(documents.schema["n_chars"].dataType)
        same = F.col("document")["text"] == F.col("new")
        changed["n_chars"] = F.when(same, F.col("document")["n_chars"]).otherwise(length)
    return new.select(*(changed.get(c, F.col("document")[c]).alias(c) for c in documents.columns))


def brute_force(text: str | None) -> list[tuple[int, int, int]]:
    """The base spans with the patterns as given, for tests."""
    patterns = (
        r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        r"[0-9]([\x20-]?[0-9])+",
        r"\+[0-9][\x20().0-9-]+[0-9]",
    )
    out = []
    for nth, pattern in enumerate(patterns):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if (
                nth == 0
                or nth == 1 and all(int(p) <= 255 for p in m[0].split("."))
                or nth == 2 and 13 <= len(digits) <= 19 and luhn(digits)
                or nth == 3 and 9 <= len(digits) <= 15
            ):
                out.append((nth, m.start(), m.end()))
    return out
