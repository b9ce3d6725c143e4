"""Quality rules as a ledger: every rule evaluated once, its verdict kept as one bit beside the measurements.

``ledger`` writes one row per document: what was measured, and ``failed``, a bit mask of the rules that it breaks. A
policy is a named, versioned set of rules, so a mask too: ``failed & mask = 0`` keeps the document, without touching a
text again. ``ablation`` tells from the same bits, in one small aggregation, what each rule of a policy costs.

A null or empty text has no words and fails the length rule. Repeated rows each get their row. Extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .textscan import NOT_SPACE, Rolling, batch_of, byte_values, frugal, mix, table_of, text_blocks, words

#: The symbols that count, the base limits, and the limits of the method's own rules.
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
RULES: dict[str, str] = {
    "too_short": f"n_words < {MIN_WORDS}",
    "repeats_itself": f"100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words",
    "symbols": "10 * n_symbols > n_words",
    "duplicate_lines": "100 * n_dup_lines > 60 * n_lines",
    "word_length_low": "word_chars < 3 * n_words",
    "word_length_high": "word_chars > 20 * n_words",
    "few_letters": "10 * n_letters < 6 * word_chars",
    "shouting": "2 * n_upper > n_letters",
}
#: Rules keep their place for ever: a new rule goes to the end, so that old ledgers stay readable.
BITS = {name: 1 << place for place, name in enumerate(RULES)}
BASE = ("too_short", "repeats_itself")
POLICIES: dict[str, tuple[str, ...]] = {
    "base/1": BASE,
    "standard/1": (*BASE, "symbols", "duplicate_lines"),
    "standard/2": (*BASE, "symbols", "duplicate_lines", "word_length_low", "word_length_high", "few_letters", "shouting"),
}
POLICY = "standard/2"
MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_letters", "n_upper",
)
_BYTES = byte_values(1)


def mask_of(policy: str) -> int:
    return sum(BITS[rule] for rule in POLICIES[policy])


def _flags(characters: str) -> np.ndarray:
    return table_of(*((ord(c), ord(c)) for c in characters))


def measure(documents: DataFrame) -> DataFrame:
    """``document`` (all columns of the row as a struct) and the measurements of its whole text."""

    def scan(batches):
        symbols, line_end = _flags(SYMBOLS), _flags("\n")
        lead = ~table_of((0x80, 0xBF))  # the bytes that begin a code point
        upper = table_of((0x41, 0x5A))
        letters = table_of((0x41, 0x5A), (0x61, 0x7A), (0xC2, 0xF4))  # beyond ASCII by the first byte of a code point
        for block in text_blocks(batches):
            data, offsets = block.data, block.offsets
            n = len(offsets) - 1

            def per_row(flags, bounds=offsets):
                return np.diff(np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))[bounds])

            found = words(data, offsets)
            rolling = Rolling(_BYTES[data])
            word_hash = rolling.stretch(found.starts, found.ends)
            # Words of 3-word windows that the row has twice.
            grams = Rolling(word_hash).grams(3)
            row = block.row_of(np.arange(len(grams)), found.offsets)
            inside = np.flatnonzero(np.arange(len(grams)) + 3 <= found.offsets[row + 1])
            code = grams[inside] ^ mix(row[inside].astype(np.uint64))
            order = np.argsort(code)
            same = code[order[1:]] == code[order[:-1]]
            twice = np.zeros(len(grams) + 3, bool)
            twice[inside[order[1:][same]]] = True
            twice[inside[order[:-1][same]]] = True
            covered = twice[: len(word_hash)].copy()
            covered[1:] |= twice[: max(0, len(word_hash) - 1)]
            covered[2:] |= twice[: max(0, len(word_hash) - 2)]
            # Lines with a word, and those among them that came before in their row.
            ends = np.flatnonzero(line_end[data])
            starts = np.unique(np.concatenate((offsets[:-1], ends + 1)))
            starts = starts[starts < len(data)]
            stops = np.append(starts[1:], len(data))[: len(starts)]
            stops = stops - line_end[data[stops - 1]] if len(starts) else stops
            text = np.concatenate(([0], np.cumsum(NOT_SPACE[data], dtype=np.int64)))
            full = text[stops] > text[starts]
            starts, stops = starts[full], stops[full]
            line_row = block.row_of(starts)
            code = rolling.stretch(starts, stops) ^ mix(line_row.astype(np.uint64))
            order = np.argsort(code)
            again = line_row[order[1:][code[order[1:]] == code[order[:-1]]]]
            yield batch_of(
                document=block.batch.column("document"),
                n_words=np.diff(found.offsets),
                word_chars=per_row(NOT_SPACE[data] & lead[data]),
                n_symbols=per_row(symbols[data]),
                n_lines=np.bincount(line_row, minlength=n),
                n_dup_lines=np.bincount(again, minlength=n),
                n_repeat_words=per_row(covered, found.offsets),
                n_letters=per_row(letters[data]),
                n_upper=per_row(upper[data]),
            )

    whole = T.StructField("document", documents.schema, False)
    schema = T.StructType([whole, *(T.StructField(name, T.LongType()) for name in MEASURES)])
    columns = F.struct(*(documents[name] for name in documents.columns))
    return documents.select(columns.alias("document"), "text").mapInArrow(frugal(scan), schema)


def ledger(documents: DataFrame) -> DataFrame:
    """``document``, the measurements, and ``failed``: the bits of the rules that the document breaks."""
    bits = sum((F.when(F.expr(rule), F.lit(BITS[name])).otherwise(F.lit(0)) for name, rule in RULES.items()), F.lit(0))
    return measure(documents).withColumn("failed", bits.cast("long"))


def keeps(policy: str, failed: str | Column = "failed") -> Column:
    failed = F.col(failed) if isinstance(failed, str) else failed
    return failed.bitwiseAND(F.lit(mask_of(policy))) == 0


def ablation(rows: DataFrame, policy: str = POLICY) -> DataFrame:
    """For each rule of a policy: failing documents, those that no other rule of it fails, and all that it keeps.

    The ledger is first reduced to one row per combination of bits, 2^rules at most; ``common`` and ``any`` are the
    bitwise and / or over the documents that the rule fails, so they show which rules go along with it always or ever.
    """
    mask = mask_of(policy)
    counted = rows.groupBy(F.col("failed").bitwiseAND(F.lit(mask)).alias("failed")).agg(F.count(F.lit(1)).alias("n"))
    rules = F.array(*(F.struct(F.lit(name).alias("rule"), F.lit(BITS[name]).alias("bit")) for name in POLICIES[policy]))
    each = counted.withColumn("r", F.explode(rules)).select("failed", "n", "r.rule", "r.bit")
    broken = F.col("failed").bitwiseAND(F.col("bit")) != 0
    return each.groupBy("rule").agg(
        F.sum(F.when(broken, F.col("n")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(F.col("failed") == F.col("bit"), F.col("n")).otherwise(0)).alias("n_only"),
        F.sum(F.when(F.col("failed") == 0, F.col("n")).otherwise(0)).alias("n_kept"),
        F.coalesce(F.bit_and(F.when(broken, F.col("failed"))), F.lit(0)).cast("long").alias("common"),
        F.coalesce(F.bit_or(F.when(broken, F.col("failed"))), F.lit(0)).cast("long").alias("any"),
    )


def digest(documents: DataFrame, policy: str = POLICY) -> DataFrame:
    """doc_id, n_words, the four base counts, base_failed, kept, failed."""
    base = ~keeps("base/1")
    return ledger(documents).select(
        "document.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base.alias("base_failed"), (~base & keeps(policy)).alias("kept"), "failed",
    )


def kept_documents(documents: DataFrame, policy: str = POLICY) -> DataFrame:
    """The documents, all columns, that a policy keeps. No shuffle: the columns travel along with the text."""
    return ledger(documents).filter(keeps(policy)).select("document.*")


def brute_force(text: str | None) -> Counter:
    """The base counts by their definition, for tests."""
    import re

    text = text or ""
    found = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(found[i : i + 3]) for i in range(len(found) - 2)]
    count = Counter(windows)
    covered = {p for i, w in enumerate(windows) if count[w] > 1 for p in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return Counter(
        n_words=len(found),
        word_chars=sum(map(len, found)),
        n_symbols=sum(text.count(c) for c in SYMBOLS),
        n_dup_lines=len(lines) - len(set(lines)),
        n_repeat_words=len(covered),
    )
