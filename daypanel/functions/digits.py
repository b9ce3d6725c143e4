"""Exact sums and quotients of whole numbers of any length, on texts of digits inside Python workers.

``limbs`` does the same in column expressions, which are interpreted limb by limb: right where long numbers are rare. Here
a number stays one text, and a batch is added up before it leaves its task.
"""

from __future__ import annotations

import decimal
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 16 << 20  # of batches added up together


def exact():
    """Sums and whole quotients of ``Decimal`` without a limit of digits; memory follows the numbers, not the precision."""
    return decimal.localcontext(decimal.Context(prec=decimal.MAX_PREC, Emax=decimal.MAX_EMAX, Emin=decimal.MIN_EMIN))


def rounded_quotient(total: decimal.Decimal, count: int) -> decimal.Decimal | None:
    """The whole number nearest to ``total / count``, halves away from zero. To be called within ``exact``."""
    if not count:
        return None
    size = (2 * abs(total) + count) // (2 * count)
    return -size if total < 0 and size else size


def added(lists: pa.ListArray) -> pa.Array:
    """The sum of each list of numbers as text; a list of one stays as it is, an empty one has no sum."""
    ends, numbers = lists.offsets.to_numpy(), lists.values
    sizes = np.diff(ends)
    sums = numbers.take(pa.array(ends[:-1], mask=sizes == 0))
    many = np.flatnonzero(sizes > 1)
    if not len(many):
        return sums
    with exact():
        texts = [str(_sum(numbers[ends[k] : ends[k + 1]])) for k in many]
    return pc.replace_with_mask(sums, pa.array(sizes > 1), pa.array(texts, pa.string()))


def _sum(numbers: pa.Array) -> decimal.Decimal:
    return sum(map(decimal.Decimal, numbers.to_numpy(zero_copy_only=False)), decimal.Decimal(0))


def totals_and_means(lists: pa.ListArray, more: pa.Array, counts: pa.Array) -> tuple[list[str], list[str | None]]:
    """The sum of each list and a whole number beside it, and their mean over the count rounded to whole, as texts."""
    sums = added(lists).to_numpy(zero_copy_only=False)
    totals, means = [], []
    with exact():
        for text, other, count in zip(sums, more.to_pylist(), counts.to_pylist()):
            total = decimal.Decimal(text or 0) + (other or 0)
            mean = rounded_quotient(total, count)
            totals.append(str(total))
            means.append(None if mean is None else str(mean))
    return totals, means


def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Batches put together up to ``CHUNK_BYTES``, so that a key of many rows leaves few."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= CHUNK_BYTES:
            yield pa.Table.from_batches(held)
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)
