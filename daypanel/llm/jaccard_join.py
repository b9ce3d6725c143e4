"""Documents whose sets of 5-word shingles have a Jaccard similarity of 0.8 or more, by filters in several orders.

Any global order of the shingles gives a filter: two sets that link share a shingle among the first
``n - ceil(0.8 n) + 1`` of each (the prefix). This join intersects the filters of three orders before it compares sets:

1. Documents with the same set become one node. Nobody compares copies.
2. Order one puts rare shingles first and those that many documents have last. It comes from a count of all shingles
   in a table of fixed size (``COUNTERS``), rounded to levels; ties are ordered by hash. Prefix shingles of all nodes are grouped in Spark,
   and those that no other node of a fitting size has are dropped.
3. What is left is a graph of nodes and shingles, so pairs need not be listed: nodes are dealt into cells by the
   smallest shingle around them and by size. Two cells are compared if they share enough prefix shingles: a pair that
   links has ``ceil(4 (a + b) / 9) - ceil(0.8 max(a, b)) + 1`` of them in common. A hot group is cut into cells of about
   ``CELL`` nodes, so it becomes many tasks of bounded size, and no pair of it ever is a row.
4. A task has the texts of one cell and of some of its partners. It keeps the pairs whose prefixes meet in orders one,
   two and three (the others by two more hashes) and compares their sets. It returns the number of links of each node,
   and links that hold each group together.
5. Components of the links are found by star contraction, on tables.

All three filters are necessary conditions, so no link is lost. Shingles are compared by 64-bit hashes, nodes are named
by a 64-bit hash of their set.

Null and empty texts, and texts without a word, have no shingle and no link. Rows that repeat an id and its text are
one document. The component of documents whose ids are all null is null. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import staged
from .components import components
from .textscan import Rolling, as_long, batch_of, byte_values, frugal, gathered, keyed, lower, mix, text_blocks, words

SHINGLE = 5
COUNTERS = 1 << 22
CHUNKS = 16
CELL = 256
CELLS = 256  # of a shingle that are compared with each other in one group
PARTNERS = 512
BAND = 1.04
BITMAP = 1 << 24
_BYTES = byte_values(2)
_SEEDS = (np.uint64(0x243F6A8885A308D3), np.uint64(0x13198A2E03707344))


class Sets:
    """The shingle sets of a block's rows: ``shingles`` without repetition, each with its ``row``; sizes and names."""

    def __init__(self, block, size: int = SHINGLE):
        data = lower(block.data)
        found = words(data, block.offsets)
        rolling = Rolling(Rolling(_BYTES[data]).stretch(found.starts, found.ends))
        n = len(block.offsets) - 1
        count = np.diff(found.offsets)
        # One shingle for each word that has enough words behind it, one for a whole row of fewer words.
        start = np.arange(int(found.offsets[-1]))
        row = np.searchsorted(found.offsets, start, "right") - 1
        end = np.minimum(start + size, found.offsets[row + 1])
        use = (end - start == size) | ((count[row] < size) & (start == found.offsets[row]))
        shingle, row = rolling.stretch(start[use], end[use]), row[use]
        code = shingle ^ mix(row.astype(np.uint64))
        order = np.argsort(code)
        order = order[np.append(True, code[order[1:]] != code[order[:-1]])] if len(order) else order
        self.shingles, self.row = shingle[order], row[order]
        self.sizes = np.bincount(self.row, minlength=n)
        # The name adds up a hash of each shingle, in pieces that a float64 holds without rounding.
        total = np.zeros(n, np.uint64)
        each = mix(self.shingles + np.uint64(1))
        for shift in (0, 22, 44):
            piece = (each >> np.uint64(shift)) & np.uint64((1 << 22) - 1)
            total += np.bincount(self.row, piece, n).astype(np.uint64) << np.uint64(shift)
        self.names = as_long(mix(total ^ mix(self.sizes.astype(np.uint64))))


def prefix_size(n):
    return n - (4 * n + 4) // 5 + 1


def first_of_rows(row: np.ndarray, key: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Where the prefix of each row's shingles stands under the order of ``key``."""
    order = np.lexsort((key, row))
    place = np.arange(len(order)) - (np.cumsum(sizes) - sizes)[row[order]]
    return order[place < prefix_size(sizes)[row[order]]]


def _counter(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(64 - COUNTERS.bit_length() + 1)).astype(np.int64)


def order_key(shingles: np.ndarray, order: int, levels: np.ndarray) -> np.ndarray:
    if order:
        return mix(shingles ^ _SEEDS[order - 1])
    return levels[_counter(shingles)].astype(np.uint64) << np.uint64(56) | mix(shingles) >> np.uint64(8)


def _sets_and_counts(rows: DataFrame) -> DataFrame:
    """A row for each document (d, k, name, size), and the task's counts of shingles in ``CHUNKS`` packed rows."""

    def scan(batches):
        counts = np.zeros(COUNTERS, np.int32)
        some = False
        for block in text_blocks(batches):
            sets = Sets(block)
            some = True
            np.add.at(counts, _counter(sets.shingles), 1)
            n = len(sets.sizes)
            yield batch_of(
                doc_id=pa.array(block.batch.column("doc_id")).cast(pa.int64()),
                d=block.column("d"), k=block.column("k"), name=sets.names, size=sets.sizes,
                chunk=pa.nulls(n, pa.int32()), counts=pa.nulls(n, pa.binary()),
            )
        if some:
            null = pa.nulls(CHUNKS, pa.int64())
            packed = [pa.compress(x.tobytes(), "zstd", asbytes=True) for x in np.split(counts, CHUNKS)]
            yield batch_of(
                doc_id=null, d=null, k=null, name=null, size=null,
                chunk=np.arange(CHUNKS, dtype=np.int32), counts=pa.array(packed, pa.binary()),
            )

    schema = "doc_id long, d long, k long, name long, size long, chunk int, counts binary"
    return staged(rows.mapInArrow(frugal(scan), schema), "shingle-sets")


def _levels(scanned: DataFrame) -> np.ndarray:
    """For each counter a level that rises with its count: one byte."""
    width = COUNTERS // CHUNKS
    mean = float(scanned.agg(F.sum("size")).first()[0] or 0) / COUNTERS

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, packed in zip(batch.column("chunk").to_pylist(), batch.column("counts")):
                raw = pa.decompress(packed.as_buffer(), 4 * width, "zstd", asbytes=True)
                sums[chunk] = sums.get(chunk, 0) + np.frombuffer(raw, np.int32).astype(np.int64)
        if sums:
            levels = []
            for total in sums.values():
                # Steps of a sixteenth of a standard deviation, and of a fourth of a doubling where that is not enough.
                z = (total - mean) / np.sqrt(mean + 1)
                far = 192 + np.minimum(63, 4 * np.log2(np.maximum(z, 8) / 8))
                levels.append(np.where(z < 8, np.clip((z + 4) * 16, 0, 191), far).astype(np.uint8).tobytes())
            yield batch_of(chunk=np.array(list(sums), np.int32), levels=pa.array(levels, pa.binary()))

    parts = scanned.filter("chunk is not null").select("chunk", "counts").repartition(CHUNKS, "chunk")
    out = np.zeros(COUNTERS, np.uint8)
    for r in parts.mapInArrow(frugal(add), "chunk int, levels binary").collect():  # CHUNKS rows of a fixed size
        out[r.chunk * width : (r.chunk + 1) * width] = np.frombuffer(r.levels, np.uint8)
    return out


def _shared_prefixes(rows: DataFrame, levels) -> DataFrame:
    """(shingle, key, name, size): prefix shingles in order one that nodes of fitting sizes share."""

    def prefixes(batches):
        for block in text_blocks(batches):
            sets = Sets(block)
            first = np.zeros(len(sets.names), bool)
            first[np.unique(sets.names, return_index=True)[1]] = True
            use = first[sets.row]
            row, shingle = sets.row[use], sets.shingles[use]
            pick = first_of_rows(row, order_key(shingle, 0, levels.value), np.where(first, sets.sizes, 0))
            yield batch_of(
                shingle=as_long(shingle[pick]), name=sets.names[row[pick]], size=sets.sizes[row[pick]].astype(np.int32)
            )

    def shared(batches):
        table = gathered(batches)
        if table is None:
            return
        shingle, name, size = (table.column(x).to_numpy() for x in ("shingle", "name", "size"))
        order = np.argsort(shingle)
        equal = shingle[order[1:]] == shingle[order[:-1]]
        order = order[np.append(equal, False) | np.append(False, equal)]
        order = order[np.lexsort((name[order], size[order], shingle[order]))]
        shingle, name, size = shingle[order], name[order], size[order]
        new = np.append(True, (shingle[1:] != shingle[:-1]) | (name[1:] != name[:-1]))[: len(order)]
        shingle, name, size = shingle[new], name[new], size[new]
        fits = (shingle[1:] == shingle[:-1]) & (5 * size[:-1].astype(np.int64) >= 4 * size[1:].astype(np.int64))
        keep = np.append(fits, False)[: len(size)] | np.append(False, fits)[: len(size)]
        shingle = shingle[keep]
        key = order_key(shingle.view(np.uint64), 0, levels.value)
        yield batch_of(shingle=shingle, key=as_long(key >> np.uint64(1)), name=name[keep], size=size[keep])

    found = rows.mapInArrow(frugal(prefixes), "shingle long, name long, size int").repartition("shingle")
    return staged(found.mapInArrow(frugal(shared), "shingle long, key long, name long, size int"), "shingle-shared")


def _cells(shared: DataFrame) -> DataFrame:
    """(name, size, cell, low, high, n): each node's cell, with the sizes in it and how many nodes it has."""
    own = F.min("key").over(Window.partitionBy("name"))  # a node has as many rows as its prefix at most
    around = shared.select("shingle", own.alias("home")).groupBy("shingle").agg(F.min("home").alias("home"))
    label = (
        shared.join(around, "shingle")
        .groupBy("name")
        .agg(F.min("home").alias("home"), F.first("size").alias("size"))
        .withColumn("band", F.floor(F.log("size") / F.log(F.lit(BAND))))
    )
    parts = label.groupBy("home", "band").agg(F.ceil(F.count(F.lit(1)) / CELL).alias("parts"))
    node = label.join(parts, ["home", "band"]).select(
        "name", "size", F.xxhash64("home", "band", F.pmod(F.xxhash64("name"), F.col("parts"))).alias("cell")
    )
    sizes = node.groupBy("cell").agg(
        F.min("size").alias("low"), F.max("size").alias("high"), F.count(F.lit(1)).alias("n")
    )
    return staged(node.join(sizes, "cell"), "shingle-cells")


def _cell_pairs(shared: DataFrame, cells: DataFrame) -> DataFrame:
    """(one, other, n_one, n): cells that share enough prefix shingles, and how many nodes the two have.

    A shingle comes with its cells, not with its nodes, and with at most about two parts of ``CELLS`` cells a group.
    """

    def pairs(batches):
        table = gathered(batches)
        if table is None:
            return
        names = ("shingle", "first", "second", "part", "cell", "low", "high")
        shingle, first, second, part, cell, low, high = (table.column(x).to_numpy() for x in names)
        order = np.lexsort((cell, second, first, shingle))
        shingle, first, second, part, cell, low, high = (x[order] for x in (shingle, first, second, part, cell, low, high))
        low, high = low.astype(np.int64), high.astype(np.int64)
        alike = (shingle[1:] == shingle[:-1]) & (first[1:] == first[:-1]) & (second[1:] == second[:-1])
        group = np.cumsum(np.append(True, ~alike))[: len(shingle)]
        found = []
        at, step = np.arange(len(shingle)), 1
        while len(at):
            at = at[at + step < len(shingle)]
            at = at[group[at + step] == group[at]]
            to = at + step
            fits = (5 * high[at] >= 4 * low[to]) & (5 * high[to] >= 4 * low[at])
            fits &= (first[at] == second[at]) | (part[at] != part[to])
            found.append(np.stack((at[fits], to[fits])))
            step += 1
        one, other = np.concatenate(found, axis=1) if found else np.zeros((2, 0), np.int64)
        order = np.lexsort((cell[other], cell[one]))
        one, other = one[order], other[order]
        new = np.append(True, (cell[one[1:]] != cell[one[:-1]]) | (cell[other[1:]] != cell[other[:-1]]))[: len(one)]
        count = np.diff(np.append(np.flatnonzero(new), len(one)))
        one, other = one[new], other[new]
        yield batch_of(
            one=cell[one], low=low[one], high=high[one], other=cell[other], other_low=low[other], other_high=high[other],
            common=count,
        )

    def need(low, high, other_low, other_high):
        # A smaller set a from low..high and a larger one b from other_low..other_high: the least number that a link
        # needs lies above (20 a - 16 b) / 45, which is lowest for the largest b and the smallest a that fits it.
        a = F.least(F.greatest(F.col(low), F.ceil(F.col(other_high) * 4 / 5)), F.col(high))
        return F.floor((20 * a - 16 * F.greatest(F.col(other_high), a)) / 45) + 1

    cell = cells.select("name", "cell", F.col("low").cast("int").alias("low"), F.col("high").cast("int").alias("high"))
    listed = shared.select("shingle", "name").join(cell, "name").select("shingle", "cell", "low", "high").distinct()
    schema = "one long, low long, high long, other long, other_low long, other_high long, common long"
    # A shingle of very many cells is cut into parts, and every two parts meet in a group of their own.
    parts = listed.groupBy("shingle").agg(F.ceil(F.count(F.lit(1)) / CELLS).cast("int").alias("parts")).filter("parts > 1")
    parted = listed.join(parts, "shingle", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    parted = parted.withColumn("part", F.pmod(F.xxhash64("cell"), F.col("parts")).cast("int"))
    dealt = parted.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(
        "shingle", F.least("part", "_other").alias("first"), F.greatest("part", "_other").alias("second"), "part", "cell", "low", "high"
    )
    found = dealt.repartition("shingle", "first", "second").mapInArrow(frugal(pairs), schema)
    summed = found.groupBy("one", "low", "high", "other", "other_low", "other_high").agg(F.sum("common").alias("common"))
    enough = F.least(need("low", "high", "other_low", "other_high"), need("other_low", "other_high", "low", "high"))
    size = cells.groupBy(F.col("cell").alias("other")).agg(F.count(F.lit(1)).alias("n"))
    chosen = summed.filter(F.col("common") >= enough).select("one", "other")
    return chosen.join(size, "other").join(size.toDF("one", "n_one"), "one")


def _tasks(cells: DataFrame, pairs: DataFrame) -> DataFrame:
    """(task, inner, partner, name): the nodes of each comparison; ``inner`` tasks also compare a cell with itself.

    Of two cells the one with more partners is the task, so that the nodes of a hub are not sent to each of them.
    """
    pairs = staged(pairs, "shingle-pairs")
    ends = pairs.select("one").unionByName(pairs.select(F.col("other").alias("one")))
    partners = ends.groupBy("one").agg(F.count(F.lit(1)).alias("partners"))
    degree = pairs.join(partners, "one").join(partners.toDF("other", "other_partners"), "other")
    turned = F.col("other_partners") > F.col("partners")
    pairs = degree.select(
        F.when(turned, F.col("other")).otherwise(F.col("one")).alias("one"),
        F.when(turned, F.col("one")).otherwise(F.col("other")).alias("other"),
        F.when(turned, F.col("n_one")).otherwise(F.col("n")).alias("n"),
    )
    pairs = staged(pairs, "shingle-turned")
    split = pairs.groupBy("one").agg(F.ceil(F.sum("n") / PARTNERS).cast("int").alias("parts"))
    several = cells.filter("n > 1").select(F.col("cell").alias("one")).distinct()
    split = split.join(several, "one", "full").select("one", F.coalesce("parts", F.lit(1)).alias("parts"))
    own = split.select("one", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")).select(
        "one", "part", F.col("one").alias("cell"), F.lit(False).alias("partner")
    )
    others = pairs.join(split, "one").select(
        "one",
        F.pmod(F.xxhash64("other"), F.col("parts")).cast("int").alias("part"),
        F.col("other").alias("cell"),
        F.lit(True).alias("partner"),
    )
    nodes = cells.select("cell", "name")
    return own.unionByName(others).join(nodes, "cell").select(
        F.xxhash64("one", "part").alias("task"), (F.col("part") == 0).alias("inner"), "partner", "name"
    )


def _bits(row: np.ndarray, column: np.ndarray, shape: tuple[int, int]) -> np.ndarray:
    """A bit for each (row, column); every place is given once."""
    width = -(-shape[1] // 8)
    packed = np.zeros(shape[0] * width, np.uint8)
    np.add.at(packed, row * width + column // 8, (1 << (column % 8)).astype(np.uint8))
    return packed.reshape(shape[0], width)


def _linked(rows: list[np.ndarray], partner: np.ndarray, inner: bool, levels: np.ndarray):
    """Pairs (i, j) of a task's sets that link; i belongs to the cell, j to it or to a partner."""
    m = len(rows)
    sizes = np.array([len(r) for r in rows])
    row = np.repeat(np.arange(m), sizes)
    flat = np.concatenate(rows)
    shingle, column, count = np.unique(flat, return_inverse=True, return_counts=True)
    common = count > 1
    column = (np.cumsum(common) - 1)[column]
    met = common[np.searchsorted(shingle, flat)]
    shape = (m, max(1, int(common.sum())))
    filters = []
    for order in range(3):
        at = first_of_rows(row, order_key(flat, order, levels), sizes)
        at = at[met[at]]
        filters.append(_bits(row[at], column[at], shape))
    whole = _bits(row[met], column[met], shape)
    for i in np.flatnonzero(~partner):
        j = np.flatnonzero(partner | (np.arange(m) > i) if inner else partner)
        j = j[(5 * sizes[j] >= 4 * sizes[i]) & (5 * sizes[i] >= 4 * sizes[j])]
        for bits in filters:
            j = j[(bits[j] & bits[i]).any(axis=1)]
        if len(j):
            both = np.bitwise_count(whole[j] & whole[i]).sum(axis=1, dtype=np.int64)
            j = j[100 * both >= 80 * (sizes[i] + sizes[j] - both)]
            yield i, j


def _likely(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows whose (d, k) may be in ``wanted``, by a bitmap of ``BITMAP`` bits, so that few texts are shuffled.

    The bitmap is a table of ``BITMAP / 64`` rows at most, whatever the input, so it can be broadcast. On inputs that
    fill it, it lets more rows pass; the exact join comes afterwards.
    """
    bit = F.pmod(F.xxhash64("d", "k"), F.lit(BITMAP))
    place, inside = (bit / 64).cast("int"), (bit % 64).cast("int")
    mark = F.call_function("shiftleft", F.lit(1).cast("long"), inside)
    bits = wanted.select(place.alias("place"), mark.alias("mark")).groupBy("place").agg(F.bit_or("mark").alias("marks"))
    met = rows.withColumn("place", place).join(F.broadcast(bits), "place")
    return met.filter(F.col("marks").bitwiseAND(mark) != 0).drop("place", "marks")


def _links(compared: DataFrame, levels) -> DataFrame:
    """From (task, inner, partner, name, copies, text): (u, v, n), links that hold the groups together (n null), and for each node u the copies it links with, as n."""

    def compare(batches):
        table = gathered(batches)
        if table is None:
            return
        task, name, copies = (table.column(x).to_numpy() for x in ("task", "name", "copies"))
        partner, inner = (table.column(x).to_numpy() for x in ("partner", "inner"))
        sets: list[np.ndarray] = []
        for block in text_blocks(table.to_batches()):
            made = Sets(block)
            by = np.argsort(made.row, kind="stable")
            sets += np.split(made.shingles[by], np.cumsum(made.sizes)[:-1])
        order = np.lexsort((name, partner, task))
        same = (task[order[1:]] == task[order[:-1]]) & (name[order[1:]] == name[order[:-1]])
        order = order[np.append(True, ~same)]
        cuts = np.flatnonzero(task[order[1:]] != task[order[:-1]]) + 1
        links, degrees = [], {}
        for at in np.split(order, cuts):
            if len(at) < 2:
                continue
            root = np.arange(len(at))

            def find(x, root=root):
                while root[x] != x:
                    root[x] = root[root[x]]
                    x = root[x]
                return x

            for i, js in _linked([sets[x] for x in at], partner[at], bool(inner[at[0]]), levels.value):
                u = int(name[at[i]])
                degrees[u] = degrees.get(u, 0) + int(copies[at[js]].sum())
                for j in js.tolist():
                    v = int(name[at[j]])
                    degrees[v] = degrees.get(v, 0) + int(copies[at[i]])
                    a, b = find(i), find(j)
                    if a != b:
                        root[b] = a
                        links.append((u, v))
        u, v = (np.array(x, np.int64) for x in (zip(*links) if links else ((), ())))
        yield batch_of(u=u, v=v, n=pa.nulls(len(u), pa.int64()))
        yield batch_of(
            u=np.array(list(degrees), np.int64), v=pa.nulls(len(degrees), pa.int64()),
            n=np.array(list(degrees.values()), np.int64),
        )

    return staged(compared.repartition("task").mapInArrow(frugal(compare), "u long, v long, n long"), "shingle-links")


def jaccard_components(documents: DataFrame) -> DataFrame:
    """d, k, doc_id, n_shingles, root, component_id, n_links, for each distinct document.

    ``root`` names the component, one value for each (null without shingles). ``component_id`` is the smallest id that
    links lead to, which components share where ids are null or repeated; ``n_links`` counts the documents linked
    directly, copies included.
    """
    spark = documents.sparkSession
    rows = keyed(documents)
    scanned = _sets_and_counts(rows)
    levels = spark.sparkContext.broadcast(_levels(scanned))
    sets = scanned.filter("chunk is null").select("doc_id", "d", "k", "name", "size").distinct()
    classes = staged(
        sets.filter("size > 0")
        .groupBy("name")
        .agg(F.count(F.lit(1)).alias("copies"), F.min(F.struct("d", "k")).alias("first"), F.min("doc_id").alias("least")),
        "shingle-classes",
    )
    shared = _shared_prefixes(rows, levels)
    cells = _cells(shared)
    tasks = staged(_tasks(cells, _cell_pairs(shared, cells)), "shingle-tasks")
    wanted = tasks.join(classes, "name").select("task", "inner", "partner", "name", "copies", "first.*")
    wanted = staged(wanted, "shingle-wanted")
    compared = wanted.join(_likely(rows.select("d", "k", "text"), wanted), ["d", "k"]).drop("d", "k")
    found = _links(compared, levels)
    roots = components(found.filter("v is not null").select("u", "v")).withColumnRenamed("node", "name")
    degree = found.filter("n is not null").groupBy(F.col("u").alias("name")).agg(F.sum("n").alias("n"))
    node = classes.join(roots, "name", "left").withColumn("root", F.coalesce("root", "name"))
    least = node.groupBy("root").agg(F.min("least").alias("component_id"))
    node = node.join(least, "root").join(degree, "name", "left")
    links = (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links")
    return sets.join(node.select("name", "root", "component_id", links), "name", "left").select(
        "d",
        "k",
        "doc_id",
        F.col("size").alias("n_shingles"),
        "root",
        F.when(F.col("size") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
    )


def digest(documents: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, n_links; repeated rows each get theirs."""
    found = jaccard_components(documents).drop("doc_id")
    return keyed(documents).drop("text").join(found, ["d", "k"]).select("doc_id", "n_shingles", "component_id", "n_links")


def keep_one_each(documents: DataFrame) -> DataFrame:
    """The documents, all columns, without those that belong to the component of a document with a smaller id.

    Documents without shingles stay, and one document of each component, whatever ids it shares with others. A null id
    is the smallest. Of rows that repeat an id and its text one stays; so does one text, the first by hash, of an id
    with several texts in a component.
    """
    found = jaccard_components(documents)
    first = found.filter("n_shingles > 0").groupBy("root").agg(F.min(F.struct("d", "k")).alias("first"))
    kept = first.select("first.*").unionByName(found.filter("n_shingles = 0").select("d", "k"))
    key = [
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))).alias("d"),
        F.coalesce(F.xxhash64("text"), F.lit(0)).alias("k"),
    ]
    whole = documents.select(F.struct(*(documents[c] for c in documents.columns)).alias("document"), *key)
    one = whole.join(kept, ["d", "k"]).dropDuplicates(["d", "k"])
    return one.select("document.*")


def brute_force(texts: dict[int, str | None]) -> dict[int, tuple[int, int, int]]:
    """(n_shingles, component, links) of each document by the definition, for tests."""
    sets = {}
    for i, text in texts.items():
        found = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
        if 0 < len(found) < SHINGLE:
            sets[i] = {tuple(found)}
        else:
            sets[i] = {tuple(found[s : s + SHINGLE]) for s in range(len(found) - SHINGLE + 1)}
    parent, links = {i: i for i in texts}, dict.fromkeys(texts, 0)

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders: dict[tuple, list[int]] = {}
    for i, s in sets.items():
        for x in s:
            holders.setdefault(x, []).append(i)
    for i, s in sets.items():
        count: dict[int, int] = {}
        for x in s:
            for j in holders[x]:
                if j > i:
                    count[j] = count.get(j, 0) + 1
        for j, both in count.items():
            if 100 * both >= 80 * (len(s) + len(sets[j]) - both):
                links[i] += 1
                links[j] += 1
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return {i: (len(sets[i]), find(i), links[i]) for i in texts}
