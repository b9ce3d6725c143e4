"""A Merkle manifest of a dataset: a tree over the rows of each group, one over the groups, and a proof for every row.

Rows become leaves: the sha256 of their fields in canonical form. The tree of a group pairs consecutive nodes, ordered by
key, until one is left; the tops of the groups, ordered by name, make a tree in the same way.

1. Leaves are narrow rows from here on; texts are read once and never shuffled. Places come from a range exchange by
   (group, key, leaf), numbers inside each range, and the counts of the ranges before it.
2. Levels are built upwards, ``LEVELS`` at a time. A *node row* holds the nodes of that many levels over ``2^LEVELS``
   consecutive nodes and the link to its parent, the node row above. Each pass has 1 / 2^LEVELS of the rows of the pass
   before. With ``levels=1`` a node row is a pair and the parent link leads one level up.
3. A recursive query climbs from every leaf: it joins the node row, appends the siblings on the way and folds the hash,
   until a row without a parent is done. The tops of the groups climb first; their siblings stand in the topmost node row
   of their group, so the leaves need no further step for them. The upper node rows serve very many leaves, so a node row
   comes in one copy for every ``SERVED`` leaves under it, and a climbing row takes the copy of its number: no task gets
   all leaves of a tree.

Siblings and hashes are binary inside, lowercase hex outside.

Rows with the same key are ordered by leaf; equal rows are interchangeable and get consecutive places. A null key comes
first, as does a null group, which is a group of its own. A group of one row has the leaf as its top. An empty table gives
no rows. A group that holds most rows is spread by ranges like any other, also if all its rows repeat one key. Extra
columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import staged

#: Levels of the tree in one node row, and leaves that one copy of a node row serves.
LEVELS = 9
SERVED = 1024
#: Rows whose key has a crc32 divisible by this are tampered with.
TAMPERED = 7
_PASS = 1 << 56  # node names: number of the pass, then the place
_WAY = "array<struct<sibling: binary, before: boolean>>"


def canonical(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(fields: list[Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*(canonical(f) for f in fields)), 256))


def _hash(*parts: Column) -> Column:
    """Of binary digests, hashed as hex text."""
    return F.unhex(F.sha2(F.lower(F.concat(*(F.hex(p) for p in parts))), 256))


def _numbered(rows: DataFrame, group: str, order: list[str], names: DataFrame | None = None) -> DataFrame:
    """``rows`` with ``place``, from 0 inside each group, and ``n``, the rows of the group; ``names`` adds columns by group.

    The order must tell all rows apart. Every range is numbered on its own; a table of one row for each range and group
    gives the number of rows before it, and takes the columns of ``names`` along, so no join is by group alone.
    """
    ranges = staged(rows.repartitionByRange(group, *order).withColumn("_range", F.spark_partition_id()), "merkle-ranges")
    counts = ranges.groupBy("_range", group).agg(F.count(F.lit(1)).alias("_here"))
    before = Window.partitionBy(group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_before", F.coalesce(F.sum("_here").over(before), F.lit(0)))
    counts = counts.withColumn("n", F.sum("_here").over(Window.partitionBy(group))).drop("_here")
    if names is not None:
        counts = counts.join(names, group)
    inside = F.row_number().over(Window.partitionBy("_range", group).orderBy(*order))
    numbered = ranges.withColumn("_inside", inside).join(counts, ["_range", group])
    return numbered.withColumn("place", F.col("_before") + F.col("_inside") - 1).drop("_range", "_before", "_inside")


def _levels(lowest: Column, height: Column) -> Column:
    """Arrays of the nodes of ``height`` levels above ``lowest``, which comes first."""

    def above(levels: Column) -> Column:
        below = F.element_at(levels, -1)
        last = F.floor((F.size(below) - 1) / 2).cast("int")
        pair = F.transform(
            F.sequence(F.lit(0), last),
            lambda i: _hash(F.get(below, 2 * i), F.coalesce(F.get(below, 2 * i + 1), F.lit(b""))),
        )
        return F.concat(levels, F.array(pair))

    steps = F.slice(F.array(*(F.lit(k) for k in range(63))), 1, height)
    return F.aggregate(steps, F.array(lowest), lambda levels, _: above(levels))


def _node_rows(nodes: DataFrame, levels: int) -> tuple[DataFrame, DataFrame]:
    """Node rows over ``nodes`` (tree, place, n, h), and the tops of the trees (tree, h).

    A node row has tree, node (its name), parent (null at the top), at (the place of its top among the nodes of its
    parent), ``nodes`` by level, and served (the leaves under it). The number of passes is the logarithm of the largest
    tree.
    """
    wide, built, passes = 1 << levels, None, 0
    rest = nodes.withColumn("served", F.lit(1).cast("long"))
    while True:
        block = rest.groupBy("tree", F.col("n").alias("below"), F.expr(f"place div {wide}").alias("place")).agg(
            F.transform(F.array_sort(F.collect_list(F.struct("place", "h"))), lambda x: x["h"]).alias("h"),
            F.sum("served").alias("served"),
        )
        # A tree ends at the level where one node is left: n nodes have as many levels above as n - 1 has binary digits.
        height = F.when(F.col("below") == 1, 0).otherwise(F.least(F.length(F.bin(F.col("below") - 1)), F.lit(levels)))
        parent = F.lit((passes + 1) * _PASS) + F.expr(f"place div {wide}")
        block = block.select(
            "tree",
            (F.lit(passes * _PASS) + F.col("place")).alias("node"),
            F.when(F.col("below") > wide, parent).alias("parent"),
            (F.col("place") % wide).cast("int").alias("at"),
            _levels(F.col("h"), height).alias("nodes"),
            "served",
            "place",
            "below",
        )
        block = staged(block, "merkle-levels")
        built = block if built is None else built.unionByName(block)
        top = F.element_at("nodes", -1)[0].alias("h")
        rest = block.filter("parent is not null").select(
            "tree", "place", F.expr(f"(below + {wide - 1}) div {wide}").alias("n"), top, "served"
        )
        if rest.isEmpty():
            return built.drop("place", "below"), built.filter("parent is null").select("tree", top)
        passes += 1


def _climbed(starts: DataFrame, nodes: DataFrame, above: DataFrame | None, way: bool = False) -> DataFrame:
    """``starts`` (row, key, leaf, folded, tree, node, at) with subroot, root, proof and the hash folded up to the root.

    ``above`` (tree, over, over_root) has the siblings from the top of each tree to the root over all. The proof is all
    siblings in one piece, or with ``way`` an array that says on which side each stands. Written before it is returned,
    since the limit on the rows of a recursion is lifted for this query only.
    """
    spark = starts.sparkSession
    copies = F.expr(f"(served + {SERVED - 1}) div {SERVED}")
    parents = nodes.select("tree", F.col("node").alias("parent"), copies.alias("parent_copies"))
    inner = nodes.filter("parent is not null").join(parents, ["tree", "parent"])
    none = {"over": F.array().cast(_WAY), "over_root": F.lit(None).cast("binary")}
    tops = nodes.filter("parent is null").withColumn("parent_copies", F.lit(None).cast("long"))
    tops = tops.withColumns(none) if above is None else tops.join(above, "tree")
    stored = inner.withColumns(none).unionByName(tops)
    stored = stored.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), copies - 1))).drop("served")
    empty, more = (f"cast(array() as {_WAY})", "concat(proof, way)") if way else (
        "cast('' as binary)", "aggregate(way, proof, (p, s) -> concat(p, coalesce(s.sibling, cast('' as binary))))"
    )
    climb = f"""
      with recursive climb(row, key, leaf, folded, proof, subroot, root, tree, node, copy, at) as (
        select row, key, leaf, folded, {empty}, cast(null as binary), cast(null as binary), tree, node, 0L, at
        from {{starts}}
        union all
        select row, key, leaf,
          aggregate(way, folded, (h, s) -> unhex(sha2(lower(concat(
            if(s.before, hex(s.sibling), ''), hex(h), if(s.before, '', coalesce(hex(s.sibling), '')))), 256))),
          {more}, if(parent is null, top, null), if(parent is null, coalesce(over_root, top), null),
          if(parent is null, null, tree), parent, pmod(row, parent_copies), parent_at
        from (
          select c.row, c.key, c.leaf, c.folded, c.proof, c.tree, n.parent, n.parent_copies, n.at parent_at, n.over_root,
            element_at(n.nodes, -1)[0] top,
            concat(transform(slice(n.nodes, 1, size(n.nodes) - 1), (level, k) -> struct(
              get(level, shiftright(c.at, k) ^ 1) as sibling, shiftright(c.at, k) % 2 = 1 as before)), n.over) way
          from climb c join {{nodes}} n on c.tree = n.tree and c.node = n.node and c.copy = n.copy
        )
      )
      select row, key, leaf, folded, proof, subroot, root from climb where root is not null
    """
    limit = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(limit, None)
    spark.conf.set(limit, "-1")
    try:
        return staged(spark.sql(climb, starts=starts, nodes=staged(stored, "merkle-nodes")), "merkle-proofs")
    finally:
        if before is None:
            spark.conf.unset(limit)
        else:
            spark.conf.set(limit, before)


def manifest(rows: DataFrame, levels: int = LEVELS) -> DataFrame:
    """``rows`` (key, group, leaf, start) climbed: key, leaf, folded, proof, subroot, root, all hashes binary.

    ``start`` is the hash that is folded along the siblings of the row's leaf, null for the leaf itself.
    """
    wide = 1 << levels
    first = [F.expr(f"place div {wide}").alias("node"), (F.col("place") % wide).cast("int").alias("at")]
    # Null before every name. Row numbers are stored before anything is ordered by them, so a retry has the same.
    group = F.coalesce(F.concat(F.lit("1"), F.col("group").cast("string")), F.lit("0"))
    leaves = staged(
        rows.select(group.alias("group"), "key", "leaf", "start", F.monotonically_increasing_id().alias("row")), "merkle-leaves"
    )
    groups = _numbered(leaves.select("group").distinct().withColumn("all", F.lit(0)), "all", ["group"])
    groups = staged(groups.select("group", F.col("place").alias("tree"), F.col("n").alias("trees")), "merkle-groups")
    numbered = staged(_numbered(leaves, "group", ["key", "leaf", "row"], groups), "merkle-places")
    built, tops = _node_rows(numbered.select("tree", "place", "n", F.col("leaf").alias("h")), levels)
    # One tree over all groups, in which a group's place is its number.
    tops = staged(
        tops.join(groups, "tree").select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("place"), F.col("trees").alias("n"), "h"),
        "merkle-tops",
    )
    over, _ = _node_rows(tops, levels)
    place = F.col("place")
    starts = tops.select(place.alias("row"), place.alias("key"), F.col("h").alias("leaf"), F.col("h").alias("folded"), "tree", *first)
    above = _climbed(starts, over, None, way=True)
    above = above.select(F.col("key").alias("tree"), F.col("proof").alias("over"), F.col("root").alias("over_root"))
    starts = numbered.select("row", "key", "leaf", F.coalesce("start", "leaf").alias("folded"), "tree", *first)
    return _climbed(starts, built, above).drop("row")


def tampered(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % TAMPERED == 0


def digest(documents: DataFrame, levels: int = LEVELS) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    Tampering adds 1 to ``n_chars``; a row without a doc_id is never tampered with, one without ``n_chars`` keeps its leaf.
    """
    head = [documents["doc_id"], documents["source"], documents["lang"]]
    changed = leaf_of([*head, documents["n_chars"] + 1, documents["text"]])
    rows = documents.select(
        documents["doc_id"].alias("key"),
        documents["lang"].alias("group"),
        leaf_of([*head, documents["n_chars"], documents["text"]]).alias("leaf"),
        F.when(tampered(documents["doc_id"]), changed).alias("start"),
    )
    shown = {name: F.lower(F.hex(name)) for name in ("leaf", "subroot", "root", "folded")}
    return manifest(rows, levels).select(
        F.col("key").alias("doc_id"),
        shown["leaf"].alias("leaf"),
        shown["subroot"].alias("subroot"),
        shown["root"].alias("root"),
        F.sha2(F.lower(F.hex("proof")), 256).alias("proof_sha256"),
        shown["folded"].alias("folded_root"),
        (F.col("folded") == F.col("root")).alias("verified"),
    )


def brute_force(rows: list[tuple]) -> list[tuple]:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of (doc_id, source, lang, n_chars, text), for tests."""

    def h(*parts: str) -> str:
        return hashlib.sha256("".join(parts).encode()).hexdigest()

    def form(value) -> str:
        return "-" if value is None else f"{len(str(value).encode())}:{value}"

    def climb(level: list[str]) -> tuple[str, list[list[tuple[str, str]]]]:
        """The top, and for each node its (before, after) siblings upwards."""
        ways: list[list[tuple[str, str]]] = [[] for _ in level]
        at = list(range(len(level)))
        while len(level) > 1:
            for i, p in enumerate(at):
                other = level[p ^ 1] if p ^ 1 < len(level) else ""
                ways[i].append((other, "") if p % 2 else ("", other))
                at[i] = p // 2
            level = [h(*level[p : p + 2]) for p in range(0, len(level), 2)]
        return level[0], ways

    groups: dict = {}
    for d, s, lang, n, t in rows:
        hit = d is not None and n is not None and zlib.crc32(str(d).encode()) % TAMPERED == 0
        leaf = h(*map(form, (d, s, lang, n, t)))
        start = h(*map(form, (d, s, lang, n + 1, t))) if hit else leaf
        groups.setdefault(lang, []).append((d is not None, d or 0, leaf, start, d))
    names = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    subs = {g: climb([x[2] for x in sorted(groups[g], key=lambda x: x[:3])]) for g in names}
    root, ways = climb([subs[g][0] for g in names])
    out = []
    for g, upper in zip(names, ways):
        for x, lower in zip(sorted(groups[g], key=lambda x: x[:3]), subs[g][1]):
            folded = x[3]
            for before, after in lower + upper:
                folded = h(before, folded, after)
            proof = h(*(b + a for b, a in lower + upper))
            out.append((x[4], x[2], subs[g][0], root, proof, folded, folded == root))
    return out
