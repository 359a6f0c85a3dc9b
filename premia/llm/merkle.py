"""Merkle manifest of a table: a tree per language over the rows, and a tree over the languages' roots.

Leaves are digests of the columns; texts are read once and never shuffled. The slim rows are range-partitioned by tree, doc_id and locator and written sorted, so a
row's place in its tree is the number of rows of that tree in the parts before plus its place in its part; no tree goes through one task.

Levels are built from the bottom. Slot-zero nodes compute the indices of the others of their run by slot offset (index + 1 ... index + width - 1), one
equijoin on (tree, index) fetches these, and the slot-zero rows emit the parents. A level has a ``width``-th of the rows of the one below and is
written, so that a lost executor costs one level. Where ``width`` is 2, ``sibling`` is the XOR of the index with 1. Proofs
go top-down: the path of a run is the path of its parent node and the digests of the run itself, so a leaf joins once with its
run, whatever the height.

Defined results: a null column counts as ``-``, an empty text as ``0:``; a null lang is a tree of its own, first in the order. Leaves ascend by doc_id,
null first; rows of equal doc_id by the digest of the leaf, so the tree is the same for any order of the files. Repeated rows are leaves
of their own. A null doc_id is never tampered with. Very long texts are hashed whole. An empty table gives an empty result and a null root; extra
columns are not part of the leaves.
"""

from __future__ import annotations

import string
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from premia.llm.common import documents, with_row_id, written

#: Columns of a leaf, in order. A fixed value.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
WIDTH = 8
STEP = "array<struct<left:binary,right:binary>>"


def digest(*parts: Column) -> Column:
    """SHA-256, as bytes, of the parts together."""
    return F.unhex(F.sha2(F.concat(*parts), 256))


def hexed(column) -> Column:
    return F.lower(F.hex(column))


def field(column: Column) -> Column:
    """``-`` for a null, else the number of bytes, a colon and the value."""
    value = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf_of(**changed: Column) -> Column:
    return digest(*[field(changed.get(c, F.col(c))) for c in FIELDS])


def lowered(column: Column) -> Column:
    return F.translate(column, string.ascii_uppercase, string.ascii_lowercase)


def tree_of(lang: str = "lang") -> Column:
    """Name of a language's tree. Names sort as the languages do, bytewise, null first."""
    return F.coalesce(F.concat(F.lit("s"), lang), F.lit("n"))


def sibling(index: Column, offset: Column | int, width: int = WIDTH) -> Column:
    """Index of the node ``offset`` slots on, cyclically, in the run of ``width``. For a width of 2 that is the XOR with 1."""
    if width == 2:
        return index.bitwiseXOR(F.lit(offset))
    slot = F.pmod(index, F.lit(width))
    return index - slot + F.pmod(slot + offset, F.lit(width))


def indexed(rows: DataFrame, tree: str, order: list[str], name: str) -> DataFrame:
    """``rows``, written, with the place of each among those of its tree (idx, from 0) and their number (size).

    Equal order values must not matter or not occur.
    """
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(tree), *[F.col(c).asc_nulls_first() for c in order]]
    dealt = rows.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    placed = written(dealt.select("*", F.monotonically_increasing_id().alias("_at")), name)  # ascends over parts and in each part
    placed = placed.withColumn("_part", F.shiftright("_at", 33))
    # One row per part and tree: no more than the parts and the trees together.
    counts = placed.groupBy("_part", tree).agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    of_tree = Window.partitionBy(tree)
    before = F.sum("_n").over(of_tree.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.select("_part", tree, "_first", F.coalesce(before, F.lit(0)).alias("_before"), F.sum("_n").over(of_tree).alias("size"))
    # A part and tree hold no more rows than one part, so no key is hot.
    out = placed.join(counts, ["_part", tree])
    return out.select(*rows.columns, (F.col("_before") + F.col("_at") - F.col("_first")).alias("idx"), "size")


def next_level(nodes: DataFrame, width: int = WIDTH) -> DataFrame:
    """tree, run, size (of the level above), digests (of the whole run, left to right) of every run of ``nodes`` (tree, idx, size, digest)."""
    zero = nodes.filter(F.pmod("idx", F.lit(width)) == 0).withColumnRenamed("idx", "at")
    offsets = F.explode(F.sequence(F.lit(1), F.lit(width - 1))).alias("slot")
    wanted = zero.select("tree", "at", offsets).withColumn("idx", sibling(F.col("at"), F.col("slot"), width))
    none = F.lit(None).cast("long").alias("size")
    others = wanted.join(nodes.select("tree", "idx", "digest"), ["tree", "idx"]).select("tree", "at", none, "slot", "digest")
    own = zero.select("tree", "at", "size", F.lit(0).alias("slot"), "digest")
    # At most ``width`` digests meet in a group.
    runs = own.unionAll(others).groupBy("tree", "at").agg(
        F.max("size").alias("size"), F.array_sort(F.collect_list(F.struct("slot", "digest"))).alias("r")
    )
    run, size = F.floor(F.col("at") / width).cast("long"), F.ceil(F.col("size") / width).cast("long")
    return runs.select("tree", run.alias("run"), size.alias("size"), F.col("r.digest").alias("digests"))


def parents(runs: DataFrame) -> DataFrame:
    """The slot-zero rows' parents: tree, idx, size, digest."""
    return runs.select("tree", F.col("run").alias("idx"), "size", digest(F.array_join(F.transform("digests", hexed), "")).alias("digest"))


def height(size: int, width: int = WIDTH) -> int:
    """Levels above the leaves until one node remains."""
    levels = 0
    while size > 1:
        size, levels = -(-size // width), levels + 1
    return levels


def build(nodes: DataFrame, width: int = WIDTH) -> tuple[list[DataFrame], DataFrame]:
    """Runs of every level from the leaves (tree, idx, size, digest) up, written, and the top node of every tree (tree, digest, top: its level)."""
    levels, tops, at = [], [], 0
    most = nodes.agg(F.max("size")).first()[0] or 0  # one number
    while True:
        tops.append(nodes.filter("size = 1").select("tree", "digest", F.lit(at).alias("top")))
        if at == height(most, width):
            return levels, reduce(DataFrame.unionAll, tops)
        levels.append(written(next_level(nodes.filter("size > 1"), width), "runs"))
        nodes = parents(levels[-1])
        at += 1


def step(digests: Column, slot: Column) -> Column:
    """The others of a run, left and right of a slot: their digests' bytes one after the other."""
    side = lambda part: F.unhex(F.array_join(F.transform(part, F.hex), ""))
    left, right = F.slice(digests, F.lit(1), slot), F.slice(digests, slot + 2, F.size(digests))
    return F.struct(side(left).alias("left"), side(right).alias("right"))


def paths(levels: list[DataFrame], tops: DataFrame, width: int = WIDTH) -> DataFrame:
    """tree, run, digests, above, subroot of every lowest run: ``above`` are the steps from its parent to the root.

    ``tops`` has tree, top, above and subroot of each tree.
    """
    known = None  # node of the level above -> steps above it
    for at in reversed(range(len(levels))):
        ends = tops.filter(F.col("top") == at + 1).select("tree", F.lit(0).cast("long").alias("run"), "above", "subroot")
        runs = levels[at].join(ends if known is None else known.unionAll(ends), ["tree", "run"])
        runs = written(runs.select("tree", "run", "digests", "above", "subroot"), "paths")
        if at == 0:
            return runs
        each = runs.select("tree", "run", "digests", "above", "subroot", F.posexplode("digests").alias("slot", "_own"))
        known = each.select(
            "tree", (F.col("run") * width + F.col("slot")).alias("run"),
            F.concat(F.array(step(F.col("digests"), F.col("slot"))), "above").alias("above"), "subroot",
        )
    return None


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path give."""
    return F.aggregate(path, leaf, lambda acc, s: digest(hexed(s["left"]), hexed(acc), hexed(s["right"])))


def proof(path: Column) -> Column:
    """All siblings, level by level, left to right, as hex text."""
    return F.array_join(F.transform(path, lambda s: F.concat(hexed(s["left"]), hexed(s["right"]))), "")


def leaves(docs: DataFrame) -> DataFrame:
    """tree, doc_id, digest, rid and the digest of the leaf after tampering (null: untouched) of every row."""
    rows = with_row_id(docs.select(*FIELDS), "rid")
    touched = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    return rows.select(
        tree_of().alias("tree"), F.col("doc_id").cast("long").alias("doc_id"), leaf_of().alias("digest"),
        F.when(touched, leaf_of(text=lowered(F.col("text")))).alias("tampered"), F.xxhash64("rid").alias("spread"),
    )


def manifest(docs: DataFrame, width: int = WIDTH) -> tuple[DataFrame, bytes | None]:
    """One row per document: tree, idx, doc_id, digest, tampered, subroot, path; and the root."""
    # The locator's hash only lets rows that are equal in all else go to several parts; it decides nothing else.
    rows = indexed(leaves(docs), "tree", ["doc_id", "digest", "spread"], "leaves").drop("spread")
    rows = written(rows, "indexed")
    levels, subroots = build(rows.select("tree", "idx", "size", "digest"), width)
    subroots = written(subroots.withColumn("all", F.lit("")), "subroots")
    # The languages are the leaves of one more tree, built in the same way.
    order = written(indexed(subroots, "all", ["tree"], "languages"), "languages")
    over, roots = build(order.select(F.col("all").alias("tree"), "idx", "size", "digest"), width)
    found = roots.first()  # one row
    if found is None:
        return rows.select("tree", "idx", "doc_id", "digest", "tampered", F.lit(None).cast("binary").alias("subroot"), F.lit([]).cast(STEP).alias("path")), None
    end = roots.select("tree", "top", F.lit([]).cast(STEP).alias("above"), F.col("digest").alias("subroot"))
    tops = order.select("tree", "top", "idx", F.col("digest").alias("subroot"))
    if over:
        tops = with_path(tops.withColumn("all", F.lit("")), paths(over, end, width).drop("subroot"), "all", width)
        tops = written(tops.select("tree", "top", F.col("path").alias("above"), "subroot"), "tops")
    else:
        tops = tops.select("tree", "top", F.lit([]).cast(STEP).alias("above"), "subroot")
    keep = ["tree", "idx", "doc_id", "digest", "tampered"]
    alone = rows.filter("size = 1").select(*keep).join(tops, "tree").select(*keep, "subroot", F.col("above").alias("path"))
    if levels:
        many = with_path(rows.filter("size > 1").select(*keep), paths(levels, tops, width), "tree", width).select(*keep, "subroot", "path")
        alone = many.unionAll(alone)
    return alone, bytes(found["digest"])


def with_path(nodes: DataFrame, runs: DataFrame, tree: str, width: int) -> DataFrame:
    """``nodes`` with the steps from each to the root, from the run it is in."""
    slot = F.pmod("idx", F.lit(width)).cast("int")
    nodes = nodes.withColumn("run", F.floor(F.col("idx") / width).cast("long"))
    joined = nodes.join(runs.withColumnRenamed("tree", tree) if tree != "tree" else runs, [tree, "run"])
    return joined.withColumn("path", F.concat(F.array(step(F.col("digests"), slot)), "above"))


def verify(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id, leaf, subroot, root, proof, folded_root, verified of every document; digests as hex text."""
    rows, root = manifest(docs, width)
    folded = fold(F.coalesce("tampered", "digest"), F.col("path"))
    out = rows.select(
        "doc_id", hexed("digest").alias("leaf"), hexed("subroot").alias("subroot"), F.lit(root and root.hex()).cast("string").alias("root"),
        proof(F.col("path")).alias("proof"), hexed(folded).alias("folded_root"),
    )
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = verify(documents(spark, sf_dir))
    return out.select("doc_id", "leaf", "subroot", "root", F.sha2("proof", 256).alias("proof_sha256"), "folded_root", "verified")


def _sql_field(column: str) -> str:
    return f"coalesce(octet_length(encode({column}::VARCHAR)) || ':' || {column}::VARCHAR, '-')"


def _sql_levels(leaves_: str) -> str:
    return f"""
    SELECT tree, 0 AS level, idx, digest, size FROM {leaves_}
    UNION ALL
    SELECT tree, level + 1, idx // 8, sha256(string_agg(digest, '' ORDER BY idx)), (size + 7) // 8
    FROM {{0}} WHERE size > 1 GROUP BY tree, level, idx // 8, size"""


def _sql_fold(start: str, nodes: str, name: str) -> str:
    return f"""
    SELECT id, tree, 0 AS level, idx, acc, proof FROM {start}
    UNION ALL
    SELECT f.id, f.tree, f.level + 1, f.idx // 8, sha256(string_agg(CASE WHEN n.idx = f.idx THEN f.acc ELSE n.digest END, '' ORDER BY n.idx)),
        f.proof || coalesce(string_agg(n.digest, '' ORDER BY n.idx) FILTER (n.idx <> f.idx), '')
    FROM {name} f JOIN {nodes} n ON n.tree = f.tree AND n.level = f.level AND n.idx // 8 = f.idx // 8 AND n.size > 1
    GROUP BY f.id, f.tree, f.level, f.idx, f.proof"""


ORACLE = f"""
WITH RECURSIVE
crc AS (
    SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda a, x: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) ORDER BY i) AS t
    FROM range(256) r(i)
),
d AS (
    SELECT doc_id, row_number() OVER () AS id, coalesce('s' || lang, 'n') AS tree, sha256({" || ".join(_sql_field(c) for c in FIELDS)}) AS leaf,
        sha256({" || ".join(_sql_field(c) for c in FIELDS[:-1])} || {_sql_field("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")}) AS bent,
        xor(list_reduce([4294967295] || list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT),
            lambda a, b: xor(a >> 8, crc.t[(xor(a, b) & 255) + 1])), 4294967295) % 3 = 0 AS touched
    FROM documents, crc
),
leaves AS (
    SELECT id, tree, doc_id, leaf, leaf AS digest, CASE WHEN touched THEN bent ELSE leaf END AS acc, '' AS proof,
        row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY tree) AS size
    FROM d
),
nodes AS ({_sql_levels("leaves").format("nodes")}),
subroots AS (
    SELECT '' AS tree, tree AS lang, level, digest, row_number() OVER (ORDER BY tree) - 1 AS idx, count(*) OVER () AS size FROM nodes WHERE size = 1
),
tops AS ({_sql_levels("subroots").format("tops")}),
low AS ({_sql_fold("leaves", "nodes", "low")}),
ends AS (SELECT l.id, s.tree, s.idx, l.acc, l.proof, s.digest AS subroot FROM low l JOIN subroots s ON l.tree = s.lang AND l.level = s.level),
high AS ({_sql_fold("ends", "tops", "high")}),
root AS (SELECT digest AS root, level FROM tops WHERE size = 1)
SELECT l.doc_id, l.leaf, e.subroot, r.root, sha256(h.proof) AS proof_sha256, h.acc AS folded_root, h.acc = r.root AS verified
FROM high h JOIN root r ON h.level = r.level JOIN leaves l ON l.id = h.id JOIN ends e ON e.id = h.id
"""
