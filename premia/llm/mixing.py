"""Mixing sources to target weights by balanced sampling with the cube method.

Every source has a target number of words. A document of a source with target / size = base + p is taken ``base`` times,
and once more with inclusion probability p. The cube method decides these last copies: it moves the vector of
probabilities along the null space of the balancing constraints (documents, words), so that both totals stay exactly
where they were, until no direction is left. Blocks of documents run their flight in parallel; the at most two
undecided documents of each block meet in the blocks of the next level, until one block of a source is left. Its at most
two documents are the landing problem: the combination nearest to the target wins.

Defined results: a null text has size 0; a null source is a source of its own, the last in order; null and repeated
doc_ids are rows like any other; of landings equally near to the target the first wins, not taking before taking; very long texts are counted
whole; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import itertools
import random
import zlib

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from premia.functions.skew import left_join
from premia.llm.common import WORD, chosen, documents, with_row_id, written

#: Documents in a block of the flight, on average. A parameter of the cost only.
BLOCK = 4096
STATE = "rid string, doc_id string, skey string, size long, pi double, h long, block long"


def sizes(rows: DataFrame) -> DataFrame:
    """One row per document: rid, doc_id, skey (sortable source key), size in words."""
    return rows.select(
        "rid",
        F.col("doc_id").cast("long").alias("doc_id"),
        # "s" + source, or "t" for null: code-point order, null last.
        F.coalesce(F.concat(F.lit("s"), "source"), F.lit("t")).alias("skey"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
    )


def targets(sized: DataFrame, weights=(5, 2, 1), share: float = 1.5, cap: int = 2) -> DataFrame:
    """One row per source: skey, source_size, docs, target.

    Resharing the excess by weight until nobody is above the cap fills sources in ascending order of cap / weight:
    a source is capped exactly if its part of what is left, by weight, reaches its cap. One row per source enters the window.
    """
    per = sized.groupBy("skey").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("docs"))
    by_name = Window.orderBy("skey")
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    weighed = per.withColumn("w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int")))
    weighed = weighed.withColumn("limit", (cap * F.col("source_size")).cast("double"))
    order = Window.orderBy(F.col("limit") / F.col("w"), "skey")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    zero = F.lit(0.0)
    left = weighed.select(
        "*",
        (F.sum("source_size").over(everything) * share - F.coalesce(F.sum("limit").over(before), zero)).alias("rest"),
        (F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), zero)).alias("w_rest"),
    )
    full = F.col("limit") * F.col("w_rest") <= F.col("rest") * F.col("w")
    # The first source that is not capped fixes what a unit of weight is worth to all that follow.
    marked = left.withColumn("free", ~full).withColumn("started", F.max("free").over(order))
    first = F.min(F.when(F.col("started"), F.struct(F.col("limit") / F.col("w"), "skey", "rest", "w_rest"))).over(everything)
    open_target = F.col("w") * F.col("first.rest") / F.col("first.w_rest")
    return marked.withColumn("first", first).select(
        "skey", "source_size", "docs", F.when(F.col("started"), open_target).otherwise(F.col("limit")).alias("target")
    )


def flight(size: list, pi: list, rng: random.Random) -> None:
    """Moves ``pi`` in place until at most two entries lie strictly between 0 and 1; keeps sum(pi) and sum(pi * size).

    Three undecided documents at a time: the constraints are two rows (1, 1, 1) and their sizes, so their cross
    product spans the null space. Both ends of the segment in the unit cube are drawn so that the mean stays at pi.
    """
    open_ = [i for i, p in enumerate(pi) if 0.0 < p < 1.0]
    queue = iter(open_)
    hand = list(itertools.islice(queue, 3))
    while len(hand) == 3:
        a, b, c = (size[i] for i in hand)
        u = (c - b, a - c, b - a)
        if not any(u):
            u = (1, -1, 0)
        up = down = float("inf")
        for i, d in zip(hand, u):
            if d > 0:
                up, down = min(up, (1.0 - pi[i]) / d), min(down, pi[i] / d)
            elif d < 0:
                up, down = min(up, pi[i] / -d), min(down, (1.0 - pi[i]) / -d)
        step = up if rng.random() * (up + down) < down else -down
        for i, d in zip(hand, u):
            p = pi[i] + step * d
            pi[i] = 0.0 if p < 1e-9 else 1.0 if p > 1.0 - 1e-9 else p
        hand = [i for i in hand if 0.0 < pi[i] < 1.0]
        hand += itertools.islice(queue, 3 - len(hand))


def landing(size: list, pi: list) -> None:
    """Decides the last undecided documents: the combination whose words, then documents, are nearest to the expected ones."""
    open_ = [i for i, p in enumerate(pi) if 0.0 < p < 1.0]
    words, count = sum(pi[i] * size[i] for i in open_), sum(pi[i] for i in open_)

    def miss(choice):
        return abs(sum(size[i] for i, x in zip(open_, choice) if x) - words), abs(sum(choice) - count)

    for i, x in zip(open_, min(itertools.product((0, 1), repeat=len(open_)), key=miss)):
        pi[i] = float(x)


def _fly(seed: int, last: bool):
    def block(rows: pd.DataFrame) -> pd.DataFrame:
        # h is a hash of doc_id: a fixed order that has nothing to do with where the rows lay.
        rows = rows.sort_values(["h", "size", "rid"], kind="stable")
        size, pi = rows["size"].tolist(), rows["pi"].tolist()
        name = f"{seed}/{rows['skey'].iloc[0]}/{rows['block'].iloc[0]}/{len(rows)}"
        flight(size, pi, random.Random(zlib.crc32(name.encode())))
        if last:
            landing(size, pi)
        return rows.assign(pi=pi)

    return block


def _with_again(sized: DataFrame) -> DataFrame:
    """Adds again: true for the rows of a doc_id that a source has more than once, else null."""
    per = sized.filter("doc_id IS NOT NULL").groupBy("skey", "doc_id").agg(F.count(F.lit(1)).alias("n"))
    ids = written(per.filter("n > 1").select("doc_id").distinct().withColumn("again", F.lit(True)), "again")
    return left_join(sized, ids, "doc_id", "rid")


def mix(docs: DataFrame, weights=(5, 2, 1), share: float = 1.5, cap: int = 2, seed: int = 7, block: int = BLOCK) -> DataFrame:
    """One row per document: rid, doc_id, size, source_size, target, copies (0 to ``cap``), taken (copies * size)."""
    return decide(with_row_id(docs.select("doc_id", "text", "source"), "rid"), weights, share, cap, seed, block)


def decide(rows: DataFrame, weights=(5, 2, 1), share: float = 1.5, cap: int = 2, seed: int = 7, block: int = BLOCK) -> DataFrame:
    """The same for rows that have their locator (rid).

    Equal input gives equal output: blocks, order and random numbers come from doc_id, source and ``seed`` alone. Rows of a
    source with a null or the same doc_id are dealt by size and row number as well, so no block has to hold them all.
    """
    # doc_id travels as a string: pandas would turn a column of whole numbers and nulls into floating point.
    sized = written(sizes(rows), "sizes")
    plan = written(targets(sized, weights, share, cap), "targets")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    plan = plan.withColumn("rate", F.least(rate, F.lit(float(cap)))).withColumn("base", F.floor("rate").cast("long"))
    plan = plan.withColumn("p", F.col("rate") - F.col("base"))
    largest = plan.agg(F.max("docs")).first()[0] or 0  # one number
    start = F.xxhash64(F.lit(seed), "doc_id")
    dealt = F.xxhash64(F.lit(seed + 1), "doc_id")
    row = F.xxhash64(F.lit(seed + 1), "doc_id", "size", F.substring_index("rid", "#", -1))
    dealt = F.when(F.col("doc_id").isNull() | F.col("again"), row).otherwise(dealt)
    state = _with_again(sized).join(plan.select("skey", "p", "docs"), "skey").select(
        "rid", F.col("doc_id").cast("string").alias("doc_id"), "skey", "size", F.col("p").alias("pi"), start.alias("h"),
        F.pmod(dealt, F.ceil(F.col("docs") / block)).alias("block"),
    )
    blocks, decided = -(-largest // block), []
    while True:
        last = blocks <= 1
        state = written(state.groupBy("skey", "block").applyInPandas(_fly(seed, last), STATE), "flight")
        decided.append(state if last else state.filter("pi <= 0 OR pi >= 1"))
        if last:
            break
        # Two undecided documents remain of a block, so half a block's worth of blocks fills one of the next level.
        state = state.filter("pi > 0 AND pi < 1").withColumn("block", F.expr(f"block DIV {block // 2}"))
        blocks = -(-blocks // (block // 2))
    chosen = decided[0]
    for more in decided[1:]:
        chosen = chosen.unionByName(more)
    return chosen.join(plan, "skey").select(
        "rid", F.col("doc_id").cast("long").alias("doc_id"), "size", "source_size", "target",
        (F.col("base") + F.round("pi").cast("long")).alias("copies"),
        ((F.col("base") + F.round("pi").cast("long")) * F.col("size")).alias("taken"),
    )


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mix itself: every document as often as it is taken, with the columns of ``docs``."""
    return chosen(docs, decide)


def op10_mixing(spark, sf_dir: str) -> DataFrame:
    """Query: the mix of all documents."""
    docs = documents(spark, sf_dir)
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken", "copies")
