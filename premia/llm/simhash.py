"""SimHash near-duplicates by bit-sliced comparison.

Fingerprints: 64 bits, the majority over the XXH64 hashes of a text's word shingles. Equal fingerprints are one node.
Two nodes within the radius agree on at least two of radius + 2 blocks of bits, so they meet in the bucket of one pair
of blocks (``near_duplicates``); for similarities as low as 0.8, longer fingerprints meet in buckets of equal
least shingle hashes and are candidates only, decided by their sets of shingles (``survivors``). A task receives its buckets as one sorted sequence and holds it vertically: 64 bit planes, one lane per
fingerprint. Comparing the sequence with itself, shifted by d lanes, gives the differing bits of 64 pairs per machine
word; carry-save adders take seven planes at a time into bitwise counters; words in which every lane is of two
buckets, already linked, or beyond the radius are abandoned. A bucket above ``BUCKET`` nodes is cut into chunks,
and every two chunks meet in a task of their own: no pair is lost and no task takes a whole hot bucket. Tasks
return a spanning forest of the links they find; components come from joins.

Defined results: a null or wordless text has fingerprint zero and is linked like any other; null doc_ids are below
no other (they never name a component); repeated rows share their fingerprint; a bit set in exactly half of the hashes is 0; very long texts
are read whole; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from premia.llm.common import chosen, documents, with_row_id, written
from premia.llm.components import components

SEED = 42
#: Most nodes of a bucket that one task compares as a whole. A parameter of the cost only.
BUCKET = 4096
#: Most shingles of the nodes that one task checks against each other as a whole. A parameter of memory only.
HELD = 4_000_000
#: Bytes of a node that are fingerprint; what follows only names it.
PRINT = 32
BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)


def shingles(text: str | None, size: int) -> list:
    """Word shingles as bytes, A-Z lower-cased, repeats included; a shorter text is one shingle, a wordless one none."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return []
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    n = max(1, len(words) - size + 1)
    first = [0, *ends[: n - 1].tolist()]
    last = (ends[min(size, len(words)) - 1 :] - 1).tolist()
    return [joined[a:b] for a, b in zip(first, last)]


def majority(columns: np.ndarray) -> bytes:
    """Bytes of hashes (rows) to the bytes of their majority; a bit is 1 if set in over half of the rows."""
    n = len(columns)
    counts = np.concatenate([np.bincount(columns[:, i], minlength=256) @ BITS for i in range(columns.shape[1])])
    return np.packbits(2 * counts > n, bitorder="little").tobytes()


def fingerprint(text: str | None, shingle: int = 4) -> bytes:
    """64 bits, most significant byte first."""
    parts = shingles(text, shingle)
    if not parts:
        return bytes(8)
    digest = xxhash.xxh64_digest  # most significant byte first
    return majority(np.frombuffer(b"".join([digest(x, SEED) for x in parts]), np.uint8).reshape(-1, 8))


def fingerprints(text, shingle: int = 4):
    """Column of 64-bit fingerprints as eight bytes."""

    @F.pandas_udf("binary")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, shingle) for t in texts], dtype=object)

    return of(text)


def shingle_set(text: str | None, shingle: int) -> np.ndarray:
    """The distinct shingles as sorted 64-bit hashes."""
    digest = xxhash.xxh3_64_intdigest
    return np.unique(np.array([digest(x, SEED) for x in set(shingles(text, shingle))], "<u8"))


def long_print(text: str | None, shingle: int, bands: int) -> tuple:
    """(256-bit fingerprint, ``bands`` least hash values of the shingles under as many hash functions, ``shingle_set``)."""
    h = shingle_set(text, shingle)
    if not len(h):
        return bytes(32), [], h
    # Of the set, as the similarity is one of sets: what a text repeats does not weigh more.
    digest = xxhash.xxh3_128_digest
    keys = [x.to_bytes(8, "little") for x in h.tolist()]
    columns = np.frombuffer(b"".join([digest(x, SEED) + digest(x, SEED + 1) for x in keys]), np.uint8).reshape(-1, 32)
    # Odd multipliers, then a fold of the high half: one hash function per band.
    mixed = [(h ^ (h >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15 + 2 * 0x632BE59BD9B4E019 * i & 0xFFFFFFFFFFFFFFFF) for i in range(bands)]
    return majority(columns), [int((m ^ (m >> np.uint64(32))).min().astype(np.int64)) for m in mixed], h


def long_prints(text, shingle: int, bands: int):
    """Column of struct(node, least, n): the 256-bit fingerprint with 128 bits that name the set of shingles, the least hashes,
    the number of shingles."""

    def row(text):
        bits, least, h = long_print(text, shingle, bands)
        return bits + xxhash.xxh3_128_digest(h.tobytes(), SEED), least, len(h)

    @F.pandas_udf("node binary, least array<long>, n long")
    def of(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([row(t) for t in texts], columns=["node", "least", "n"])

    return of(text)


def shingle_sets(text, shingle: int):
    """Column of sets of shingles, as the bytes of their sorted hashes."""

    @F.pandas_udf("binary")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([shingle_set(t, shingle).tobytes() for t in texts], dtype=object)

    return of(text)


def block_masks(radius: int) -> list:
    """Masks of all pairs of radius + 2 blocks of bits, as signed numbers."""
    edges = [64 * i // (radius + 2) for i in range(radius + 3)]
    blocks = [sum(1 << b for b in range(lo, hi)) for lo, hi in itertools.pairwise(edges)]
    masks = [a | b for a, b in itertools.combinations(blocks, 2)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def planes_of(values: np.ndarray) -> np.ndarray:
    """Bit planes of the rows of bytes, lane i in bit i % 64 of word i // 64; filled up with planes of zeros to a
    multiple of seven, and with two words of zeros."""
    n, width = values.shape
    words = -(-n // 64) + 2
    bits = np.zeros((-(-8 * width // 7) * 7, words * 64), np.uint8)
    bits[: 8 * width, :n] = np.unpackbits(values, axis=1).T
    return np.packbits(bits, axis=1, bitorder="little").view("<u8")


def _add(a, b, c):
    """Carry-save adder: three bits of equal weight into a sum and a carry."""
    x = a ^ b
    return x ^ c, (a & b) | (x & c)


def within(planes: np.ndarray, shift: int, words: np.ndarray, alive: np.ndarray, radius: int) -> tuple:
    """Lanes i (as words and masks) whose value and that of lane i + shift differ in at most ``radius`` bits."""
    step, turn = divmod(shift, 64)
    size = max(3, (radius + 1).bit_length())
    count = np.zeros((size, len(words)), np.uint64)
    over = ~alive
    end = planes.shape[1] - 1
    for g in range(0, len(planes), 7):
        here = planes[g : g + 7]
        other = here[:, np.minimum(words + step, end)]
        if turn:
            other = (other >> np.uint64(turn)) | (here[:, np.minimum(words + step + 1, end)] << np.uint64(64 - turn))
        x = here[:, words] ^ other
        s, k1 = _add(x[0], x[1], x[2])
        s, k2 = _add(s, x[3], x[4])
        s, k3 = _add(s, x[5], x[6])
        twos, fours = _add(k1, k2, k3)
        carry = np.zeros_like(s)
        for bit in range(size):
            if bit < 3:
                count[bit], carry = _add(count[bit], (s, twos, fours)[bit], carry)
            else:
                count[bit], carry = count[bit] ^ carry, count[bit] & carry
        over |= carry
        # Over the radius: the counter, from its highest bit down, is above it.
        above, equal = np.zeros_like(over), ~np.zeros_like(over)
        for bit in reversed(range(size)):
            if radius >> bit & 1:
                equal &= count[bit]
            else:
                above |= equal & count[bit]
                equal &= ~count[bit]
        over |= above
        left = over != ~np.uint64(0)
        if not left.all():
            words, over, count = words[left], over[left], count[:, left]
            if not len(words):
                break
    return words, ~over


def links(values: np.ndarray, ends: np.ndarray, radius: int, agree=None) -> list:
    """Spanning forest, as (child, root) positions, of the links inside the groups of lanes (rows of bytes);
    ends[i]: end of the group of lane i. With ``agree``, a pair within the radius is a link only if agree(i, j) says so:
    every such pair is asked for, unless other links already join it."""
    n = len(values)
    planes = planes_of(values)
    parent = np.arange(n)
    pairs, room = [], ends - np.arange(n)

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for shift in range(1, int(room.max(initial=1))):
        lanes = np.flatnonzero(room > shift)
        lanes = lanes[parent[lanes] != parent[lanes + shift]]
        if not len(lanes):
            continue
        mask = np.zeros(planes.shape[1] * 64, np.uint8)
        mask[lanes] = 1
        alive = np.packbits(mask, bitorder="little").view("<u8")
        words = np.flatnonzero(alive)
        words, hits = within(planes, shift, words, alive[words], radius)
        if not len(words):
            continue
        bits = np.unpackbits(hits.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        row, lane = np.nonzero(bits)
        joined = 0
        for i in (words[row] * 64 + lane).tolist():
            a, b = root(i), root(i + shift)
            if a != b and (agree is None or agree(i, i + shift)):
                parent[max(a, b)] = min(a, b)
                pairs.append((max(a, b), min(a, b)))
                joined += 1
        if joined:
            while True:
                flat = parent[parent]
                if np.array_equal(flat, parent):
                    break
                parent[:] = flat
    return pairs


def _compare(radius: int, lanes: int = 1 << 16):
    schema = pa.schema([("u", pa.binary()), ("v", pa.binary())])

    def forest(keys, nodes):
        change = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
        sizes = np.diff(np.concatenate(([0], change, [len(nodes)])))
        more = np.repeat(sizes > 1, sizes)  # a bucket of one has no pair
        nodes, sizes = nodes.filter(pa.array(more)), sizes[sizes > 1]
        pairs = np.zeros((0, 2), np.int64)
        if len(nodes):
            values = np.frombuffer(b"".join(nodes.to_pylist()), np.uint8).reshape(len(nodes), -1)[:, :PRINT]
            pairs = np.array(links(values, np.repeat(np.cumsum(sizes), sizes), radius), np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays([nodes.take(pa.array(pairs[:, 0])), nodes.take(pa.array(pairs[:, 1]))], schema=schema)

    def run(batches):
        # Whole buckets only: what may go on in the next batch is carried over.
        key, value, held = [], [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            key.append(np.stack([batch.column(c).to_numpy() for c in ("t", "k", "part")]))
            value.append(batch.column("node"))
            held += batch.num_rows
            if held >= lanes:
                keys, values = np.concatenate(key, axis=1), pa.concat_arrays(value)
                own = (keys != keys[:, -1:]).any(axis=0)
                cut = int(np.flatnonzero(own)[-1]) + 1 if own.any() else 0
                if cut:
                    yield forest(keys[:, :cut], values.slice(0, cut))
                key, value, held = [keys[:, cut:]], [values.slice(cut)], len(values) - cut
        if held:
            yield forest(np.concatenate(key, axis=1), pa.concat_arrays(value))

    return run


def near_pairs(buckets: DataFrame, radius: int, bucket: int = BUCKET) -> DataFrame:
    """Links (u, v) between nodes that share a bucket (t, k) and differ in at most ``radius`` bits: enough of them to
    hold every component together. ``buckets``: t, k, node, each row once."""
    size = buckets.groupBy("t", "k").agg(F.count(F.lit(1)).alias("n"))
    hot = written(size.filter(F.col("n") > bucket).withColumn("chunks", F.ceil(F.col("n") / bucket)), "hot")
    placed = buckets.join(hot, ["t", "k"], "left")
    # Chunk i of a hot bucket goes to the tasks of all chunk pairs (i, j) and (j, i), i <= j; part is the number of the pair.
    own = F.pmod(F.xxhash64("node"), "chunks")
    pairs = F.transform(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1), lambda j: F.least(own, j) * F.col("chunks") + F.greatest(own, j))
    alone = F.array(F.lit(-1).cast("long"))
    placed = placed.select("t", "k", "node", F.explode(F.when(F.col("chunks").isNull(), alone).otherwise(pairs)).alias("part"))
    dealt = placed.repartition("t", "k", "part").sortWithinPartitions("t", "k", "part", "node")
    return dealt.mapInArrow(_compare(radius), "u binary, v binary")


def block_buckets(nodes: DataFrame, radius: int) -> DataFrame:
    """Buckets of 64-bit nodes: one per pair of radius + 2 blocks of bits. No two nodes within the radius are missed."""
    half = lambda at: F.conv(F.substring(F.hex("node"), at, 8), 16, 10).cast("long")
    bits = F.shiftleft(half(1), 32).bitwiseOR(half(9))
    tables = [F.struct(F.lit(i).alias("t"), F.col("bits").bitwiseAND(F.lit(m)).alias("k")) for i, m in enumerate(block_masks(radius))]
    return nodes.select("node", bits.alias("bits")).select("node", F.inline(F.array(*tables)))


def rooted(nodes: DataFrame, links_: DataFrame) -> DataFrame:
    """``nodes`` with their component's root."""
    roots = components(links_)
    return nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))


def near_duplicates(docs: DataFrame, radius: int = 4, shingle: int = 4, bucket: int = BUCKET) -> DataFrame:
    """One row per document: rid, doc_id, node (fingerprint), component_id (least doc_id reachable)."""
    rows = with_row_id(docs.select("doc_id", "text"), "rid")
    prints = written(rows.select("rid", F.col("doc_id").cast("long").alias("doc_id"), fingerprints(F.col("text"), shingle).alias("node")), "prints")
    nodes = written(prints.groupBy("node").agg(F.min("doc_id").alias("least")), "nodes")
    placed = rooted(nodes, near_pairs(block_buckets(nodes, radius), radius, bucket))
    least = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    ids = written(placed.join(least, "root").select("node", "component_id"), "components")
    return prints.join(ids, "node").select("rid", "doc_id", "node", "component_id")


def alike(a: np.ndarray, b: np.ndarray, similarity: float) -> bool:
    """Whether two sets, as sorted arrays, have at least this Jaccard similarity."""
    small, large = sorted((len(a), len(b)))
    if not small or small / large < similarity:
        return False
    both = np.concatenate((a, b))
    both.sort(kind="stable")  # two runs: a merge
    common = int(np.count_nonzero(both[1:] == both[:-1]))
    return common / (small + large - common) >= similarity


def _check(similarity: float, radius: int, rows: int = 10_000):
    schema = pa.schema([("u", pa.binary()), ("v", pa.binary())])

    def agreeing(nodes, sets):
        agree = lambda i, j: alike(sets[i], sets[j], similarity)
        values = np.frombuffer(b"".join(nodes), np.uint8).reshape(len(nodes), -1)[:, :PRINT]
        return [(nodes[a], nodes[b]) for a, b in links(values, np.full(len(nodes), len(nodes)), radius, agree)]

    def run(batches):
        key, nodes, sets, out = None, [], [], []
        for batch in batches:
            for group, part, node, data in zip(*(batch.column(c).to_pylist() for c in ("group", "part", "node", "shingles"))):
                if (group, part) != key:
                    out += agreeing(nodes, sets) if len(nodes) > 1 else []
                    key, nodes, sets = (group, part), [], []
                    if len(out) >= rows:
                        yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary()) for x in zip(*out)], schema=schema)
                        out = []
                nodes.append(node)
                sets.append(np.frombuffer(data, "<u8"))
        out += agreeing(nodes, sets) if len(nodes) > 1 else []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary()) for x in zip(*out)], schema=schema)

    return run


def checked_pairs(docs: DataFrame, placed: DataFrame, similarity: float, radius: int, shingle: int, bucket: int = BUCKET, held: int = HELD) -> DataFrame:
    """Links (u, v) between nodes of one root whose sets of shingles have the similarity: enough of them to hold every
    component together. ``placed``: node, first (whose rid has a text of the node), n, root."""
    size = placed.groupBy("root").agg(F.count(F.lit(1)).alias("nodes"), F.sum("n").alias("n")).filter("nodes > 1")
    chunks = F.ceil(F.greatest(F.col("nodes") / bucket, F.col("n") / held))
    groups = written(size.select("root", chunks.alias("chunks")), "groups")
    members = placed.join(groups, "root").select("root", "node", "chunks", F.col("first.rid").alias("rid"))
    sets = docs.select("rid", "text").join(written(members, "members"), "rid")
    sets = sets.select(F.col("root").alias("group"), "node", "chunks", shingle_sets(F.col("text"), shingle).alias("shingles"))
    # As in near_pairs: every two chunks of a group meet in a task of their own.
    own = F.pmod(F.xxhash64("node"), "chunks")
    pairs = F.transform(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1), lambda j: F.least(own, j) * F.col("chunks") + F.greatest(own, j))
    dealt = sets.select("group", "node", "shingles", F.explode(pairs).alias("part"))
    dealt = dealt.repartition("group", "part").sortWithinPartitions("group", "part", "node")
    return dealt.mapInArrow(_check(similarity, radius), "u binary, v binary")


def candidate_radius(similarity: float, deviations: float = 4.0) -> int:
    """So many standard deviations beyond the differing bits that two sets of this similarity are expected to have."""
    p = math.acos(2 * similarity / (1 + similarity)) / math.pi
    return int(8 * PRINT * p + deviations * math.sqrt(8 * PRINT * p * (1 - p)))


def survivors(docs: DataFrame, similarity: float = 0.8, shingle: int = 5, bands: int = 6, deviations: float = 4.0, bucket: int = BUCKET) -> DataFrame:
    """(rid, kept): one row of each group of near copies stays, the least doc_id (null first), then the least locator.

    Near copies are joined by pairs of at least this Jaccard similarity of their sets of shingles. Candidates come from
    256-bit fingerprints, whose share of differing bits is the angle between two sets, cos = 2 J / (1 + J) for sets
    of a size and more for others. A pair of similarity J shares one of ``bands`` least hashes with probability
    1 - (1 - J) ** bands; inside these buckets all pairs are compared, bit-sliced. The links found are unverified, so they
    only say which nodes may belong together: inside such a group every pair within the radius is checked on its
    sets, unless checked pairs join it already. Equal nodes have equal sets. ``docs`` has rid, doc_id, text.
    """
    radius = candidate_radius(similarity, deviations)
    prints = docs.select("rid", "doc_id", long_prints(F.col("text"), shingle, bands).alias("p")).select("rid", "doc_id", "p.*")
    prints = written(prints, "long_prints")
    nodes = prints.groupBy("node").agg(F.min(F.struct("doc_id", "rid")).alias("first"), F.min("least").alias("least"), F.max("n").alias("n"))
    nodes = written(nodes, "long_nodes")
    buckets = nodes.select("node", F.posexplode("least").alias("t", "k"))
    maybe = written(rooted(nodes.select("node", "first", "n"), near_pairs(buckets, radius, bucket)), "candidates")
    checked = checked_pairs(docs, maybe, similarity, radius, shingle, bucket)
    placed = written(rooted(nodes.select("node", "first"), checked).select("node", "first", "root"), "placed")
    first = placed.groupBy("root").agg(F.min("first").alias("keep"))
    keep = written(placed.join(first, "root").select("node", "keep.rid").withColumnRenamed("rid", "keep"), "keep")
    return prints.select("rid", "node").join(keep, "node").select("rid", (F.col("rid") == F.col("keep")).alias("kept"))


def kept_documents(docs: DataFrame) -> DataFrame:
    """One row of each group of near copies, with the columns of ``docs``."""
    return chosen(docs, lambda rows: survivors(rows.select("rid", "doc_id", "text")).select("rid", F.col("kept").cast("int").alias("copies")))


def op7_simhash(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return near_duplicates(docs).select("doc_id", F.lower(F.hex("node")).alias("fingerprint"), "component_id")
