import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from premia.llm import simhash
from premia.llm.components import components


def brute_print(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(nodes, radius):
    nodes = sorted(nodes)
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(nodes):
        for b in nodes[:i]:
            if (a ^ b).bit_count() <= radius:
                parent[root(a)] = root(b)
    return {n: root(n) for n in nodes}


def same_partition(a, b):
    groups = lambda d: {frozenset(k for k in d if d[k] == v) for v in d.values()}
    return groups(a) == groups(b)


def test_fingerprints_of_spark_and_python_agree(docs, corpus):
    for _, t, *_ in corpus[:70]:
        assert int.from_bytes(simhash.fingerprint(t)) == brute_print(t)


def clustered(n, seed):
    rng = random.Random(seed)
    out = {0}
    while len(out) < n:
        x = rng.choice([rng.getrandbits(64), rng.choice(sorted(out)[:50])])
        for _ in range(rng.randint(0, 6)):
            x ^= 1 << rng.randrange(64)
        out.add(x)
    return sorted(out)


@pytest.mark.parametrize("radius", [0, 1, 3, 4, 7, 12])
def test_bit_sliced_links(radius):
    values = clustered(300, radius)
    ends = np.full(len(values), len(values))
    pairs = simhash.links(np.array(values, ">u8").view(np.uint8).reshape(-1, 8), ends, radius)
    got = {v: v for v in values}

    def root(x):
        while got[x] != x:
            x = got[x]
        return x

    for a, b in pairs:
        assert root(values[a]) != root(values[b])  # a forest
        got[root(values[a])] = root(values[b])
    assert same_partition({v: root(v) for v in values}, brute_components(values, radius))


def test_near_pairs_also_where_buckets_are_hot(spark, docs):
    values = clustered(400, 9)
    nodes = spark.createDataFrame([(v.to_bytes(8),) for v in values], "node binary")
    expected = brute_components(values, 4)
    for bucket in (4096, 3):
        links = simhash.near_pairs(simhash.block_buckets(nodes, 4), 4, bucket)
        roots = {int.from_bytes(r.node): int.from_bytes(r.root) for r in components(links).collect()}
        assert same_partition({v: roots.get(v, v) for v in values}, expected)


def test_survivors(docs, corpus, empty):
    rows = simhash.with_row_id(docs, "row").select(F.col("row").alias("rid"), "doc_id", "text")
    kept = [r.doc_id for r in rows.join(simhash.survivors(rows), "rid").filter("kept").collect()]
    # Copies of 3 and near copies of 5 go; all that is unlike the rest stays.
    assert set(range(60)) <= set(kept) and not set(kept) & set(range(100, 140))
    edited = [r for r in kept if r is not None and 200 <= r < 230]
    assert len(edited) <= (0 if len(corpus[5][1].split()) > 60 else 30)
    none = empty.select("rid", "doc_id", "text")
    assert simhash.survivors(none).count() == 0


def test_long_prints_tell_similarity():
    rng = random.Random(4)
    words = [f"w{rng.randrange(5000)}" for _ in range(400)]
    for changes, low, high in ((0, 0, 0), (4, 1, 42), (60, 60, 160)):
        other = list(words)
        for i in rng.sample(range(400), changes):
            other[i] = "x" + other[i]
        a, b = (int.from_bytes(simhash.long_print(" ".join(w), 5, 6)[0]) for w in (words, other))
        assert low <= (a ^ b).bit_count() <= high


def exact_survivors(texts):
    sets = [set(simhash.shingles(t, 5)) for t in texts]
    parent = list(range(len(texts)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if root(i) != root(j) and 5 * len(a & b) >= 4 * len(a | b):
                parent[max(root(i), root(j))] = min(root(i), root(j))
    return {i for i in parent if root(i) == i}


def test_survivors_are_decided_by_the_shingles(spark, docs):
    rng = random.Random(11)
    texts = []
    for family in range(3):  # texts of one template whose pairs have similarities from 0.5 to 0.95
        base = [f"w{family}x{rng.randrange(9000)}" for _ in range(260)]
        for _ in range(70):
            at = rng.randrange(3)
            own = rng.sample(range(260), (2, 5, 9)[at])
            texts.append(" ".join(f"y{rng.randrange(10**6)}" if i in own else w for i, w in enumerate(base)))
    # One repeated phrase gives most of the words, and the sets of shingles differ.
    texts += [("same line again " * 200) + " ".join(f"z{i}q{j}" for j in range(80)) for i in range(4)]
    want = exact_survivors(texts)
    rows = spark.createDataFrame([(f"r{i:04}", i, t) for i, t in enumerate(texts)], "rid string, doc_id long, text string")
    assert 20 < len(want) < len(texts) - 20
    for bucket in (4096, 40):
        assert {int(r.rid[1:]) for r in simhash.survivors(rows, bucket=bucket).filter("kept").collect()} == want


def test_components_of_a_long_chain(spark):
    edges = spark.range(300).selectExpr("id AS u", "id + 1 AS v")
    got = components(edges).collect()
    assert len(got) == 300 and {r.root for r in got} == {0}


def test_near_duplicates(docs, corpus):
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == len(corpus)
    prints = {i: int.from_bytes(simhash.fingerprint(t)) for i, t, *_ in corpus if i is not None}
    expected = brute_components(set(prints.values()) | {0}, 4)
    least = {}
    for i, p in prints.items():
        least[expected[p]] = min(i, least.get(expected[p], i))
    for r in got:
        if r.doc_id is not None:
            assert r.component_id == least[expected[prints[r.doc_id]]]


def test_empty_table(empty):
    assert simhash.near_duplicates(empty).count() == 0
