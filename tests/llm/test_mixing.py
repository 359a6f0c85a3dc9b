import uuid
from collections import defaultdict

from pyspark.sql import functions as F

from premia.llm import mixing


def expected_targets(sizes):
    """By resharing: all sources share by weight, those above the cap stop there, and the excess is shared again."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, capped = 1.5 * sum(sizes.values()), {}
    while True:
        rest = total - sum(capped.values())
        w = sum(weight[s] for s in names if s not in capped)
        share = {s: rest * weight[s] / w for s in names if s not in capped}
        over = {s: 2.0 * sizes[s] for s in share if share[s] > 2 * sizes[s]}
        if not over:
            return share | capped
        capped |= over


def test_mix(docs, corpus):
    got = mixing.mix(docs, block=16).collect()
    assert len(got) == len(corpus)
    size = defaultdict(int)
    for _, t, _, s in corpus:
        size[s] += len((t or "").encode().split())
    want = expected_targets(size)
    source = {}
    for i, t, _, s in corpus:
        source[(i, len((t or "").encode().split()))] = s
    taken, largest = defaultdict(int), defaultdict(int)
    for r in got:
        s = source[(r.doc_id, r.size)]
        assert r.source_size == size[s] and abs(r.target - want[s]) < 1e-6 * max(1, want[s])
        assert r.taken == r.copies * r.size and 0 <= r.copies <= 2
        taken[s] += r.taken
        largest[s] = max(largest[s], r.size)
    for s in want:
        assert abs(taken[s] - want[s]) <= 2 * largest[s]


def test_small_blocks_keep_totals_and_reruns_agree(spark):
    rows = spark.range(5000).select(
        F.col("id").alias("doc_id"), F.repeat(F.lit("w "), (F.col("id") % 97 + 1).cast("int")).alias("text"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 4)).alias("source"),
    )
    a = mixing.mix(rows, block=32).collect()
    b = mixing.mix(rows.repartition(7), block=32).collect()
    assert sorted((r.doc_id, r.taken) for r in a) == sorted((r.doc_id, r.taken) for r in b)
    total = defaultdict(int)
    for r in a:
        total[r.target, r.source_size] += r.taken
    assert all(abs(t - x) <= 97 for (t, _), x in total.items())


def test_null_and_repeated_ids_spread_over_blocks(spark, monkeypatch, tmp_path):
    seen = tmp_path / "blocks"
    seen.mkdir()
    fly = mixing._fly

    def noted(seed, last):
        block, to = fly(seed, last), str(seen)

        def run(rows):
            with open(f"{to}/{uuid.uuid4().hex}-{len(rows)}", "w"):
                return block(rows)

        return run

    monkeypatch.setattr(mixing, "_fly", noted)
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 3 == 1, F.col("id")).alias("doc_id"), F.lit("a b c").alias("text"), F.lit("s").alias("source")
    )
    got = mixing.mix(rows, block=64).collect()
    assert len(got) == 3000 and abs(sum(r.taken for r in got) - 1.5 * 9000) <= 6
    assert max(int(f.name.split("-")[1]) for f in seen.iterdir()) < 3 * 64


def test_empty_table(empty):
    assert mixing.mix(empty).count() == 0
