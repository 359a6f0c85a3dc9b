import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from premia.functions import exact_quantile
from premia.operators import sketches
from tests.conftest import rows


@pytest.fixture
def write(spark, tmp_path):
    count = iter(range(10_000))

    def written(df):
        path = f"{tmp_path}/w{next(count)}"
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    return written


def test_exact_quantiles_of_all_cells(frame, write):
    rng = random.Random(1)
    cells = {("a", 1): [rng.randrange(3000) for _ in range(700)], ("a", None): [rng.random() * 1e9 for _ in range(501)], (None, None): [5.0],
             ("hot", 1): [float(int(rng.expovariate(0.01))) for _ in range(5000)], ("ties", 2): [7.0] * 40 + [8.0], ("two", 2): [1.0, 2.0], ("neg", 3): [-1e12, 0.0, 1e12]}
    data = [(*c, float(v)) for c, values in cells.items() for v in values] + [("a", 1, None), ("empty", 1, None), ("a", 1, float("nan")), ("a", 1, float("inf"))]
    named = {"low": 0.0, "q1": 0.25, "median": 0.5, "p90": 0.9, "high": 1.0}
    df = frame(data, "x string, y int, v double").repartition(7)
    got = {(r["x"], r["y"]): r for r in sketches.exact_cell_quantiles(df, ["x", "y"], "v", named, write).collect()}
    assert set(got) == set(cells)
    for c, values in cells.items():
        want = np.quantile(values, list(named.values()))
        assert [got[c][n] for n in named] == pytest.approx(list(want), rel=1e-12), c
    assert got["hot", 1]["median"] == statistics.median(cells["hot", 1]) == exact_quantile(df.filter("x = 'hot'"), "v", 0.5)


def test_exact_quantiles_of_nothing(frame, write):
    assert sketches.exact_cell_quantiles(frame([], "x string, v double"), ["x"], "v", {"median": 0.5}, write).count() == 0


def test_merged_batches_are_within_the_rank_error_of_the_whole(spark, write):
    df = spark.range(60_000).select((F.col("id") % 2).alias("cell"), (F.col("id") % 3).alias("batch"), F.pmod(F.xxhash64("id"), F.lit(100_000)).alias("v"))
    kept = write(sketches.quantile_sketches(df, ["cell", "batch"], "v"))
    assert kept.count() == 6  # a row per cell and batch, whatever its rows
    merged = sketches.merge_quantiles(kept, ["cell"])
    for r in sketches.quantiles_of(merged, ["cell"], {"median": 0.5, "p90": 0.9}).collect():
        assert (r["rows"], r["n"]) == (30_000, 30_000)
        values = df.filter(F.col("cell") == r["cell"])
        for name, p in (("median", 0.5), ("p90", 0.9)):
            rank = values.filter(F.col("v") <= r[name]).count() / 30_000
            assert abs(rank - p) <= 2 * sketches.rank_error()
    assert sketches.rank_error(200) == pytest.approx(0.0193, abs=1e-3) and sketches.rank_error(800) < 0.006


def test_a_batch_added_later_reads_no_earlier_one(spark, frame, write):
    first = write(sketches.quantile_sketches(frame([("a", i) for i in range(100)], "c string, v int"), ["c"], "v"))
    second = write(sketches.quantile_sketches(frame([("a", i) for i in range(100, 201)] + [("b", None)], "c string, v int"), ["c"], "v"))
    merged = sketches.merge_quantiles(first.unionByName(second), ["c"])
    got = {r["c"]: (r["rows"], r["n"], r["median"]) for r in sketches.quantiles_of(merged, ["c"], {"median": 0.5}).collect()}
    assert got == {"a": (201, 201, 100), "b": (1, 0, None)}


def keyed(spark, n, distinct, batch=0):
    return spark.range(n).select(F.concat(F.lit("k"), F.col("id") % distinct).alias("key"), F.lit(batch).alias("batch"))


def test_overlap_of_layers(spark, write):
    small = [write(sketches.key_sketch(keyed(spark, 1000, n), "key")) for n in (500, 200)]
    assert rows(sketches.overlap(*small)) == [(500, 200, 200, 300)]  # exact while the keys fit
    large = [write(sketches.key_sketch(df, "key")) for df in (keyed(spark, 100_000, 100_000), keyed(spark, 60_000, 60_000))]
    (left, right, both, only) = rows(sketches.overlap(*large))[0]
    slack = sketches.SIGMAS * sketches.set_error() * 100_000
    assert abs(left - 100_000) < slack and abs(right - 60_000) < slack and abs(both - 60_000) < slack and abs(only - 40_000) < slack


def test_keys_of_several_batches_are_one_key(spark, write):
    batches = keyed(spark, 1000, 300, 1).unionAll(keyed(spark, 1000, 400, 2))
    kept = write(sketches.key_sketch(batches, "key", "batch"))
    assert kept.count() == 2
    merged = sketches.merge_keys(kept).select("rows", sketches.distinct_estimate().alias("n"))
    assert rows(merged) == [(2000, 400)]


@pytest.mark.parametrize(
    ("n", "distinct", "passed", "counted"),
    [(5000, 5000, True, False), (5000, 4999, False, False), (100_000, 50_000, False, False), (60_000, 60_000, True, True), (60_001, 60_000, False, True)],
)
def test_duplicates_are_counted_only_near_the_limit(spark, write, n, distinct, passed, counted):
    df = keyed(spark, n, distinct)
    got = sketches.duplicates(df, "key", write(sketches.key_sketch(df, "key"))).first()
    assert (got["passed"], got["counted"]) == (passed, counted)
    if counted or n <= 2**sketches.SET_LOG2:
        assert got["duplicates"] == n - distinct


def test_rows_without_a_key_are_one_key(frame, write):
    df = frame([("a",), (None,), (None,)], "key string")
    assert sketches.duplicates(df, "key", write(sketches.key_sketch(df, "key"))).first()["duplicates"] == 1
    empty = frame([], "key string")
    assert sketches.duplicates(empty, "key", write(sketches.key_sketch(empty, "key"))).first()["passed"]
