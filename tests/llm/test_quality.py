from collections import Counter

from pyspark.sql import functions as F

from premia.llm import quality


def brute(text):
    words = (text or "").encode().split()
    windows = Counter(zip(words, words[1:], words[2:]))
    hit = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if line.encode().split():
            dup += line in seen
            seen.add(line)
    return (len(words), sum(len(w.decode()) for w in words), sum(c in "#*$%&|<>" for c in text or ""), dup, len(hit))


def test_measures(docs, corpus):
    rows = quality.judge(docs, ["doc_id", "text"]).collect()
    assert len(rows) == len(corpus)
    for r in rows:
        m = brute(r["_k1"])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == m
        assert r.base_failed == (m[0] < 50 or 100 * m[4] > 50 * m[0])
        assert not (r.base_failed and r.kept)


def test_symbols_fall_out_and_clean_text_stays(spark, make, docs, corpus):
    junk = [(1000 + i, " ".join(f"word{j}%%%" for j in range(i, i + 80)), "en", "b") for i in range(20)]
    kept = {r.doc_id for r in quality.kept_documents(make(spark, corpus + junk)).collect()}
    assert not kept & set(range(1000, 1020))
    assert kept >= {i for i, t, *_ in corpus if i is not None and 50 <= i < 60 and len(t.split()) >= 50}


def test_thresholds_follow_the_group_in_both_directions(spark, make, docs):
    def text(seed, symbols=0, lines=10, same=0, again=0, letters=5):
        word = iter(range(10**6))
        words = lambda n: [f"{seed}x{next(word)}".ljust(letters + 4, "w") for _ in range(n)]
        rows = [" ".join(words(10)) for _ in range(lines)]
        rows[:same] = rows[-1:] * same
        rows += [" ".join(["so it goes"] * again)] if again else []
        return "\n".join(rows) + "#" * symbols

    rows = [(i, text(i), "en", "plain") for i in range(250)]
    rows += [(1000 + i, text(1000 + i, symbols=90 + i % 40), "en", "tables") for i in range(250)]
    odd = {2000: text(2000, symbols=40), 2001: text(2001, same=4), 2002: text(2002, again=25), 2003: text(2003, letters=9), 2004: text(2004, letters=1)}
    rows += [(i, t, "en", "plain") for i, t in odd.items()]
    got = {r["_k0"]: r for r in quality.judge(make(spark, rows), ["doc_id"]).collect()}
    assert all(1000 * got[2000].n_symbols <= 50 * got[2000].word_chars and not got[i].base_failed for i in odd)
    assert got[2001].n_dup_lines == 4
    assert {i for i, r in got.items() if not r.kept} == set(odd)


def test_kept_documents_keep_their_columns(docs, empty):
    out = quality.kept_documents(docs)
    assert out.columns == docs.columns
    assert quality.kept_documents(empty).count() == 0


def test_quantiles_of_merged_sketches(spark):
    rows = [("x", f"s{i % 3}", "m", v, 1) for i, v in enumerate(range(1, 1001))]
    sketch = spark.createDataFrame(rows, "lang string, source string, measure string, bucket long, n long")
    q = quality.quantiles(quality.merged(sketch, ["lang"]), ["lang"]).first()
    assert (q.total, q.q10, q.q50, q.q90) == (1000, 100, 500, 900)


def test_buckets_beyond_whole_numbers(spark):
    values = spark.createDataFrame([(v,) for v in (1023, 1024, 1039, 1040, 5000, 10**9)], "v long").select("v", quality._bucket(F.col("v")).alias("bucket"))
    got = values.select("v", F.lit("m").alias("measure"), F.lit(1).alias("n"), "bucket")
    for r in got.collect():
        one = quality.quantiles(got.filter(F.col("v") == r.v).drop("v"), []).first()
        assert one.q50 <= r.v < one.q50 * (1 + 1 / 64) + 1


def groups(spark, sizes):
    """Measured rows of one language: source by source, so many rows with symbols of a typical share."""
    rows = [("en", s, 100, 1000, share + i % 5, 0, 0, 10) for s, (n, share) in sizes.items() for i in range(n)]
    names = "lang string, source string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long"
    return spark.createDataFrame(rows, names)


def test_no_number_of_rows_is_a_step(spark, docs):
    """A row more moves a threshold little, at any size of the group."""
    limit = {}
    for n in (1, 2, 10, 50, 51, 199, 200, 201, 1000):
        limits = quality.thresholds(groups(spark, {"a": (3000, 5), "b": (n, 200)})).collect()
        limit[n] = {r.source: r.symbols_max for r in limits}["b"]
    assert all(limit[a] < limit[b] for a, b in zip(list(limit), list(limit)[1:]))  # towards the group's own
    assert limit[201] - limit[200] < 1 and limit[200] - limit[199] < 1 and limit[51] - limit[50] < 2
    assert limit[1] < 60 and limit[1000] > 225


def test_a_value_at_its_threshold_passes(spark, docs):
    measured = groups(spark, {"a": (400, 50)})
    limits = quality.thresholds(measured).withColumn("symbols_max", F.lit(52.0))
    kept = {r.n_symbols: r.kept for r in quality.judged(measured, limits).collect()}
    assert kept == {50: True, 51: True, 52: True, 53: False, 54: False}
