import hashlib
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from premia.llm import lines

WHITE = " \t\n\x0b\x0c\r"
LOWER = {c: c + 32 for c in range(65, 91)}


def brute(rows, min_chars=20, min_documents=3):
    """Rows are (doc_id, text); every row is a document, of equal doc_ids any one may count as the largest."""
    holders = defaultdict(set)
    split = [(t or "").split("\n") for _, t in rows]
    for i, part in enumerate(split):
        for line in part:
            key = line.strip(WHITE).translate(LOWER)
            if len(key) >= min_chars:
                holders[key].add(i)
    rank = lambda i: -1 if rows[i][0] is None else rows[i][0]
    out = []
    for i, part in enumerate(split):
        kept = []
        for line in part:
            who = holders.get(line.strip(WHITE).translate(LOWER), ())
            if len(who) >= min_documents and i != max(who, key=rank):
                continue
            kept.append(line)
        out.append((rows[i][0], len(part), len(part) - len(kept), "\n".join(kept)))
    return out


def result(df):
    return [(r.doc_id, r.n_lines, r.n_dropped, r.kept_text) for r in df.collect()]


def key(row):
    return (row[0] is not None, row[0] or 0, *row[1:])


@pytest.fixture(scope="module")
def shared_lines():
    rng = random.Random(3)
    pool = [f"shared line number {i} of the common stock" for i in range(30)] + ["short", "", "  \t", "É" * 19, "É" * 20, "ß" * 25]
    rows = []
    for i in range(150):
        picked = [rng.choice(pool) for _ in range(rng.randint(0, 12))] + [f"own line of document {i} alone, part {rng.random()}"]
        picked = [rng.choice(["", "  ", "\t", "\x0b"]) + (x.upper() if x.isascii() and rng.random() < 0.3 else x) + rng.choice(["", "\r", " "]) for x in picked]
        rng.shuffle(picked)
        rows.append((i, "\n".join(["A LINE that every document of the table holds", *picked])))
    return rows + [(200, None), (201, ""), (202, "\n"), (None, "a line that every document of the table holds\n\n")]


def test_equals_brute_force(spark, make, shared_lines):
    rows = [(i, t, "en", "a") for i, t in shared_lines]
    got = result(lines.deduplicate_lines(make(spark, rows)))
    assert sorted(got, key=key) == sorted(brute(shared_lines), key=key)


def test_corpus_with_copies_and_long_texts(docs, corpus):
    got = result(lines.deduplicate_lines(docs))
    want = brute([(i, t) for i, t, *_ in corpus])
    drop_ties = lambda rows: sorted((r for r in rows if r[0] not in (7, None)), key=key)
    assert drop_ties(got) == drop_ties(want)
    # Repeated rows: exactly one of those with the largest doc_id keeps the line.
    assert sorted(r[1:3] for r in got) == sorted(r[1:3] for r in want)


def test_only_the_locator_breaks_ties_of_doc_id(spark, make, docs):
    text = "the very same line in rows of one identifier"
    got = result(lines.deduplicate_lines(make(spark, [(5, text, "en", "a")] * 9)))
    assert sorted(r[2] for r in got) == [0] + [1] * 8
    got = result(lines.deduplicate_lines(make(spark, [(None, text, "en", "a")] * 9 + [(1, text, "en", "a")])))
    assert [r[2] for r in got if r[0] == 1] == [0] and sum(r[2] for r in got) == 9


@pytest.mark.parametrize(("least", "count"), [(5, 2), (20, 5)])
def test_other_limits(spark, make, docs, shared_lines, least, count):
    rows = [(i, t, "en", "a") for i, t in shared_lines]
    got = result(lines.deduplicate_lines(make(spark, rows), least, count))
    assert sorted(got, key=key) == sorted(brute(shared_lines, least, count), key=key)


def test_bitmap_is_run_length_coded(spark, frame):
    df = frame([([0, 1, 2, 5, 7, 8],), ([],), ([3],)], "p array<int>").select(lines.runs_of(F.col("p")).alias("r"))
    got = [[tuple(x) for x in r.r] for r in df.collect()]
    assert got == [[(0, 3), (5, 1), (7, 2)], [], [(3, 1)]]


def test_a_hot_line_is_dealt_to_many_tasks(spark, make, docs):
    rows = [(i, f"one line that all of the documents hold\nline {i}", "en", "hot") for i in range(2000)]
    parts = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        located = lines.located(make(spark, rows).select("doc_id", "text"))
        each = lines.line_rows(located, 20)
        assert each.select("hash", "salt").distinct().count() == 16
        assert max(r["count"] for r in each.groupBy("hash", "salt").count().collect()) < 2000 / 8
        got = result(lines.deduplicate_lines(make(spark, rows)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", parts)
    assert [r[2] for r in sorted(got)] == [1] * 1999 + [0]


def test_no_python_and_one_range_shuffle_of_the_lines(spark, make, docs):
    rows = lines.located(make(spark, [(1, "x", "en", "a")]).select("doc_id", "text"))
    plan = lines.bitmaps(rows)._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning(hash" in plan and "Python" not in plan
    assert not re.search(r"hashpartitioning\(hash#\w+, salt", plan)  # the first run takes the range partitions as they are


def test_empty_table(empty):
    assert lines.deduplicate_lines(empty).count() == 0


def test_digest_of_a_text_that_loses_all():
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0c44298fc1c14")
