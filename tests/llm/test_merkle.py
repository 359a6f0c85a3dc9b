import hashlib
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from premia.llm import merkle

LOWER = {c: c + 32 for c in range(65, 91)}


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def tree(nodes, width):
    """Levels from the leaves to the one node that remains."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([h(*last[i : i + width]) for i in range(0, len(last), width)])
    return levels


def steps(levels, at, width):
    for level in levels[:-1]:
        run = level[at // width * width : at // width * width + width]
        yield run[: at % width], run[at % width + 1 :]
        at //= width


def brute(rows, width=8):
    """Rows are (doc_id, source, lang, n_chars, text)."""
    by_lang = defaultdict(list)
    for r in rows:
        by_lang[r[2]].append((r[0] is not None, r[0] or 0, leaf(r), r))
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    trees = {x: tree([y[2] for y in sorted(by_lang[x], key=lambda y: y[:3])], width) for x in langs}
    top = tree([trees[x][-1][0] for x in langs], width)
    out = []
    for at_top, x in enumerate(langs):
        for at, (known, doc_id, own, r) in enumerate(sorted(by_lang[x], key=lambda y: y[:3])):
            path = [*steps(trees[x], at, width), *steps(top, at_top, width)]
            acc = own
            if known and zlib.crc32(str(doc_id).encode()) % 3 == 0 and r[4] is not None:
                acc = leaf((*r[:4], r[4].translate(LOWER)))
            for left, right in path:
                acc = h(*left, acc, *right)
            proof = "".join("".join(a) + "".join(b) for a, b in path)
            out.append((r[0], own, trees[x][-1][0], top[-1][0], proof, acc, acc == top[-1][0]))
    return Counter(out)


def result(df, width=8):
    return Counter(tuple(r) for r in merkle.verify(df, width).collect())


def content(rows):
    return [(i, s, lang, len(t or ""), t) for i, t, lang, s in rows]


def test_equals_brute_force_on_the_corpus(docs, corpus):
    assert result(docs) == brute(content(corpus))


@pytest.mark.parametrize("width", [2, 3])
def test_other_widths(spark, make, docs, corpus, width):
    rows = corpus[:30] + corpus[-4:]
    assert result(make(spark, rows), width) == brute(content(rows), width)


def test_many_languages_of_one_row(spark, make, docs):
    """Lone leaves are their own subroots; the tree over the languages has two levels and a short last run."""
    rows = [(i, f"Text {i}", f"l{i:03}", "a") for i in range(67)] + [(100, "T", None, None), (101, "É", "", "a"), (102, "x", "é", "a")]
    assert result(make(spark, rows)) == brute(content(rows))


def test_one_document(spark, make, docs):
    rows = [(9, "Ab", "en", "a")]
    (got,) = result(make(spark, rows))
    own = leaf((9, "a", "en", 2, "Ab"))
    assert got[1:5] == (own, own, own, "") and result(make(spark, rows)) == brute(content(rows))


def test_rows_equal_in_all_columns_go_to_several_parts(spark, make, docs):
    rows = [(None, "the same", "en", "a")] * 400 + [(1, "other", "en", "a")]
    df = make(spark, rows)
    placed = merkle.indexed(merkle.leaves(df), "tree", ["doc_id", "digest", "spread"], "t")
    assert sorted(r.idx for r in placed.collect()) == list(range(401))
    assert result(df) == brute(content(rows))


def test_siblings_by_xor_and_by_offset(spark):
    got = spark.range(16).select(
        merkle.sibling(F.col("id"), 1, 2).alias("two"), merkle.sibling(F.col("id"), F.lit(3), 8).alias("eight")
    ).collect()
    assert [r.two for r in got] == [i ^ 1 for i in range(16)]
    assert [r.eight for r in got] == [i - i % 8 + (i + 3) % 8 for i in range(16)]


def test_empty_table(empty):
    assert merkle.verify(empty).count() == 0
