import random
import re
import zlib
from collections import Counter

import pytest

from premia.llm import spelling
from premia.llm.common import written

LOWER = {c: c + 32 for c in range(65, 91)}


def distance_one(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = (a, b) if len(a) > len(b) else (b, a)
    return any(a[:i] + a[i + 1 :] == b for i in range(len(a)))


def brute_words(rows, least_chars=6, least_n=5, modulus=199):
    total = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % modulus == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            total[run] += 1
    return {w: n for w, n in total.items() if len(w) >= least_chars and n >= least_n}


def brute(words, ratio=5):
    near = {w: [x for x in words if distance_one(w, x)] for w in words}
    best = {w: min(x, key=lambda y: (-words[y], y)) for w, x in near.items() if x}
    form = {w: b for w, b in best.items() if words[b] >= ratio * words[w]}
    out = set()
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out.add((w, n, len(near[w]), form.get(w), words[form[w]] if w in form else None, root))
    return out


def result(df):
    got = [(r.word, r.n, r.n_near, r.form, r.form_n, r.root) for r in df.collect()]
    assert len(got) == len(set(got))
    return set(got)


@pytest.fixture(scope="module")
def misspelt():
    rng = random.Random(11)
    base = ["".join(rng.choice("abcdeéüÀß×") for _ in range(rng.randint(6, 9))) for _ in range(60)] + ["a" * 40, "ab" * 10_000]
    words = {}
    for w in base:
        words[w] = rng.choice([5, 30, 200, 1000, 6000])
        for _ in range(6):
            at, to = rng.randrange(len(w)), rng.choice("abcdeéz")
            other = rng.choice([w[:at] + w[at + 1 :], w[:at] + to + w[at:], w[:at] + to + w[at + 1 :]])
            if len(other) >= 6:
                words.setdefault(other, rng.choice([5, 6, 25, 30, 150, 1000]))
    return words


def frame_of(spark, words):
    return written(spark.createDataFrame(sorted(words.items()), "word string, n long").repartition(3), "words")


def test_words_equal_brute_force(spark, docs, corpus):
    for limits in ((6, 5, 199), (4, 1, 7)):
        got = {r.word: r.n for r in spelling.vocabulary(docs, *limits).collect()}
        assert got == brute_words([(i, t) for i, t, *_ in corpus], *limits) and got


@pytest.mark.parametrize("shard", [20_000, 3])
def test_variants_equal_brute_force(spark, docs, misspelt, shard):
    """With splits of three words too: every node is cut up, and no pair is lost or found twice."""
    words = frame_of(spark, misspelt)
    want = brute(misspelt)
    assert result(spelling.variants(words, shard=shard)) == want
    assert any(form and root != form for *_, form, _, root in want)  # there are chains


def test_whole_operator_on_the_corpus(spark, docs, corpus):
    words = written(spelling.vocabulary(docs, 5, 2, 13), "words")
    assert result(spelling.variants(words)) == brute(brute_words([(i, t) for i, t, *_ in corpus], 5, 2, 13))


def test_long_chains(spark, docs):
    """Seven forms one after the other, by one letter each."""
    words = {"abcdef" + "g" * i: 5 * 5**i for i in range(8)}
    got = {r.word: r.root for r in spelling.variants(frame_of(spark, words)).collect()}
    assert set(got.values()) == {"abcdefggggggg"}


def test_ties_go_to_the_smallest_word(spark, docs):
    words = {"abcdez": 50, "abcdey": 50, "abcdéf": 50, "abcdef": 10}
    got = {r.word: r for r in spelling.variants(frame_of(spark, words)).collect()}
    assert (got["abcdef"].form, got["abcdef"].n_near, got["abcdez"].form) == ("abcdey", 3, None)


def test_deleted_letter_by_hash(spark, make, docs):
    rows = [(i, "Wonderful wonderful WONDERFUL", "en", "a") for i in range(2000)] + [(None, "wonderful " * 5, "en", "a")]
    got = {r.word: r.n for r in spelling.vocabulary(make(spark, rows)).collect()}
    assert got == brute_words([(i, t) for i, t, *_ in rows]) and len(got) > 1


def test_search_verifies_letter_by_letter():
    trie = spelling.Trie([("listen", 1), ("silent", 2), ("lister", 3), ("listed", 4), ("litsen", 5)])
    assert {w for w, _ in trie.near("listen")} == {"lister", "listed"}
    assert {w for w, _ in trie.near("listenn")} == {"listen"} and not list(trie.near("xxxxxxx"))


def test_empty_table(empty):
    assert spelling.variants(written(spelling.vocabulary(empty), "words")).count() == 0
