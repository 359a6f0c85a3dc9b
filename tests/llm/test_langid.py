import random
from collections import Counter

import numpy as np
import pytest

from premia.llm import langid

ALPHABETS = {"aa": "abcdefgh", "bb": "efghijkl", "cc": "éèñßäop"}


def prose(lang, n, rng):
    return " ".join("".join(rng.choice(ALPHABETS[lang]) for _ in range(rng.randint(2, 8))) for _ in range(n))


def brute(text, profiles):
    n = Counter()
    for w in langid.LETTERS.findall(text.lower()):
        n.update(langid.grams(w))
    places = max(map(len, profiles.values()))
    mine = sorted(n, key=lambda g: (-n[g], int(langid.mixed(np.array([langid.number(g)], np.uint64))[0])))[:places]
    out = {}
    for lang, ranked in profiles.items():
        rank = {g: i for i, g in enumerate(ranked)}
        out[lang] = sum(abs(i - rank[g]) if g in rank else places for i, g in enumerate(mine)) / (len(mine) * places)
    return out


def test_distances_and_profiles(spark, docs):
    rng = random.Random(3)
    rows = [(lang, prose(lang, 50, rng)) for lang in ALPHABETS for _ in range(20)]
    learned = langid.profiles(spark.createDataFrame(rows, "lang string, text string"), places=60)
    for lang in ALPHABETS:
        n = Counter()
        for x, t in rows:
            if x == lang:
                for w in t.split():
                    n.update(langid.grams(w))
        assert learned[lang] == sorted(n, key=lambda g: (-n[g], g.encode()))[:60]
    matcher = langid.Matcher(learned)
    for lang in ALPHABETS:
        for size in (1, 3, 40):
            text = prose(lang, size, rng)
            expected = brute(text, learned)
            assert all(abs(a - expected[x]) < 1e-12 for x, a in zip(matcher.langs, matcher.distances(text)))


def test_held_out_accuracy_and_odd_texts(spark, make, docs):
    rng = random.Random(4)
    rows = [(i, prose(lang := rng.choice(list(ALPHABETS)), rng.randint(3, 60), rng), lang, "s") for i in range(300)]
    truth = {i: lang for i, _, lang, _ in rows}
    rows += [(1000, None, "aa", "s"), (1001, "", "aa", "s"), (1002, "12 34 !!", "aa", "s"), (None, "abc abc", None, "s"), rows[0]]
    got = langid.identify(make(spark, rows)).collect()
    assert len(got) == len(rows)
    right = [r.lang_pred == truth[r.doc_id] for r in got if r.held_out and r.doc_id in truth]
    assert sum(right) >= 0.95 * len(right) > 0
    assert {r.lang_pred for r in got if r.doc_id in (1000, 1001, 1002)} == {"und"}
    assert all(0 <= r.score <= 1 for r in got)


def test_empty_and_unlabelled_tables(spark, make, empty, docs):
    assert langid.identify(empty).count() == 0
    none = langid.identify(make(spark, [(i, "some words", None, "s") for i in range(5)])).collect()
    assert {r.lang_pred for r in none} == {"und"}


@pytest.mark.parametrize("text", ["", "a", "  a b", "Das IST, ein--Test 12ab3 é", "\U0001f600 no 漢字x \U00020000y", "x\U0001f600y İ"])
def test_numbers_are_the_grams_of_the_words(text):
    want = Counter()
    for w in langid.LETTERS.findall(text.lower()):
        want.update(langid.grams(w) if max(map(ord, w)) < 65536 else [])
    got = Counter(langid.gram_of(int(n)) for n in langid.numbers(text))
    assert {g: n for g, n in got.items() if not any(0xD800 <= ord(c) < 0xE000 or ord(c) > 65535 for c in g)}.items() >= want.items()
    if all(ord(c) < 65536 or not c.isalpha() for c in text):
        assert got == want


def test_counts(spark, docs):
    rng = random.Random(5)
    rows = [(rng.choice(list(ALPHABETS)), prose("aa", 20, rng)) for _ in range(40)]
    frame = spark.createDataFrame(rows, "lang string, text string")
    whole = sorted(langid.counted(frame).collect())
    want = Counter()
    for lang, text in rows:
        for w in text.split():
            want.update((lang, g) for g in langid.grams(w))
    assert {(r.lang, langid.gram_of(r.gram)): r.n for r in whole} == want


def by_row(df):
    return sorted((repr((r.doc_id, r.held_out, r.lang_pred)), round(r.score, 9)) for r in df.collect())


def test_joined_profiles_give_the_same_as_broadcast_ones(spark, make, docs, corpus):
    """The corpus with its long texts, nulls, repeated rows and clashing names, and languages that are told apart."""
    rng = random.Random(6)
    rows = corpus + [(2000 + i, prose(lang := rng.choice(list(ALPHABETS)), rng.randint(1, 60), rng), lang, "s") for i in range(200)]
    rows += [(3000, "漢字", None, "s"), (3001, "12", "aa", "s")]
    few = by_row(langid.identify(make(spark, rows)))
    assert len(few) == len(rows) and by_row(langid.identify(make(spark, rows), languages=1)) == few


def test_more_languages_than_are_broadcast(spark, make, docs, monkeypatch):
    """Every language is learned, also the least frequent ones."""
    monkeypatch.setattr(langid, "LANGUAGES", 20)
    letters = [chr(c) for c in range(0x4E00, 0x4E00 + 300)]
    of = lambda i: letters[i * 5 : i * 5 + 5]
    rng = random.Random(7)
    rows = [(i * 60 + j, " ".join("".join(rng.choice(of(i)) for _ in range(4)) for _ in range(20 if i < 30 else 3)), f"l{i:02}", "s") for i in range(60) for j in range(8)]
    got = langid.identify(make(spark, rows), languages=langid.LANGUAGES).collect()
    truth = {i: lang for i, _, lang, _ in rows}
    assert all(r.lang_pred == truth[r.doc_id] for r in got) and len(got) == len(rows)


@pytest.mark.parametrize("languages", [500, 1])
def test_languages_equally_near_go_by_name(spark, make, docs, languages):
    same = "gleich gleich text text"
    rows = [(i, same, lang, "s") for i, lang in enumerate(["zz", "mm", "aa"] * 20)] + [(900, same, None, "s"), (901, "漢", None, "s")]
    got = {r.doc_id: r for r in langid.identify(make(spark, rows), languages=languages).collect()}
    assert got[900].lang_pred == "aa" and abs(got[900].score - 1 / 3) < 1e-9
    assert got[901].lang_pred == "aa" and got[901].score == 0.0
