import pickle
import random

import pytest
from pyspark.sql import functions as F

from premia.llm import toxicity
from premia.llm.levenshtein import Automaton, Trie

BAD = ["gorblak", "snivelworm", "trundlehead", "mucklefoot"]


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, old = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
    return row[-1]


@pytest.mark.parametrize("errors", [0, 1, 2, 3])
def test_automaton_against_edit_distance(errors):
    rng = random.Random(errors)
    terms = {"".join(rng.choice("abc") for _ in range(rng.randint(1, 7))) for _ in range(60)}
    automaton, trie = Automaton(errors), Trie(terms)
    for _ in range(400):
        word = "".join(rng.choice("abcd") for _ in range(rng.randint(0, 8)))
        assert sorted(automaton.matches(word, trie)) == sorted((t, distance(word, t)) for t in terms if distance(word, t) <= errors)


def prose(n, rng):
    return [f"{rng.choice('bcdfgklm')}{rng.choice('aeiou')}{rng.choice('lnrst')}{rng.choice('aeiou')}" for _ in range(n)]


def rows_and_labels():
    rng = random.Random(8)
    rows, labels = [], []
    for i in range(400):
        words = prose(rng.randint(20, 120), rng)
        toxic = i % 5 == 0
        if toxic:
            for _ in range(rng.randint(2, 5)):
                words.insert(rng.randrange(len(words)), rng.choice(BAD))
        rows.append((i, " ".join(words), "en", "s"))
        labels.append((i, int(toxic)))
    return rows, labels


def test_scores(spark, make, docs):
    rng = random.Random(9)
    rows, labels = rows_and_labels()
    plain = prose(60, rng)
    wrong = list(plain)
    for at, w in ((5, "gorblaak"), (20, "snivelwurm"), (33, "trundelhead"), (50, "muckelfoot")):
        wrong.insert(at, w)
    rows += [(1000, " ".join(wrong), "en", "s"), (1001, " ".join(plain), "en", "s"), (1002, None, "en", "s"), (1003, "", "en", "s"), rows[0], (None, "x", None, None)]
    frame = spark.createDataFrame(labels + labels[:3] + [(77777, 1), (None, 1), (4, None)], "doc_id long, toxic int")
    got = toxicity.score(make(spark, rows), frame).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    right = [by[i].predicted == y for i, y in labels if by[i].held_out]
    assert sum(right) >= 0.97 * len(right) > 0
    assert by[1000].predicted == 1 and by[1001].predicted == 0
    assert by[1002].score == by[1003].score < 0.5


def test_rare_terms_of_a_large_sample_are_learned(spark, make, docs):
    terms = [f"{a}{b}{c}{d}x" for a in "bcdfg" for b in "aeiou" for c in "bcdfghklmnprst" for d in "abcdefghij"]  # seven texts each
    dealt = terms * 7
    rng = random.Random(3)
    toxic = [" ".join(rng.sample(dealt[i::2003], len(dealt[i::2003]))) for i in range(2003)]  # in no order that two texts share
    clean = [" ".join(prose(8, rng)) for _ in range(4000)]
    rows = [(i, t, "en", "s") for i, t in enumerate(toxic + clean)]
    labels = spark.createDataFrame([(i, int(i < 2003)) for i in range(6003)], "doc_id long, toxic int")
    lexicon, _ = toxicity.learn(make(spark, rows), labels, F.lit(False))
    assert len(terms) > 3000 and set(pickle.loads(lexicon)[0]) == set(terms)


def test_all_clean_neighbours_are_ordinary_words(spark, make, docs):
    term, letters = "snivelwormhead", "bcdfgjkpqtuxyz"
    wrong = {term[:a] + x + term[a + 1 : b] + y + term[b + 1 :] for b in range(len(term)) for a in range(b) for x in letters for y in letters}
    wrong |= {term[:a] + x + term[a:b] + y + term[b:] for b in range(len(term)) for a in range(b) for x in letters for y in letters}
    wrong |= {term[:a] + x + term[a + 1 : b] + y + term[b:] for b in range(len(term)) for a in range(b) for x in letters for y in letters}
    wrong = sorted(wrong - {term})
    clean = [" ".join(wrong[i::300]) for i in range(300)]
    clean += [" ".join(c.split()[::-1]) for c in clean]  # each word in two families of texts
    rows = [(i, t, "en", "s") for i, t in enumerate([f"{term} {i}" for i in range(50)] + clean)]
    labels = spark.createDataFrame([(i, int(i < 50)) for i in range(650)], "doc_id long, toxic int")
    lexicon, _ = toxicity.learn(make(spark, rows), labels, F.lit(False))
    terms, ordinary = pickle.loads(lexicon)
    assert set(terms) == {term} and len(wrong) > 50_000 and ordinary == set(wrong)


def test_a_repeated_identifier_brings_one_text(spark, make, docs):
    """A third of all rows share one labelled doc_id: the sample, and so the driver, gets one of them."""
    rng = random.Random(5)
    rows = [(7, " ".join(prose(30, rng)), "en", "s") for _ in range(1000)] + [(100 + i, " ".join(prose(30, rng)), "en", "s") for i in range(60)] + [(100, None, "en", "s")]
    labels = spark.createDataFrame([(7, 1)] + [(100 + i, i % 2) for i in range(50)], "doc_id long, toxic int")
    got = toxicity.sampled(make(spark, rows), labels, F.lit(False), sample=10).collect()
    assert len(got) == len({r.doc_id for r in got}) <= 20 and {r.toxic for r in got} == {0, 1}


def test_near_copies_support_a_term_once(spark, make, docs):
    """Words that only a family of near copies shares are no terms; a word of as many different texts is one."""
    rng = random.Random(6)
    copied = prose(400, rng)
    rows = []
    for i in range(40):
        words = list(copied)
        words[i * 10] = f"changed{i}"
        rows.append((i, " ".join(["copyword", *words]), "en", "s"))
    rows += [(100 + i, " ".join([*prose(40, rng), "gorblak"]), "en", "s") for i in range(8)]
    rows += [(1000 + i, " ".join(prose(40, rng)), "en", "s") for i in range(400)]
    labels = spark.createDataFrame([(i, int(i < 1000)) for i, *_ in rows], "doc_id long, toxic int")
    terms = pickle.loads(toxicity.learn(make(spark, rows), labels, F.lit(False))[0])[0]
    assert "gorblak" in terms and "copyword" not in terms


def test_learned_from_the_corpus(spark, make, docs, corpus):
    """Nulls, long texts, repeated rows and clashing names beside labelled rows."""
    rows, labels = rows_and_labels()
    rows = [(10_000 + i, t, lang, s) for i, t, lang, s in rows] + corpus
    frame = spark.createDataFrame([(10_000 + i, y) for i, y in labels] + [(300, 0), (7, 0)], "doc_id long, toxic int")
    got = toxicity.score(make(spark, rows), frame).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert {r.predicted for r in got if r.doc_id is not None and r.doc_id < 10_000} == {0}


def test_quotation_weighs_less():
    lexicon = toxicity.Lexicon({"gorblak": 1.0}, set())
    direct = toxicity.features("you are a gorblak and nothing else", lexicon)
    quoted = toxicity.features('she said he wrote "a gorblak" in the report', lexicon)
    assert direct[0] > quoted[0] and quoted[2] > direct[2] and direct[4] > quoted[4]


def test_ordinary_neighbours_are_no_misspellings():
    lexicon = toxicity.Lexicon({"gorblak": 1.0}, {"gorblad"})
    assert lexicon.find("gorblad") is None and lexicon.find("gorblat") == ("gorblak", 1)


def test_empty_tables(spark, empty, docs):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.score(empty, labels).count() == 0
    got = toxicity.score(docs, labels).collect()
    assert all(r.predicted == 0 for r in got)
