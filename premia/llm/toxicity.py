"""Toxicity: a learned lexicon met with spelling errors, hits weighed by their context.

Training draws a bounded sample of labelled documents by a hash of doc_id, counts in how many families of toxic and of clean ones (near
copies share a family) each word occurs, and keeps as lexicon the words that are much likelier in toxic texts. Words run through the Levenshtein
automata of the lexicon's trie, so misspelled terms are hits as well; a neighbour that clean texts use often is
an ordinary word and none. Every hit has a context score from the words around it: quotation (quotation marks
around it, reporting verbs near it) against address (second person near it). A logistic model of the hits, exact and
misspelled, quoted and direct, gives the score.

Defined results: a null or empty text gets the score of a text without hits; with no labelled toxic or no clean row,
scores are those of the prior weights, 0 hits giving a score below 0.5; repeated rows get equal scores; of labelled rows that share a doc_id one
text, the greatest, is learned from; of terms equally near to a word the first in the trie counts; very long texts are read whole; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

import math
import pickle
import zlib
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from premia.llm.common import documents, holdout, written
from premia.llm.levenshtein import Automaton, Trie

#: Labelled rows of either label that are learned from, at most.
SAMPLE = 20_000
#: A term occurs in so many families of toxic texts of the sample, however large it is, and is so many times likelier in toxic than in clean ones.
SUPPORT, RATIO = 5, 20.0
TOKEN = regex.compile(r"[\p{L}\p{M}\p{N}@$*]+|[\"'“”„«»‘’]")
QUOTES = set("\"'“”„«»‘’")
WINDOW = 8
#: Words that report and words that address, in the languages of the corpus. Fixed values.
REPORTING = frozenset("said says wrote called quoted quote reported sagte schrieb nannte zitierte dijo llamó escribió citó dit appelé écrit cité".split())
ADDRESS = frozenset("you your yours youre du dich dein deine ihr tu tú tus usted ustedes te vous votre vos toi".split())
FEATURES = ("direct", "misspelled", "quoted", "density", "strength")
#: Weights that hold as far as the sample says nothing else: intercept, then FEATURES.
PRIOR = (-4.0, 2.0, 1.5, 0.5, 1.0, 0.5)
#: Parts of texts without a hit that a worker remembers, and the longest one. Parameters of the cost only.
CACHE, LONGEST = 500_000, 60


#: Least length of a term that is within reach of words with so many errors.
LEAST = {1: 5, 2: 8}


def errors_of(word: str) -> int:
    """Edit distance at which a word of this length still is a misspelling."""
    return 0 if len(word) < 5 else 1 if len(word) < 9 else 2


class Lexicon:
    def __init__(self, terms: dict, ordinary: set):
        self.terms, self.ordinary = terms, ordinary
        # Terms too short for any misspelling, or for a misspelling of so long a word, are left out.
        self.tries = {k: Trie(t for t in terms if errors_of(t) and len(t) >= LEAST[k]) for k in (1, 2)}
        self.automata = {k: Automaton(k) for k in (1, 2)}
        self.free: set = set()

    def find(self, word: str) -> tuple | None:
        """(term, distance) of the nearest term, or None."""
        if word in self.terms:
            return word, 0
        k = errors_of(word)
        if not k or word in self.ordinary:
            return None
        # The shorter of the two decides what counts as a misspelling.
        near = [(t, d) for t, d in self.automata[k].matches(word, self.tries[k]) if d <= errors_of(t)]
        return near[0] if near else None

    def hits(self, text: str) -> dict:
        """word -> (term, distance) for the words of a lower-cased text that hit. No word spans white space, so parts without a hit are remembered."""
        out = {}
        if len(self.free) > CACHE:
            self.free = set()
        new = set(text.split()) - self.free
        for part in new:
            found = {w: hit for w in TOKEN.findall(part) if (hit := self.find(w)) is not None}
            out |= found
            if not found and len(part) <= LONGEST:
                self.free.add(part)
        return out


def context(tokens: list, at: int) -> float:
    """0 (address) to 1 (quotation), from the words around a hit."""
    left, right = tokens[max(0, at - WINDOW) : at], tokens[at + 1 : at + 1 + WINDOW]
    inside = any(t in QUOTES for t in left) and any(t in QUOTES for t in right)
    score = 0.2 + 0.5 * inside + 0.3 * any(t in REPORTING for t in left + right) - 0.2 * any(t in ADDRESS for t in left + right)
    return min(1.0, max(0.0, score))


def features(text: str | None, lexicon: Lexicon) -> tuple:
    text = (text or "").lower()
    hits = lexicon.hits(text)
    if not hits:
        return 0.0, 0.0, 0.0, 0.0, 0.0
    tokens = TOKEN.findall(text)
    direct = misspelled = quoted = strength = 0.0
    for i, t in enumerate(tokens):
        if t in hits:
            term, distance = hits[t]
            c = context(tokens, i)
            quoted += c
            strength = max(strength, lexicon.terms[term] * (1 - c) / (1 + distance))
            if distance:
                misspelled += 1 - c
            else:
                direct += 1 - c
    return (*(math.log1p(x) for x in (direct, misspelled, quoted)), math.log1p(100 * (direct + misspelled) / len(tokens)), strength)


def fitted(x: np.ndarray, y: np.ndarray, pull: float = 1.0) -> np.ndarray:
    """Logistic regression by Newton's method, pulled towards PRIOR."""
    prior = np.array(PRIOR)
    w = prior.copy()
    x = np.column_stack([np.ones(len(x)), x.reshape(-1, len(FEATURES))])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - y) + pull * (w - prior)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + pull * np.eye(len(w)), slope)
        w -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return w


@lru_cache(2)
def _lexicon(data: bytes) -> Lexicon:
    return Lexicon(*pickle.loads(data))


def family(text: str | None) -> int:
    """Texts that share most of their five-word shingles mostly share the least hash of them."""
    words = (text or "").lower().split()
    return min((zlib.crc32(" ".join(words[i : i + 5]).encode("utf-8", "surrogatepass")) for i in range(max(1, len(words) - 4))), default=0)


def sampled(docs: DataFrame, labels: DataFrame, held, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, text, toxic, family) of a bounded sample of the labelled rows that are not held out, each label alike."""
    rows = labels.filter(F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))  # a repeated label counts once
    rows = rows.filter(F.col("doc_id").isNotNull() & ~held)
    rows = rows.withColumn("h", F.xxhash64("doc_id"))
    few = [rows.filter(F.col("toxic") == v).orderBy("h", "doc_id").limit(sample) for v in (0, 1)]
    ids = written(few[0].unionByName(few[1]).select("doc_id", "toxic"), "sample")
    # A labelled doc_id may stand for many rows: one text of each is learned from, so that the sample is 2 * sample rows at most.
    found = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")
    found = found.groupBy("doc_id").agg(F.max("text").alias("text"), F.max("toxic").alias("toxic"))

    @F.pandas_udf("long")
    def families(texts: pd.Series) -> pd.Series:
        return texts.map(family).astype("int64")

    return written(found.withColumn("family", families("text")), "sampled")


def words_of(text: str | None) -> set:
    """The distinct words: no word spans white space, so each part between it is searched once."""
    return set(TOKEN.findall(" ".join(set((text or "").lower().split()))))


def word_counts(rows: DataFrame) -> DataFrame:
    """word, toxic and clean: in how many families of texts of either label. Near copies are one family, or few, however many they are."""

    def count(batches):
        for batch in batches:
            seen = {(w, int(t), f) for text, t, f in zip(batch["text"], batch["toxic"], batch["family"]) for w in words_of(text)}
            yield pd.DataFrame(list(seen), columns=["word", "toxic", "family"])

    out = rows.select("text", "toxic", "family").mapInPandas(count, "word string, toxic int, family long").distinct()
    return out.groupBy("word").agg(F.count_if(F.col("toxic") == 1).alias("toxic"), F.count_if(F.col("toxic") == 0).alias("clean"))


def learn(docs: DataFrame, labels: DataFrame, held, sample: int = SAMPLE) -> tuple:
    """(pickled lexicon, weights)."""
    rows = sampled(docs, labels, held, sample)
    n = {r.toxic: r["count"] for r in rows.select("toxic", "family").distinct().groupBy("toxic").count().collect()}
    words = written(word_counts(rows), "words")
    rate = (F.col("toxic") / max(1, n.get(1, 0))) / ((F.col("clean") + 0.5) / max(1, n.get(0, 0)))
    # Alone the words of one label say nothing.
    strong = words.withColumn("rate", rate).filter((F.col("toxic") >= SUPPORT) & (F.col("rate") >= RATIO) & (F.length("word") > 2))
    top = strong.orderBy(F.desc("rate"), "word").collect() if n.get(0) and n.get(1) else []  # as many as the bounded sample has
    terms = {r.word: math.log(r.rate) / 10 for r in top}
    common = words.filter((F.col("clean") >= 2) & (F.length("word") >= 5))
    data = pickle.dumps((terms, set()))

    def near(batches):
        for batch in batches:
            lexicon = _lexicon(data)
            yield batch[[lexicon.find(w) is not None for w in batch["word"]]]

    # The counts are a small table; the search in the trie is what takes time, so it is dealt to all cores.
    width = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = common.select("word", "clean").repartition(width, "word")
    close = dealt.mapInPandas(near, "word string, clean long").select("word").collect()  # as many as the bounded sample has
    ordinary = {r.word for r in close} - set(terms)
    lexicon = pickle.dumps((terms, ordinary))

    @F.pandas_udf("array<double>")
    def described(texts: pd.Series) -> pd.Series:
        return pd.Series([list(features(t, _lexicon(lexicon))) for t in texts], dtype=object)

    found = rows.select("doc_id", described("text").alias("x"), "toxic").orderBy("doc_id").collect()  # the bounded sample
    x = np.array([r.x for r in found], float)
    return lexicon, fitted(x, np.array([r.toxic for r in found], float))


def scored(text, lexicon: bytes, weights: np.ndarray):
    """Column of scores."""

    @F.pandas_udf("double")
    def of(texts: pd.Series) -> pd.Series:
        x = np.array([features(t, _lexicon(lexicon)) for t in texts], float).reshape(-1, len(FEATURES))
        return pd.Series(1 / (1 + np.exp(-np.clip(weights[0] + x @ weights[1:], -30, 30))))

    return of(text)


def score(docs: DataFrame, labels: DataFrame, modulus: int = 3, remainder: int = 1, least: float = 0.7) -> DataFrame:
    """doc_id, held_out, score, predicted of every document; learned from labelled rows that are not held out."""
    held = holdout("doc_id", modulus, remainder)
    lexicon, weights = learn(docs, labels.select("doc_id", "toxic"), held)
    rows = docs.select("doc_id", held.alias("held_out"), scored(F.col("text"), lexicon, weights).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= least).cast("int"))


def op1_toxicity(spark, sf_dir: str) -> DataFrame:
    return score(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
