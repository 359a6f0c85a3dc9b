"""Language identification by rank-order profiles.

Training counts the n-grams (1 to 4 characters of lower-cased, padded words) of all labelled texts per language and
keeps the ranks of the most frequent ones. A document is compared with every profile by out-of-place distance: the sum,
over its own most frequent n-grams, of how far each is from its place in the profile, at most a fixed penalty. Ties in a
document are ordered by a hash of the n-gram, so that they favour no language. An n-gram is a number of 64 bits, four UTF-16
units, so a text is counted by one sort of its numbers, and nothing is kept between texts.

Defined results: a text that is null or has no letter is ``und`` with score 0, and so is every text if nothing could be
learned; rows with a null language are not learned from; repeated rows count each time and get equal results; of languages equally near the
first by name is predicted; very long texts are counted whole; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import pickle
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from premia.llm.common import documents, holdout, with_row_id, written

PLACES = 500
#: Up to so many languages the profiles, LANGUAGES * PLACES rows at most, go to every task; of more they are joined. The results are the same.
LANGUAGES = 500
LETTERS = regex.compile(r"\p{L}+")
#: Characters of two units that are no letters.
OTHERS = regex.compile(r"[^\p{L}\x00-\uFFFF]")
#: While learning: units that are counted at a time, and n-grams that a task holds before it gives them away. Parameters of the cost only.
CHUNK, HELD = 2_000_000, 1_000_000
EDGE = ord("_")


def grams(word: str, longest: int = 4) -> list:
    padded = f"_{word}_"
    return [padded[i : i + n] for n in range(1, longest + 1) for i in range(len(padded) - n + 1) if padded[i : i + n] != "_"]


@lru_cache(1)
def _letters() -> np.ndarray:
    """For every UTF-16 unit whether it is, or is half of, a letter."""
    out = np.zeros(1 << 16, bool)
    out[[ord(c) for run in LETTERS.findall("".join(chr(c) for c in range(1 << 16) if not 0xD800 <= c < 0xE000)) for c in run]] = True
    out[0xD800:0xE000] = True
    return out


def numbers(text: str) -> np.ndarray:
    """The numbers of all n-grams of a text's lower-cased words, as often as they occur: the first unit in the highest bits."""
    text = text.lower()
    if not text.isascii():
        text = OTHERS.sub(" ", text)
    units = np.frombuffer(text.encode("utf-16-le", "surrogatepass"), "<u2")
    letter = np.concatenate(([False], _letters()[units], [False]))
    kept = letter.copy()
    kept[1:] |= letter[:-1]  # the edge behind a word, which is that before the next one
    kept[0] = True
    if not letter.any():
        return np.zeros(0, np.uint64)
    edge = ~letter[kept]
    units = np.where(letter, np.concatenate(([EDGE], units, [EDGE])), EDGE)[kept].astype(np.uint64)
    two = units[:-1] << np.uint64(48) | units[1:] << np.uint64(32)
    three = two[:-1] | units[2:] << np.uint64(16)
    four = three[:-1] | units[3:]
    within = ~edge[1:-1]
    return np.concatenate((units[~edge] << np.uint64(48), two, three[within], four[within[:-1] & within[1:]]))


def number(gram: str) -> int:
    return int.from_bytes(gram.encode("utf-16-be", "surrogatepass").ljust(8, b"\0"), "big")


def gram_of(n: int) -> str:
    """The n-gram of a number."""
    units = [n >> shift & 0xFFFF for shift in (48, 32, 16, 0)]
    return b"".join(u.to_bytes(2, "big") for u in units if u).decode("utf-16-be", "surrogatepass")


def mixed(n: np.ndarray) -> np.ndarray:
    """A hash of every number."""
    n = (n ^ n >> np.uint64(31)) * np.uint64(0x9E3779B97F4A7C15)
    n = (n ^ n >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
    return n ^ n >> np.uint64(32)


def counted(rows: DataFrame) -> DataFrame:
    """lang, gram (its number), n over rows (lang, text). Every task adds what it counts before anything is shuffled."""

    def count(batches):
        texts: dict = {}
        sums: dict = {}

        def add(lang):
            found, n = np.unique(numbers(" ".join(texts.pop(lang)[1])), return_counts=True)
            if lang in sums:
                found = np.concatenate((sums[lang][0], found))
                n = np.concatenate((sums[lang][1], n))
                found, place = np.unique(found, return_inverse=True)
                n = np.bincount(place, weights=n).astype(np.int64)
            sums[lang] = found, n

        def out():
            for lang, (found, n) in sums.items():
                yield pd.DataFrame({"lang": lang, "gram": found.view(np.int64), "n": n})
            sums.clear()

        for batch in batches:
            for lang, text in zip(batch["lang"], batch["text"]):
                held = texts.setdefault(lang, [0, []])
                held[1].append(text or "")
                held[0] += len(held[1][-1])
                if held[0] >= CHUNK:
                    add(lang)
            for lang in list(texts):  # no batch's texts are held longer than the batch
                add(lang)
            if sum(len(f) for f, _ in sums.values()) > HELD:
                yield from out()
        yield from out()

    return rows.mapInPandas(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def ranked(rows: DataFrame, places: int = PLACES) -> DataFrame:
    """lang, gram (its number), r (from 1): the most frequent n-grams of every language, from labelled rows (lang, text). A written table."""
    n = written(counted(rows), "grams")
    order = [F.desc("n"), "gram"]
    # First the best of each of 32 parts of a language, then of those: no task sorts a whole language.
    part = Window.partitionBy("lang", F.pmod(F.xxhash64("gram"), F.lit(32))).orderBy(*order)
    best = n.withColumn("r", F.row_number().over(part)).filter(F.col("r") <= places)
    whole = Window.partitionBy("lang").orderBy(*order)
    return written(best.withColumn("r", F.row_number().over(whole)).filter(F.col("r") <= places).select("lang", "gram", "r"), "profiles")


def collected(places: DataFrame) -> dict:
    """language -> its n-grams by rank."""
    out: dict = {}
    for r in sorted(places.collect(), key=lambda r: (r.lang, r.r)):
        out.setdefault(r.lang, []).append(gram_of(r.gram))
    return out


def profiles(rows: DataFrame, places: int = PLACES) -> dict:
    """language -> its n-grams by rank, from labelled rows (lang, text)."""
    return collected(ranked(rows, places))


def first_places(text: str | None, places: int) -> np.ndarray:
    """The numbers of a text's most frequent n-grams, by rank."""
    found, n = np.unique(numbers(text or ""), return_counts=True)
    if len(found) > places:  # only what can be among the first places is sorted
        least = np.partition(n, -places)[-places]
        found, n = found[n >= least], n[n >= least]
    return found[np.lexsort((mixed(found), -n))][:places]


class Matcher:
    def __init__(self, profiles_: dict):
        self.langs = sorted(profiles_)
        self.places = max(map(len, profiles_.values()), default=0)
        #: All n-grams of the profiles in the order of their numbers, with their place in every profile; -1: in none of its places.
        self.known = np.array(sorted({number(g) for p in profiles_.values() for g in p}), np.uint64)
        self.ranks = np.full((len(self.known) + 1, len(self.langs)), -1, np.int32)
        for i, lang in enumerate(self.langs):
            self.ranks[np.searchsorted(self.known, np.array([number(g) for g in profiles_[lang]], np.uint64)), i] = np.arange(len(profiles_[lang]))

    def distances(self, text: str | None) -> np.ndarray | None:
        """Out-of-place distance to every language, as a share of the largest possible one."""
        if not self.langs:
            return None
        found = first_places(text, self.places)
        if not len(found):
            return None
        at = np.searchsorted(self.known, found)
        at[self.known[np.minimum(at, len(self.known) - 1)] != found] = len(self.known)  # the row of -1
        known = self.ranks[at]
        off = np.where(known < 0, self.places, np.abs(known - np.arange(len(found))[:, None]))
        return off.sum(axis=0) / (len(found) * self.places)

    def predict(self, text: str | None) -> tuple:
        d = self.distances(text)
        if d is None:
            return "und", 0.0
        near = 1.0 - np.minimum(d, 1.0)
        best = int(np.argmin(d))
        total = near.sum()
        return self.langs[best], float(near[best] / total) if total > 0 else 0.0


@lru_cache(2)
def matcher(data: bytes) -> Matcher:
    return Matcher(pickle.loads(data))


def predicted(text, profiles_: dict):
    """Column of struct(lang_pred, score)."""
    data = pickle.dumps(profiles_)

    @F.pandas_udf("lang_pred string, score double")
    def of(texts: pd.Series) -> pd.DataFrame:
        m = matcher(data)
        return pd.DataFrame([m.predict(t) for t in texts], columns=["lang_pred", "score"])

    return of(text)


def joined(docs: DataFrame, places: DataFrame) -> DataFrame:
    """The same predictions for any number of languages: the documents' n-grams meet the table of the profiles in a join.

    What a language gains by an n-gram is how much nearer than the penalty its place is; the distance is what it does not gain. So only n-grams of a profile make
    rows. An n-gram that very many documents have is split by AQE, as both sides have a shuffle of their own.
    """
    size = places.agg(F.max("r").alias("r"), F.min("lang").alias("lang")).first()  # one row
    width, least = size["r"], size["lang"]

    @F.pandas_udf("array<long>")
    def first(texts: pd.Series) -> pd.Series:
        return pd.Series([first_places(t, width).view(np.int64) for t in texts], dtype=object)

    rows = written(with_row_id(docs, "_rid").withColumn("_grams", first("text")), "first")
    each = rows.select("_rid", F.posexplode("_grams").alias("_at", "gram")).withColumn("_hash", F.xxhash64("gram"))
    met = each.join(places.withColumn("_hash", F.xxhash64("gram")), ["gram", "_hash"])
    gains = met.groupBy("_rid", "lang").agg(F.sum(width - F.abs(F.col("r") - 1 - F.col("_at"))).alias("gain"))
    best = gains.groupBy("_rid").agg(F.min(F.struct(-F.col("gain"), "lang")).alias("best"), F.sum("gain").alias("all"))
    found = rows.join(best.select("_rid", (-F.col("best.col1")).alias("_gain"), F.col("best.lang").alias("_lang"), F.col("all").alias("_all")), "_rid", "left")
    letters = F.size("_grams") > 0
    return found.select(
        *[F.col(f"`{c}`") for c in docs.columns],
        F.when(letters, F.coalesce("_lang", F.lit(least))).otherwise("und").alias("lang_pred"),
        F.when(letters, F.coalesce(F.try_divide("_gain", "_all"), F.lit(0.0))).otherwise(0.0).alias("score"),
    )


def identify(docs: DataFrame, modulus: int = 4, remainder: int = 2, languages: int = LANGUAGES) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document; learned from labelled rows that are not held out."""
    held = holdout("doc_id", modulus, remainder)
    places = ranked(docs.filter(~held & F.col("lang").isNotNull()).select("lang", "text"))
    rows = docs.select("doc_id", held.alias("held_out"), "text")
    if places.select("lang").distinct().count() > languages:
        return joined(rows, places).drop("text")
    rows = rows.select("doc_id", "held_out", predicted(F.col("text"), collected(places)).alias("p"))
    return rows.select("doc_id", "held_out", "p.*")


def op2_language(spark, sf_dir: str) -> DataFrame:
    return identify(documents(spark, sf_dir))
