"""Quality rules with adaptive thresholds.

Every document is measured once. The measures are counted into sketches per language and source: histograms with one
bucket per whole number up to 1,024 and 64 buckets per power of two beyond, so a sketch has a bounded size, an error of
at most 1/64, and two sketches are merged by adding their counts, in any order. A group's quartiles are drawn towards those of
the merged sketch of its language, and these towards the whole table's, the more the fewer rows there are. A threshold lies a
multiple of the distance between the quartiles beyond the outer one, wherever that is; a least distance keeps ordinary text
where a group hardly varies. At most a quarter of a group is beyond a threshold. The documents are then joined with the
thresholds of their group.

Defined results: a null text has no words and fails the base rule; null languages and sources form groups of their own;
repeated rows are judged alike; a value that equals its threshold passes; very long texts are measured whole; an empty table gives an empty result; extra columns are ignored or passed on.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from premia.llm.common import documents, written

MEASURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long"
#: name -> (numerator, denominator, scale). Whole numbers, so that sketches do not depend on floating point.
RATIOS = {
    "symbols": ("n_symbols", "word_chars", 1000),
    "dup_lines": ("n_dup_lines", "n_lines", 1000),
    "repeats": ("n_repeat_words", "n_words", 1000),
    "word_length": ("word_chars", "n_words", 100),
}
#: Which thresholds there are: (lower, upper).
SIDES = {"symbols": (False, True), "dup_lines": (False, True), "repeats": (False, True), "word_length": (True, True)}
#: Least distance between the quartiles: 1 % symbols, 11.5 % lines (one line of three may repeat another), 10 % words, 0.4 letters.
FLOORS = {"symbols": 10, "dup_lines": 115, "repeats": 100, "word_length": 40}
#: A threshold is so many times that distance beyond the quartile.
SPREADS = 3
#: Rows at which a group's own quartiles weigh as much as those of its language, and a language's as much as the whole table's.
SMALL = 100


def repeated_words(words: list) -> int:
    """Words that lie in a three-word window which occurs at least twice."""
    n = len(words)
    if n < 4:
        return 0
    number: dict = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    pairs = np.unique(ids[:-1] * len(number) + ids[1:], return_inverse=True)[1]
    _, where, count = np.unique(pairs[:-1] * len(number) + ids[2:], return_inverse=True, return_counts=True)
    hit = count[where] > 1
    covered = np.zeros(n, bool)
    for shift in range(3):
        covered[shift : n - 2 + shift] |= hit
    return int(covered.sum())


def measure(text: str | None) -> tuple:
    text = text or ""
    words = text.encode("utf-8", "surrogatepass").split()
    lines = [x for x in text.split("\n") if x.strip(" \t\r\x0b\x0c")]
    return (
        len(words),
        len(text) - sum(map(text.count, " \t\n\r\x0b\x0c")),
        sum(map(text.count, "#*$%&|<>")),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
    )


def measures(text: str):
    """Column of all measures of a text column, as a struct."""
    names = [x.split()[0] for x in MEASURES.split(", ")]

    @F.pandas_udf(MEASURES)
    def of(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([measure(t) for t in texts], columns=names, dtype="int64")

    return of(text)


def _ratio(name: str):
    over, under, scale = RATIOS[name]
    return F.when(F.col(under) > 0, F.expr(f"({scale} * {over}) DIV {under}"))


def _bucket(value):
    """Number of the bucket: the value itself below 1,024, then its power of two and its next six bits."""
    power = F.length(F.bin(value)) - 1
    return F.when(value < 1024, value).otherwise(
        1024 + (power - 10) * 64 + F.expr("CAST(shiftright(v, CAST(length(bin(v)) - 7 AS INT)) AS LONG)") - 64
    )


def sketches(measured: DataFrame) -> DataFrame:
    """Mergeable sketches: lang, source, measure, bucket, n."""
    pairs = F.array(*[F.struct(F.lit(name).alias("measure"), _ratio(name).alias("v")) for name in RATIOS])
    return (
        measured.select("lang", "source", F.inline(pairs))
        .filter("v IS NOT NULL")
        .withColumn("bucket", _bucket(F.col("v")))
        .groupBy("lang", "source", "measure", "bucket")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def merged(sketch: DataFrame, keys: list) -> DataFrame:
    return sketch.groupBy(*keys, "measure", "bucket").agg(F.sum("n").alias("n"))


def quantiles(sketch: DataFrame, keys: list) -> DataFrame:
    """One row per group and measure: total and quantiles, as lower ends of buckets."""
    group = Window.partitionBy(*keys, "measure")
    run = sketch.select(
        "*",
        F.sum("n").over(group.orderBy("bucket")).alias("upto"),
        F.sum("n").over(group).alias("total"),
        F.expr(
            "CASE WHEN bucket < 1024 THEN bucket "
            "ELSE shiftleft(64L + (bucket - 1024) % 64, CAST((bucket - 1024) DIV 64 + 4 AS INT)) END"
        ).alias("low"),
    )
    at = {f"q{q}": F.min(F.when(F.col("upto") * 100 >= F.col("total") * q, F.col("low"))) for q in (10, 25, 50, 75, 90)}
    return run.groupBy(*keys, "measure").agg(F.max("total").alias("total"), *[c.alias(k) for k, c in at.items()])


def thresholds(measured: DataFrame, small: int = SMALL, spreads: int = SPREADS) -> DataFrame:
    """One row per language and source: lower and upper threshold of every measure (null: none)."""
    sketch = written(sketches(measured), "sketch")
    groups = sketch.select("lang", "source", "measure").distinct()
    own = quantiles(sketch, ["lang", "source"]).alias("o")
    lang = quantiles(merged(sketch, ["lang"]), ["lang"]).alias("l")
    whole = quantiles(merged(sketch, []), []).alias("w")
    joined = (
        groups.alias("g")
        .join(own, F.expr("g.lang <=> o.lang AND g.source <=> o.source AND g.measure = o.measure"), "left")
        .join(lang, F.expr("g.lang <=> l.lang AND g.measure = l.measure"), "left")
        .join(whole, F.expr("g.measure = w.measure"), "left")
    )
    def shrunk(q, own, parent):
        """From a group towards what it is part of: few rows hardly count, as junk may be most of them, many do in full, and no number is a step."""
        weight = 1 / (1 + F.pow(small / F.col(f"{own}.total"), 3))
        return weight * F.col(f"{own}.{q}") + (1 - weight) * parent

    pick = {q: shrunk(q, "o", shrunk(q, "l", F.col(f"w.{q}"))) for q in ("q25", "q75")}
    picked = joined.select(F.col("g.lang").alias("lang"), F.col("g.source").alias("source"), F.col("g.measure").alias("measure"), *[c.alias(k) for k, c in pick.items()])
    out = []
    for name, (lower, upper) in SIDES.items():
        mine = F.col("measure") == name
        spread = spreads * F.greatest(F.col("q75") - F.col("q25"), F.lit(FLOORS[name]))
        if lower:
            out.append(F.max(F.when(mine, F.col("q25") - spread)).alias(f"{name}_min"))
        if upper:
            out.append(F.max(F.when(mine, F.col("q75") + spread)).alias(f"{name}_max"))
    return picked.groupBy("lang", "source").agg(*out)


def judged(measured: DataFrame, limits: DataFrame, base_words: int = 50, base_repeat: int = 50) -> DataFrame:
    """Adds base_failed and kept. The thresholds are a written table: Catalyst broadcasts it by its size, or else joins by shuffle."""
    t = limits.alias("t")
    rows = measured.alias("m").join(t, F.expr("m.lang <=> t.lang AND m.source <=> t.source"), "left")
    outside = F.lit(False)
    for name, (lower, upper) in SIDES.items():
        value = _ratio(name)
        if lower:
            outside = outside | F.coalesce(value < F.col(f"t.{name}_min"), F.lit(False))
        if upper:
            outside = outside | F.coalesce(value > F.col(f"t.{name}_max"), F.lit(False))
    failed = (F.col("n_words") < base_words) | (100 * F.col("n_repeat_words") > base_repeat * F.col("n_words"))
    return rows.select("m.*", failed.alias("base_failed"), (~failed & ~outside).alias("kept"))


def judge(docs: DataFrame, columns: list) -> DataFrame:
    """``columns`` of every document with its measures, base_failed and kept. The texts are measured once."""
    names = [f"_k{i}" for i in range(len(columns))]  # measures never clash with what is passed on
    renamed = docs.select("lang", "source", *[F.col(f"`{c}`").alias(n) for c, n in zip(columns, names)], measures("text").alias("_m"))
    measured = written(renamed.select("lang", "source", *names, "_m.*"), "measured")
    limits = written(thresholds(measured), "thresholds")
    return judged(measured, limits)


def kept_documents(docs: DataFrame) -> DataFrame:
    """The documents that pass, with the columns of ``docs``."""
    rows = judge(docs, docs.columns).filter("kept")
    return rows.select(*[F.col(f"_k{i}").alias(c) for i, c in enumerate(docs.columns)])


def op9_quality(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return judge(docs, ["doc_id"]).select(
        F.col("_k0").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )
