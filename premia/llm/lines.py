"""Line de-duplication with keep bitmaps. DataFrame functions only.

Every line long enough is a row of 128 bits of the SHA-256 of its key, doc_id, locator of its document (hash of the file, row in it) and
position; no text is shuffled to find copies. The rows are range-partitioned by hash and a salt of the locator, and sorted
within by document, greatest doc_id first, and position: the first document of each run is the one that may keep the line. A run
of one salt passes on what its first few documents hold; from the rest on every line is a copy whatever the other salts
hold. A second run over the hash alone, of no more than ``min_documents`` documents a salt, decides these. So a line that
a third of all documents hold is dealt to as many tasks as there are salts.

The result per document is a run-length compressed bitmap (``dropped``: start and length of each run of dropped lines, ascending;
all other lines are kept), and ``apply_bitmaps`` cuts the text with it.

Defined results: every row is a document, also where doc_ids repeat; a null doc_id is below all others; of rows with the same
doc_id the one with the greatest locator counts as the largest. A null or empty text is one empty line. All lines of the document that keeps a key stay, repeated
ones too. Very long texts are cut in time linear in their lines. An empty table gives an empty result; extra columns are
ignored.
"""

from __future__ import annotations

import string

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from premia.llm.common import documents, text_of, written

#: ASCII white space.
BLANK = "\x20\x09\x0a\x0b\x0c\x0d"
LOCATOR = ("file", "row")
RUNS = "array<struct<start:int,length:int>>"


def lower_ascii(column: Column) -> Column:
    return F.translate(column, string.ascii_uppercase, string.ascii_lowercase)


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def key_of(line: Column) -> Column:
    return lower_ascii(F.btrim(line, F.lit(BLANK)))


def located(docs: DataFrame) -> DataFrame:
    """Adds the locator, two numbers: the same each time the frame is read. A frame that is no file scan is written first."""
    try:
        return docs.select("*", F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    except AnalysisException:
        return located(written(docs, "rows"))


def line_rows(rows: DataFrame, min_chars: int) -> DataFrame:
    """hash, salt, doc_id, locator, position of every line whose key has at least ``min_chars`` code points."""
    salts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = F.transform(lines_of(text_of()), key_of)
    each = rows.select(F.col("doc_id").cast("long").alias("doc_id"), *LOCATOR, F.posexplode(keys).alias("position", "key"))
    return each.filter(F.length("key") >= min_chars).select(
        F.unhex(F.substring(F.sha2("key", 256), 1, 32)).alias("hash"),
        F.pmod(F.xxhash64(*LOCATOR), F.lit(salts)).cast("int").alias("salt"),
        "doc_id", *LOCATOR, "position",
    )


def copies(rows: DataFrame, min_chars: int, min_documents: int) -> DataFrame:
    """Locator and position of every line to drop."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    newest = [F.col(c).desc_nulls_last() for c in ("doc_id", *LOCATOR)]
    each = written(line_rows(rows, min_chars), "lines")  # else the texts are read twice: the bounds of the ranges come from a pass of their own
    ordered = each.repartitionByRange(parts, "hash", "salt")
    ordered = ordered.sortWithinPartitions("hash", "salt", *newest, "position")
    run = ordered.withColumn("nth", F.dense_rank().over(Window.partitionBy("hash", "salt").orderBy(*newest)))
    sure = run.filter(F.col("nth") > min_documents)
    heads = Window.partitionBy("hash")
    open_ = run.filter(F.col("nth") <= min_documents).withColumn("nth", F.dense_rank().over(heads.orderBy(*newest)))
    open_ = open_.withColumn("found", F.max("nth").over(heads))
    decided = open_.filter((F.col("nth") > 1) & (F.col("found") >= min_documents))
    return sure.select(*LOCATOR, "position").unionAll(decided.select(*LOCATOR, "position"))


def runs_of(positions: Column) -> Column:
    """Maximal runs of consecutive numbers in an ascending array without repeats."""
    ends = lambda step: F.filter(positions, lambda p, i: F.coalesce(F.get(positions, i + step) != p + step, F.lit(True)))
    pairs = F.arrays_zip(ends(F.lit(-1)).alias("a"), ends(F.lit(1)).alias("b"))
    return F.transform(pairs, lambda r: F.struct(r["a"].alias("start"), (r["b"] - r["a"] + 1).alias("length")))


def bitmaps(docs: DataFrame, min_chars: int = 20, min_documents: int = 3) -> DataFrame:
    """file, row, dropped: one row per document that loses lines. ``docs`` has its locator (``located``)."""
    if min_documents < 2:
        raise ValueError("a line of one document is no copy")
    found = copies(docs.select("doc_id", "text", *LOCATOR), min_chars, min_documents)
    per_document = found.groupBy(*LOCATOR).agg(F.sort_array(F.collect_list("position")).alias("p"))  # lines of one document
    return per_document.select(*LOCATOR, runs_of(F.col("p")).alias("dropped"))


def kept_lines(lines: Column, dropped: Column) -> Column:
    """The lines between the dropped runs."""
    n = F.size(dropped)
    begin = lambda i: F.when(i == 0, 0).otherwise(F.get(dropped, i - 1)["start"] + F.get(dropped, i - 1)["length"])
    end = lambda i: F.when(i == n, F.size(lines)).otherwise(F.get(dropped, i)["start"])
    between = F.transform(F.sequence(F.lit(0), n), lambda i: F.slice(lines, begin(i) + 1, end(i) - begin(i)))
    return F.flatten(between)


def apply_bitmaps(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``docs``, with locator, and n_lines, n_dropped, dropped, kept_text."""
    # The joins of both sides are on the locator, which names one row: no key is hot.
    joined = docs.join(found, list(LOCATOR), "left").withColumn("dropped", F.coalesce("dropped", F.lit([]).cast(RUNS)))
    lines, n = lines_of(text_of()), F.aggregate("dropped", F.lit(0), lambda a, r: a + r["length"])
    cut = F.array_join(kept_lines(lines, F.col("dropped")), "\n")
    return joined.withColumns({
        "n_lines": F.size(lines).cast("long"),
        "n_dropped": n.cast("long"),
        "kept_text": F.when(F.size("dropped") == 0, text_of()).otherwise(cut),
    })


def deduplicate_lines(docs: DataFrame, min_chars: int = 20, min_documents: int = 3) -> DataFrame:
    """doc_id, text, n_lines, n_dropped, dropped (the bitmap), kept_text of every document."""
    rows = located(docs.select("doc_id", "text"))
    return apply_bitmaps(rows, bitmaps(rows, min_chars, min_documents)).drop(*LOCATOR)


def op13_lines(spark, sf_dir: str) -> DataFrame:
    out = deduplicate_lines(documents(spark, sf_dir))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


ORACLE = r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS position FROM d),
k AS (
    SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM l
),
c AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
m AS (SELECT k.*, coalesce(k.doc_id <> c.keeper, false) AS dropped FROM k LEFT JOIN c USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY position) FILTER (NOT dropped), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""
