"""Removal of bytes that repeat: every byte covered by a string of ``LENGTH`` bytes that starts anywhere else, too.

Cells (``anchors``) deal out all windows of all texts, so that equal windows meet under one key; only hashes travel at
first. A cell alone with its key has no repeated window. If all cells of a key are equal as wholes, all
their windows repeat. Else the key's different cells are fetched as bytes and put into shards, whole keys
together; each shard's suffix array is built by induced sorting, and its permuted common prefixes show which windows repeat.
Keys with more than ``HOT`` different cells would not fit a task: their windows are counted by hash, each on its own,
with partial counts before the shuffle. Coverage comes back to the documents as intervals.

Hashes decide equality of whole cells (64 bits for the key's bytes, 64 for the whole); the suffix array compares bytes.

Defined results: a null text is empty; texts below ``LENGTH`` bytes lose nothing; repeated rows, also of equal doc_id, repeat each other;
no string counts more than another, so there are no ties; very long texts are cut into windows whole; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from premia.llm.anchors import Hashes, cells
from premia.llm.common import documents, with_row_id, written
from premia.llm.suffixes import repeated

LENGTH = 400
#: Different cells of a key that one task takes, and bytes of a shard, about. Parameters of the cost only.
HOT, SHARD = 2000, 1 << 21
#: Names a row in two numbers: a hash of its file and its number there.
ROW = ("f", "r")


def located(docs: DataFrame) -> DataFrame:
    """f, r, doc_id, text."""
    rows = with_row_id(docs.select("doc_id", "text"), "rid")
    number = F.substring_index("rid", "#", -1)
    file = F.expr("substring(rid, 1, length(rid) - length(substring_index(rid, '#', -1)))")
    return rows.select(F.xxhash64(file).alias("f"), number.cast("long").alias("r"), "doc_id", "text")


def _bytes(text) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)


def cell_rows(rows: DataFrame, length: int) -> DataFrame:
    """f, r, key, whole, first, last of every cell."""
    schema = pa.schema([(c, pa.int64()) for c in ("f", "r", "key", "whole", "first", "last")])

    def run(batches):
        for batch in batches:
            for f, r, text in zip(batch.column("f").to_pylist(), batch.column("r").to_pylist(), batch.column("text")):
                data = _bytes(text.as_py())
                if len(data) >= length:
                    key, whole, first, last = cells(data, length)
                    n = len(key)
                    values = (np.full(n, f), np.full(n, r), key.view(np.int64), whole.view(np.int64), first, last)
                    yield pa.RecordBatch.from_arrays([pa.array(v) for v in values], schema=schema)

    return rows.select("f", "r", "text").mapInArrow(run, "f long, r long, key long, whole long, first long, last long")


def packed(text):
    """The text's bytes, compressed: what is shuffled is the smaller by half."""

    @F.pandas_udf("binary")
    def of(texts: pd.Series) -> pd.Series:
        press = zstandard.ZstdCompressor(level=3)
        return pd.Series([press.compress(_bytes(t).tobytes()) for t in texts], dtype=object)

    return of(text)


def _unpacked(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def fetched(rows: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """``wanted`` (f, r, first, last, key, n) with the bytes of the cell. The wishes of a document travel to it as one row."""
    wishes = wanted.groupBy(*ROW).agg(F.collect_list(F.struct("key", "n", "hot", "first", "last")).alias("w"))  # cells of one text

    def run(batches):
        for batch in batches:
            for x in batch.to_pylist():
                data = _unpacked(x["data"])
                w = x["w"]
                yield pa.RecordBatch.from_pydict({
                    "f": pa.array([x["f"]] * len(w), pa.int64()), "r": pa.array([x["r"]] * len(w), pa.int64()),
                    "key": pa.array([y["key"] for y in w], pa.int64()), "n": pa.array([y["n"] for y in w], pa.int64()),
                    "hot": pa.array([y["hot"] for y in w], pa.bool_()), "first": pa.array([y["first"] for y in w], pa.int64()),
                    "part": pa.array([data[y["first"] : y["last"] + length] for y in w], pa.binary()),
                })

    texts = rows.select(*ROW, packed("text").alias("data"))
    return texts.join(wishes, list(ROW)).mapInArrow(run, "f long, r long, key long, n long, hot boolean, first long, part binary")


SPANS = pa.schema([("f", pa.int64()), ("r", pa.int64()), ("a", pa.int64()), ("b", pa.int64())])


def _runs(mask: np.ndarray) -> tuple:
    edge = np.flatnonzero(np.diff(np.concatenate(([0], mask.view(np.int8), [0]))))
    return edge[::2], edge[1::2] - 1


def _shards(length: int, size: int):
    """Suffix arrays over shards of whole keys; spans of the cells that occur once. Rows come sorted by key."""

    def solve(held):
        hits = repeated([x["part"] for x in held], length)
        f, r, a, b = [], [], [], []
        for x, hit in zip(held, hits):
            if x["n"] == 1:
                starts, ends = _runs(hit)
                f += [x["f"]] * len(starts)
                r += [x["r"]] * len(starts)
                a += (starts + x["first"]).tolist()
                b += (ends + x["first"] + length).tolist()
        return pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in (f, r, a, b)], schema=SPANS)

    def run(batches):
        held, total, key = [], 0, None
        for batch in batches:
            for x in batch.to_pylist():
                if total >= size and x["key"] != key:
                    yield solve(held)
                    held, total = [], 0
                key = x["key"]
                held.append(x)
                total += len(x["part"])
        if held:
            yield solve(held)

    return run


def hot_spans(parts: DataFrame, length: int) -> DataFrame:
    """Spans of windows that repeat among the cells of hot keys: one hash (2 x 64 bits, with the key) per window."""

    def hashed(batches):
        for batch in batches:
            for x in batch.to_pylist():
                h = Hashes(np.frombuffer(x["part"], np.uint8)).all(length).view(np.int64)
                n = len(h)
                values = [np.full(n, x[c]) for c in ("f", "r", "key", "n")]
                at = np.arange(n) + x["first"]
                yield pa.RecordBatch.from_arrays([pa.array(v) for v in (*values, h, at)], names=["f", "r", "key", "n", "h", "a"])

    windows = written(parts.mapInArrow(hashed, "f long, r long, key long, n long, h long, a long"), "windows")
    often = windows.groupBy("key", "h").agg(F.sum("n").alias("m")).filter("m > 1").select("key", "h")
    hits = windows.filter("n = 1").join(written(often, "often"), ["key", "h"])
    return hits.select("f", "r", "a", (F.col("a") + length).alias("b"))


def spans(rows: DataFrame, length: int = LENGTH, hot: int = HOT, shard: int = SHARD) -> DataFrame:
    """f, r, a, b: bytes a .. b - 1 of a document are covered. Spans may overlap."""
    slim = written(cell_rows(rows, length), "cells")
    met = slim.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("whole").alias("lo"), F.max("whole").alias("hi")).filter("n > 1")
    met = written(met.select("key", (F.col("lo") != F.col("hi")).alias("differ")), "met")
    found = written(slim.join(met, "key"), "found")
    end = (F.col("last") + length).alias("b")
    out = found.filter("NOT differ").select("f", "r", F.col("first").alias("a"), end)
    differing = found.filter("differ")
    wholes = differing.groupBy("key", "whole").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("f", "r", "first", "last")).alias("x"))
    wholes = written(wholes, "wholes")
    equal = differing.join(wholes.filter("n > 1").select("key", "whole"), ["key", "whole"])
    out = out.unionByName(equal.select("f", "r", F.col("first").alias("a"), end))
    # Only keys with a cell that occurs once have anything left to find.
    keys = wholes.groupBy("key").agg(F.min("n").alias("least"), F.count(F.lit(1)).alias("cells")).filter("least = 1")
    keys = written(keys.select("key", (F.col("cells") > hot).alias("hot")), "keys")
    parts = written(fetched(rows, wholes.join(keys, "key").select("x.*", "key", "n", "hot"), length), "parts")
    by_key = parts.filter("NOT hot").repartition("key").sortWithinPartitions("key")
    sorted_ = by_key.select("f", "r", "key", "n", "first", "part").mapInArrow(_shards(length, shard), "f long, r long, a long, b long")
    return out.unionByName(sorted_).unionByName(hot_spans(parts.filter("hot"), length))


def removal(rows: DataFrame, covered: DataFrame) -> DataFrame:
    """f, r, doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (the remaining bytes) of every document."""
    lists = covered.groupBy(*ROW).agg(F.collect_list(F.struct("a", "b")).alias("s"))  # spans of one text
    kinds = "n_bytes long, n_removed long, n_spans long, kept_sha256 string"

    @F.pandas_udf(kinds)
    def cut(data: pd.Series, spans_: pd.Series) -> pd.DataFrame:
        out = []
        for d, s in zip(data, spans_):
            d = _unpacked(d)
            kept, at, removed, runs = [], 0, 0, 0
            end = -1
            for a, b in sorted((x["a"], x["b"]) for x in s) if s is not None else ():
                if a > end:  # a new run
                    kept.append(d[at:a])
                    runs += 1
                    removed += b - a
                    at = end = b
                elif b > end:
                    removed += b - end
                    at = end = b
            kept.append(d[at:])
            out.append((len(d), removed, runs, hashlib.sha256(b"".join(kept)).hexdigest()))
        return pd.DataFrame(out, columns=[x.split()[0] for x in kinds.split(", ")])

    texts = rows.select(*ROW, "doc_id", packed("text").alias("data"))
    return texts.join(lists, list(ROW), "left").select(*ROW, "doc_id", cut("data", "s").alias("x")).select(*ROW, "doc_id", "x.*")


def remove_repeats(docs: DataFrame, length: int = LENGTH, hot: int = HOT, shard: int = SHARD) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    rows = located(docs)
    return removal(rows, spans(rows, length, hot, shard)).drop(*ROW)


def op5_repeats(spark, sf_dir: str) -> DataFrame:
    return remove_repeats(documents(spark, sf_dir))
