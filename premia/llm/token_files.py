"""Token ids in compressed files.

Texts are tokenized once; the ids of all documents are counted, and the counts give a canonical Huffman code of limited length. The
rows are sorted by doc_id over range partitions, and each partition, a shard, writes its ids as independent blocks: whole documents up to
about ``BLOCK`` ids, a payload of bits, and the bit offset of every 128th id. The files are two Parquet tables, so any
store that Spark writes to will do: ``codebook`` (id, n, length) and ``blocks``. Reading needs nothing else: the codes follow
from the lengths, each block is decoded alone, and where a shard starts follows from the sums of the shards before it.

Defined results: a null or empty text has the end id alone; null doc_ids come first; rows of equal doc_id are ordered by a digest of their ids; ids of equal count
are ordered by id before they get their codes; very long texts are encoded whole and make a block of their own; an empty
table gives empty files and an empty result; extra columns are ignored.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from array import array
from functools import lru_cache

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from premia.llm.common import documents, shared_folder, written
from premia.llm.huffman import STRIDE, Codebook, code_lengths

VOCABULARY = "word_bpe_49k.json"
END = 1
#: Ids of a block, about.
BLOCK = 1 << 18
#: Entries of either half of a worker's table of words.
CACHE = 600_000
BLOCKS = "shard int, block int, first long, n long, doc_ids binary, known binary, sizes binary, payload binary, checkpoints binary"


#: How byte-level vocabularies write a byte as a character: printable bytes as themselves, the others from 256 on. A fixed rule.
_SELF = [*range(33, 127), *range(161, 173), *range(174, 256)]
WRITTEN = str.maketrans({chr(b): chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in _SELF)})
#: Punctuation before a full stop or comma at the end of a word: there the two are one token's worth of text.
DOUBLE = re.compile(r"(?<![^\W_])(?<![ \n\t\r])[.,][ \n]")


#: How the library prepares a text, and what a word is to it. ``Tokens.parts`` and ``Tokens.word`` rest on this. Fixed values.
NORMALISED = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"


def require_known(library) -> None:
    """Refuse a tokenizer file that prepares or splits texts in another way."""
    spec = json.loads(library.to_str())
    first, *others = (spec["pre_tokenizer"] or {}).get("pretokenizers", [{}])
    found = (
        (spec["normalizer"] or {}).get("normalizers"), first.get("pattern"), first.get("behavior"), first.get("invert"),
        [(p["type"], p.get("add_prefix_space"), p.get("use_regex")) for p in others], spec["post_processor"], spec["model"]["type"],
        spec["model"].get("dropout"),
    )
    known = (NORMALISED, {"Regex": SPLIT}, "Removed", True, [("ByteLevel", False, False)], None, "BPE", None)
    if found != known:
        raise ValueError(f"this tokenizer prepares or splits texts in a way that is not known here: {found}")


class Tokens:
    """The library's ids of whole texts. No token spans a space or a line end, nor the border between a letter and a mark of
    punctuation behind it, so the parts between these are encoded once and kept. A word of plain letters goes straight to the library's
    merges; plain are the letters for which, tried one by one, that gives what the library's whole way gives."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task per core
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        require_known(self.library)
        self.model = self.library.model
        self.type = "<u2" if self.library.get_vocab_size() <= 1 << 16 else "<u4"
        self.end = np.array([END], self.type).tobytes()
        self.code = "H" if self.type == "<u2" else "I"  # as the array module names them, on a little-endian machine
        self.known = Kept(self.part, CACHE)
        letters = [c for c in map(chr, range(592)) if c.isalpha()]
        tried = [(c, w) for c in letters for w in (c, f"a{c}e", f"{c}{c}")]
        wrong = {c for c, w in tried if self.word(w) != self.library.encode(w, add_special_tokens=False).ids}
        self.plain = frozenset(letters) - wrong

    def word(self, word: str) -> list:
        """Ids by the merges alone, of a word that is one piece of text to the library."""
        written_ = word.lower()
        if not written_.isascii():
            written_ = written_.encode().decode("latin-1").translate(WRITTEN)
        return [x.id for x in self.model.tokenize(written_)]

    @staticmethod
    def parts(text: str) -> list:
        if DOUBLE.search(text) is None:
            text = text.replace(", ", " , ").replace(". ", " . ").replace(".\n", " . ").replace(",\n", " , ")
        return text.replace("\n", " ").split(" ")

    def encode(self, text: str | None) -> bytes:
        """Ids of a text and the end id, as little-endian numbers."""
        return b"".join(map(self.known.__getitem__, self.parts(text or ""))) + self.end

    def part(self, part: str) -> bytes:
        """Ids of a part that is not kept yet."""
        if part and self.plain.issuperset(part):
            ids = self.word(part)
        else:
            ids = self.library.encode_batch_fast([part], add_special_tokens=False)[0].ids
        return array(self.code, ids).tobytes()


class Kept(dict):
    """Ids of parts, found as a dictionary finds them, so that only a new part costs a call. Full, what it holds becomes the older half, and
    what is found there moves up. Long parts are not kept."""

    def __init__(self, find, size: int):
        super().__init__()
        self.find, self.size, self.old = find, size, {}

    def __missing__(self, part: str) -> bytes:
        ids = self.old.get(part)
        if ids is None:
            ids = self.find(part)
        if len(part) < 100:
            if len(self) >= self.size:
                self.old = dict(self)
                self.clear()
            self[part] = ids
        return ids


@lru_cache(2)
def tokens(path: str) -> Tokens:
    return Tokens(path)


def encoded(text, path: str):
    @F.pandas_udf("binary")
    def of(texts: pd.Series) -> pd.Series:
        t = tokens(path)
        return pd.Series([t.encode(x) for x in texts], dtype=object)

    return of(text)


def _type(size: int) -> str:
    return "<u2" if size <= 1 << 16 else "<u4"


def counted(rows: DataFrame, size: int) -> np.ndarray:
    """How often each id occurs in the column ids. One row per id is collected: the vocabulary's size."""

    def count(batches):
        total = np.zeros(size, np.int64)
        for batch in batches:
            for at in range(0, len(batch), 200):  # not one sum of the vocabulary's size per text
                total += np.bincount(np.frombuffer(b"".join(batch["ids"].iloc[at : at + 200]), _type(size)), minlength=size)
        at = np.flatnonzero(total)
        yield pd.DataFrame({"id": at, "n": total[at]})

    out = np.zeros(size, np.int64)
    for r in rows.select("ids").mapInPandas(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect():
        out[r.id] = r.n
    return out


def _count_fast(ids: bytes, kind: str) -> int:
    return len(ids) // np.dtype(kind).itemsize


def _blocks(lengths: bytes, size: int, block: int):
    schema = pa.schema([
        ("shard", pa.int32()), ("block", pa.int32()), ("first", pa.int64()), ("n", pa.int64()), ("doc_ids", pa.binary()),
        ("known", pa.binary()), ("sizes", pa.binary()), ("payload", pa.binary()), ("checkpoints", pa.binary()),
    ])

    def run(batches):
        book, kind = Codebook(np.frombuffer(lengths, np.uint8)), _type(size)
        shard, number, first = TaskContext.get().partitionId(), 0, 0
        docs, lists, held = [], [], 0

        def row():
            ids = np.frombuffer(b"".join(lists), kind)
            payload, checkpoints = book.encode(ids)
            known = np.array([d is not None for d in docs])
            numbers = np.array([d or 0 for d in docs], "<i8")
            sizes = np.array([_count_fast(x, kind) for x in lists], "<i8")
            values = (shard, number, first, len(ids), numbers.tobytes(), known.tobytes(), sizes.tobytes(), payload, checkpoints)
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, schema)], schema=schema)

        for batch in batches:
            for d, ids in zip(batch.column("doc_id").to_pylist(), batch.column("ids")):
                docs.append(d)
                lists.append(ids.as_py())
                held += _count_fast(lists[-1], kind)
                if held >= block:
                    yield row()
                    number, first, docs, lists, held = number + 1, first + held, [], [], 0
        if docs:
            yield row()

    return run


def write_files(docs: DataFrame, folder: str, path: str, block: int = BLOCK) -> None:
    """Writes ``folder``/codebook and ``folder``/blocks."""
    spark = docs.sparkSession
    staged = shared_folder(spark, "ids")
    docs.select(F.col("doc_id").cast("long").alias("doc_id"), encoded(F.col("text"), path).alias("ids")).write.option("compression", "zstd").parquet(staged)
    rows = spark.read.schema("doc_id long, ids binary").parquet(staged)
    size = tokens(path).library.get_vocab_size()
    counts = counted(rows, size)
    lengths = code_lengths(counts)
    at = np.flatnonzero(lengths)
    book = pd.DataFrame({"id": at.astype(np.int64), "n": counts[at], "length": lengths[at].astype(np.int32)})
    spark.createDataFrame(book, "id long, n long, length int").coalesce(1).write.parquet(f"{folder}/codebook")
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # A null or repeated doc_id may stand for very many rows: the range goes on by digest and, for equal rows, by place in the staged files.
    digest, place = F.xxhash64("ids").alias("digest"), F.xxhash64("_metadata.file_path", "_metadata.row_index").alias("place")
    keys = [F.col("doc_id").asc_nulls_first(), F.col("digest"), F.col("place")]
    ordered = rows.select("doc_id", "ids", digest, place).repartitionByRange(shards, *keys).sortWithinPartitions(*keys).select("doc_id", "ids")
    ordered.mapInArrow(_blocks(lengths.tobytes(), size, block), BLOCKS).write.option("compression", "uncompressed").parquet(f"{folder}/blocks")


def read_files(spark, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids (little-endian unsigned 32-bit numbers) of every document, from the files alone."""
    return _read(spark, folder, "doc_id long, start long, n_tokens long, ids binary", lambda ids: ids.tobytes(), pa.binary(), "ids")


def read_digests(spark, folder: str) -> DataFrame:
    """The same with ids_crc32 in place of the ids."""
    return _read(spark, folder, "doc_id long, start long, n_tokens long, ids_crc32 long", lambda ids: zlib.crc32(ids.tobytes()), pa.int64(), "ids_crc32")


def _read(spark, folder: str, ddl: str, of, kind, name: str) -> DataFrame:
    book = spark.read.schema("id long, n long, length int").parquet(f"{folder}/codebook").collect()  # one row per id
    lengths = np.zeros(max((r.id for r in book), default=0) + 1, np.uint8)
    for r in book:
        lengths[r.id] = r.length
    lengths = lengths.tobytes()
    blocks = spark.read.schema(BLOCKS).parquet(f"{folder}/blocks")
    # One row per shard: where it starts.
    shards = blocks.groupBy("shard").agg(F.sum("n").alias("size"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = written(shards.select("shard", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset")), "shards")
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), (name, kind)])

    def decode(batches):
        book_ = _book(lengths)
        for batch in batches:
            for r in batch.to_pylist():
                ids = book_.decode(r["payload"], r["checkpoints"], r["n"], STRIDE).astype("<u4")
                sizes = np.frombuffer(r["sizes"], "<i8")
                ends = np.cumsum(sizes)
                known = np.frombuffer(r["known"], bool)
                numbers = np.frombuffer(r["doc_ids"], "<i8")
                values = [of(ids[b - n : b]) for b, n in zip(ends.tolist(), sizes.tolist())]
                yield pa.RecordBatch.from_arrays([
                    pa.array(numbers, mask=~known), pa.array(r["offset"] + r["first"] + ends - sizes), pa.array(sizes), pa.array(values, kind),
                ], schema=schema)

    return blocks.join(starts, "shard").mapInArrow(decode, ddl)


@lru_cache(2)
def _book(lengths: bytes) -> Codebook:
    return Codebook(np.frombuffer(lengths, np.uint8))


def op6_tokens(spark, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "token-files")
    write_files(documents(spark, sf_dir), folder, public_tokenizers.path(VOCABULARY))
    return read_digests(spark, folder)
