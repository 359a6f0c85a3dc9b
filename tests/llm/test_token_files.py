import heapq
import json
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from premia.llm import token_files
from premia.llm.common import shared_folder
from premia.llm.huffman import Codebook, code_lengths

PATH = public_tokenizers.path(token_files.VOCABULARY)


def huffman_cost(counts):
    heap = [c for c in counts if c]
    heapq.heapify(heap)
    total = 0
    while len(heap) > 1:
        pair = heapq.heappop(heap) + heapq.heappop(heap)
        total += pair
        heapq.heappush(heap, pair)
    return total


def test_lengths_are_optimal_and_limited():
    rng = random.Random(1)
    for _ in range(60):
        counts = np.array([rng.choice((0, 1, 2, 10, 1000, 10**6)) * rng.randint(1, 5) for _ in range(rng.randint(2, 200))])
        if np.count_nonzero(counts) < 2:
            continue
        lengths = code_lengths(counts, 20).astype(int)
        assert (counts * lengths).sum() == huffman_cost(counts.tolist()) or lengths.max() == 20
        assert sum(2.0 ** -x for x in lengths if x) == 1
    fibonacci = np.array([1, 1, 2, 3, 5, 8, 13, 21, 34, 55, 89, 144])
    best = min((fibonacci * np.array(x)).sum() for x in [code_lengths(fibonacci, 5).astype(int)])
    assert code_lengths(fibonacci, 5).max() == 5 and best >= huffman_cost(fibonacci.tolist())
    assert sum(2.0 ** -x for x in code_lengths(fibonacci, 4).astype(int)) == 1
    with pytest.raises(ValueError):
        code_lengths(np.ones(20, int), 4)


def test_round_trip():
    rng = np.random.default_rng(2)
    for n, size in ((0, 5), (1, 1), (127, 3), (128, 300), (129, 300), (5000, 40000)):
        ids = np.minimum(rng.geometric(0.01, n) - 1, size - 1)
        book = Codebook(code_lengths(np.bincount(ids, minlength=size)))
        payload, checkpoints = book.encode(ids)
        assert np.array_equal(book.decode(payload, checkpoints, n), ids)


def test_parts_are_encoded_like_whole_texts(corpus):
    library = Tokenizer.from_file(PATH)
    rng = random.Random(3)
    mine = token_files.Tokens(PATH)
    letters = "abcDEF  \n\n\t'sré́Σς漢<|endoftext|>0123!?.\x1c\x85​　 "
    texts = [t or "" for _, t, *_ in corpus[-80:]] + ["".join(rng.choice(letters) for _ in range(rng.randint(0, 80))) for _ in range(2000)]
    for text in texts:
        want = [*library.encode(text, add_special_tokens=False).ids, 1]
        assert np.frombuffer(mine.encode(text), mine.type).tolist() == want


@pytest.mark.parametrize("block", [1, 500, 1 << 18])
def test_files(spark, docs, corpus, block):
    folder = shared_folder(spark, "files")
    token_files.write_files(docs, folder, PATH, block)
    library = Tokenizer.from_file(PATH)
    want = [(i, [*library.encode(t or "", add_special_tokens=False).ids, 1]) for i, t, *_ in corpus]
    described = [(i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) for i, ids in want]
    rows = sorted(token_files.read_digests(spark, folder).collect(), key=lambda r: r.start)
    assert sorted(map(repr, described)) == sorted(repr((r.doc_id, r.n_tokens, r.ids_crc32)) for r in rows)
    assert [r.doc_id for r in rows] == sorted((i for i, _ in want), key=lambda i: (i is not None, i or 0))
    start = 0
    for r in rows:
        assert r.start == start
        start += r.n_tokens
    whole = {r.start: bytes(r.ids) for r in token_files.read_files(spark, folder).collect()}
    assert [zlib.crc32(whole[r.start]) for r in rows] == [r.ids_crc32 for r in rows]


def test_one_identifier_of_a_third_of_the_rows_is_dealt_to_many_tasks(spark, make, docs):
    """Null and repeated identifiers, with equal texts and with different ones."""
    rows = [(None, f"text {i} of no identifier", "en", "a") for i in range(400)] + [(7, "the very same text", "en", "a")] * 400
    rows += [(1000 + i, f"text {i}", "en", "a") for i in range(400)]
    parts = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "12")
    try:
        folder = shared_folder(spark, "files")
        token_files.write_files(make(spark, rows), folder, PATH)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", parts)
    blocks = spark.read.parquet(f"{folder}/blocks").groupBy("shard").sum("n").collect()
    got = sorted(token_files.read_digests(spark, folder).collect(), key=lambda r: r.start)
    assert len(blocks) >= 9 and len(got) == 1200
    assert max(r["sum(n)"] for r in blocks) < sum(r.n_tokens for r in got) / 4
    assert [r.doc_id for r in got] == [None] * 400 + [7] * 400 + [1000 + i for i in range(400)]
    assert all(a.start + a.n_tokens == b.start for a, b in zip(got, got[1:]))


def test_a_full_table_of_parts_forgets_and_finds_again():
    calls = []
    kept = token_files.Kept(lambda p: calls.append(p) or p.encode(), 3)
    for p in ("a", "b", "c", "a", "d", "a", "b", "e", "f", "g", "a", "x" * 200, "x" * 200):
        assert kept[p] == p.encode()
    assert calls.count("c") == 1 and calls.count("x" * 200) == 2 and len(kept) <= 3 and len(kept.old) <= 3


def test_a_tokenizer_that_splits_otherwise_is_refused(tmp_path):
    spec = json.loads(Tokenizer.from_file(PATH).to_str())
    for change in ({"normalizer": None}, {"pre_tokenizer": {"type": "Whitespace"}}):
        (tmp_path / "t.json").write_text(json.dumps(spec | change))
        with pytest.raises(ValueError, match="not known"):
            token_files.Tokens(str(tmp_path / "t.json"))


def test_empty_table(spark, empty):
    folder = shared_folder(spark, "files")
    token_files.write_files(empty, folder, PATH)
    assert token_files.read_digests(spark, folder).count() == 0
