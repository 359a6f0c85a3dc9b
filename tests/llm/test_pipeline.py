import hashlib
from collections import defaultdict

import public_tokenizers
import tiktoken

import corpus_pipeline
from premia.llm import bpe, simhash
from premia.llm.common import shared_folder


def brute_failed(text):
    words = (text or "").encode().split()
    windows = defaultdict(int)
    for w in zip(words, words[1:], words[2:]):
        windows[w] += 1
    hit = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    return len(words) < 50 or 2 * len(hit) > len(words)


def similarity(a, b):
    a, b = set(simhash.shingles(a, 5)), set(simhash.shingles(b, 5))
    return len(a & b) / max(1, len(a | b))


def test_stages_against_brute_force(spark, docs, corpus):
    folder = shared_folder(spark, "pipeline")
    docs.write.parquet(f"{folder}/documents.parquet")
    rows, frames = spark.read.parquet(f"{folder}/documents.parquet"), []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, rows, folder)
        if i < 4:
            assert out.columns == docs.columns
        out.write.parquet(f"{folder}/{i}")
        rows = spark.read.parquet(f"{folder}/{i}")
        frames.append(rows.collect())
    passed, single, unlike, mixed, tokens = frames
    # No text here has symbols or odd words: only the base rule rejects.
    assert sorted(map(str, (r.doc_id for r in passed))) == sorted(str(i) for i, t, *_ in corpus if not brute_failed(t))
    greatest = defaultdict(list)
    for r in passed:
        greatest[r.text].append(r.doc_id)
    assert sorted(r.doc_id for r in single) == sorted(max(x for x in v) for v in greatest.values())
    texts = {r.doc_id: r.text for r in single}
    kept = {r.doc_id for r in unlike}
    for i in texts:  # what goes has a similar text with a smaller id; what is unlike everything stays
        best = max((similarity(texts[i], texts[j]) for j in texts if j < i), default=0)
        assert i in kept or best >= 0.75
        assert best < 0.85 or i not in kept
    total, taken = defaultdict(int), defaultdict(int)
    for r in unlike:
        total[r.source] += len(r.text.split())
    for r in mixed:
        taken[r.source] += len(r.text.split())
        assert r.doc_id in kept
    longest = max(len(r.text.split()) for r in unlike)
    assert abs(sum(taken.values()) - 1.5 * sum(total.values())) <= 2 * longest * len(total)
    assert all(taken[s] <= 2 * total[s] for s in total)
    path = public_tokenizers.path(bpe.VOCABULARY)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.coder(path, public_tokenizers.PATTERN).ranks, special_tokens={})
    want = sorted((r.doc_id, hashlib.sha256(",".join(map(str, library.encode_ordinary(r.text))).encode()).hexdigest()) for r in mixed)
    assert sorted((r.doc_id, r.ids_sha256) for r in tokens) == want


def test_empty_table(spark, empty):
    folder = shared_folder(spark, "pipeline")
    empty.write.parquet(f"{folder}/documents.parquet")
    assert corpus_pipeline.run(spark, folder).count() == 0
