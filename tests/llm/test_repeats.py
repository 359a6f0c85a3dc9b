import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from premia.llm import repeats
from premia.llm.anchors import cells


def brute(texts, length):
    data = [(t or "").encode() for t in texts]
    count = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d), bool)
        for i in range(len(d) - length + 1):
            if count[d[i : i + length]] > 1:
                gone[i : i + length] = True
        runs = int((np.diff(np.concatenate(([0], gone.view(np.int8)))) == 1).sum())
        kept = np.frombuffer(d, np.uint8)[~gone].tobytes()
        out.append((len(d), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


def texts(seed, n):
    rng = random.Random(seed)

    def noise(k):
        return "".join(rng.choice("abcdefghij é漢\n") for _ in range(k))

    shared = [noise(rng.randint(300, 900)) for _ in range(6)]
    out = [None, "", "short", "ab" * 500, "x" * 450, "x" * 399, "the " * 150]
    for _ in range(n):
        t = noise(rng.randint(0, 900))
        for _ in range(rng.randint(0, 3)):
            s = rng.choice(shared)
            a = rng.randint(0, len(s) // 2)
            t += s[a : a + rng.randint(100, 900)] + noise(rng.randint(0, 200))
        out.append(t)
    out += [out[-1], out[-2], out[-2]]
    return out


@pytest.mark.parametrize("hot", [2000, 2])
def test_against_all_windows(spark, make, docs, hot):
    rows = texts(hot, 60)
    got = repeats.remove_repeats(make(spark, [(i, t, "en", "s") for i, t in enumerate(rows)]), hot=hot, shard=20000).collect()
    want = brute(rows, 400)
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == want[r.doc_id]


def test_corpus(docs, corpus):
    got = repeats.remove_repeats(docs).collect()
    want = brute([t for _, t, *_ in corpus], 400)
    key = lambda r: (str(r[0]), *r[1:])
    assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == sorted(
        key((i, *w)) for (i, *_), w in zip(corpus, want)
    )


def test_equal_windows_share_a_key():
    rng = random.Random(1)
    for _ in range(30):
        w = bytes(rng.choice(b"abc") for _ in range(400))
        found = []
        for _ in range(2):
            data = bytes(rng.choice(b"abc") for _ in range(rng.randint(0, 300)))
            at = len(data)
            data += w + bytes(rng.choice(b"abc") for _ in range(rng.randint(0, 300)))
            key, _, first, last = cells(np.frombuffer(data, np.uint8), 400)
            assert first[0] == 0 and last[-1] == len(data) - 400 and (first[1:] == last[:-1] + 1).all()
            found.append(key[np.searchsorted(last, at)])
        assert found[0] == found[1]


def test_empty_table(empty):
    assert repeats.remove_repeats(empty).count() == 0
