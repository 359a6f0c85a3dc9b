import random

import numpy as np
import pytest

from premia.llm.suffixes import permuted_prefixes, repeated, suffix_array


def random_bytes(rng, n):
    kind = rng.randrange(4)
    if kind == 0:
        return bytes(rng.randrange(256) for _ in range(n))
    if kind == 1:
        return bytes(rng.choice(b"ab") for _ in range(n))
    if kind == 2:
        return (bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 5))) * n)[:n]
    out = bytearray(rng.choice(b"xyz") for _ in range(n))
    for _ in range(3):
        a, b, k = rng.randrange(n + 1), rng.randrange(n + 1), rng.randint(0, n)
        out[b : b + k] = out[a : a + k]
    return bytes(out[:n])


@pytest.mark.parametrize("seed", range(60))
def test_array_and_prefixes(seed):
    rng = random.Random(seed)
    data = random_bytes(rng, rng.randint(0, 200))
    t = np.append(np.frombuffer(data, np.uint8).astype(np.uint16) + 1, np.uint16(0))
    sa = suffix_array(t, 257)
    s = t.tolist()
    assert sa.tolist() == sorted(range(len(s)), key=lambda i: s[i:])
    plcp, phi = permuted_prefixes(t, sa, len(s) + 4)
    for i, j in enumerate(phi.tolist()):
        if j >= 0:
            n = 0
            while s[i + n : i + n + 1] == s[j + n : j + n + 1] != []:
                n += 1
            assert plcp[i] == n


@pytest.mark.parametrize("seed", range(40))
def test_repeated_windows(seed):
    rng = random.Random(seed)
    parts = [random_bytes(rng, rng.randint(0, 60)) for _ in range(rng.randint(1, 12))]
    parts += [rng.choice(parts) for _ in range(2)] + [b"\0\0\0\0\0\0\0"]
    length = rng.randint(1, 12)
    count: dict = {}
    for p in parts:
        for i in range(len(p) - length + 1):
            count[p[i : i + length]] = count.get(p[i : i + length], 0) + 1
    for p, hits in zip(parts, repeated(parts, length), strict=True):
        assert hits.tolist() == [count[p[i : i + length]] > 1 for i in range(len(p) - length + 1)]
