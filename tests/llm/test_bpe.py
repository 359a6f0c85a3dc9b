import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from premia.llm import bpe

PATH = public_tokenizers.path(bpe.VOCABULARY)


@pytest.fixture(scope="module")
def coder():
    return bpe.coder(PATH, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library(coder):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=coder.ranks, special_tokens={})


def test_random_texts(coder, library):
    rng = random.Random(1)
    letters = "aabcdeeeenrstthh  \n\t'.,!0123äßéñç漢字\U0001f600́  \x1c\x85​　"
    for _ in range(3000):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 60)))
        assert coder.encode(text) == library.encode_ordinary(text)


def test_long_pieces(coder, library):
    for text in ("a" * 5000, " " * 3000 + "x", "ab" * 4000, "é" * 2000, "the" * 3000, "0" * 3000, "!?" * 2000):
        assert coder.encode(text) == library.encode_ordinary(text)


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(codec="utf-8"), max_size=40))
def test_any_text(text):
    c = bpe.coder(PATH, public_tokenizers.PATTERN)
    lib = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=c.ranks, special_tokens={})
    ids = c.encode(text)
    assert ids == lib.encode_ordinary(text)
    assert c.decode(ids) == (text.encode(), 0)
    assert "".join(c.chunks([i] for i in ids)) == text


def test_tables_that_start_anew(coder, library, monkeypatch):
    monkeypatch.setattr(bpe, "MOVES", 50)
    monkeypatch.setattr(bpe, "PIECES", 3)
    fresh = bpe.Coder(PATH, public_tokenizers.PATTERN)
    text = "Ein längerer Text, with words of several languages, y otras cosas además. " * 3
    assert fresh.encode(text) == library.encode_ordinary(text)


def test_utf8_machine_against_the_codec():
    rng = random.Random(2)
    for _ in range(20000):
        data = bytes(rng.choice((rng.randrange(256), rng.randrange(0x80, 0xC0), 0xE0, 0xED, 0xF0, 0xF4, 65)) for _ in range(rng.randint(1, 5)))
        try:
            data.decode()
            fine = True
        except UnicodeDecodeError:
            fine = False
        assert (bpe.Coder.through(0, data) == 0) == fine


def test_invalid_streams(coder):
    half = coder.ranks["é".encode()[:1]]
    assert coder.decode([half])[1] == 1
    assert coder.decode([half, half])[1] == 8
    with pytest.raises(ValueError):
        list(coder.chunks([[half]]))


def test_documents(docs, corpus, library, empty):
    got = bpe.encode_documents(docs).collect()
    want = []
    for i, t, *_ in corpus:
        ids = library.encode_ordinary(t or "")
        want.append((str(i), len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == sorted(want)
    assert bpe.encode_documents(empty).count() == 0


def test_columns_of_ids(docs, library):
    rows = docs.filter("doc_id < 20").select("text", bpe.encoded(F.col("text"), PATH).alias("ids"))
    rows = rows.select("text", "ids", bpe.decoded(F.col("ids"), PATH).alias("back"))
    for r in rows.collect():
        assert r.ids == library.encode_ordinary(r.text) and bytes(r.back.data).decode() == r.text and r.back.valid
