import hashlib
from collections import Counter

from pyspark.sql import functions as F

from premia.llm import exact
from premia.llm.common import shared_folder


def test_classes(spark, docs, corpus):
    got = exact.deduplicate(docs).collect()
    texts = Counter(r[1] or "" for r in corpus)
    keep = {}
    for i, t, *_ in corpus:
        keep[t or ""] = max([x for x in (keep.get(t or ""), i) if x is not None], default=None)
    expected = sorted((str(i), str(keep[t or ""]), texts[t or ""], hashlib.sha256((t or "").encode()).hexdigest()) for i, t, *_ in corpus)
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.text_sha256) for r in got) == expected
    assert sum(r.kept for r in got) == len(texts)


def test_empty_table(empty):
    assert exact.deduplicate(empty).count() == 0


def test_state_goes_on(spark, docs):
    state = shared_folder(spark, "state")
    first = exact.ingest(exact.digests(exact.located(docs.filter("doc_id < 120"))), state)
    assert first.agg(F.sum("copies")).first()[0] == docs.filter("doc_id < 120").count()
    both = exact.ingest(exact.digests(exact.located(docs.filter("doc_id >= 120"))), state)
    assert both.agg(F.sum("copies")).first()[0] == docs.filter("doc_id is not null").count()
    assert both.agg(F.max("copies")).first()[0] == 41


def test_texts_that_share_a_digest_are_told_apart(docs):
    rows = exact.collisions(exact.located(docs.filter("doc_id between 50 and 139")), F.lit(b"same")).collect()
    assert len(rows) == docs.filter("doc_id between 50 and 139").count()
    assert sorted(r.copies for r in rows)[-40:] == [40] * 40
