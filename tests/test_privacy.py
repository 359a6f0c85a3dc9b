import base64
import hashlib
import hmac

import pytest
from pyspark.sql import functions as F

from premia.operators import privacy
from tests.conftest import rows

KEY = b"a key that only a test may know"


@pytest.mark.parametrize("key", [KEY, b"", b"k" * 64, b"long" * 40, bytes(range(256))[:63]])
def test_hmac_equals_the_standard_one(frame, key):
    df = frame([("a", 1), ("é", None), (None, 3), ("", 4)], "x string, y int")
    want = [tuple(None if v is None else hmac.new(key, str(v).encode(), hashlib.sha256).hexdigest() for v in r) for r in [("a", 1), ("é", None), (None, 3), ("", 4)]]
    assert sorted(rows(privacy.pseudonymise(df, ["x", "y"], key)), key=repr) == sorted(want, key=repr)


def test_the_key_may_come_from_a_protected_file(spark, frame, tmp_path):
    privacy.key_frame(spark, KEY).write.parquet(f"{tmp_path}/key")
    got = privacy.pseudonymise(frame([("a",)], "x string"), ["x"], spark.read.parquet(f"{tmp_path}/key"))
    assert rows(got) == [(hmac.new(KEY, b"a", hashlib.sha256).hexdigest(),)]


def forms(key: bytes) -> list[str]:
    """How a key, or one of its padded forms, may be written."""
    block = key.ljust(64, b"\0")
    blocks = [key, *[bytes(b ^ mask for b in block) for mask in (0x36, 0x5C)]]
    return [f for b in blocks for f in (b.hex(), b.hex().upper(), base64.b64encode(b).decode()[:20], " ".join(map(str, b[:8])), ", ".join(map(str, b[:8])), b.decode("latin-1"))]


def test_no_plan_shows_the_key(spark, frame):
    df = privacy.pseudonymise(frame([("a",)], "x string").withColumn("y", F.lit(1)), ["x", "y"], KEY)
    before = df._jdf.queryExecution().toString()
    df.collect()
    execution = df._jdf.queryExecution()
    texts = [before, execution.toString(), execution.optimizedPlan().toString(), execution.executedPlan().toString()]
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(10_000)
    listed = spark._jsparkSession.sharedState().statusStore().executionsList()
    texts += [listed.apply(i).physicalPlanDescription() for i in range(listed.size())]  # what the event log and the web page have
    for text in texts:
        assert not [f for f in forms(KEY) if f in text]
    assert any("subquery" in t.lower() for t in texts[:2])


def test_erasing_keeps_rows_without_a_key(frame):
    df = frame([(1, "a"), (2, None), (3, "b"), (4, None)], "i int, client_id string")
    gone = frame([("a",), (None,), ("a",)], "client_id string")
    assert rows(privacy.erase(df, gone).select("i")) == [(2,), (3,), (4,)]
    assert privacy.erase(df, gone).columns == ["client_id", "i"]
