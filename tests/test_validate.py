from datetime import datetime

import pytest
from pyspark.sql import types as T

from premia.operators import validate
from tests.conftest import rows

SCHEMA = (
    "claim_id string, policy_id string, client_id string, type_sinistre string, date_sinistre string, "
    "date_declaration string, montant_declare double, statut string"
)
GOOD = ("c1", "p1", "k1", "vol", "2024-01-01", "2024-01-02", 10.0, "ouvert")


def changed(**kw):
    names = [p.split()[0] for p in SCHEMA.split(", ")]
    return tuple(kw.get(n, v) for n, v in zip(names, GOOD, strict=True))


def test_split(frame):
    data = [
        GOOD,
        changed(claim_id="c2", statut="bogus"),
        changed(claim_id="c3", montant_declare=0.0),
        changed(claim_id="c4", montant_declare=float("nan")),
        changed(claim_id="c5", policy_id=None, statut=None),
    ]
    df = frame(data, SCHEMA)
    valid, rejected = validate.split_rows(df, validate.rules_for("claims"), "b7", datetime(2024, 1, 1))
    assert rows(valid) == [GOOD]
    got = {r["claim_id"]: (r["_rejection_rules"], r["_rejection_reason"], r["_batch_id"]) for r in rejected.collect()}
    assert {k: v[0] for k, v in got.items()} == {
        "c2": ["statut_not_allowed"],
        "c3": ["montant_declare_not_positive"],
        "c4": ["montant_declare_not_positive"],
        "c5": ["policy_id_missing", "statut_missing", "statut_not_allowed"],
    }
    assert got["c2"][1:] == ("schema_validation_failed", "b7")
    assert rows(validate.volumetry(df, validate.rules_for("claims"))) == [(5, 1, 4)]


def test_missing_column_and_unknown_entity(frame):
    df = frame([GOOD], SCHEMA).drop("statut", "client_id")
    with pytest.raises(validate.SchemaError, match=r"\['client_id', 'statut'\]"):
        validate.split_rows(df, validate.rules_for("claims"), "b", datetime(2024, 1, 1))
    with pytest.raises(ValueError):
        validate.rules_for("boats")


def test_compare_schema(frame):
    df = frame([(1, "x")], "a int, b string")
    expected = T.StructType([T.StructField("a", T.LongType()), T.StructField("c", T.StringType())])
    assert validate.compare_schema(df, expected) == [
        "missing column: c", "unexpected column: b", "wrong type: a is int, not bigint",
    ]
    assert validate.compare_schema(df, df.schema) == []
    with pytest.raises(validate.SchemaError):
        validate.require_schema(df, expected, "t")
