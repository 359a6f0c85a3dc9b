from datetime import date as D

import pytest

from premia.operators import inflation
from premia.sources import readers
from tests.conftest import rows

SERIES = [("2021", "1", "1.0"), ("2021", "2", "2.0"), ("2021", "5", "-1.0"), ("2021", "6", None), ("2021", "5", "-3"), ("x", "1", "9"), ("2022", "13", "")]


@pytest.fixture
def index(frame):
    return inflation.price_index(frame(SERIES, "annee string, mois string, taux_mensuel_pct string"))


def test_index_is_the_product_of_the_rates(index):
    got = {r["month"] - 2021 * 12: r["index"] for r in index.collect()}
    assert got == {0: pytest.approx(1.01), 1: pytest.approx(1.01 * 1.02), 4: pytest.approx(1.01 * 1.02 * 0.99)}


def test_gaps_take_the_last_known_value(index):
    got = [r["index"] for r in inflation.filled(index).orderBy("month").collect()]
    assert got == pytest.approx([1.01, 1.0302, 1.0302, 1.0302, 1.0302 * 0.99])


def test_amounts_in_constant_money(frame, index):
    days = [D(2020, 12, 31), D(2021, 1, 1), D(2021, 4, 30), D(2021, 5, 1), D(2030, 1, 1), None]
    df = frame([(i, day, 100.0) for i, day in enumerate(days)] + [(9, D(2021, 1, 1), None)], "claim_id int, date_sinistre date, montant_declare double")
    last = 1.0302 * 0.99
    got = dict(rows(inflation.constant_money(df, index).select("claim_id", "montant_constant")))
    assert got == {0: None, 1: round(100 * last / 1.01, 2), 2: 99.0, 3: 100.0, 4: 100.0, 5: None, 9: None}
    in_2021 = dict(rows(inflation.constant_money(df, index, base="2021-01-15").select("claim_id", "montant_constant")))
    assert in_2021[1] == 100.0 and in_2021[2] == round(100 * 1.01 / 1.0302, 2)


def test_a_series_from_a_file_and_an_empty_one(spark, frame, tmp_path):
    (tmp_path / "r.csv").write_text("annee,mois,taux_annuel_pct,taux_mensuel_pct,source\n2021,1,1.6,0.102,b\n2021,2,1.6,,b\n")
    index = inflation.price_index(readers.read_inflation(spark, f"{tmp_path}/r.csv"))
    assert rows(index) == [(2021 * 12, pytest.approx(1.00102))]
    df = frame([(1, D(2021, 1, 1), 5.0)], "claim_id int, date_sinistre date, montant_declare double")
    none = inflation.price_index(frame([], "annee string, mois string, taux_mensuel_pct string"))
    assert rows(inflation.constant_money(df, none).select("montant_constant")) == [(None,)]


def test_the_join_is_by_equality_of_months(frame, index):
    df = frame([(1, D(2021, 1, 1), 5.0)], "claim_id int, date_sinistre date, montant_declare double")
    plan = inflation.constant_money(df, index)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
