"""Goals of a small sales force."""

from datetime import date, datetime

import pytest

from ebbtide import schemas
from ebbtide.plans import goals

AS_OF = date(2024, 3, 5)


def proposal(seller, lives, ts=datetime(2024, 3, 1), branch="  norte ", status="ok", product="p"):
    return (seller, branch, status, product, ts, lives)


@pytest.fixture(scope="module")
def proposals(spark):
    rows = [
        proposal("1", 3),
        proposal("1.0", 2, datetime(2024, 2, 26)),
        proposal("1", 100, datetime(2024, 2, 25, 23)),  # before the cycle
        proposal("1", 100, datetime(2024, 3, 5, 10)),  # later on the last day
        proposal("1", 1, datetime(2024, 3, 5)),
        proposal("2", 5, branch="NORTE"),
        proposal("2", 50, status="no"),
        proposal("2", 50, product="q"),
        proposal(None, 7),
        proposal("9", 8),  # not listed
    ]
    return spark.createDataFrame(rows, schemas.PROPOSAL)


@pytest.fixture(scope="module")
def sellers(spark):
    rows = [("000001", "red"), ("2", "blue"), ("2", "green"), (None, "grey"), ("x", "grey"), ("3", None)]
    return spark.createDataFrame(rows, schemas.SELLER_TEAM)


def lives(proposals, sellers, **options):
    found = goals.lives_by_team(proposals, sellers, AS_OF, "ok", "p", "Norte", **options)
    return {r["team"]: r["lives"] for r in found.collect()}


def test_lives(proposals, sellers):
    assert lives(proposals, sellers) == {"red": 6, "blue": 5, "green": 5}


def test_null_codes_match_if_wanted(proposals, sellers):
    assert lives(proposals, sellers, null_safe=True) == {"red": 6, "blue": 5, "green": 5, "grey": 14}


def test_latest_goals(spark):
    rows = [
        ("Norte", "red", "jan/2024", 90.0),
        ("Norte", "red", "fev/2024", 10.0),
        ("Norte", "red", "2024-02-20", 2.0),
        ("Norte", "blue", "??", 5.0),
        ("Sul", "red", "dez/2023", 4.0),
        ("Sul", None, "dez/2023", 4.0),
    ]
    df = spark.createDataFrame(rows, schemas.GOAL)
    got = {(r["branch"], r["team"]): r["goal"] for r in goals.latest_goals(df).collect()}
    assert got == {("Norte", "red"): 12.0, ("Sul", "red"): 4.0}
    assert goals.latest_goals(df, "Sul").count() == 1


@pytest.fixture(scope="module")
def result(spark):
    lives = spark.createDataFrame([("F", "a", 2), ("F", "b", 5), ("F", "c", 0), ("F", "d", 9)], "branch string, team string, lives bigint")
    goal = spark.createDataFrame([("F", "a", 3.0), ("F", "b", 0.0), ("F", "c", 0.0), ("F", "idle", 6.0)], "branch string, team string, goal double")
    return lives, goal


def test_attainment(result):
    got = {r["team"]: r["pct"] for r in goals.attainment(*result).collect()}
    assert got == {"a": 66.7, "b": None, "c": 0.0, "d": 0.0}
    kept = {r["team"]: (r["lives"], r["pct"]) for r in goals.attainment(*result, keep_idle_teams=True).collect()}
    assert kept["idle"] == (0, 0.0)


def test_message(result):
    got = {r["team"]: r for r in goals.message(goals.attainment(*result)).collect()}
    assert (got["a"]["attained"], got["a"]["progress"]) == ("66.7%", "faltam 1 vidas para alcançar a meta")
    assert (got["b"]["attained"], got["b"]["bar"]) == ("—", "⬜" * 10 + " 0%")
    assert (got["d"]["goal_text"], got["d"]["progress"]) == ("—", "sem meta definida")
    total = got["TOTAL GERAL"]
    assert (total["lives_text"], total["goal_text"], total["reached"]) == ("16", "3", True)
    assert total["progress"] == "✅ Meta batida! Superou em 13 vida(s)" and total["attained"] == "533.3%"


def test_diagnosis(proposals, sellers):
    got = goals.seller_diagnosis(proposals, sellers, AS_OF, "ok", "p", "Norte").collect()
    one = [r for r in got if r["seller_code"] == "000001"]
    assert [(r["proposals"], r["in_cycle"], r["listings"], r["branch_ok"]) for r in one] == [(5, 3, 1, True)]
    two = {(r["branch"], r["status"], r["product"]): (r["branch_ok"], r["status_ok"], r["product_ok"]) for r in got if r["seller_code"] == "000002"}
    assert two["  norte ", "no", "p"] == (True, False, True) and two["NORTE", "ok", "p"] == (True, True, True)
    assert {r["seller_code"]: r["listings"] for r in got}["000009"] == 0
