"""Reports on a few handmade rows."""

import pytest

from ebbtide import schemas
from ebbtide.plans import reports

ROWS = [
    # branch, kind, seller, age, tenure, value, reason, plan, class, payment
    ("N", "cancelled", "ann  ", -3, "0", "10", "r1", "p1", "c1", "boleto"),
    ("N", "cancelled", " ann", 9, "6", "20", "r1", "p1", "c1", "card"),
    ("N", "cancelled", "bob", 10, "7", "-5", "r2", "p2", "c2", None),
    ("N", "cancelled", None, 70, "x", "bad", None, "p2", None, "card"),
    ("N", "reactivated", "bob", None, "25", None, "r1", "p1", "c1", "card"),
    ("S", "cancelled", "cid", 33, "13", "7.5", "r1", "p1", "c1", "card"),
]


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(ROWS, schemas.CONTRACT_ROW)


def listed(df, branch="N", kind="cancelled", **where):
    out = [r for r in df.collect() if r["branch"] == branch and r["kind"] == kind]
    out = [r for r in out if all(r[k] == v for k, v in where.items())]
    return [(r["label"], r["qty"], r["pct_text"]) for r in sorted(out, key=lambda r: r["ord"])]


def test_age_section(rows):
    got = listed(reports.section(rows, "age"))
    assert got[0] == ("0 a 9", 2, "50.0%")
    assert got[1] == ("10 a 19", 1, "25.0%")
    assert got[-2:] == [("70+", 1, "25.0%"), (" TOTAL GERAL", 4, "100.0%")]
    assert len(got) == 9


def test_unknown_tenure_counts_as_zero(rows):
    got = listed(reports.section(rows, "tenure"))
    assert [q for _, q, _ in got] == [3, 1, 0, 0, 4]


def test_all_ages_missing_gives_zeros_without_percentages(rows):
    got = listed(reports.section(rows, "age"), kind="reactivated")
    assert [(q, p) for _, q, p in got[:-1]] == [(0, None)] * 8


def test_reason_percentages_leave_out_null(rows):
    assert listed(reports.section(rows, "reason")) == [
        ("r1", 2, "66.7%"),
        ("r2", 1, "33.3%"),
        (" TOTAL GERAL", 3, "100.0%"),
    ]


def test_sellers_are_shares_of_all_rows(rows):
    assert listed(reports.section(rows, "sellers")) == [("ann", 2, "50.0%"), ("bob", 1, "25.0%")]


def test_plans_and_payments(rows):
    assert listed(reports.section(rows, "plan")) == [("p1", 2, "50.0%"), ("p2", 2, "50.0%")]
    assert listed(reports.section(rows, "payment")) == [("card", 2, "66.7%"), ("boleto", 1, "33.3%")]


def test_kpis_use_all_values(rows):
    got = {(r["branch"], r["kind"]): r for r in reports.kpis(rows).collect()}
    first = got["N", "cancelled"]
    assert (first["qty"], first["mean_age"], first["revenue"]) == (4, 22.25, 25.0)
    assert (first["qty_text"], first["age_text"], first["revenue_text"]) == ("4", "22 anos", "R$ 25,00")
    assert got["N", "reactivated"]["revenue_text"] == "R$ 0,00"


def test_stats_use_positive_values(rows):
    got = [r for r in reports.stats(rows).orderBy("ord").collect() if r["branch"] == "N"]
    assert [r["amount"] for r in got] == [15.0, 15.0, 10.0, 20.0, 30.0]
    assert got[0]["amount_text"] == "R$ 15.00" and got[4]["label"] == "Receita Perdida (Mensal)"
    assert {r["kind"] for r in got} == {"cancelled"}  # none where no value is positive


def test_long_report_equals_its_sections(rows):
    whole = reports.report(rows).cache()
    columns = ["branch", "kind", "section", "ord", "label", "qty", "pct", "pct_text", "bar", "is_total"]
    for name in reports.SECTIONS:
        kinds = [k for k, names in reports.CONTENT.items() if name in names]
        own = reports.section(rows, name)
        want = sorted(tuple(r) for r in own.where(own["kind"].isin(kinds)).select(columns).collect())
        assert sorted(tuple(r) for r in whole.where(f"section = '{name}'").select(columns).collect()) == want
    assert whole.where("section = 'kpi'").count() == 4 * 3
    assert [r["amount"] for r in whole.where("section = 'value' and branch = 'N'").orderBy("ord").collect()] == [
        15.0,
        15.0,
        10.0,
        20.0,
        30.0,
    ]
    whole.unpersist()


def test_section_left_out_for_a_branch(rows):
    got = reports.report(rows, without=[("S", "class"), ("S", "age")]).collect()
    sections = {r["section"] for r in got if r["branch"] == "S"}
    assert not {"class", "age"} & sections and "tenure" in sections


def test_missing_column_is_an_error(spark):
    with pytest.raises(ValueError, match="branch"):
        schemas.conform(spark.range(1), schemas.CONTRACT_ROW)
