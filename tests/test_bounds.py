"""Values and keys at the edge of what the plans are made for."""

import pytest
from pyspark.sql import functions as F

from ebbtide import schemas
from ebbtide.functions import numbers
from ebbtide.operators.latest import last_n
from ebbtide.operators.stats import rank_sum_auc
from ebbtide.plans import reports
from ebbtide.sources import readers, writers


def test_no_number_is_infinite(column):
    assert column(["1e400", "-1e400", "1e308", " 2.5 ", "NaN"], "string", numbers.to_number) == [None, None, 1e308, 2.5, None]


def test_amounts(column):
    assert column([1e25, -1e16, 1.23456789, 2.0, None], "double", numbers.amount) == [None, None, 1.234568, 2.0, None]


def test_plain_numbers(column):
    values = [12345678.9, 0.0004, 2.5, 1e7, 1.0, -3.25e-9, 1e22, 0.0, 123456789012345680.0, None]
    wanted = ["12345678.9", "0.0004", "2.5", "10000000.0", "1.0", "-0.00000000325", "1" + "0" * 22 + ".0", "0.0", "123456789012345680.0", None]
    assert column(values, "double", writers.plain_number) == wanted


def test_csv_round_trip(spark, tmp_path):
    rows = [(1, 12345678.9, 0.0004), (2, 2.5, None), (3, -1e-9, 1e15)]
    writers.write_csv(spark.createDataFrame(rows, "id int, revenue double, p double"), str(tmp_path / "out"))
    read = spark.read.csv(str(tmp_path / "out"), header=True, sep=";")
    assert not [r for r in read.collect() if "E" in str(r)[3:].replace("Row", "")]
    back = read.select(F.col("id").cast("int"), *[numbers.comma_number(F.col(c)).alias(c) for c in ("revenue", "p")])
    assert sorted(map(tuple, back.collect())) == rows


def lead_file(path, ids):
    names = [f.name for f in schemas.LEAD]
    lines = [";".join(names), *[";".join([i] + [""] * (len(names) - 1)) for i in ids]]
    path.write_text("\n".join(lines) + "\n", encoding="latin-1")
    return str(path)


def test_lead_ids_are_exact(spark, tmp_path):
    file = lead_file(tmp_path / "leads.csv", ["9007199254740993", " 17 ", "18,0", "19.00", "-3"])
    assert [r["lead_id"] for r in readers.lead_csv(spark, file).collect()] == [9007199254740993, 17, 18, 19, -3]


@pytest.mark.parametrize("bad", ["A-17", "1,5", "99999999999999999999"])
def test_other_lead_ids_end_the_job(spark, tmp_path, bad):
    with pytest.raises(Exception, match="no lead id"):
        readers.lead_csv(spark, lead_file(tmp_path / "leads.csv", ["1", bad])).collect()


def contract_rows(spark, rows):
    names = [f.name for f in schemas.CONTRACT_ROW]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schemas.CONTRACT_ROW)


FULL = dict(
    kind="cancelled", seller_name="S", age=30, tenure_months="12", monthly_value="10", reason="r", plan="p", plan_class="c", payment_type="x"
)


def test_a_null_branch_has_every_section(spark):
    rows = contract_rows(spark, [FULL, {**FULL, "branch": "B"}, {**FULL, "branch": "B"}])
    found = reports.report(rows, without=[("B", "class")]).collect()
    sections = {b: {r["section"] for r in found if r["branch"] == b} for b in (None, "B")}
    assert sections[None] == sections["B"] | {"class"} and {"sellers", "value", "kpi", "class"} <= sections[None]
    assert {r["amount"] for r in found if r["branch"] is None and r["section"] == "value"} == {10.0}


def test_values_that_are_no_amounts_count_nowhere(spark):
    odd = [{**FULL, "branch": "B", "monthly_value": v} for v in ("1e25", "1e400", "10", "20", "", None)]
    rows = contract_rows(spark, odd)
    got = {r["label"]: r["amount"] for r in reports.stats(rows).collect()}
    assert sorted(got.values()) == [10.0, 15.0, 15.0, 20.0, 30.0]
    assert [tuple(r) for r in reports.rejected(rows).collect()] == [("B", "cancelled", 2)]


def test_auc_of_large_ties(spark):
    ties = spark.range(1).select(F.lit(4_000_000_000).alias("n"))
    product = ties.select((F.col("n").cast("decimal(19,0)") * (2 * F.col("n").cast("decimal(19,0)"))).alias("w")).first()[0]
    assert int(product) == 32 * 10**18
    scored = spark.range(40_000).select((F.col("id") % 3).cast("double").alias("p"), (F.col("id") % 2).cast("int").alias("y"))
    assert rank_sum_auc(scored, "p", "y").first()["auc"] == pytest.approx(0.5, abs=1e-3)


@pytest.mark.parametrize("n", [1, 2, 3])
def test_last_rows_of_null_groups_and_repeated_numbers(spark, n):
    rows = [(None, i) for i in range(5)] + [("a", 1)] * 3 + [("b", i) for i in range(10)] + [("b", 8), ("c", None)]
    df = spark.createDataFrame(rows, "folder string, uid long")
    found = sorted((str(r["folder"]), r["uid"] or -1) for r in last_n(df, "folder", "uid", n, slots=4).collect())
    wanted = []
    for folder in (None, "a", "b", "c"):
        wanted += sorted(((str(f), -1 if u is None else u) for f, u in rows if f == folder), reverse=True)[:n]
    assert found == sorted(wanted)
