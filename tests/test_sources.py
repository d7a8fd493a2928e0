"""Readers and writers."""

from datetime import datetime

from ebbtide import schemas
from ebbtide.sources import readers, writers


def test_lead_csv(spark, tmp_path):
    file = tmp_path / "leads.csv"
    file.write_bytes(
        "lead_id;Estágio;created;closed;expected_revenue;place\n"
        "1;Negociação;05/03/2024;06/03/2024 10:30:00;10,5;São Paulo\n"
        "2;Ganho;31/02/2024;01/01/2024 25:00;x;\n".encode("latin-1")
    )
    raw = readers.lead_csv
    other = [f.name for f in schemas.LEAD if f.name not in "lead_id stage created closed expected_revenue place".split()]
    header, *lines = file.read_bytes().split(b"\n")
    file.write_bytes(b"\n".join([header + b"".join(b";" + o.encode() for o in other)] + [l + b";" * len(other) for l in lines if l]))
    a, b = raw(spark, str(file), {"Estágio": "stage"}).orderBy("lead_id").collect()
    assert (a["lead_id"], a["stage"], a["place"], a["expected_revenue"]) == (1, "Negociação", "São Paulo", "10,5")
    assert (a["created"], a["closed"]) == (datetime(2024, 3, 5), datetime(2024, 3, 6, 10, 30))
    assert (b["created"], b["closed"], b["place"]) == (None, None, None)


def test_first_columns_of_a_sheet(spark, tmp_path):
    (tmp_path / "s.csv").write_text("a,b,c\n1,2,3\n")
    assert readers.dimension_csv(spark, str(tmp_path / "s.csv"), columns=2).columns == ["a", "b"]


def test_csv_with_decimal_comma(spark, tmp_path):
    df = spark.createDataFrame([(1, 2.5, "x;y")], "i int, score double, t string")
    writers.write_csv(df.coalesce(1), str(tmp_path / "out"))
    (part,) = (tmp_path / "out").glob("*.csv")
    assert part.read_text(encoding="utf-8") == 'i;score;t\n1;2,5;"x;y"\n'


def test_one_folder_per_part(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "report string, n int")
    writers.write_parts(df, str(tmp_path / "out"), "report")
    assert {p.name for p in (tmp_path / "out").glob("report=*")} == {"report=a", "report=b"}
    back = spark.read.parquet(str(tmp_path / "out")).where("report = 'a'")
    assert [r["n"] for r in back.collect()] == [1]


def test_parquet_is_checked(spark, tmp_path):
    spark.createDataFrame([("1", "x", " ", "extra")], "code string, name string, deleted string, more string").write.parquet(str(tmp_path / "s"))
    assert readers.parquet(spark, str(tmp_path / "s"), schemas.SELLER).columns == ["code", "name", "deleted"]


def test_scores_are_ranked(spark):
    df = spark.createDataFrame([(2, 5.0), (1, 5.0), (3, 9.0)], "lead_id int, score double")
    assert [r["lead_id"] for r in writers.ranked(df).collect()] == [3, 1, 2]
