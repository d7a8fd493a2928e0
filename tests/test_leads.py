"""Lead features and scoring."""

import hashlib
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from ebbtide import schemas
from ebbtide.plans import leads, scoring

NAMES = [f.name for f in schemas.LEAD]


def make(spark, *rows):
    full = [tuple({"lead_id": i, **r}.get(n) for n in NAMES) for i, r in enumerate(rows)]
    return spark.createDataFrame(full, schemas.LEAD)


def test_outcomes(spark):
    df = make(
        spark,
        dict(stage="Ganho", loss_reason="x"),
        dict(stage="Negociação", loss_reason="x"),
        dict(stage="Negociação", loss_reason=""),
        dict(stage="Desistiu"),
        dict(),
    )
    got = [(r["decided"], r["target"], r["open"]) for r in leads.features(df).orderBy("lead_id").collect()]
    assert got == [(True, 1, False), (True, 0, True), (False, 0, True), (True, 0, False), (False, 0, False)]


def test_features(spark):
    df = make(
        spark,
        dict(
            created=datetime(2024, 3, 2, 12), closed=datetime(2024, 3, 4, 11), created_time="06:30:00", days="4",
            expected_revenue="10,5", hours_to_close="7,25", channel="Offline", place="  São Paulo ", email="a", campaign="",
        ),
        dict(created=datetime(2024, 3, 4), closed=datetime(2024, 3, 1), created_time="25:00:00", expected_revenue="1.234,5", days="x"),
        dict(),
    )
    a, b, c = leads.features(df).orderBy("lead_id").collect()
    assert (a["days_to_close"], b["days_to_close"], c["days_to_close"]) == (1, 0, -1)
    assert (a["day_part"], b["day_part"], b["hour"]) == ("madrugada", "nan", None)
    assert (a["weekday"], a["weekend"], a["month"], c["weekday"], c["weekend"]) == (5, 1, 3, None, 0)
    assert (a["revenue"], a["has_revenue"], b["revenue"], b["has_revenue"]) == (10.5, 1, 0.0, 0)
    assert (a["days_in_funnel"], b["days_in_funnel"]) == (4.0, 0.0)
    assert (a["hours_to_close"], b["hours_to_close"]) == (7.25, -1.0)
    assert (a["channel_norm"], c["channel_norm"], a["place_norm"], c["place_norm"]) == ("offline", "outro", "são paulo", "desconhecida")
    assert (a["has_email"], a["has_campaign"], c["has_email"]) == (1, 0, 0)


def test_no_decided_lead_is_an_error(spark):
    with pytest.raises(ValueError, match="won or lost"):
        scoring.check_classes(leads.features(make(spark, dict(stage="Negociação"))))


def test_one_class_only_warns(spark):
    with pytest.warns(UserWarning, match="one class"):
        assert scoring.check_classes(leads.features(make(spark, dict(stage="Ganho")))) == 1.0


def test_split_is_exact_in_each_class_and_repeatable(spark):
    won = F.col("lead_id") % 31 == 0
    rows = spark.range(5000).select(F.col("id").alias("lead_id"), (F.col("id") % 7 != 0).alias("decided"), won.cast("int").alias("target"))
    first = {r["lead_id"]: r for r in leads.folded(leads.split(rows), "fold", leads.outcome(), 5).collect()}
    again = {r["lead_id"]: r for r in leads.folded(leads.split(rows.repartition(7)), "fold", leads.outcome(), 5).collect()}
    assert first == again and len(first) == 5000
    for group in ((True, 1), (True, 0), (False, None)):
        own = [r for r in first.values() if r["decided"] == group[0] and group[1] in (None, r["target"])]
        assert sum(r["is_test"] for r in own) == -(-len(own) * 20 // 100)
        sizes = [sum(r["fold"] == f for r in own) for f in range(5)]
        assert max(sizes) - min(sizes) <= 1
    by_hash = sorted((hashlib.md5(str(i).encode()).hexdigest(), i) for i, r in first.items() if r["decided"] and r["target"])
    test = {i for _, i in by_hash[: sum(first[i]["is_test"] for _, i in by_hash)]}
    assert test == {i for _, i in by_hash if first[i]["is_test"]}


def test_one_order_gives_hold_out_and_both_folds(spark):
    rows = spark.range(3000).select(F.col("id").alias("lead_id"), (F.col("id") % 7 != 0).alias("decided"), (F.col("id") % 31 == 0).cast("int").alias("target"))
    both = leads.folded(leads.split(rows), "fold", leads.outcome(), 5).select("lead_id", "is_test", "fold")
    one = leads.dealt(rows, 5, 3)
    assert sorted(one.select("lead_id", "is_test", "fold").collect()) == sorted(both.collect())
    listed = one.where("decided").collect()
    assert all(r["is_test"] == (r["inner_fold"] is None) for r in listed)
    for y in (0, 1):
        sizes = [sum(r["inner_fold"] == f and r["target"] == y for r in listed) for f in range(3)]
        assert max(sizes) - min(sizes) <= 1


def test_score_lookup(spark):
    rows = make(spark, dict(), dict())
    scores = leads.score_table(rows.where("lead_id = 0").withColumn("p", F.lit(0.755)), "p")
    assert [tuple(r) for r in scores.select("score", "probability", "score_band").collect()] == [(75.5, 0.755, "Hot (76-100)")]
    got = leads.with_scores(rows, scores).orderBy("lead_id").collect()
    assert [r["score_text"] for r in got] == ["75.5 pts", "—"]
    assert [r["score_colour"] for r in got] == ["#378ADD", "#D85A30"]
