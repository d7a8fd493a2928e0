"""A key that holds a third of all rows."""

from collections import Counter
from datetime import date

import pytest
from pyspark.sql import functions as F

from ebbtide import schemas
from ebbtide.plans import blocks, churn, detail, goals, reports

ROWS = 30_000
SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "30k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "30k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture
def no_broadcast(spark):
    before = {k: spark.conf.get(k, None) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def filled(spark, schema, n, **columns):
    rows = spark.range(n, numPartitions=8).withColumn("deleted", F.lit(" "))
    blank = [f.name for f in schema if f.name not in columns and f.name != "deleted"]
    return schemas.conform(rows.select("id", "deleted", *[F.lit(None).alias(b) for b in blank], *[c.alias(n) for n, c in columns.items()]), schema)


def text(c, width):
    return F.format_string(f"%0{width}d", c)


def test_hot_plan_is_split(spark, no_broadcast):
    key = F.col("id")
    hot = F.when(key % 3 == 0, F.lit(0)).otherwise(key % 1000)
    ids = dict(org=F.lit("0001"), company=F.lit("0001"), family=text(key, 6), member_type=F.lit("00"))
    members = filled(
        spark, schemas.MEMBER, ROWS, **ids, plan_code=text(hot, 4), class_code=F.lit("1"),
        # What is left of the rows behind the first join has to fill the partitions.
        birth=F.date_format(F.date_add(F.lit("1950-01-01"), (F.pmod(F.xxhash64(key), F.lit(20000))).cast("int")), "yyyyMMdd"),
        joined=F.concat(F.lit("2000"), text(key % 12 + 1, 2), F.lit("01")), name=F.sha2(key.cast("string"), 256),
    )
    events = filled(
        spark, schemas.BLOCK_EVENT, ROWS, row_id=key, family_key=F.concat(F.lit("00010001"), text(key, 6)), member_type=F.lit("00"),
        event_type=F.lit("0"), event_date=F.lit("20240102"), reason_code=F.lit("R"),
    )
    plans = filled(spark, schemas.PLAN, 1000, code=text(key, 4), modality=F.lit(1))
    reasons = filled(spark, schemas.REASON, 1, code=F.lit("R"), description=F.lit("r"))
    latest = blocks.latest_blocks(events, date(2024, 1, 1), date(2024, 1, 31))
    rows = churn.churned(members, latest, plans, reasons, ["r"], date(2024, 2, 1))
    assert len(rows.collect()) == ROWS
    assert "skew=true" in rows._jdf.queryExecution().executedPlan().toString()


def test_hot_price_and_receivable_keys(spark, no_broadcast):
    key = F.col("id")
    due = filled(
        spark, schemas.RECEIVABLE, ROWS, row_id=key, customer=F.when(key % 3 == 0, "hot").otherwise(key.cast("string")),
        org=F.lit("o"), company=F.lit("c"), family=F.lit("f"), due=F.lit(date(2024, 1, 1)), issued=F.lit(date(2024, 1, 1)),
        occurrence=key.cast("string"),
    )
    got = detail.last_occurrences(due, date(2024, 2, 1))
    assert got.count() == 1 + ROWS * 2 // 3
    assert got.where("customer = 'hot'").first()["occurrence"] == str(ROWS - 3)


def test_hot_seller_is_added_up_before_the_join(spark, no_broadcast):
    key = F.col("id")
    proposals = spark.range(ROWS, numPartitions=8).select(
        F.when(key % 3 == 0, "1").otherwise((key % 500).cast("string")).alias("seller_code"), F.lit("N").alias("branch"),
        F.lit("ok").alias("status"), F.lit("p").alias("product"), F.lit("2024-01-30").cast("timestamp_ntz").alias("proposal_ts"),
        F.lit(1).alias("lives"),
    )
    teams = spark.range(500).select(key.cast("string").alias("seller_code"), F.concat(F.lit("t"), key % 7).alias("team"))
    found = goals.lives_by_team(proposals, teams, date(2024, 2, 1))
    want = Counter()
    for i in range(ROWS):
        want[f"t{(1 if i % 3 == 0 else i % 500) % 7}"] += 1
    assert {r["team"]: r["lives"] for r in found.collect()} == want
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.index("SortMergeJoin") < plan.index("partial_sum(lives", plan.index("SortMergeJoin"))


def test_one_branch_and_seller_hold_most_rows(spark, no_broadcast):
    key = F.col("id")
    rows = schemas.conform(
        spark.range(ROWS, numPartitions=8).select(
            F.when(key % 3 == 0, "small").otherwise("big").alias("branch"), F.lit("cancelled").alias("kind"),
            F.when(key % 3 == 1, "hot").otherwise(F.concat(F.lit("s"), key % 2000)).alias("seller_name"), (key % 90).cast("int").alias("age"),
            F.lit("3").alias("tenure_months"), (key % 7000 + 1).cast("string").alias("monthly_value"), F.lit("r").alias("reason"),
            F.lit("p").alias("plan"), F.lit("c").alias("plan_class"), F.lit("x").alias("payment_type"),
        ),
        schemas.CONTRACT_ROW,
    )
    got = reports.report(rows).where("branch = 'big'").collect()
    assert next(r["qty"] for r in got if r["section"] == "sellers" and r["ord"] == 1) == ROWS // 3
    values = sorted(i % 7000 + 1 for i in range(ROWS) if i % 3)
    middle = (values[len(values) // 2 - 1] + values[len(values) // 2]) / 2
    assert next(r["amount"] for r in got if r["section"] == "value" and r["ord"] == 2) == middle
