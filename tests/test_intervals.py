"""Look-up by key and interval, sketches, and tables that are replaced or read in parts."""

import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from ebbtide.operators import sketch
from ebbtide.operators.intervals import left_join_holding
from ebbtide.operators.stats import value_stats
from ebbtide.plans import detail
from ebbtide.sources import writers


def joined(rows, bands):
    return left_join_holding(rows, bands, ["k", "j"], F.col("at"), "lo", "hi", ["price"])


def plain(rows, bands):
    found = []
    for k, j, at in rows:
        own = [p for a, b, lo, hi, p in bands if None not in (k, j, at, lo, hi) and (a, b) == (k, j) and lo <= at <= hi]
        found += [(k, j, at, p) for p in own or [None]]
    return sorted(found, key=repr)


def test_against_plain_loops(spark):
    draw = random.Random(1)
    bands = []
    for k in ("a", "b", "c", None):
        for _ in range(40):
            lo = draw.choice([None, *range(100)])
            bands.append((k, draw.choice(["x", "y"]), lo, None if lo is None or draw.random() < 0.05 else lo + draw.choice([-1, 0, 1, 5, 60]), draw.random()))
    bands += [("a", "x", 5, 5, 1.0)] * 2
    rows = [(draw.choice(["a", "b", "c", "d", None]), draw.choice(["x", "y", None]), draw.choice([None, *range(-2, 170)])) for _ in range(500)]
    got = joined(spark.createDataFrame(rows, "k string, j string, at int"), spark.createDataFrame(bands, "k string, j string, lo int, hi int, price double"))
    assert sorted(map(tuple, got.collect()), key=repr) == plain(rows, bands)


def test_no_bands_and_no_rows(spark):
    rows = spark.createDataFrame([("a", "x", 3)], "k string, j string, at int")
    bands = spark.createDataFrame([], "k string, j string, lo int, hi int, price double")
    assert [tuple(r) for r in joined(rows, bands).collect()] == [("a", "x", 3, None)]
    assert joined(rows.where("false"), bands).collect() == []


def rows_out(plan):
    """Rows that each join of an executed plan has put out."""
    found, todo = [], [plan]
    while todo:
        node = todo.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
            continue
        if node.nodeName().endswith("QueryStage"):
            todo.append(node.plan())
            continue
        if "Join" in node.nodeName():
            found.append(node.metrics().apply("numOutputRows").value())
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return found


def test_many_bands_of_one_key_multiply_nothing(spark):
    bands = spark.range(10_000).select(F.lit("a").alias("k"), F.lit("x").alias("j"), (F.col("id") * 10).cast("int").alias("lo"),
                                       (F.col("id") * 10 + 8).cast("int").alias("hi"), F.col("id").cast("double").alias("price"))
    rows = spark.range(3000).select(F.lit("a").alias("k"), F.lit("x").alias("j"), (F.col("id") * 33).cast("int").alias("at"))
    df = joined(rows, bands)
    got = {r["at"]: r["price"] for r in df.collect()}
    assert len(got) == 3000 and all(p == (at // 10 if at % 10 != 9 else None) for at, p in got.items())
    assert rows_out(df._jdf.queryExecution().executedPlan()) == [3000]


def test_price_is_joined_on_keys_alone(spark, folder):
    from ebbtide.sources import standin

    t = standin.Tables(spark, folder)
    rows = standin.members(t).withColumn("birth_date", F.to_date(F.lit("1970-01-01")))
    plan = detail.with_price(rows, standin.prices(t), standin.AS_OF)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join LeftOuter" in plan and "age_from" not in next(line for line in plan.splitlines() if "Join LeftOuter" in line)


# --- sketches ------------------------------------------------------------------------


@pytest.mark.parametrize("error", [0.01, 0.002])
def test_a_sketch_of_days_is_within_its_bound(spark, error):
    draw = random.Random(2)
    data = [(g, d, round(draw.lognormvariate(3 + g, 2), 2) or 0.01) for g in range(3) for d in range(30) for _ in range(draw.randrange(40))]
    data += [(3, 0, 7.5), (4, 0, -1.0), (4, 0, None), (5, 1, 3.0), (5, 2, 5.0)]
    df = spark.createDataFrame(data, "g int, day int, value double")
    days = sketch.sketches(df, ["g", "day"], "value", error)
    found = {r["g"]: r for r in sketch.statistics(sketch.merged(days, ["g"]), ["g"], error).collect()}
    exact = value_stats(df.groupBy("g", "value").agg(F.count("*").alias("n")), ["g"], "value", "n").collect()
    assert set(found) == {r["g"] for r in exact} == {0, 1, 2, 3, 5}
    for r in exact:
        own = found[r["g"]]
        assert abs(own["median"] - r["median"]) <= error * r["median"] * (1 + 1e-9)
        assert (own["mean"], own["lowest"], own["highest"], own["total"]) == (r["mean"], r["lowest"], r["highest"], r["total"])


# --- parts and buckets ---------------------------------------------------------------


def test_a_part_is_replaced_alone(spark, tmp_path):
    path = str(tmp_path / "out")
    writers.write_parts(spark.createDataFrame([("a", 1), ("b", 2)], "period string, n int"), path, "period")
    writers.write_parts(spark.createDataFrame([("b", 3), ("c", 4)], "period string, n int"), path, "period")
    assert sorted(tuple(r) for r in spark.read.parquet(path).select("period", "n").collect()) == [("a", 1), ("b", 3), ("c", 4)]


def test_a_branch_is_read_alone(spark, tmp_path):
    path = str(tmp_path / "branches")
    writers.write_parts(spark.createDataFrame([("n", 1, 2), ("s", 1, 3)], "branch string, kind int, v int"), path, ["branch", "kind"])
    one = spark.read.parquet(path).where("branch = 'n'")
    assert [r["v"] for r in one.collect()] == [2] and len(one.inputFiles()) >= 1
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(branch" in plan
    assert "DataFilters: []" in plan


def test_bucketed_tables_join_without_a_shuffle(spark, tmp_path):
    from ebbtide.plans.detail import FAMILY_KEY

    keys = "org string, company string, family string"
    listed = [("1", str(i % 3), str(i % 50)) for i in range(400)]
    writers.write_bucketed(spark.createDataFrame([(*k, i) for i, k in enumerate(listed)], f"{keys}, card int"), "laid_members", str(tmp_path / "m"), FAMILY_KEY, 4)
    writers.write_bucketed(spark.createDataFrame([(*k, 1) for k in set(listed)], f"{keys}, flag int"), "laid_families", str(tmp_path / "f"), FAMILY_KEY, 4)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.table("laid_members").join(spark.table("laid_families"), FAMILY_KEY).groupBy(*FAMILY_KEY).agg(F.count("*").alias("n"))
        assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString() and df.agg(F.sum("n")).first()[0] == 400
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        spark.sql("DROP TABLE laid_members")
        spark.sql("DROP TABLE laid_families")


def scans(plan, above=()):
    """Scans of a physical plan, each with the nodes above it."""
    children = [plan.children().apply(i) for i in range(plan.children().size())]
    if not children:
        yield plan.toString(), above
    for c in children:
        yield from scans(c, (plan.nodeName(), *above))


SETTINGS = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.requireAllClusterKeysForCoPartition": "false"}


@pytest.fixture
def plain_plans(spark):
    before = {k: spark.conf.get(k) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_a_laid_out_extract_shuffles_neither_members_nor_families(spark, folder, tmp_path, plain_plans):
    import __spark_entry__ as entry
    from ebbtide.plans.contracts import DIALECT_A
    from ebbtide.sources import standin
    from ebbtide.sources.layout import lay_out

    t = standin.Tables(spark, folder)
    names = "members families sellers reasons plans subcontracts contracts prices attendance payment_types receivables customers".split()
    plain = detail.Sources(**{n: getattr(standin, n)(t) for n in names}, events=standin.block_events(t, entry.FIRST_DAY, entry.LAST_DAY))
    laid = lay_out(plain, "laid", str(tmp_path), 4)
    try:
        period = entry.FIRST_DAY, entry.LAST_DAY, entry.AS_OF, DIALECT_A
        branch = replace(laid, members=laid.members.where("branch_code = '01'"))
        found = detail.extract(branch, *period)
        seen = []
        for scan, above in scans(found._jdf.queryExecution().executedPlan()):
            if "laid_" in scan:
                below = above[: next(i for i, n in enumerate(above) if "Join" in n)]
                assert not any("Exchange" in n for n in below), above
                seen.append("laid_members" in scan)
                assert not seen[-1] or "PartitionFilters: [isnotnull(branch_code" in scan
        assert sorted(seen) == [False, True]
        assert sorted(found.collect(), key=repr) == sorted(detail.extract(plain, *period).collect(), key=repr)
    finally:
        spark.sql("DROP TABLE IF EXISTS laid_members")
        spark.sql("DROP TABLE IF EXISTS laid_families")
