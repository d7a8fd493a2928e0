"""Targets, tilts and copies against plain arithmetic."""

import math
import random
import time

import pytest
from cases import table
from pyspark.sql import functions as F

from ebbtide.llm import mixing
from ebbtide.llm.batches import written


def plain_targets(sizes, weights=(1, 2, 3), most=3):
    names = sorted((n for n in sizes if n is not None)) + ([None] if None in sizes else [])
    weight = {n: weights[i % len(weights)] for i, n in enumerate(names)}
    total, stopped = sum(sizes.values()), set()
    while True:
        rest = [n for n in names if n not in stopped]
        if not rest:
            return {n: most * sizes[n] for n in names}
        level = (total - sum(most * sizes[n] for n in stopped)) / sum(weight[n] for n in rest)
        over = {n for n in rest if weight[n] * level > most * sizes[n]}
        if not over:
            return {n: most * sizes[n] if n in stopped else weight[n] * level for n in names}
        stopped |= over


def corpus(seed, n=900):
    draw = random.Random(seed)
    sources = ["hot"] * 6 + ["b", "a", "é", "Z", None, "tiny"]
    rows = []
    for i in range(n):
        s = draw.choice(sources) if i % 40 else "tiny"
        rows.append((i, "w " * int(draw.lognormvariate(3, 1)), "en", s if s != "tiny" or i % 40 == 0 else "b"))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_targets_and_copies(spark, seed):
    rows = corpus(seed)
    found = mixing.mixed(table(spark, rows)).collect()
    assert len(found) == len(rows)
    size = {i: len(t.split()) for i, t, _, _ in rows}
    source = {i: s for i, _, _, s in rows}
    sums = {}
    for i in size:
        sums[source[i]] = sums.get(source[i], 0) + size[i]
    goal = plain_targets(sums)
    taken = dict.fromkeys(sums, 0)
    for r in found:
        assert r["size"] == size[r["doc_id"]] and r["source_size"] == sums[source[r["doc_id"]]]
        assert r["target"] == pytest.approx(goal[source[r["doc_id"]]], rel=1e-9)
        assert 0 <= r["copies"] <= 3 and r["taken"] == r["copies"] * r["size"]
        taken[source[r["doc_id"]]] += r["taken"]
    for s in sums:
        assert abs(taken[s] - goal[s]) <= max(3, 0.01 * goal[s]), s
    again = mixing.mixed(table(spark, rows)).collect()
    assert sorted(again) == sorted(found)


def test_tilts_solve_the_dual(spark):
    rows = corpus(3)
    docs = table(spark, rows).select("doc_id", mixing.words(F.col("text")).alias("size"), "source")
    goals = mixing.targets(docs.groupBy("source").agg(F.sum("size").alias("source_size")), (1, 2, 3), 3)
    want = {r["source"]: r for r in goals.collect()}
    tilt = {r["source"]: r for r in mixing.tilts(docs, goals, 3.0).collect()}
    for s, w in want.items():
        if w["target"] >= 3 * w["source_size"] * (1 - 1e-12):
            continue
        sizes = [len(t.split()) for _, t, _, x in rows if x == s]
        got = sum(n * 3 / (1 + 2 * math.exp(-tilt[s]["tilt"] * n / tilt[s]["scale"])) for n in sizes if n)
        assert got == pytest.approx(w["target"], rel=1e-5)


def test_extremes(spark):
    words = lambda n: "w " * n
    rows = [(1, words(10), "en", "a"), (2, words(1000), "en", "b"), (3, None, "en", "c"), (4, "", "en", None), (5, words(1), "en", "d")]
    found = {r["doc_id"]: r for r in mixing.mixed(table(spark, rows)).collect()}
    assert found[1]["target"] == 30 and found[1]["taken"] == 30
    assert found[3]["taken"] == found[3]["target"] == 0 and found[3]["size"] == 0
    assert all(r["taken"] <= 3 * r["size"] for r in found.values())


def test_one_long_document_among_short_ones(spark):
    words = lambda n: "w " * n
    rows = [(0, words(10_000), "en", "a"), *[(i, words(100), "en", "a") for i in range(1, 201)], *[(i, words(90), "en", "b") for i in range(201, 701)]]
    found = mixing.mixed(table(spark, rows)).collect()
    for low, high, target in ((0, 200, 25_000), (201, 700, 50_000)):
        own = [r for r in found if low <= r["doc_id"] <= high]
        assert own[0]["target"] == pytest.approx(target) and abs(sum(r["taken"] for r in own) - target) < 100
    assert all(0 <= r["copies"] <= 3 for r in found)


def test_settling_takes_all_sizes(spark):
    sizes = [700] * 3 + [60] * 50 + [7] * 100 + [1] * 5
    schema = "row long, _id long, doc_id long, _row long, target double, group string, draw long, copies long, size long"
    for target in (20_000, 14_321, 300, 0):
        rows = [(i, 0, i, 1, float(target), "g", i * 7919 % 101, 1, n) for i, n in enumerate(sizes)]
        found = mixing.settled(table(spark, rows, schema), 3).collect()
        assert all(0 <= r["copies"] <= 3 for r in found) and len(found) == len(rows)
        # 300 comes to 301: all documents of one word are given up by then.
        assert abs(sum(r["copies"] * r["size"] for r in found) - min(target, 3 * sum(sizes))) <= 1


def test_one_source_of_equal_documents(spark):
    rows = [(i, "five words are in here", "en", "only") for i in range(500)]
    found = mixing.mixed(table(spark, rows)).collect()
    assert sum(r["taken"] for r in found) == 2500 and {r["target"] for r in found} == {2500.0}


def test_running_sums(spark):
    draw = random.Random(9)
    rows = [(draw.choice("ab"), draw.randint(0, 50), i) for i in range(400)]
    summed = mixing.running(table(spark, rows, "g string, v long, i long"), "g", ["v", "i"], F.col("v"), "s")
    for r in summed.collect():
        assert r["s"] == sum(v for g, v, i in rows if g == r["g"] and (v, i) < (r["v"], r["i"]))


def test_no_python_on_the_way(spark):
    plan = mixing.mixed(table(spark, corpus(1, 50)))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def plain_settling(sizes, rest, most):
    """One more copy of each document, the largest first, while it fits; then another one."""
    taken = dict.fromkeys(sizes, 0)
    for _ in range(most):
        for size in sorted(sizes, reverse=True):
            k = min(sizes[size], rest // size)
            taken[size] += k
            rest -= k * size
    return taken


@pytest.mark.parametrize("rest", [0, 1, 777, 99_999, 5_000_000])
def test_settling_against_a_plain_loop(spark, rest):
    draw = random.Random(rest)
    sizes = {s: draw.randint(1, 4) for s in draw.sample(range(1, 3000), 400)}
    rows = [(s, 1.0 * rest) for s, n in sizes.items() for _ in range(n)]
    df = spark.createDataFrame(rows, "size long, target double").withColumns(
        {"row": F.monotonically_increasing_id(), "copies": F.lit(0).cast("long"), "group": F.lit("g"), "draw": F.xxhash64("size")}
    )
    found = mixing.settled(written(df), 3).groupBy("size").agg(F.sum("copies").alias("n")).collect()
    assert {r["size"]: r["n"] for r in found} == plain_settling(sizes, rest, 3)


def test_many_sizes_in_one_source(spark):
    df = spark.range(1, 100_001).select(
        F.col("id").alias("size"), F.lit(2_000_000_000.0).alias("target"), F.col("id").alias("row"), F.lit(0).cast("long").alias("copies"),
        F.lit("g").alias("group"), F.xxhash64("id").alias("draw"),
    )
    started = time.monotonic()
    taken = mixing.settled(written(df), 3).agg(F.sum(F.col("copies") * F.col("size"))).first()[0]
    assert taken == 2_000_000_000 and time.monotonic() - started < 60


def test_no_tilt_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(mixing, "STEPS", 1)
    with pytest.raises(ArithmeticError):
        mixing.mixed(table(spark, corpus(1, 200)))
