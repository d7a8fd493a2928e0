"""Mixing sources to target weights by entropy balancing, with DataFrame functions only.

Of all document rates between 0 and `most` that give each source its target of words, those
closest to one copy each (in the entropy of a bounded rate) are
`most / (1 + (most - 1) * exp(-tilt * size))`: tilted exponentially in the document's size, with
one tilt for each source. The tilts solve a convex dual, here by Newton steps; a step is one
aggregation of the size histogram by source. Rates become copies by systematic rounding along
the sizes of a source, which keeps its words within a document or two of the target.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.llm.batches import keyed, row_key, written
from ebbtide.operators.lineage import cut

# ASCII white space, as characters and as a pattern.
SPACE, SPACES = " \t\n\x0b\x0c\r", r"[\x20\x09-\x0D]+"
# At most so many Newton steps, and words off target, as a share of it, that end them.
STEPS, CLOSE = 60, 1e-6
# What settling takes of the documents of one size.
NOTHING, EVERY, SOME = range(3)


def words(text: Column) -> Column:
    """How many words a text has; none if it is null."""
    inner = F.btrim(text, F.lit(SPACE))
    return F.when(F.length(inner) > 0, F.size(F.split(inner, SPACES))).otherwise(0).cast("long")


def running(df: DataFrame, group: str, order: Sequence[str], value: Column, name: str) -> DataFrame:
    """`df` with the sum of `value` over the earlier rows of the same `group` (never null) in this order.

    Rows are dealt into sorted ranges and written; the sums of whole ranges are added up first,
    then those inside each range, so neither a group nor the order is ever in one task.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.withColumn("_v", value).repartitionByRange(n, group, *order).withColumn("_range", F.spark_partition_id())
    dealt = written(dealt)
    totals = dealt.groupBy(group, "_range").agg(F.sum("_v").alias("_t"))
    ranges = Window.partitionBy(group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(group, "_range", F.coalesce(F.sum("_t").over(ranges), F.lit(0)).alias("_start"))
    inside = Window.partitionBy(group, "_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    sums = dealt.withColumn(name, F.coalesce(F.sum("_v").over(inside), F.lit(0))).join(starts, [group, "_range"])
    return sums.withColumn(name, F.col(name) + F.col("_start")).drop("_v", "_range", "_start")


def targets(sizes: DataFrame, weights: Sequence[float], most: float) -> DataFrame:
    """`source`, `source_size` and `target` from `source` and `source_size`, one row a source.

    Sources in the order of their code points, null last, take `weights` in turn and share all
    sizes by them; a target stops at `most` times its source's size, and what is over is shared
    again by weight among the others, until none is above.
    """
    by_name = F.when(F.col("source").isNull(), 1).otherwise(0)
    placed = sizes.select("source", "source_size", by_name.alias("last"), F.coalesce("source", F.lit("")).alias("name"), F.lit(0).alias("all"))
    ranked = running(placed, "all", ["last", "name"], F.lit(1), "place")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    rows = cut(ranked.select("source", "source_size", weight.alias("weight"), (F.col("source_size") * float(most)).alias("top")))
    total = rows.agg(F.sum("source_size")).first()[0] or 0
    level, stopped = 0.0, -1
    while True:
        # Of sources that the level stops, the top counts; the rest shares by weight.
        over = F.col("weight") * level >= F.col("top")
        n, fixed, share = rows.agg(
            F.count_if(over & (F.lit(level) > 0)), F.sum(F.when(over & (F.lit(level) > 0), F.col("top"))), F.sum(F.when(~over | (F.lit(level) <= 0), F.col("weight")))
        ).first()
        if n == stopped or not share:
            break
        level, stopped = (total - (fixed or 0.0)) / share, n
    return rows.select("source", "source_size", F.least(F.col("weight") * level, F.col("top")).alias("target"))


def tilts(docs: DataFrame, goals: DataFrame, most: float) -> DataFrame:
    """`source`, `tilt`, `scale` (mean size): Newton steps on the dual of each source, kept inside a bracket."""
    cells = cut(docs.where("size > 0").groupBy("source", "size").agg(F.count("*").alias("n")))
    means = cells.groupBy("source").agg((F.sum(F.col("size") * F.col("n")) / F.sum("n")).alias("scale"))
    state = goals.where("source_size > 0").join(means, goals["source"].eqNullSafe(means["source"])).select(
        goals["source"], "target", "scale", F.lit(0.0).alias("tilt"), F.lit(None).cast("double").alias("lo"), F.lit(None).cast("double").alias("hi"),
        (F.col("target") >= F.col("source_size") * most * (1 - 1e-12)).alias("done"),
    )
    state = cut(state)
    for _ in range(STEPS):
        live = state.where("not done")
        if live.isEmpty():
            break
        x = F.col("size") / F.col("scale")
        rate = F.lit(most) / (1 + (most - 1) * F.exp(-F.col("tilt") * x))
        wide = cells.join(live.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")))
        slope = F.col("n") * F.col("size") * x * rate * (1 - rate / most)
        sums = wide.groupBy("s").agg(F.sum(F.col("n") * F.col("size") * rate).alias("got"), F.sum(slope).alias("slope"))
        off = F.col("got") - F.col("target")
        stepped = live.join(sums, live["source"].eqNullSafe(sums["s"])).select(
            "source", "target", "scale", "tilt", "got", "slope",
            F.when(off < 0, F.col("tilt")).otherwise(F.col("lo")).alias("lo"),
            F.when(off > 0, F.col("tilt")).otherwise(F.col("hi")).alias("hi"),
        )
        newton = F.col("tilt") - off / F.col("slope")
        outside = (F.col("slope") <= 0) | newton.isNull() | (newton <= F.col("lo")) | (newton >= F.col("hi"))
        # Without a bracket yet, a step is at most doubling; with one, halving it is always right.
        bound = 1 + 2 * F.abs("tilt")
        inside = F.when(F.col("lo").isNull(), F.col("hi") - bound).when(F.col("hi").isNull(), F.col("lo") + bound).otherwise((F.col("lo") + F.col("hi")) / 2)
        careful = F.when(F.col("lo").isNull(), F.greatest(newton, F.col("hi") - bound)).when(F.col("hi").isNull(), F.least(newton, F.col("lo") + bound)).otherwise(newton)
        done = F.abs(off) <= CLOSE * F.col("target")
        moved = stepped.withColumn("next", F.when(done, F.col("tilt")).when(F.coalesce(outside, F.lit(False)), inside).otherwise(careful))
        same = F.col("next") == F.col("tilt")
        moved = moved.select("source", "target", "scale", F.col("next").alias("tilt"), "lo", "hi", (done | same).alias("done"))
        state = cut(state.where("done").unionByName(moved))
    else:
        if not state.where("not done").isEmpty():
            raise ArithmeticError(f"no tilt found in {STEPS} Newton steps")
    return state.select("source", "tilt", "scale")


def mixed(docs: DataFrame, *args, **names) -> DataFrame:
    """`documents_mixed` without its row keys."""
    return documents_mixed(docs, *args, **names).drop("_id", "_row")


def documents_mixed(
    docs: DataFrame,
    weights: Sequence[float] = (1, 2, 3),
    most: int = 3,
    id_col: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """Per row: row key, `doc_id`, `size`, `source_size`, `target` (of its source), `copies`, `taken` = copies * size.

    `size` counts words between ASCII white space (null: 0). Targets: see `targets`. Copies are
    0 to `most`. A source with a target of `most` times its size is taken `most` times; a null
    source is a source. Texts without words have one copy, which takes nothing. Rounding goes
    along size, a hash of the id, and the id; rows equal in all of these are interchangeable, so
    reruns agree. Further columns are left out; an empty table gives an empty one.
    """
    rows = written(
        docs.select(*row_key(id_col, text), F.col(id_col).cast("long").alias("doc_id"), words(F.col(text)).alias("size"), F.col(source).cast("string").alias("source"))
        .withColumn("row", F.monotonically_increasing_id())
    )
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    goals = cut(targets(cut(sizes), weights, most))
    tilt = tilts(rows, goals, float(most)).withColumnRenamed("source", "t")
    found = goals.join(tilt, F.col("source").eqNullSafe(F.col("t")), "left").select(F.col("source").alias("s"), "source_size", "target", "tilt", "scale")
    found = written(found)
    full = F.col("target") >= F.col("source_size") * most * (1 - 1e-12)
    rate = F.lit(float(most)) / (1 + (most - 1) * F.exp(-F.col("tilt") * F.col("size") / F.col("scale")))
    rate = F.when(F.col("size") == 0, 1.0).when(full, float(most)).otherwise(rate)
    known = rows.join(found, F.col("source").eqNullSafe(F.col("s"))).withColumn("rate", rate)
    # Exact sums need whole numbers: parts of a copy in units of 2^-40.
    unit = 1 << 40
    part = F.round((F.col("rate") - F.floor("rate")) * unit).cast("long")
    known = known.select(
        "row", "_id", "_row", "doc_id", "size", "source_size", "target", F.floor("rate").alias("whole"), part.alias("part"),
        F.to_json(F.struct("source")).alias("group"), F.xxhash64("doc_id").alias("draw"),
    )
    summed = running(known, "group", ["size", "draw", "doc_id"], F.col("part").cast("decimal(38,0)"), "before")
    half = F.lit(unit // 2).cast("decimal(38,0)")
    upto = F.col("before") + F.col("part") + half
    extra = F.floor(upto / unit) - F.floor((F.col("before") + half) / unit)
    copies = (F.col("whole") + extra).cast("long")
    rounded = written(summed.select("row", "_id", "_row", "doc_id", "size", "source_size", "target", "group", "draw", copies.alias("copies")))
    return settled(rounded, most).select(
        "_id", "_row", "doc_id", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken")
    )


def mixed_rows(docs: DataFrame, weights: Sequence[float] = (1, 2, 3), most: int = 3, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `docs` that the mix takes, with all columns and `_copies`; see `documents_mixed`.

    Repeated rows are alike and have the larger number of their copies.
    """
    found = documents_mixed(docs, weights, most, id_col, text).groupBy("_id", "_row").agg(F.max("copies").alias("_copies"))
    return keyed(docs, id_col, text).join(found.where("_copies > 0"), ["_id", "_row"]).select("_all.*", "_copies")


def settled(rounded: DataFrame, most: int) -> DataFrame:
    """`rounded` with copies more or less, so that no further copy comes nearer to a target.

    What rounding left over is used up by single copies of all documents of a source: one copy
    of each first, the largest documents first. How many of each size are taken is found on the
    histogram of sizes; which ones, by running sums.
    """
    off = rounded.groupBy("group").agg((F.first("target") - F.sum(F.col("copies") * F.col("size"))).alias("off"))
    room = F.when(F.col("off") > 0, most - F.col("copies")).otherwise(F.col("copies"))
    near = rounded.select("row", "size", "group", "draw", "copies").join(written(off), "group")
    near = near.where((F.col("size") > 0) & (F.col("size") <= F.abs("off")) & (room > 0))
    steps = near.withColumn("layer", F.explode(F.sequence(F.lit(1).cast("long"), room)))
    cells = steps.groupBy("group", "layer", "size").agg(F.count("*").alias("n"), F.first("off").alias("off"))
    own = F.sort_array(F.collect_list(F.struct("layer", (-F.col("size")).alias("down"), "n")))
    lists = cells.groupBy("group").agg(F.first("off").alias("off"), own.alias("own"))
    none = F.array().cast("array<struct<layer:long,down:long,kind:int,k:long>>")
    start = F.struct(F.abs("off").alias("rest"), F.lit(NOTHING).alias("kind"), none.alias("turns"))

    def take(state: Column, cell: Column) -> Column:
        size = -cell["down"]
        k = F.least(cell["n"], F.floor(state["rest"] / size))
        kind = F.when(k == 0, NOTHING).when(k == cell["n"], EVERY).otherwise(SOME)
        turn = F.struct(cell["layer"].alias("layer"), cell["down"].alias("down"), kind.alias("kind"), k.alias("k"))
        # Only where the kind turns is anything kept. What is left is less than half after a cell of
        # which some are taken, so turns are few however many sizes there are.
        turns = F.when((kind != state["kind"]) | (kind == SOME), F.array_append(state["turns"], turn)).otherwise(state["turns"])
        return F.struct((state["rest"] - k * size).alias("rest"), kind.alias("kind"), turns.alias("turns"))

    ends = lists.select("group", F.signum("off").cast("long").alias("change"), F.aggregate("own", start, take)["turns"].alias("turns"))
    own_place = F.struct(F.col("layer"), (-F.col("size")).alias("down"))
    passed = F.filter("turns", lambda t: F.struct(t["layer"], t["down"]) <= own_place)
    last = F.get(passed, F.size(passed) - 1)
    taken = cells.join(written(ends), "group").select("group", "change", "layer", "size", "n", last.alias("_last"))
    k = F.when(F.col("_last.kind") == EVERY, F.col("n")).when(F.col("_last.kind") == SOME, F.col("_last.k"))
    taken = written(taken.withColumn("k", k).where("k > 0").drop("_last"))
    moved = steps.select("row", "draw", "group", "layer", "size").join(taken, ["group", "layer", "size"])
    some = moved.where("k < n").withColumn("cell", F.concat_ws(" ", "layer", "size", "group"))
    first = running(some, "cell", ["draw", "row"], F.lit(1), "place").where("place < k")
    both = moved.where("k = n").select("row", "change").unionByName(first.select("row", "change"))
    changes = written(both.groupBy("row").agg(F.sum("change").alias("change")))
    return rounded.join(changes, "row", "left").withColumn("copies", F.col("copies") + F.coalesce("change", F.lit(0)))
