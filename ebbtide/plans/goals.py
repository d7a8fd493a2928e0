"""Sales goals by team over the 26th-to-25th cycle."""

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide import fixed_values as fv
from ebbtide.functions import text
from ebbtide.functions.dates import cycle_start, month_start
from ebbtide.functions.numbers import percent


def latest_goals(goals: DataFrame, branch: str | None = None) -> DataFrame:
    """Goal by branch and team in the latest month for which the branch has goals."""
    if branch is not None:
        goals = goals.where(F.col("branch") == branch)
    dated = goals.withColumn("_month", month_start(F.col("month")))
    latest = dated.groupBy("branch").agg(F.max("_month").alias("_month"))
    return (
        dated.where(F.col("team").isNotNull())
        .join(latest, ["branch", "_month"])
        .groupBy("branch", "team")
        .agg(F.sum("goal").alias("goal"))
    )


def cycle_proposals(
    proposals: DataFrame,
    as_of: date,
    status: str | None = None,
    product: str | None = None,
    branch: str | None = None,
) -> DataFrame:
    """Proposals of the running cycle, with clean branch names and seller codes.

    The upper bound is midnight at the start of the day itself.
    """
    stamp = F.col("proposal_ts")
    start = F.lit(cycle_start(as_of)).cast("timestamp_ntz")
    out = proposals.where(stamp.between(start, F.lit(as_of).cast("timestamp_ntz")))
    if status is not None:
        out = out.where(F.col("status") == status)
    if product is not None:
        out = out.where(F.col("product") == product)
    out = out.withColumn("branch", text.title_case(F.col("branch")))
    if branch is not None:
        out = out.where(F.col("branch") == branch)
    return out.withColumn("seller_code", text.seller_code(F.col("seller_code")))


def lives_by_team(
    proposals: DataFrame,
    seller_teams: DataFrame,
    as_of: date,
    status: str | None = None,
    product: str | None = None,
    branch: str | None = None,
    null_safe: bool = False,
) -> DataFrame:
    """Lives by branch and team. A seller listed twice counts twice.

    Lives are added up by seller before the join. `null_safe` lets missing seller
    codes match missing ones.
    """
    sold = (
        cycle_proposals(proposals, as_of, status, product, branch)
        .groupBy("branch", "seller_code")
        .agg(F.sum("lives").alias("lives"))
    )
    teams = seller_teams.select(text.seller_code(F.col("seller_code")).alias("_code"), "team")
    code = F.col("seller_code")
    match = code.eqNullSafe(F.col("_code")) if null_safe else code == F.col("_code")
    # Sellers without a team drop out, so an inner join on those with one is enough.
    return (
        sold.join(teams.where(F.col("team").isNotNull()), match)
        .groupBy("branch", "team")
        .agg(F.sum("lives").alias("lives"))
    )


def attainment(lives: DataFrame, goals: DataFrame, keep_idle_teams: bool = False) -> DataFrame:
    """Lives against goal. No goal gives 0 %, sales against a goal of 0 give NULL."""
    joined = lives.join(goals, ["branch", "team"], "full" if keep_idle_teams else "left")
    if keep_idle_teams:
        joined = joined.withColumn("lives", F.coalesce("lives", F.lit(0)))
    endless = (F.col("goal") == 0) & (F.col("lives") > 0)
    share = F.coalesce(percent(F.col("lives"), F.col("goal")), F.lit(0.0))
    return joined.select("branch", "team", "lives", "goal", F.when(~F.coalesce(endless, F.lit(False)), share).alias("pct"))


def message(result: DataFrame) -> DataFrame:
    """Text rows of the goal message: the total of a branch, then its teams.

    `reached` tells on the total row whether the branch's goal is reached.
    """
    totals = result.groupBy("branch").agg(
        F.sum("lives").alias("lives"), F.coalesce(F.floor(F.sum("goal")), F.lit(0)).cast("double").alias("goal")
    )
    ratio = F.when(F.col("goal") > 0, F.col("lives") / F.col("goal") * 100)
    total_rows = totals.select(
        "branch",
        F.lit(0).alias("ord"),
        F.lit(fv.TOTAL_TEAM).alias("team"),
        "lives",
        "goal",
        ratio.alias("shown"),
        (F.col("lives") >= F.col("goal")).alias("reached"),
    )
    team_rows = result.select(
        "branch",
        F.lit(1).alias("ord"),
        "team",
        "lives",
        "goal",
        F.col("pct").alias("shown"),
        F.lit(None).cast("boolean").alias("reached"),
    )
    lives, goal = F.col("lives").cast("double"), F.col("goal")
    return total_rows.unionByName(team_rows).select(
        "branch",
        "ord",
        "team",
        text.count_text(lives).alias("lives_text"),
        text.count_text(goal).alias("goal_text"),
        text.progress_phrase(goal, lives).alias("progress"),
        text.attainment_text(F.col("shown")).alias("attained"),
        text.progress_bar(F.when(goal > 0, lives / goal * 100).otherwise(F.lit(0.0))).alias("bar"),
        "reached",
    )


def seller_diagnosis(
    proposals: DataFrame, seller_teams: DataFrame, as_of: date, status: str, product: str, branch: str
) -> DataFrame:
    """Why a seller's proposals do or do not count, for all sellers at once.

    One row per seller and distinct (branch, status, product), with the number of raw
    proposals, those of the cycle, which filter passes, and whether the seller is
    listed with a team.
    """
    stamp = F.col("proposal_ts")
    start = F.lit(cycle_start(as_of)).cast("timestamp_ntz")
    in_cycle = stamp.between(start, F.lit(as_of).cast("timestamp_ntz"))
    found = (
        proposals.withColumn("seller_code", text.seller_code(F.col("seller_code")))
        .groupBy("seller_code", "branch", "status", "product")
        .agg(F.count("*").alias("proposals"), F.count_if(in_cycle).alias("in_cycle"))
    )
    listed = (
        seller_teams.groupBy(text.seller_code(F.col("seller_code")).alias("seller_code"))
        .agg(F.count("*").alias("listings"))
        .where(F.col("seller_code").isNotNull())
    )
    return found.join(listed, "seller_code", "left").select(
        *found.columns,
        F.coalesce("listings", F.lit(0)).alias("listings"),
        F.coalesce(text.title_case(F.col("branch")) == branch, F.lit(False)).alias("branch_ok"),
        F.coalesce(F.col("status") == status, F.lit(False)).alias("status_ok"),
        F.coalesce(F.col("product") == product, F.lit(False)).alias("product_ok"),
    )
