"""Lead features, outcomes and score tables."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide import fixed_values as fv
from ebbtide.functions import bands, decode, text
from ebbtide.functions.numbers import comma_number, round_even
from ebbtide.operators.ranking import hash_place

CATEGORICAL = ["channel_norm", "place_norm", "team_type", "day_part"]
NUMERIC = [
    "hour",
    "weekday",
    "weekend",
    "month",
    "days_in_funnel",
    "revenue",
    "has_revenue",
    "has_email",
    "has_campaign",
    "days_to_close",
    "hours_to_close",
]
# Known only once a lead is closed.
LEAKY = ["days_to_close", "hours_to_close"]


def features(leads: DataFrame) -> DataFrame:
    """Leads with outcome flags and model features; a projection without a shuffle.

    What several features use is a column of its own, so that it is parsed once.
    """
    won = F.coalesce(F.col("stage") == fv.WON_STAGE, F.lit(False))
    lost = text.filled(F.col("loss_reason")) | F.coalesce(F.col("stage").isin(fv.LOST_STAGES), F.lit(False))
    weekday = F.weekday("created")
    parsed = {
        "_hour": F.hour(F.try_to_timestamp(F.col("created_time"), F.lit("H:m:s"))),
        "_revenue": F.coalesce(comma_number(F.col("expected_revenue")), F.lit(0.0)),
    }
    hour, revenue = F.col("_hour"), F.col("_revenue")
    whole_days = F.extract(F.lit("DAY"), F.col("closed") - F.col("created"))
    return leads.withColumns(parsed).select(
        *[c for c in leads.columns if c != "hours_to_close"],
        (won | lost).alias("decided"),
        won.cast("int").alias("target"),
        F.coalesce(F.col("stage").isin(fv.OPEN_STAGES), F.lit(False)).alias("open"),
        hour.alias("hour"),
        F.coalesce(bands.DAY_PART.label(hour), F.lit(fv.MISSING_CATEGORY)).alias("day_part"),
        weekday.alias("weekday"),
        F.coalesce(weekday >= 5, F.lit(False)).cast("int").alias("weekend"),
        F.month("created").alias("month"),
        F.coalesce(comma_number(F.col("days")), F.lit(0.0)).alias("days_in_funnel"),
        revenue.alias("revenue"),
        (revenue > 0).cast("int").alias("has_revenue"),
        text.filled(F.col("email")).cast("int").alias("has_email"),
        decode.channel(F.col("channel")).alias("channel_norm"),
        F.lower(text.strip(F.coalesce("place", F.lit(fv.PLACE_UNKNOWN)))).alias("place_norm"),
        decode.team_type(F.col("sales_team")).alias("team_type"),
        text.filled(F.col("campaign")).cast("int").alias("has_campaign"),
        F.when(whole_days.isNull(), -1).otherwise(F.greatest(whole_days, F.lit(0))).cast("int").alias("days_to_close"),
        F.coalesce(comma_number(F.col("hours_to_close")), F.lit(-1.0)).alias("hours_to_close"),
    )


def outcome() -> Column:
    """Class of a lead: won, lost, or NULL where it is not decided."""
    return F.when(F.col("decided"), F.col("target"))


def split(rows: DataFrame, test_percent: int = 20) -> DataFrame:
    """Mark the hold-out rows: of each class the first ones in the order of md5(lead_id), its exact share."""
    placed = hash_place(rows, outcome(), F.col("lead_id"))
    test = F.col("_place") * 100 < F.col("_whole") * test_percent
    return placed.withColumn("is_test", test).drop("_place", "_whole")


def folded(rows: DataFrame, name: str, group: Column, folds: int, salt: str = "") -> DataFrame:
    """Rows with a fold, dealt in turn within each class in the order of md5(salt and lead_id)."""
    placed = hash_place(rows, group, F.concat(F.lit(salt), F.col("lead_id").cast("string")))
    return placed.withColumn(name, (F.col("_place") % folds).cast("int")).drop("_place", "_whole")


def dealt(rows: DataFrame, folds: int, inner_folds: int = 1, test_percent: int = 20, tie: str | None = None) -> DataFrame:
    """Hold-out mark, fold of all rows and fold of those outside the hold-out, from one order.

    `is_test` and `fold` are those of `split` and `folded`; `inner_fold` goes on dealing behind the
    hold-out rows, which come first in the order, and is NULL for them.
    """
    placed = hash_place(rows, outcome(), F.col("lead_id"), tie)
    place, whole = F.col("_place"), F.col("_whole")
    tests = F.ceil(whole * test_percent / 100)
    marks = {
        "is_test": place * 100 < whole * test_percent,
        "fold": (place % folds).cast("int"),
        "inner_fold": F.when(place >= tests, ((place - tests) % inner_folds).cast("int")),
    }
    return placed.withColumns(marks).drop("_place", "_whole")


def class_balance(rows: DataFrame) -> DataFrame:
    """Decided leads by outcome, the weight of a won one, and the open leads."""
    won = F.count_if(F.col("decided") & (F.col("target") == 1))
    lost = F.count_if(F.col("decided") & (F.col("target") == 0))
    return rows.agg(
        F.count("*").alias("leads"),
        F.count_if("decided").alias("decided"),
        won.alias("won"),
        lost.alias("lost"),
        F.count_if("open").alias("open_leads"),
        F.count_if(F.col("open") & F.col("decided")).alias("open_and_decided"),
        F.try_divide(lost.cast("double"), won).alias("weight"),
    )


def stage_counts(leads: DataFrame) -> DataFrame:
    return leads.where(F.col("stage").isNotNull()).groupBy("stage").agg(F.count("*").alias("n"))


CARRIED = [
    "lead_id",
    "contact",
    "seller",
    "stage",
    "channel",
    "place",
    "sales_team",
    "created",
    "expected_revenue",
    "campaign",
]


def score_table(rows: DataFrame, probability: str) -> DataFrame:
    """Carried columns with score, probability and score band."""
    score = round_even(F.col(probability) * 100, 1)
    return rows.select(
        *CARRIED,
        score.alias("score"),
        round_even(F.col(probability), 4).alias("probability"),
        bands.SCORE.label(score).alias("score_band"),
    )


def band_counts(scores: DataFrame) -> DataFrame:
    return scores.groupBy("score_band").agg(F.count("*").alias("n"))


def with_scores(leads: DataFrame, scores: DataFrame) -> DataFrame:
    """Leads with the looked-up score, its text and colour; leads without one show a dash."""
    looked_up = scores.select("lead_id", "score")
    return leads.join(looked_up, "lead_id", "left").withColumns(
        {"score_text": text.score_text(F.col("score")), "score_colour": bands.score_colour(F.col("score"))}
    )
