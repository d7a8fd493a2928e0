"""

Each query reads the tables of a folder, projects the domain tables from them
(`ebbtide.sources.standin`) and runs a plan of the library over all rows.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Callable
from datetime import date
from importlib.util import find_spec
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

sys.path.insert(0, str(Path(__file__).resolve().parent))

from ebbtide import schemas
from ebbtide.functions import dates
from ebbtide.functions.dates import monthly_cycles, semesters
from ebbtide.functions.html import html_text
from ebbtide.functions.numbers import comma_number, round_even
from ebbtide.operators import stats
from ebbtide.operators.lineage import checkpoint_dir, spread
from ebbtide.operators.permutation import permuted
from ebbtide.plans import blocks, churn, contracts, detail, goals, leads, mail, reports, scoring
from ebbtide.sources import readers, standin, writers
from ebbtide.sources.standin import AS_OF, Tables
from oracles import sql

# The training-data operators are a part of their own; the rest works without it.
found = find_spec("ebbtide.llm")
if found and found.origin and find_spec("corpus_pipeline"):
    import corpus_pipeline
    from ebbtide.llm import queries as llm
else:
    corpus_pipeline = llm = None

Query = Callable[[SparkSession, str], DataFrame]

FIRST_DAY, LAST_DAY = dates.parse_bound("19950101"), dates.parse_bound("01/08/2001")
CYCLES = monthly_cycles(date(1995, 1, 1), 80)
REVERSIBLE = [f"NATION_{n}" for n in (1, 3, 4, 7, 9, 12, 18, 22)]
GOAL_FILTERS = {"status": "O", "product": "1-URGENT"}
SKETCHED = date(1996, 1, 1), date(2000, 12, 31)
MAIL_SINCE, MAIL_LAST = date(1996, 1, 1), 500


def plain(df: DataFrame) -> DataFrame:
    """Dates as ISO text and decimals as doubles, which every engine prints alike."""

    def shown(field: T.StructField):
        c = F.col(field.name)
        if isinstance(field.dataType, (T.DateType, T.TimestampNTZType)):
            c = c.cast("string")
        elif isinstance(field.dataType, T.DecimalType):
            c = c.cast("double")
        return c.alias(field.name)

    return df.select(*[shown(f) for f in df.schema])


# --- reports -------------------------------------------------------------------------

NEEDS = {"age": "age", "tenure": "tenure_months", "class": "plan_class", "sellers": "seller_name", "payment": "payment_type"}
ALL_COLUMNS = ["seller_name", "age", "tenure_months", "monthly_value", "reason", "plan", "plan_class", "payment_type"]


def _section(name: str, *kinds: str) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        need = [NEEDS.get(name, name)]
        return reports.section(standin.contract_rows(Tables(spark, folder), need, kinds or ["cancelled"]), name)

    return run


def band_totals(spark: SparkSession, folder: str) -> DataFrame:
    rows = standin.contract_rows(Tables(spark, folder), ["tenure_months"])
    return reports.band_totals(rows, "tenure")


def value_stats(spark: SparkSession, folder: str) -> DataFrame:
    return reports.stats(standin.contract_rows(Tables(spark, folder), ["monthly_value"]))


def value_stats_by_sketch(spark: SparkSession, folder: str) -> DataFrame:
    """Statistics of a period from sketches by branch, kind and day that were written before."""
    path = _scratch(spark, "sketches")
    day = F.col("o_orderdate").cast("date").alias("day")
    rows = standin.contract_rows(Tables(spark, folder), ["monthly_value"], standin.KINDS.values(), day)
    reports.value_sketches(rows, ["branch", "kind", "day"]).write.parquet(path)
    period = spark.read.parquet(path).where(F.col("day").between(*SKETCHED))
    return _six(reports.approximate_stats(period), "amount")


def report_kpis(spark: SparkSession, folder: str) -> DataFrame:
    return reports.kpis(standin.contract_rows(Tables(spark, folder), ["age", "tenure_months", "monthly_value"]))


def _report(*kinds: str) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        rows = standin.contract_rows(Tables(spark, folder), ALL_COLUMNS, kinds)
        return reports.report(rows, without=[("AFRICA", "class")])

    return run


# --- blocks and churn ----------------------------------------------------------------


def latest_block(spark: SparkSession, folder: str) -> DataFrame:
    events = standin.block_events(Tables(spark, folder), FIRST_DAY, LAST_DAY)
    return blocks.latest_blocks(events, FIRST_DAY, LAST_DAY)


def latest_block_by_cycle(spark: SparkSession, folder: str) -> DataFrame:
    events = standin.block_events(Tables(spark, folder), CYCLES[0].start, CYCLES[-1].end)
    return blocks.latest_blocks_by_period(events, CYCLES)


def _churned(t: Tables, latest: DataFrame) -> DataFrame:
    return churn.churned(standin.members(t), latest, standin.plans(t), standin.reasons(t), REVERSIBLE, AS_OF)


def _churn(*names: str) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        t = Tables(spark, folder)
        events = standin.block_events(t, FIRST_DAY, LAST_DAY)
        latest = blocks.latest_blocks(events, FIRST_DAY, LAST_DAY, ["event_date", "reason_code"])
        return churn.rollups(_churned(t, latest), names)

    return run


def _churn_series(periods: list[dates.Period]) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        t = Tables(spark, folder)
        events = standin.block_events(t, periods[0].start, periods[-1].end)
        latest = blocks.latest_blocks_by_period(events, periods, ["event_date", "reason_code"])
        return churn.rollups(_churned(t, latest), ["tenure"])

    return run


# --- detail extract ------------------------------------------------------------------


def _detail(dialect: contracts.Dialect) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        t = Tables(spark, folder)
        sources = detail.Sources(
            members=standin.members(t),
            families=standin.families(t),
            sellers=standin.sellers(t),
            events=standin.block_events(t, FIRST_DAY, LAST_DAY),
            reasons=standin.reasons(t),
            plans=standin.plans(t),
            subcontracts=standin.subcontracts(t),
            contracts=standin.contracts(t),
            prices=standin.prices(t),
            attendance=standin.attendance(t),
            payment_types=standin.payment_types(t),
            receivables=standin.receivables(t),
            customers=standin.customers(t),
        )
        return plain(detail.extract(sources, FIRST_DAY, LAST_DAY, AS_OF, dialect))

    return run


def price_by_age(spark: SparkSession, folder: str) -> DataFrame:
    t = Tables(spark, folder)
    rows = standin.members(t).withColumn("birth_date", dates.lenient_date(F.col("birth")))
    return plain(detail.with_price(rows, standin.prices(t), AS_OF).select("card_no", "birth_date", "monthly_value"))


def last_occurrence(spark: SparkSession, folder: str) -> DataFrame:
    return detail.last_occurrences(standin.receivables(Tables(spark, folder)), AS_OF)


def date_scalars(spark: SparkSession, folder: str) -> DataFrame:
    member = standin.members(Tables(spark, folder))
    born, joined = dates.lenient_date(F.col("birth")), dates.strict_date(F.col("joined"))
    until = dates.or_today(dates.lenient_date(F.col("blocked")), AS_OF)
    return plain(
        member.select(
            "card_no",
            born.alias("born"),
            joined.alias("joined"),
            until.alias("until"),
            dates.months_crossed(joined, until).alias("months"),
            dates.years_crossed(born, until).alias("years"),
            dates.cycle_month(joined).alias("cycle"),
        )
    )


# --- goals ---------------------------------------------------------------------------


def goals_latest_month(spark: SparkSession, folder: str) -> DataFrame:
    return goals.latest_goals(standin.goals(Tables(spark, folder)))


def _goals_by_team(t: Tables, **options) -> DataFrame:
    lives = goals.lives_by_team(standin.proposals(t), standin.seller_teams(t), AS_OF, **options)
    return goals.attainment(lives, goals.latest_goals(standin.goals(t)))


def lives_by_team(spark: SparkSession, folder: str) -> DataFrame:
    t = Tables(spark, folder)
    return goals.lives_by_team(standin.proposals(t), standin.seller_teams(t), AS_OF)


def goals_by_team(spark: SparkSession, folder: str) -> DataFrame:
    return _goals_by_team(Tables(spark, folder))


def goals_by_team_filtered(spark: SparkSession, folder: str) -> DataFrame:
    return _goals_by_team(Tables(spark, folder), status=GOAL_FILTERS["status"])


def goals_idle_teams(spark: SparkSession, folder: str) -> DataFrame:
    """Attainment of one product, with the teams that sold none of it."""
    t = Tables(spark, folder)
    lives = goals.lives_by_team(standin.proposals(t), standin.seller_teams(t), AS_OF, product="1-URGENT", null_safe=True)
    return goals.attainment(lives, goals.latest_goals(standin.goals(t)), keep_idle_teams=True)


def goal_message(spark: SparkSession, folder: str) -> DataFrame:
    return goals.message(_goals_by_team(Tables(spark, folder)))


def seller_diagnosis(spark: SparkSession, folder: str) -> DataFrame:
    t = Tables(spark, folder)
    return goals.seller_diagnosis(
        standin.proposals(t), standin.seller_teams(t), AS_OF, branch="Asia", **GOAL_FILTERS
    )


# --- mail ----------------------------------------------------------------------------


def mail_last_n(spark: SparkSession, folder: str) -> DataFrame:
    found = mail.scan(standin.mail(Tables(spark, folder)), since=MAIL_SINCE, last=MAIL_LAST)
    return plain(found.select("folder", "uid", "sent", "sender", "subject"))


def mail_codes_explicit(spark: SparkSession, folder: str) -> DataFrame:
    return plain(mail.code_report(standin.mail(Tables(spark, folder)), full=False))


def mail_codes_full(spark: SparkSession, folder: str) -> DataFrame:
    return plain(mail.code_report(standin.mail(Tables(spark, folder))))


def mail_totals(spark: SparkSession, folder: str) -> DataFrame:
    return mail.code_totals(standin.mail(Tables(spark, folder)))


def html_to_text(spark: SparkSession, folder: str) -> DataFrame:
    return spread(Tables(spark, folder).pages).select("page_id", html_text(F.col("html")).alias("text"))


# --- leads ---------------------------------------------------------------------------


def _features(spark: SparkSession, folder: str) -> DataFrame:
    return leads.features(standin.leads(Tables(spark, folder)))


def lead_features(spark: SparkSession, folder: str) -> DataFrame:
    flags = ["decided", "target", "open"]
    return _features(spark, folder).select("lead_id", *flags, *leads.CATEGORICAL, *leads.NUMERIC)


def lead_stages(spark: SparkSession, folder: str) -> DataFrame:
    return leads.stage_counts(standin.leads(Tables(spark, folder)))


def lead_balance(spark: SparkSession, folder: str) -> DataFrame:
    return leads.class_balance(_features(spark, folder))


def lead_label_codes(spark: SparkSession, folder: str) -> DataFrame:
    return scoring.label_codes(_features(spark, folder))


def lead_split(spark: SparkSession, folder: str) -> DataFrame:
    rows = _features(spark, folder).where("decided").select("lead_id", "decided", "target")
    return leads.dealt(rows, 5).select("lead_id", "target", "is_test", "fold")


def _rule_score(rows: DataFrame) -> DataFrame:
    """A fixed rule as a probability, to check the score operators against SQL."""
    return rows.withColumn("p", F.least(F.floor(F.col("revenue") / 500) / 1000 + F.col("days_in_funnel") / 1000, F.lit(1.0)))


def auc_rank_sum(spark: SparkSession, folder: str) -> DataFrame:
    return stats.rank_sum_auc(_rule_score(_features(spark, folder).where("decided")), "p", "target")


def class_report(spark: SparkSession, folder: str) -> DataFrame:
    return stats.class_report(_rule_score(_features(spark, folder).where("decided")), "p", "target")


def score_bands(spark: SparkSession, folder: str) -> DataFrame:
    scored = leads.score_table(_rule_score(_features(spark, folder)).where("open"), "p")
    return plain(scored)


def score_band_counts(spark: SparkSession, folder: str) -> DataFrame:
    return leads.band_counts(leads.score_table(_rule_score(_features(spark, folder)).where("open"), "p"))


def lead_score_lookup(spark: SparkSession, folder: str) -> DataFrame:
    rows = standin.leads(Tables(spark, folder))
    scored = leads.score_table(_rule_score(leads.features(rows)).where("open"), "p")
    return leads.with_scores(rows.select("lead_id"), scored)


_TRAINED: dict[tuple[str, str], scoring.Trained] = {}


def _trained(spark: SparkSession, folder: str) -> scoring.Trained:
    """The model of a folder's leads, at the library's settings; trained once in an application."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _TRAINED:
        _TRAINED.clear()
        _TRAINED[key] = scoring.train(_features(spark, folder))
    return _TRAINED[key]


def lead_scores(spark: SparkSession, folder: str) -> DataFrame:
    return plain(scoring.scores(_features(spark, folder), _trained(spark, folder).model))


def lead_importance(spark: SparkSession, folder: str) -> DataFrame:
    return scoring.importance(_trained(spark, folder).model)


def lead_permutation_importance(spark: SparkSession, folder: str) -> DataFrame:
    return scoring.permutation_importance(_trained(spark, folder))


def lead_hold_out(spark: SparkSession, folder: str) -> DataFrame:
    auc, by_class = scoring.hold_out(_trained(spark, folder))
    return by_class.unionByName(auc, allowMissingColumns=True)


def lead_model_checks(spark: SparkSession, folder: str) -> DataFrame:
    return scoring.checks(_trained(spark, folder))


def lead_cross_validation(spark: SparkSession, folder: str) -> DataFrame:
    return scoring.cross_validate(_trained(spark, folder))


def lead_saved_model(spark: SparkSession, folder: str) -> DataFrame:
    """Open leads, and how many of them a model that was saved and loaded scores as before."""
    path, model = _scratch(spark, "model"), _trained(spark, folder).model
    scoring.save(model, path)
    both = [scoring.scores(_features(spark, folder), m).select("lead_id", "probability") for m in (model, scoring.load(spark, path))]
    met = both[0].join(both[1].withColumnRenamed("probability", "again"), "lead_id", "left")
    return met.agg(F.count("*").alias("leads"), F.count_if(F.col("probability") == F.col("again")).alias("alike"))


def _six(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: round_even(F.col(c), 6) for c in columns})


def lead_fold_auc(spark: SparkSession, folder: str) -> DataFrame:
    rows = _rule_score(_features(spark, folder).where("decided"))
    return _six(scoring.fold_auc(rows, "p", "target"), "auc_mean", "auc_sd")


def lead_calibration(spark: SparkSession, folder: str) -> DataFrame:
    """The isotonic map of the fixed rule."""
    rows = _rule_score(_features(spark, folder).where("decided"))
    return _six(scoring.calibration(rows, "p", "target"), "raw", "calibrated")


def lead_rule_importance(spark: SparkSession, folder: str) -> DataFrame:
    """What the AUC of the fixed rule loses when one of its numbers is exchanged between leads."""
    names = ["revenue", "days_in_funnel"]
    rows = _features(spark, folder).where("decided").select("lead_id", "target", F.array(*names).alias("x"))

    def scored(df: DataFrame) -> DataFrame:
        return _rule_score(df.withColumns({n: F.get("x", F.lit(i)) for i, n in enumerate(names)}))

    return _six(scoring.auc_drops(scored(rows), scored(permuted(rows, "lead_id", "x", names)), "p", "target"), "auc", "auc_drop")


# --- files ---------------------------------------------------------------------------


def _scratch(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def score_export(spark: SparkSession, folder: str) -> DataFrame:
    """Scores written as CSV with decimal commas, and read again."""
    path = _scratch(spark, "scores")
    scored = leads.score_table(_rule_score(_features(spark, folder)).where("open"), "p")
    writers.write_csv(writers.ranked(scored.select("lead_id", "score", "probability")), path)
    sheet = readers.dimension_csv(spark, path, sep=";")
    return sheet.select(F.col("lead_id").cast("bigint").alias("lead_id"), *[comma_number(F.col(c)).alias(c) for c in ("score", "probability")])


def lead_csv_features(spark: SparkSession, folder: str) -> DataFrame:
    """Features of leads that came from a Latin-1 file with day-first dates."""
    path = _scratch(spark, "leads")
    rows = standin.leads(Tables(spark, folder))
    shown = {f.name: F.date_format(f.name, "dd/MM/yyyy HH:mm:ss") for f in rows.schema if isinstance(f.dataType, T.TimestampNTZType)}
    spaces = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    rows.withColumns(shown).write.csv(path, header=True, sep=";", encoding="ISO-8859-1", **spaces)
    flags = ["decided", "target", "open"]
    return leads.features(readers.lead_csv(spark, path)).select("lead_id", *flags, *leads.CATEGORICAL, *leads.NUMERIC)


def report_parts(spark: SparkSession, folder: str) -> DataFrame:
    """One part of a report that was written with a folder for each section."""
    path = _scratch(spark, "report")
    writers.write_parts(_report("cancelled", "reactivated")(spark, folder), path, "section")
    return spark.read.parquet(path).where("section = 'kpi'")


def report_rerun(spark: SparkSession, folder: str) -> DataFrame:
    """Two parts of a report, one of them written again with another section; both are read."""
    path = _scratch(spark, "rerun")
    writers.write_parts(_section("tenure", "cancelled", "reactivated")(spark, folder), path, "kind")
    writers.write_parts(_section("payment")(spark, folder), path, "kind")
    return spark.read.parquet(path)


def branch_part(spark: SparkSession, folder: str) -> DataFrame:
    """KPIs of one branch from a table of contract rows that is kept in a folder for each branch."""
    path = _scratch(spark, "branches")
    writers.write_parts(standin.contract_rows(Tables(spark, folder), ["age", "tenure_months", "monthly_value"]), path, "branch")
    return reports.kpis(readers.parquet(spark, path, schemas.CONTRACT_ROW).where(F.col("branch") == "ASIA"))


def sheet_columns(spark: SparkSession, folder: str) -> DataFrame:
    """The first columns of a dimension that came as CSV."""
    path = _scratch(spark, "sheet")
    Tables(spark, folder).supplier.select("s_suppkey", "s_name", "s_nationkey").write.csv(path, header=True)
    return readers.dimension_csv(spark, path, columns=2)


# --- contract ------------------------------------------------------------------------


def entry(spark: SparkSession) -> DataFrame:
    """Cancellations by tenure band, with percentage and total, for every branch."""
    return _section("tenure")(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    extra = {**llm.queries(), "pipeline": corpus_pipeline.run} if llm else {}
    return {
        **extra,
        "cancel_by_age_band": _section("age"),
        "cancel_by_tenure_band": _section("tenure"),
        "cancel_by_class": _section("class"),
        "cancel_by_reason": _section("reason"),
        "cancel_by_plan": _section("plan"),
        "cancel_by_payment": _section("payment"),
        "top_sellers": _section("sellers", "cancelled", "reactivated"),
        "band_totals": band_totals,
        "value_stats": value_stats,
        "value_stats_by_sketch": value_stats_by_sketch,
        "report_kpis": report_kpis,
        "cancellation_report": _report("cancelled"),
        "reactivation_report": _report("reactivated"),
        "branch_report": _report("cancelled", "reactivated"),
        "latest_block": latest_block,
        "latest_block_by_cycle": latest_block_by_cycle,
        "churn_by_tenure": _churn("tenure"),
        "churn_by_age": _churn("age"),
        "churn_by_class": _churn("class"),
        "churn_all": _churn("tenure", "age", "class"),
        "churn_series_month": _churn_series(CYCLES),
        "churn_series_semester": _churn_series(semesters(CYCLES)),
        "cancel_detail_a": _detail(contracts.DIALECT_A),
        "cancel_detail_b": _detail(contracts.DIALECT_B),
        "price_by_age": price_by_age,
        "last_occurrence": last_occurrence,
        "date_scalars": date_scalars,
        "goals_latest_month": goals_latest_month,
        "lives_by_team": lives_by_team,
        "goals_by_team": goals_by_team,
        "goals_by_team_filtered": goals_by_team_filtered,
        "goals_idle_teams": goals_idle_teams,
        "goal_message": goal_message,
        "seller_diagnosis": seller_diagnosis,
        "mail_last_n": mail_last_n,
        "mail_codes_explicit": mail_codes_explicit,
        "mail_codes_full": mail_codes_full,
        "mail_totals": mail_totals,
        "html_text": html_to_text,
        "lead_features": lead_features,
        "lead_stages": lead_stages,
        "lead_balance": lead_balance,
        "lead_label_codes": lead_label_codes,
        "lead_split": lead_split,
        "auc_rank_sum": auc_rank_sum,
        "class_report": class_report,
        "score_bands": score_bands,
        "score_band_counts": score_band_counts,
        "lead_score_lookup": lead_score_lookup,
        "score_export": score_export,
        "lead_csv_features": lead_csv_features,
        "report_parts": report_parts,
        "report_rerun": report_rerun,
        "branch_part": branch_part,
        "sheet_columns": sheet_columns,
        "lead_fold_auc": lead_fold_auc,
        "lead_calibration": lead_calibration,
        "lead_rule_importance": lead_rule_importance,
        "lead_scores": lead_scores,
        "lead_importance": lead_importance,
        "lead_permutation_importance": lead_permutation_importance,
        "lead_hold_out": lead_hold_out,
        "lead_model_checks": lead_model_checks,
        "lead_cross_validation": lead_cross_validation,
        "lead_saved_model": lead_saved_model,
    }


def oracle_sql() -> dict[str, str]:
    if not llm:
        return sql.all_queries()
    chain = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return {**sql.all_queries(), **llm.oracle_sql(), **chain}
