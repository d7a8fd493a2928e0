"""The contract-level extract of cancellations: a star join around the member."""

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.functions import decode
from ebbtide.functions.dates import months_crossed, or_today, years_crossed
from ebbtide.operators.intervals import left_join_holding
from ebbtide.operators.joins import left_join_sparse
from ebbtide.operators.latest import latest
from ebbtide.plans.blocks import MEMBER_KEY, latest_blocks
from ebbtide.plans.contracts import Dialect, alive, prefixed

FAMILY_KEY = ["org", "company", "family"]
PRICE_KEY = ["org", "branch_code", "company", "family", "member_type"]


@dataclass(frozen=True)
class Sources:
    members: DataFrame
    families: DataFrame
    sellers: DataFrame
    events: DataFrame
    reasons: DataFrame
    plans: DataFrame
    subcontracts: DataFrame
    contracts: DataFrame
    prices: DataFrame
    attendance: DataFrame
    payment_types: DataFrame
    receivables: DataFrame
    customers: DataFrame


def last_occurrences(receivables: DataFrame, as_of: date) -> DataFrame:
    """Occurrence of the receivable issued last among those due before the day.

    Equal issue dates are settled by the highest row id.
    """
    due = alive(receivables).where(F.col("due") < F.lit(as_of))
    keys = ["customer", *FAMILY_KEY]
    return latest(due, keys, ["issued", "row_id"], ["occurrence"])


def with_price(rows: DataFrame, prices: DataFrame, as_of: date) -> DataFrame:
    """Left join of the price whose age range holds the age on the day.

    Overlapping ranges repeat the row, a NULL birth date matches nothing.
    """
    price = alive(prices).select(*PRICE_KEY, "age_from", "age_to", F.col("value").alias("monthly_value"))
    age = years_crossed(F.col("birth_date"), F.lit(as_of))
    return left_join_holding(rows, price, PRICE_KEY, age, "age_from", "age_to", ["monthly_value"])


def equal(prefix: str, *pairs: tuple[str, str]) -> Column:
    """Columns on the left equal to prefixed ones on the right."""
    condition = F.lit(True)
    for left, right in pairs:
        condition = condition & (F.col(left) == F.col(f"{prefix}_{right}"))
    return condition


def same(prefix: str, *names: str) -> Column:
    return equal(prefix, *[(n, n) for n in names])


def with_subcontracts(rows: DataFrame, subcontracts: DataFrame) -> DataFrame:
    """Left join of the living sub-contract of a member, its columns prefixed."""
    keys = same("sub", "org", "company", "contract_no", "contract_ver", "subcontract")
    return rows.join(prefixed(alive(subcontracts), "sub"), keys, "left")


def extract(s: Sources, start: date, end: date, as_of: date, dialect: Dialect) -> DataFrame:
    """Members blocked in the period with plan, contract, seller, price and contact data.

    The blocks of the period are joined first: they leave few members for the rest. Members that
    carry their sub-contract (see `ebbtide.sources.layout`) are not joined with it again.
    """
    blocks = latest_blocks(s.events, start, end, ["event_date", "reason_code", "user"])
    families = prefixed(dialect.wanted_families(s.families), "fam")
    contracts = prefixed(alive(s.contracts), "con")

    rows = (
        dialect.wanted_members(s.members)
        .join(blocks, MEMBER_KEY)
        .join(prefixed(dialect.wanted_plans(s.plans), "plan"), "plan_code")
        .join(prefixed(alive(s.sellers), "seller"), "seller_code")
        .join(prefixed(alive(s.reasons), "reason"), "reason_code")
        .join(families, same("fam", *FAMILY_KEY))
    )
    if "sub_billing_level" not in s.members.columns:
        rows = with_subcontracts(rows, s.subcontracts)
    rows = (
        rows.join(contracts, same("con", "org", "company", "contract_no", "contract_ver"), "left")
        .join(prefixed(s.attendance, "att"), equal("att", ("card_no", "card_no")), "left")
        .join(prefixed(alive(s.payment_types), "pay"), equal("pay", ("fam_payment_code", "code")), "left")
        .withColumn("birth_date", dialect.date(F.col("birth")))
    )
    rows = with_price(rows, s.prices, as_of)
    # Of the receivables, only those of families with a block in the period are aggregated.
    owing = s.receivables.join(blocks.select(*FAMILY_KEY).distinct(), FAMILY_KEY, "left_semi")
    last = prefixed(last_occurrences(owing, as_of), "last")
    rows = rows.join(last, equal("last", ("fam_customer_code", "customer"), *[(k, k) for k in FAMILY_KEY]), "left")

    joined = dialect.date(F.col("joined"))
    blocked = F.nullif(F.rtrim("blocked"), F.lit(""))
    until = or_today(dialect.date(blocked), as_of)
    customer = decode.billed_customer(
        (F.col("fam_billing_level"), F.col("fam_customer_code")),
        (F.col("sub_billing_level"), F.col("sub_customer_code")),
        (F.col("con_billing_level"), F.col("con_customer_code")),
    )
    described = decode.contract_name(F.col("con_billing_level"), F.col("con_name"), F.col("sub_description"))
    distinct = rows.select(
        "card_no",
        customer.alias("customer_code"),
        F.col("name").alias("member_name"),
        "tax_id",
        "street",
        "district",
        F.col("reason_description").alias("reason"),
        described.alias("contract_description"),
        F.col("seller_name"),
        F.col("birth_date").alias("birth"),
        F.col("att_n").alias("attendances"),
        months_crossed(joined, until).alias("tenure_months"),
        F.col("phone").alias("member_phone"),
        years_crossed(F.col("birth_date"), until).alias("age"),
        F.col("user").alias("blocked_by"),
        joined.alias("joined"),
        dialect.date(F.col("event_date")).alias("blocked_on"),
        decode.plan_modality(F.col("plan_modality"), F.col("plan_code")).alias("plan"),
        F.col("class_code"),
        F.col("monthly_value"),
        F.col("pay_description").alias("payment_type"),
        F.col("last_occurrence"),
        *([dialect.date(F.col("blocked")).alias("blocked_registered")] if dialect.strict_dates else []),
    ).distinct()

    phones = alive(s.customers).select(F.col("code").alias("_code"), F.col("phone").alias("customer_phone"))
    return (
        left_join_sparse(distinct, phones, "customer_code", "_code")
        .withColumn("plan_class", decode.plan_class(F.col("class_code"), dialect.class_labels))
        .drop("_code", "class_code", "blocked_registered")
    )
