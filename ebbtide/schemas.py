"""Schemas of the source tables, checked where a table enters a plan."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "date": T.DateType(),
    "timestamp": T.TimestampNTZType(),
    "double": T.DoubleType(),
    "money": T.DecimalType(18, 2),
}


def _schema(text: str) -> T.StructType:
    """'name type, name type, ...'; a name alone is a string."""
    fields = [f.split() for f in text.split(",")]
    return T.StructType([T.StructField(f[0], _TYPES[f[1] if len(f) > 1 else "string"]) for f in fields])


CONTRACT_ROW = _schema(
    "branch, kind, seller_name, age int, tenure_months, monthly_value, reason, plan, plan_class, payment_type"
)

MEMBER = _schema(
    "branch_code, org, company, family, member_type, card_no, name, tax_id, phone, street, district, plan_code,"
    "seller_code, contract_no, contract_ver, subcontract, class_code, birth, joined, blocked, deleted"
)
FAMILY = _schema("org, company, family, billing_level, customer_code, payment_code, plan_code, deleted")
SELLER = _schema("code, name, deleted")
BLOCK_EVENT = _schema("row_id bigint, family_key, member_type, event_type, event_date, reason_code, user, deleted")
REASON = _schema("code, description, deleted")
PLAN = _schema("code, modality int, deleted")
SUBCONTRACT = _schema(
    "org, company, contract_no, contract_ver, subcontract, billing_level, customer_code, description, deleted"
)
CONTRACT = _schema("org, company, contract_no, contract_ver, billing_level, customer_code, name, deleted")
PRICE = _schema("branch_code, org, company, family, member_type, age_from int, age_to int, value money, deleted")
ATTENDANCE = _schema("card_no, n bigint")
PAYMENT_TYPE = _schema("code, description, deleted")
RECEIVABLE = _schema("row_id bigint, customer, org, company, family, due date, issued date, occurrence, deleted")
CUSTOMER = _schema("code, phone, deleted")

GOAL = _schema("branch, team, month, goal double")
SELLER_TEAM = _schema("seller_code, team")
PROPOSAL = _schema("seller_code, branch, status, product, proposal_ts timestamp, lives int")

MAIL = _schema("folder, uid bigint, sent timestamp, sender, subject, body, body_html")

LEAD = _schema(
    "lead_id bigint, contact, seller, stage, channel, place, sales_team, created timestamp, created_time,"
    "closed timestamp, days, hours_to_close, expected_revenue, loss_reason, email, campaign, stage_updated timestamp"
)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the columns of the schema, cast to its types; a missing one is an error."""
    missing = [f.name for f in schema if f.name not in df.columns]
    if missing:
        raise ValueError(f"columns missing: {', '.join(missing)}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])
