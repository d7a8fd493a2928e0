"""The domain tables, projected from the star-schema tables of a folder.

Fixed projections without randomness, so that another engine can build the same
rows. They hold blank padding, deleted rows, NULLs, bad numbers, dangling codes
and repeated matches on purpose. Every table grows with the folder's tables.
"""

from collections.abc import Collection
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide import fixed_values as fv
from ebbtide import schemas
from ebbtide.functions import dates, decode
from ebbtide.operators.lineage import spread

AS_OF = date(2001, 8, 1)
KINDS = {"R": "cancelled", "A": "reactivated"}
ORG = "0001"


# Columns of the source tables. With a given schema no file is opened to infer one.
COLUMNS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,"
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string,"
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "pages": "page_id bigint, url string, html string",
}


class Tables:
    """Source tables of one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        if name not in COLUMNS:
            raise AttributeError(name)
        table = self.spark.read.schema(COLUMNS[name]).parquet(f"{self.folder}/{name}.parquet")
        setattr(self, name, table)
        return table


def _digits(c: Column, width: int) -> Column:
    return F.format_string(f"%0{width}d", c)


def _deleted(key: Column, every: int) -> Column:
    return F.when(key % every == every - 1, "*").otherwise(" ")


# --- cancellation and reactivation rows ---------------------------------------------


def contract_rows(t: Tables, need: Collection[str], kinds: Collection[str] = tuple(KINDS.values()), *more: Column) -> DataFrame:
    """One row per line item that was returned ('cancelled') or accepted ('reactivated').

    Only the columns in `need` are built, beside branch and kind, and only their
    lookup tables are joined: all lookups are left joins on unique keys, so the rows
    are the same either way. `more` adds columns of the joined tables.
    """
    flags = [f for f, k in KINDS.items() if k in kinds]
    customers = (
        t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
        .select("c_custkey", "c_mktsegment", "r_name")
    )
    contracts = t.orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
    lines = t.lineitem.where(F.col("l_returnflag").isin(flags))
    rows = lines.join(contracts, F.col("l_orderkey") == F.col("o_orderkey"))
    if "plan" in need:
        rows = rows.join(t.part, F.col("l_partkey") == F.col("p_partkey"), "left")
    if "seller_name" in need:
        rows = rows.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"), "left")

    line, cust = F.col("l_linenumber"), F.col("c_custkey")
    price = F.col("l_extendedprice").cast("string")
    tenure = dates.months_crossed(F.col("o_orderdate").cast("date"), F.lit(AS_OF))
    made = {
        "branch": F.col("r_name"),
        "kind": decode.lookup(F.col("l_returnflag"), KINDS),
        "seller_name": F.when(F.col("l_suppkey") % 11 != 0, F.rpad("s_name", 30, " ")),
        "age": F.when(cust % 53 != 0, (cust % 97 - 5).cast("int")),
        "tenure_months": F.when(line == 6, "n/a").otherwise(tenure.cast("string")),
        "monthly_value": F.when(line == 7, None)
        .when((line == 5) & (F.col("l_quantity") < 5), F.concat(F.lit("-"), price))
        .otherwise(price),
        "reason": F.when(F.col("l_quantity") != 1, F.col("o_orderpriority")),
        "plan": decode.plan_modality(F.col("p_size") % 10, _digits(F.col("l_partkey"), 4)) if "plan" in need else None,
        "plan_class": F.col("c_mktsegment"),
        "payment_type": F.nullif(F.col("o_orderstatus"), F.lit("P")),
    }
    return rows.select(
        *[
            (made[f.name] if f.name in {"branch", "kind", *need} else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schemas.CONTRACT_ROW
        ],
        *more,
    )


# --- contract tables -----------------------------------------------------------------


def _family(key: Column) -> Column:
    """Number of a customer's family: three customers share one."""
    return F.floor(key / 3).cast("bigint")


def _family_keys(family: Column) -> dict[str, Column]:
    """Key columns of a family; all families share 25 contracts of eight companies."""
    return {"org": F.lit(ORG), "company": _digits(family % 25 % 8, 4), "family": _digits(family, 6)}


def _customer_code(key: Column) -> Column:
    return F.concat(F.lit("C"), _digits(key, 6))


def members(t: Tables) -> DataFrame:
    key = F.col("c_custkey")
    family = _family(key)
    contract = family % 25
    ymd = F.concat(_digits(key % 12 + 1, 2), _digits(key % 28 + 1, 2))
    return schemas.conform(
        t.customer.select(
            F.lit("01").alias("branch_code"),
            *[c.alias(n) for n, c in _family_keys(_family(key)).items()],
            _digits(key % 3, 2).alias("member_type"),
            _digits(key, 9).alias("card_no"),
            F.col("c_name").alias("name"),
            _digits(key * 7, 11).alias("tax_id"),
            F.concat(F.lit("9"), _digits(key, 8)).alias("phone"),
            F.concat(F.lit("Street "), (key % 100).cast("string")).alias("street"),
            F.concat(F.lit("District "), (key % 10).cast("string")).alias("district"),
            _digits(key % 200, 4).alias("plan_code"),
            _digits(key % 120, 6).alias("seller_code"),
            _digits(contract, 4).alias("contract_no"),
            F.lit("001").alias("contract_ver"),
            _digits(F.when(family % 7 == 0, 9).otherwise(contract % 3), 3).alias("subcontract"),
            F.get(
                F.array(*[F.lit(v) for v in ("1", "2", "3", "4", "5", "IND", "PRE", "VER", "ZZZ")]),
                (key % 9).cast("int"),
            ).alias("class_code"),
            F.when(key % 41 == 0, " " * 8)
            .otherwise(F.concat((key % 80 + 1930).cast("string"), ymd))
            .alias("birth"),
            F.concat((key % 11 + 1990).cast("string"), ymd).alias("joined"),
            F.when(key % 3 == 0, " " * 8)
            .when(key % 5 == 0, "19000101")
            .otherwise(F.concat((key % 4 + 1998).cast("string"), ymd))
            .alias("blocked"),
            _deleted(key, 29).alias("deleted"),
        ),
        schemas.MEMBER,
    )


def families(t: Tables) -> DataFrame:
    """One row per family of the customers."""
    family = F.col("family_no")
    return schemas.conform(
        t.customer.select(_family(F.col("c_custkey")).alias("family_no"))
        .distinct()
        .select(
            *[c.alias(n) for n, c in _family_keys(family).items()],
            F.when(family % 2 == 0, "1").otherwise("2").alias("billing_level"),
            _customer_code(family).alias("customer_code"),
            (family % 7).cast("string").alias("payment_code"),
            _digits(family % 100, 4).alias("plan_code"),
            _deleted(family, 29).alias("deleted"),
        ),
        schemas.FAMILY,
    )


def sellers(t: Tables) -> DataFrame:
    return schemas.conform(
        t.supplier.select(
            _digits(F.col("s_suppkey"), 6).alias("code"),
            F.rpad("s_name", 25, " ").alias("name"),
            _deleted(F.col("s_suppkey"), 13).alias("deleted"),
        ),
        schemas.SELLER,
    )


def block_events(t: Tables, start: date, end: date) -> DataFrame:
    """Events of the days in question; the range reaches the scan."""
    key = F.col("o_orderkey")
    ids = _family_keys(_family(F.col("o_custkey")))
    day = F.col("o_orderdate")
    in_range = (day >= F.lit(start).cast("timestamp_ntz")) & (day < F.lit(end + timedelta(days=1)).cast("timestamp_ntz"))
    return schemas.conform(
        t.orders.where(in_range).select(
            key.alias("row_id"),
            F.concat(*ids.values()).alias("family_key"),
            _digits(F.col("o_custkey") % 3, 2).alias("member_type"),
            F.when(F.col("o_orderstatus") == "F", "1").otherwise("0").alias("event_type"),
            F.date_format(day, "yyyyMMdd").alias("event_date"),
            _digits(key % 27, 3).alias("reason_code"),
            F.concat(F.lit("U"), (key % 9).cast("string")).alias("user"),
            _deleted(key, 31).alias("deleted"),
        ),
        schemas.BLOCK_EVENT,
    )


def reasons(t: Tables) -> DataFrame:
    return schemas.conform(
        t.nation.select(
            _digits(F.col("n_nationkey"), 3).alias("code"), F.col("n_name").alias("description"), F.lit(" ").alias("deleted")
        ),
        schemas.REASON,
    )


def plans(t: Tables) -> DataFrame:
    return schemas.conform(
        t.part.select(
            _digits(F.col("p_partkey"), 4).alias("code"),
            (F.col("p_size") % 10).alias("modality"),
            _deleted(F.col("p_partkey"), 37).alias("deleted"),
        ),
        schemas.PLAN,
    )


def subcontracts(t: Tables) -> DataFrame:
    key = F.col("n_nationkey")
    return schemas.conform(
        t.nation.select(
            F.lit(ORG).alias("org"),
            _digits(key % 8, 4).alias("company"),
            _digits(key, 4).alias("contract_no"),
            F.lit("001").alias("contract_ver"),
            _digits(key % 3, 3).alias("subcontract"),
            F.when(key % 2 == 0, "1").otherwise("2").alias("billing_level"),
            _customer_code(key).alias("customer_code"),
            F.col("n_name").alias("description"),
            F.lit(" ").alias("deleted"),
        ),
        schemas.SUBCONTRACT,
    )


def contracts(t: Tables) -> DataFrame:
    key = F.col("n_nationkey")
    return schemas.conform(
        t.nation.select(
            F.lit(ORG).alias("org"),
            _digits(key % 8, 4).alias("company"),
            _digits(key, 4).alias("contract_no"),
            F.lit("001").alias("contract_ver"),
            F.when(key % 3 == 0, "1").otherwise("2").alias("billing_level"),
            _customer_code(key + 100).alias("customer_code"),
            F.concat(F.lit("Contract "), F.col("n_name")).alias("name"),
            _deleted(key, 4).alias("deleted"),
        ),
        schemas.CONTRACT,
    )


def prices(t: Tables) -> DataFrame:
    """Two age ranges per member, and an overlapping third one for every tenth."""
    key = F.col("c_custkey")
    fixed = [F.struct(F.lit(a).alias("lo"), F.lit(b).alias("hi"), F.lit(n).alias("n")) for a, b, n in ((0, 39, 0), (40, 200, 1))]
    third = F.struct(F.lit(60).alias("lo"), F.lit(200).alias("hi"), F.lit(2).alias("n"))
    ranges = F.when(key % 10 == 0, F.array(*fixed, third)).otherwise(F.array(*fixed))
    return schemas.conform(
        t.customer.select("c_custkey", F.inline(ranges)).select(
            F.lit("01").alias("branch_code"),
            *[c.alias(n) for n, c in _family_keys(_family(key)).items()],
            _digits(key % 3, 2).alias("member_type"),
            F.col("lo").alias("age_from"),
            F.col("hi").alias("age_to"),
            (key % 100 + 50 + F.col("n") * 10).alias("value"),
            _deleted(key, 43).alias("deleted"),
        ),
        schemas.PRICE,
    )


def attendance(t: Tables) -> DataFrame:
    counts = t.events.groupBy("user_id").agg(F.count("*").alias("n"))
    return schemas.conform(counts.select(_digits(F.col("user_id"), 9).alias("card_no"), "n"), schemas.ATTENDANCE)


def payment_types(t: Tables) -> DataFrame:
    return schemas.conform(
        t.region.select(
            F.col("r_regionkey").cast("string").alias("code"), F.col("r_name").alias("description"), F.lit(" ").alias("deleted")
        ),
        schemas.PAYMENT_TYPE,
    )


def receivables(t: Tables) -> DataFrame:
    key = F.col("o_custkey")
    day = F.col("o_orderdate").cast("date")
    return schemas.conform(
        t.orders.select(
            F.col("o_orderkey").alias("row_id"),
            _customer_code(_family(key)).alias("customer"),
            *[c.alias(n) for n, c in _family_keys(_family(key)).items()],
            day.alias("due"),
            day.alias("issued"),
            F.col("o_orderpriority").alias("occurrence"),
            _deleted(F.col("o_orderkey"), 17).alias("deleted"),
        ),
        schemas.RECEIVABLE,
    )


def customers(t: Tables) -> DataFrame:
    """One billed customer per family."""
    family = F.col("family_no")
    return schemas.conform(
        t.customer.select(_family(F.col("c_custkey")).alias("family_no"))
        .distinct()
        .select(
            _customer_code(family).alias("code"),
            F.concat(F.lit("71-"), family.cast("string")).alias("phone"),
            _deleted(family, 23).alias("deleted"),
        ),
        schemas.CUSTOMER,
    )


# --- goals ---------------------------------------------------------------------------


def goals(t: Tables) -> DataFrame:
    """One row per nation: branch of its region, one of seven teams, month in three spellings."""
    key = F.col("n_nationkey")
    month = (
        F.when(key % 4 == 0, "jul/2001").when(key % 4 == 1, "2001-08-15").when(key % 4 == 2, "Ago/2001").otherwise("??")
    )
    return schemas.conform(
        t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
            F.initcap("r_name").alias("branch"),
            F.concat(F.lit("Team "), (key % 7).cast("string")).alias("team"),
            month.alias("month"),
            F.when(key == 9, 0).otherwise((key + 1) * 4).alias("goal"),
        ),
        schemas.GOAL,
    )


def seller_teams(t: Tables) -> DataFrame:
    """Codes in mixed spelling; every 9th seller has no team, every 50th is listed twice."""
    key = F.col("s_suppkey")
    spelled = F.when(key % 3 == 0, key.cast("string")).when(key % 3 == 1, key.cast("double").cast("string")).otherwise(
        F.concat(F.lit(" "), key.cast("string"))
    )
    copies = F.when(key % 50 == 7, F.sequence(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return schemas.conform(
        t.supplier.select(
            spelled.alias("seller_code"),
            F.when(key % 9 != 0, F.concat(F.lit("Team "), (F.col("s_nationkey") % 7).cast("string"))).alias("team"),
            F.explode(copies),
        ),
        schemas.SELLER_TEAM,
    )


def proposals(t: Tables) -> DataFrame:
    """Orders as proposals; the branch is spelled in three ways."""
    name, key = F.col("r_name"), F.col("o_orderkey")
    branch = F.when(key % 3 == 0, name).when(key % 3 == 1, F.concat(F.lit("  "), F.lower(name))).otherwise(
        F.concat(F.initcap(name), F.lit(" "))
    )
    seller = F.when(key % 40 == 0, None).when(key % 40 == 1, "x").otherwise((F.col("o_custkey") % 110).cast("string"))
    return schemas.conform(
        t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            seller.alias("seller_code"),
            branch.alias("branch"),
            F.col("o_orderstatus").alias("status"),
            F.col("o_orderpriority").alias("product"),
            F.col("o_orderdate").alias("proposal_ts"),
            (key % 5 + 1).alias("lives"),
        ),
        schemas.PROPOSAL,
    )


# --- mail ----------------------------------------------------------------------------


def mail(t: Tables) -> DataFrame:
    """One message per order, with codes in all spellings, dates and far numbers.

    Every 40th message lists so many bare numbers that the cap applies.
    """
    key = F.col("o_orderkey")
    five, three, eight = _digits(key * 37 % 100000, 5), _digits(key % 1000, 3), _digits(key * 7919 % 100000000, 8)
    far = F.repeat(F.lit("x "), 40)
    bare = F.transform(F.sequence(F.lit(0), F.lit(24)), lambda i: _digits((key * 104729 + i * 3571) * 97 % 100000000, 8))
    subject = (
        F.when(key % 7 == 0, F.concat(F.lit("Lista de CEPS "), key.cast("string"), F.lit(" "), F.repeat(F.lit("assunto "), 14)))
        .when(key % 7 == 1, F.concat(F.lit("Pedido "), eight))
        .otherwise("Pedido")
    )
    body = (
        F.when(key % 40 == 0, F.concat(F.lit("cep "), far, F.array_join(bare, " ")))
        .when(key % 6 == 0, F.concat(F.lit("Entrega CEP: "), five, F.lit("-"), three, F.lit(" e "), eight))
        .when(key % 6 == 1, F.concat(F.lit("CEP "), five, three, far, eight, F.lit(" "), five, F.lit(" - "), three))
        .when(key % 6 == 2, F.concat(F.lit("nada aqui "), eight))
        .when(key % 6 == 3, F.concat(eight, F.lit(" "), far, F.lit("20240101 cep "), far, F.lit("00123456 19991231")))
        .when(key % 6 == 4, F.concat(F.lit("somente CEPS "), five, F.lit("-"), three))
    )
    page = F.concat(
        F.lit("<html><style>p{margin:0}</style><script>var a='"), eight, F.lit("';</script><p>CEP&nbsp;<b>"),
        five, F.lit("-"), three, F.lit("</b><!-- "), eight, F.lit(" --> &amp;amp; fim</p></html>"),
    )
    return schemas.conform(
        spread(t.orders).select(
            F.concat(F.lit("Box "), F.col("o_orderstatus")).alias("folder"),
            key.alias("uid"),
            F.col("o_orderdate").alias("sent"),
            F.concat(F.lit("c"), F.col("o_custkey").cast("string"), F.lit("@example.org")).alias("sender"),
            subject.alias("subject"),
            body.alias("body"),
            page.alias("body_html"),
        ),
        schemas.MAIL,
    )


# --- leads ---------------------------------------------------------------------------


def _one_of(key: Column, *values: str | None) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), (key % len(values)).cast("int"))


def leads(t: Tables) -> DataFrame:
    """One lead per order; dear orders of some customers are won more often."""
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    dear = F.col("o_totalprice") > 300000
    stage = (
        F.when(dear & (key % 3 == 0), fv.WON_STAGE)
        .when(key % 11 == 0, fv.WON_STAGE)
        .when(key % 5 == 1, fv.LOST_STAGES[0])
        .when(key % 10 == 2, fv.LOST_STAGES[1])
        .when(key % 10 == 3, fv.LOST_STAGES[2])
        .otherwise(_one_of(key, *fv.OPEN_STAGES, "Outro"))
    )
    created = F.col("o_orderdate")
    after = F.make_dt_interval(hours=((key % 200 - 20) * 7).cast("int"))
    return schemas.conform(
        spread(t.orders).select(
            key.alias("lead_id"),
            F.concat(F.lit("Contact "), cust.cast("string")).alias("contact"),
            F.concat(F.lit("Seller "), (cust % 17).cast("string")).alias("seller"),
            stage.alias("stage"),
            _one_of(key, *fv.CHANNELS, "Evento", None).alias("channel"),
            F.when(cust % 13 != 0, F.concat(F.lit(" Place "), (cust % 25).cast("string"))).alias("place"),
            _one_of(cust, "Pré-Vendas 1", "Suporte", "Televendas", "Vendas Diretas Sul", "Parceiros", None).alias("sales_team"),
            created.alias("created"),
            F.when(key % 19 == 0, "??")
            .otherwise(F.concat(_digits(key % 24, 2), F.lit(":"), _digits(key % 60, 2), F.lit(":00")))
            .alias("created_time"),
            F.when(key % 4 != 0, created + after).alias("closed"),
            F.when(key % 23 == 0, "x").otherwise((key % 90).cast("string")).alias("days"),
            F.when(key % 4 != 0, F.concat((key % 300).cast("string"), F.lit(",5"))).alias("hours_to_close"),
            F.when(key % 8 == 0, None)
            .when(key % 8 == 1, "1.234,56")
            .otherwise(F.translate(F.col("o_totalprice").cast("decimal(18,2)").cast("string"), ".", ","))
            .alias("expected_revenue"),
            F.when(key % 9 == 4, "price").when(key % 9 == 5, "").alias("loss_reason"),
            F.when(cust % 3 != 0, F.concat(F.lit("c"), cust.cast("string"), F.lit("@example.org"))).alias("email"),
            F.when(cust % 4 == 0, "").when(cust % 4 == 1, "Campaign").alias("campaign"),
            created.alias("stage_updated"),
        ),
        schemas.LEAD,
    )
