"""Postal codes from mail."""

from collections.abc import Collection
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide import fixed_values as fv
from ebbtide.functions.codes import code_lists, explicit_codes, mentions_code
from ebbtide.functions.html import body_text
from ebbtide.functions.text import strip
from ebbtide.operators.latest import last_n


def scan(
    mail: DataFrame, since: date | None = None, last: int | None = None, folders: Collection[str] | None = None
) -> DataFrame:
    """Messages since a day, then the last n of each folder."""
    if folders is not None:
        mail = mail.where(F.col("folder").isin(list(folders)))
    if since is not None:
        mail = mail.where(F.col("sent") >= F.lit(since).cast("timestamp_ntz"))
    return mail if not last else last_n(mail, "folder", "uid", last)


def read_codes(mail: DataFrame, full: bool = True, cap: int = fv.CODE_CAP) -> DataFrame:
    """Every message with its readable body and the list of its codes.

    Messages that do not mention the word have none. `full` adds the bare numbers,
    away from the word only while fewer than `cap` codes are listed; `dropped` says how
    many that leaves out.
    """
    read = mail.select(
        "folder",
        "uid",
        "sent",
        "sender",
        F.coalesce(strip(F.col("subject")), F.lit("")).alias("subject"),
        body_text(F.col("body"), F.col("body_html")).alias("body"),
    )
    whole = F.concat("subject", F.lit("\n"), "body")
    explicit = F.struct(F.array_distinct(explicit_codes(whole)).alias("codes"), F.lit(0).alias("dropped"))
    found = code_lists(whole, cap) if full else explicit
    none = F.struct(F.array().cast("array<string>").alias("codes"), F.lit(0).alias("dropped"))
    gate = mentions_code(F.col("subject"), F.col("body"))
    # As a generator the search runs once; a later filter is not moved in front of it.
    return read.select("*", F.inline(F.array(F.when(gate, found).otherwise(none))))


def code_report(mail: DataFrame, full: bool = True, cap: int = fv.CODE_CAP) -> DataFrame:
    """Messages with at least one code."""
    return (
        read_codes(mail, full, cap)
        .where(F.size("codes") > 0)
        .select(
            "folder",
            "uid",
            "sent",
            "sender",
            F.substring("subject", 1, fv.SUBJECT_CHARS).alias("subject"),
            "body",
            F.array_join("codes", ", ").alias("codes"),
            F.size("codes").alias("quantity"),
            "dropped",
        )
    )


def code_totals(mail: DataFrame, cap: int = fv.CODE_CAP) -> DataFrame:
    """Messages with and without codes, the codes listed and those the cap dropped, by folder."""
    found = F.size("codes")
    return (
        read_codes(mail, cap=cap)
        .groupBy("folder")
        .agg(
            F.count_if(found > 0).alias("with_codes"),
            F.count_if(found == 0).alias("without_codes"),
            F.sum(found).alias("codes"),
            F.sum("dropped").alias("dropped"),
        )
    )
