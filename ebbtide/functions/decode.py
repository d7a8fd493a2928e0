"""Codes to labels."""

from collections.abc import Mapping
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from ebbtide import fixed_values as fv


def lookup(c: Column, labels: Mapping) -> Column:
    """Label of a code, NULL where the code is not listed."""
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(labels.items())])[c]


def plan_modality(modality: Column, plan_code: Column, labels: Mapping = fv.MODALITY_LABELS) -> Column:
    special = (modality == 3) & (F.rtrim(plan_code) == fv.SPECIAL_PLAN_CODE)
    return F.when(special, fv.SPECIAL_PLAN_LABEL).otherwise(
        F.coalesce(lookup(modality, labels), F.lit(fv.MODALITY_OTHER))
    )


def plan_class(code: Column, labels: Mapping = fv.CLASS_LABELS_A) -> Column:
    """Listed codes get a label, all others keep the raw value."""
    return F.coalesce(lookup(F.trim(code), labels), code)


def billed_customer(*levels: tuple[Column, Column]) -> Column:
    """Customer of the first level that is billed; NULL where none is."""
    picked = F
    for level, customer in levels:
        picked = picked.when(F.rtrim(level) == "1", customer)
    return picked


def contract_name(level: Column, name: Column, description: Column) -> Column:
    return F.when(F.rtrim(level) == "1", name).otherwise(description)


def channel(c: Column) -> Column:
    return F.coalesce(lookup(c, fv.CHANNELS), F.lit(fv.CHANNEL_OTHER))


def team_type(c: Column) -> Column:
    picked = F
    for mark, kind in fv.TEAM_MARKS:
        picked = picked.when(c.contains(mark), F.lit(kind))
    return picked.otherwise(fv.TEAM_OTHER)
