"""The tables of the contract extract, laid out once for the joins that every run makes."""

from dataclasses import replace

from ebbtide.plans.detail import FAMILY_KEY, Sources, with_subcontracts
from ebbtide.sources.writers import write_bucketed


def lay_out(s: Sources, prefix: str, path: str, buckets: int) -> Sources:
    """Members and families as tables in buckets of the family key, members with their sub-contract and
    in a folder for each branch; the other tables as they are.

    An extract over the result shuffles neither members nor families nor sub-contracts: the blocks of
    the period are dealt to the members' buckets, if the session sets
    spark.sql.requireAllClusterKeysForCoPartition to false, for members are found by more columns than
    they are dealt by. A family is small, so no bucket is hot. Tables are named `prefix`_members and
    `prefix`_families and replaced if they are there.
    """
    spark = s.members.sparkSession
    write_bucketed(with_subcontracts(s.members, s.subcontracts), f"{prefix}_members", f"{path}/members", FAMILY_KEY, buckets, ["branch_code"])
    write_bucketed(s.families, f"{prefix}_families", f"{path}/families", FAMILY_KEY, buckets)
    return replace(s, members=spark.table(f"{prefix}_members"), families=spark.table(f"{prefix}_families"))
