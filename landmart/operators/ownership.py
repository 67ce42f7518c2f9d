"""Distinct views of the ownership rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OWNERSHIP_KEY = ("owner_name", "parcel_id", "is_real_property", "pct_own", "account_type", "file_index")


def distinct_ownership(owners: DataFrame) -> DataFrame:
    """Ownership without the account: two accounts alike in everything else count once."""
    return owners.select(*OWNERSHIP_KEY).distinct()


def parcel_account_type(owners: DataFrame) -> DataFrame:
    """Real-property types per parcel and snapshot with their number of distinct named owners."""
    return (
        owners.filter("is_real_property")
        .groupBy("file_index", "parcel_id", "account_type")
        .agg(F.count_distinct("owner_name").alias("owners"))
    )


def type_mask(account_type: Column, types: tuple[str, ...]) -> Column:
    """Bit set of the listed types seen in a group; its bit count is their distinct number."""
    bits = F.lit(0)
    for position, name in enumerate(types):
        bits = F.when(account_type == name, 1 << position).otherwise(bits)
    return F.bit_or(bits)
