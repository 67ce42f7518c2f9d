"""Expressions over ownership attributes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from landmart.constants import REAL_ACCOUNT_PREFIX, SNAPSHOT_FORMAT
from landmart.schemas import STAKE


def is_real_account(account: Column) -> Column:
    """Case-sensitive prefix test; a missing account number is not real property."""
    return F.coalesce(account.startswith(REAL_ACCOUNT_PREFIX), F.lit(False))


def assemble_address(number: Column, prefix: Column, street: Column, suffix: Column) -> Column:
    """One line of address. Blanks are kept as they fall, so two blanks when all parts are missing."""
    empty, blank = F.lit(""), F.lit(" ")
    return F.concat(
        F.coalesce(number, empty), blank,
        F.coalesce(F.concat(prefix, blank), empty),
        F.coalesce(street, empty), blank,
        F.coalesce(suffix, empty),
    )


def stake(text: Column) -> Column:
    """Ownership fraction with three places, rounded half up; bad text raises."""
    return text.cast(STAKE)


def report_date(file_index: Column) -> Column:
    return F.to_date(file_index, SNAPSHOT_FORMAT)


def in_types(account_type: Column, types: Sequence[str]) -> Column:
    """Membership flag that is false, not NULL, for a missing type."""
    return F.coalesce(account_type.isin(*types), F.lit(False))
