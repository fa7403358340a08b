"""Column expressions that clean values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The spellings of a missing value in text files.
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]
POST_PREFIX = "t3_"
# End of fixed values.


def na_to_null(text: Column) -> Column:
    return F.when(~text.isin(NA_TOKENS), text)


def nan_to_null(number: Column) -> Column:
    """NaN compares as the largest value in Spark, so a missing number must be NULL."""
    return F.when(~F.isnan(number), number)


def to_number(value: Column, default: float = 0.0) -> Column:
    """Numeric coercion: whatever does not parse becomes ``default``."""
    # A trailing Java type letter ("1d", "2F") is not a number in the data's own format.
    typed = value.cast("string").rlike(r"[0-9.][dDfF]\s*$")
    return F.coalesce(F.when(~typed, nan_to_null(value.try_cast("double"))), F.lit(default))


def to_flag(flag: Column, missing: bool = True) -> Column:
    """Boolean coercion in which a missing value counts as ``missing``."""
    return F.coalesce(flag.cast("boolean"), F.lit(missing))


def strip_post_prefix(post_id: Column) -> Column:
    return F.replace(post_id, F.lit(POST_PREFIX), F.lit(""))


def to_id(number: Column) -> Column:
    """Whole-number id from a float column or text such as ``12.0``; NULL if there is none."""
    return F.coalesce(number.try_cast("bigint"), nan_to_null(number.try_cast("double")).try_cast("bigint"))


def drop_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """Drop columns, ignoring names the frame does not have."""
    return df.drop(*names)


def fill_missing(df: DataFrame, values: dict[str, float | str]) -> DataFrame:
    return df.fillna(values)


def drop_incomplete(df: DataFrame) -> DataFrame:
    """Drop every row that misses any value."""
    return df.dropna("any")
