"""Row shaping between extract and append."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from batchload.functions.patterns import format_column


def quoted(name: str) -> str:
    """A column name as it stands, dots and backticks included."""
    return "`" + name.replace("`", "``") + "`"


def first_n(df: DataFrame, n: int) -> DataFrame:
    """The first `n` columns by position."""
    if not 1 <= n <= len(df.columns):
        raise ValueError(f"cannot take {n} of {len(df.columns)} columns")
    return df.select(*map(quoted, df.columns[:n]))


def with_sign_version(
    df: DataFrame,
    version_source: str,
    sign: int = 1,
    sign_col: str = "sign",
    version_col: str = "version",
) -> DataFrame:
    """Append a constant sign column and a copy of a column as the row version."""
    return df.withColumns({sign_col: F.lit(sign), version_col: F.col(quoted(version_source))})


def plain_decimal(text: Column) -> Column:
    """The text of a floating-point number without an exponent; beyond 10^20 it keeps one."""
    digits = F.regexp_replace(text.cast("decimal(38,17)").cast("string"), "0+$", "")
    whole = F.when(digits.endswith("."), F.concat(digits, F.lit("0"))).otherwise(digits)
    return F.when(text.contains("E"), F.coalesce(whole, text)).otherwise(text)


def stringify(
    df: DataFrame,
    null_as_empty: bool = False,
    timestamp_pattern: str | None = None,
    plain_numbers: bool = False,
) -> DataFrame:
    """Every column as text; times in `timestamp_pattern` if one is given.

    With `plain_numbers` floating-point numbers are written without an exponent.
    """
    columns = []
    for field in df.schema.fields:
        column = F.col(quoted(field.name))
        if timestamp_pattern is not None and isinstance(field.dataType, T.TimestampNTZType):
            text = format_column(column, timestamp_pattern)
        elif timestamp_pattern is not None and isinstance(field.dataType, T.TimestampType):
            text = F.date_format(column, timestamp_pattern)
        elif plain_numbers and isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            text = plain_decimal(column.cast("string"))
        else:
            text = column.cast("string")
        if null_as_empty:
            text = F.coalesce(text, F.lit(""))
        columns.append(text.alias(field.name))
    return df.select(*columns)


def null_to_empty(df: DataFrame, plain_numbers: bool = False) -> DataFrame:
    """Every column as text with NULL turned into the empty string."""
    return stringify(df, null_as_empty=True, plain_numbers=plain_numbers)


def rename_positional(df: DataFrame, target_columns: list[str]) -> DataFrame:
    """Column *j* takes the name of target column *j*, whatever it was called."""
    if len(target_columns) != len(df.columns):
        raise ValueError(f"{len(df.columns)} columns for {len(target_columns)} target columns")
    return df.toDF(*target_columns)
