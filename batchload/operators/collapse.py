"""The present rows of a change log with a sign and a version column.

A change log says what is so with sign 1 and what is so no longer with sign -1, in pairs of equal
key and version. Collapsed, pairs are gone and the latest version of each key is left. The state
between two batches is the net sign of every key and version that does not cancel out, so batches
may come in any order and any number of times a part: a cancelling row may come before its pair.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from batchload.operators.project import quoted

SIGN, VERSION = "sign", "version"


def net(changes: DataFrame, keys: list[str], sign: str = SIGN, version: str = VERSION) -> DataFrame:
    """One row for each key and version whose signs do not cancel out, with the sum of them.

    The other columns come from a row with a positive sign, or if there is none, with a negative one:
    of several the greatest. Rows without a sign or version are left out; a key may have nulls. Hot
    keys are summed before they are shuffled.
    """
    others = [name for name in changes.columns if name not in (*keys, sign, version)]
    values = F.struct(
        (F.col(quoted(sign)) > 0).alias("__positive"), *[F.col(quoted(name)) for name in others]
    )
    known = F.col(quoted(sign)).isNotNull() & F.col(quoted(version)).isNotNull()
    summed = changes.where(known).groupBy(*map(quoted, [*keys, version])).agg(
        F.sum(quoted(sign)).cast("long").alias("__net"), F.max(values).alias("__row")
    )
    return summed.where("__net <> 0").select(*[_column(name, keys, sign, version) for name in changes.columns])


def _column(name: str, keys: list[str], sign: str, version: str) -> Column:
    if name == sign:
        return F.col("__net").alias(name)
    if name in (*keys, version):
        return F.col(quoted(name))
    return F.col("__row")[name].alias(name)


def fold(
    state: DataFrame, changes: DataFrame, keys: list[str], sign: str = SIGN, version: str = VERSION
) -> DataFrame:
    """The state after one more batch of changes."""
    return net(state.unionByName(changes), keys, sign, version)


def present(state: DataFrame, keys: list[str], sign: str = SIGN, version: str = VERSION) -> DataFrame:
    """The rows that are so now: of each key the latest version with a positive net sign."""
    others = [name for name in state.columns if name not in (*keys, sign, version)]
    row = F.struct(quoted(version), *map(quoted, others))
    latest = state.where(F.col(quoted(sign)) > 0).groupBy(*map(quoted, keys)).agg(
        F.max_by(row, F.col(quoted(version))).alias("__row")
    )
    return latest.select(
        *map(quoted, keys), *[F.col("__row")[name].alias(name) for name in [version, *others]]
    )
