"""Column checks that a path-based output cannot get from a table's declared types."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def varchar(col: Column | str, limit: int, name: str | None = None) -> Column:
    """Store-assignment rule of ``VARCHAR(limit)``.

    A value within the limit passes; a longer one whose excess is only trailing blanks is
    cut to the limit; any other longer value raises, failing the whole job.
    """
    c = F.col(col) if isinstance(col, str) else col
    label = name or (col if isinstance(col, str) else "value")
    # octet_length is O(1) and bytes <= limit implies characters <= limit, so the
    # character count is only taken for values that might be too long.
    return (
        F.when(c.isNull() | (F.octet_length(c) <= limit) | (F.char_length(c) <= limit), c)
        .when(F.char_length(F.rtrim(c)) <= limit, F.substring(c, 1, limit))
        .otherwise(F.raise_error(F.concat(
            F.lit(f"value too long for {label} VARCHAR({limit}): "), F.substring(c, 1, 40))))
    )


def enforce_varchar(df: DataFrame, limits: Mapping[str, int]) -> DataFrame:
    """Apply :func:`varchar` to each limited column, keeping names and column order."""
    if not limits:
        return df
    return df.select(*[
        varchar(name, limits[name], name).alias(name) if name in limits else F.col(name)
        for name in df.columns
    ])
