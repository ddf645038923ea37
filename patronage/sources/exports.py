"""Files handed to people: review queue, segment lists, profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_csv(df: DataFrame, path: str) -> None:
    """CSV part files with a header line each; quotes inside text are doubled."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


_PLAIN = (T.NumericType, T.BooleanType, T.NullType)


def profile_json(rows: DataFrame, key: str = "unified_id") -> DataFrame:
    """``(key, profile)``: every row as JSON; whatever is not a number or a truth value, as text."""
    fields = [
        F.col(f.name) if isinstance(f.dataType, _PLAIN) else F.col(f.name).cast("string").alias(f.name)
        for f in rows.schema.fields
    ]
    text = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    return rows.select(F.col(key), text.alias("profile"))


def write_profiles(rows: DataFrame, path: str) -> None:
    """One JSON object per line."""
    profile_json(rows, rows.columns[0]).select("profile").write.mode("overwrite").text(path)
