"""Normal forms of the compared fields, and records with equal normal forms."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronage.functions.text import block_letter, digits, normal_email, normal_name

FORMS = ["first_letter", "name_lower", "email_normalized", "phone_normalized"]


# What records may be blocked by: a form, null where a record can't be in a block.
BLOCKS = {"first_letter": "first_letter", "zip_code": "zip_block"}


def normalise(records: DataFrame) -> DataFrame:
    """Add the normal forms of email, phone and name, and the block letter."""
    return records.select(
        "*",
        normal_email(F.col("email")).alias("email_normalized"),
        digits(F.col("phone")).alias("phone_normalized"),
        normal_name(F.col("name")).alias("name_lower"),
    ).withColumn("first_letter", block_letter(F.col("name_lower")))


def block_columns(blocking: tuple[str, ...]) -> list[str]:
    """The columns behind the names of blocking fields."""
    unknown = [b for b in blocking if b not in BLOCKS]
    if unknown or not blocking:
        raise ValueError(f"blocking fields are {', '.join(BLOCKS)}, not {', '.join(unknown) or 'none'}")
    return [BLOCKS[b] for b in blocking]


def forms_of(records: DataFrame, blocking: tuple[str, ...] = ("first_letter",)) -> DataFrame:
    """``rec_id`` with the normal forms, for records that can be in a pair at all."""
    blocks = block_columns(blocking)
    rows = normalise(records)
    if "zip_block" in blocks:
        rows = rows.withColumn("zip_block", F.nullif(F.trim("zip_code"), F.lit("")))
    more = [b for b in blocks if b not in FORMS]
    somewhere = F.coalesce(*blocks).isNotNull()
    return rows.where(somewhere).select("rec_id", *FORMS, *more)


def _forms(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c in FORMS or c in BLOCKS.values()]


def profiles(forms: DataFrame) -> DataFrame:
    """Distinct normal forms, named by their smallest ``rec_id``, with their number of copies.

    Copies of one another score alike against everybody, so pairs are formed
    between profiles and weighted by the copies.
    """
    return forms.groupBy(*_forms(forms)).agg(
        F.min("rec_id").alias("profile_id"), F.count(F.lit(1)).alias("copies")
    )


def members(forms: DataFrame, distinct: DataFrame) -> DataFrame:
    """``(rec_id, profile_id)``; only profiles with copies need the join."""
    columns = _forms(forms)
    shared = distinct.where("copies > 1").select(*[F.col(c).alias(f"s_{c}") for c in columns], "profile_id")
    same = [F.col(c).eqNullSafe(F.col(f"s_{c}")) for c in columns]
    return forms.join(shared, same, "left").select("rec_id", F.coalesce("profile_id", "rec_id").alias("profile_id"))
