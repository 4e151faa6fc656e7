"""Star joins of spells with people, families, centers and products.

All joins are left joins without hints: Spark broadcasts a dimension when its size allows and
shuffles it otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortline.functions.text import clean_email, full_name

# Fixed values.
FAMILY_CHANNEL = "Familia"
CORPORATE_CHANNEL = "Empresa"


def channel(is_corporate: Column) -> Column:
    return F.when(is_corporate, CORPORATE_CHANNEL).otherwise(FAMILY_CHANNEL)


def with_person(df: DataFrame, persons: DataFrame, role: str) -> DataFrame:
    """Id, name, document number and e-mail of a person in one role; the role prefixes the columns.

    ``{role}_link`` points to the person; the id is the person's own, unknown if none is on file.
    """
    in_role = persons.select(
        F.col("person_id").alias(f"{role}_link"),
        F.col("person_id").alias(f"{role}_id"),
        full_name(F.col("first_name"), F.col("last_name"), F.col("second_last_name")).alias(f"{role}_full_name"),
        F.col("dni").alias(f"{role}_dni"),
        clean_email(F.col("email")).alias(f"{role}_email"),
    )
    return df.join(in_role, f"{role}_link", "left")


def with_relation(df: DataFrame, family_members: DataFrame, relations: DataFrame, role: str) -> DataFrame:
    """How the linked person relates to the family."""
    described = family_members.join(
        relations.select(F.col("id").alias("relation_id"), F.rtrim("description").alias(f"{role}_relation")),
        "relation_id",
        "left",
    )
    in_role = described.select("family_id", F.col("person_id").alias(f"{role}_link"), f"{role}_relation")
    return df.join(in_role, ["family_id", f"{role}_link"], "left")


def with_children(df: DataFrame, children: DataFrame) -> DataFrame:
    named = children.select(
        "child_id",
        F.col("child_id").alias("known_child_id"),
        "family_id",
        F.col("edu_guardian_id").alias("guardian_link"),
        full_name(F.col("first_name"), F.col("last_name"), F.col("second_last_name")).alias("child_full_name"),
        F.col("dni").alias("child_dni"),
        F.col("birth_dt").alias("child_birth_dt"),
        F.col("gender").alias("child_gender"),
    )
    return df.join(named, "child_id", "left")


def with_payers(df: DataFrame, child_payers: DataFrame) -> DataFrame:
    """One row per payer of a known child; any other row stays once.

    The rows come from ``with_children``.
    """
    payers = child_payers.select(F.col("child_id").alias("known_child_id"), F.col("person_id").alias("payer_link"))
    return df.join(payers, "known_child_id", "left").drop("known_child_id")


def with_center(df: DataFrame, centers: DataFrame) -> DataFrame:
    """Center ids are blank-padded text, so both sides are trimmed."""
    named = centers.select(F.rtrim("center_id").alias("center_id"), F.rtrim("name").alias("center_name"))
    return df.withColumn("center_id", F.rtrim("center_id")).join(named, "center_id", "left")


def with_product(
    df: DataFrame, center_products: DataFrame, levels: DataFrame, shifts: DataFrame
) -> DataFrame:
    level = levels.select(F.col("id").alias("level_id"), F.rtrim("description").alias("level"))
    shift = shifts.select(F.col("id").alias("shift_id"), F.rtrim("description").alias("shift"))
    product = (
        center_products.join(level, "level_id", "left")
        .join(shift, "shift_id", "left")
        .select("product_id", "level", "shift", "room_id")
    )
    return df.join(product, "product_id", "left")


def with_status(df: DataFrame, service_status: DataFrame) -> DataFrame:
    named = service_status.select(F.col("id").alias("status_id"), F.col("description").alias("status"))
    return df.join(named, "status_id", "left")


def with_channel(df: DataFrame, company_services: DataFrame) -> DataFrame:
    """Presence among the company services makes a spell corporate."""
    marked = company_services.select("service_id", F.lit(True).alias("is_corporate"))
    joined = df.join(marked, "service_id", "left").withColumn(
        "is_corporate", F.coalesce("is_corporate", F.lit(False))
    )
    return joined.withColumn("channel", channel(F.col("is_corporate")))
