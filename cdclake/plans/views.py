"""Reporting views over curated tables. Column names are fixed by the consumers of the views."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdclake.functions.columns import recode

# View columns by source column, and race codes replaced by others.
ESTABLISHMENT = {"agy_loc_id": "id", "description": "name"}
LIVING_UNIT = {
    "internal_location_id": "id",
    "internal_location_code": "code",
    "agy_loc_id": "establishment_id",
    "description": "name",
}
PERSON = {
    "offender_id_display": "number",
    "offender_book_id": "id",
    "living_unit_id": "living_unit_reference",
    "first_name": "firstname",
    "middle_name": "middlename",
    "middle_name_2": "middename2",
    "last_name": "lastname",
    "birth_date": "dob",
    "sex_code": "sexcode",
}
MOVEMENT = {
    "offender_book_id": "prisoner",
    "movement_date": "date",
    "movement_time": "time",
    "direction_code": "direction",
    "movement_type": "type",
    "from_agy_loc_id": "origin_code",
    "to_agy_loc_id": "destination_code",
    "comment_text": "comment",
    "escort_code": "escort",
}
RACE_CODES = {"W8": "W3", "O1": "A4"}


def project(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Select and rename columns."""
    return df.select(*[F.col(old).alias(new) for old, new in names.items()])


def establishment(agency_locations: DataFrame) -> DataFrame:
    return project(agency_locations, ESTABLISHMENT)


def living_unit(internal_locations: DataFrame) -> DataFrame:
    return project(internal_locations, LIVING_UNIT)


def person(bookings: DataFrame, offenders: DataFrame) -> DataFrame:
    """Bookings with their person: full name with initial, race codes recoded."""
    joined = bookings.join(offenders, "offender_id")
    return joined.select(
        *[F.col(old).alias(new) for old, new in PERSON.items()],
        F.concat("last_name", F.lit(", "), F.substring("first_name", 1, 1)).alias("name"),
        recode(F.col("race_code"), RACE_CODES).alias("racecode"),
    )


def movement(movements: DataFrame, reasons: DataFrame, agency_locations: DataFrame) -> DataFrame:
    """Movements with their reason and the names of both locations, if known.

    Locations are joined twice under two roles. Whether a side is broadcast is left to the planner.
    """
    place = agency_locations.select("agy_loc_id", "description")
    origin = place.select(F.col("agy_loc_id").alias("from_agy_loc_id"), F.col("description").alias("origin"))
    target = place.select(F.col("agy_loc_id").alias("to_agy_loc_id"), F.col("description").alias("destination"))
    reason = reasons.select("movement_type", "movement_reason_code", F.col("description").alias("reason"))
    joined = (
        movements.join(reason, ["movement_type", "movement_reason_code"])
        .join(origin, "from_agy_loc_id", "left")
        .join(target, "to_agy_loc_id", "left")
    )
    key = F.concat(F.col("offender_book_id").cast("string"), F.lit("."), F.col("movement_seq").cast("string"))
    return joined.select(
        key.alias("id"),
        *[F.col(old).alias(new) for old, new in MOVEMENT.items()],
        "origin", "destination", "reason", F.col("movement_reason_code").alias("reason_code"),
    )
