"""The pN_ queries of the operators in the core, and the SQL to check them against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from loomsift.operators.drift import consistent_table, schema_changes
from loomsift.operators.instants import utc_instants
from loomsift.operators.rejects import loaded_records, split_records
from loomsift.session import table


#: What fields are called in English and Swahili, beside the alias dictionary.
FURTHER_NAMES: dict[str, tuple[str, ...]] = {
    "full_name": ("jina", "jina kamili", "names", "learner name", "student name"),
    "gender": ("jinsia", "m or f"),
    "email": ("mail", "e mail", "barua pepe"),
    "phone_number": ("tel", "tel no", "phone no", "mobile no", "cell", "cell no", "cell phone", "simu", "namba ya simu"),
    "national_id": ("kitambulisho", "id", "id card no", "natl id"),
    "age": ("umri", "age in years", "age yrs"),
    "county": ("kaunti", "home county"),
    "sub_county": ("constituency", "sub cty"),
    "ward": ("wadi", "ward name"),
    "village": ("kijiji", "home village"),
    "organization": ("org", "employer"),
    "role": ("cheo", "job title"),
    "disability": ("ulemavu", "disabled", "disability yn"),
    "education_level": ("elimu", "edu level", "highest education"),
    "internet_access": ("internet", "net access"),
    "trainer_name": ("mkufunzi", "facilitator"),
    "remarks": ("maoni", "observations"),
    "completion_date": ("completed on", "date complete"),
    "registration_date": ("registered on", "reg dt"),
    "training_time": ("duration", "hours spent"),
    "quiz_average": ("quiz avg", "mean quiz score"),
    "percent_complete": ("progress", "pct done"),
    "serial_no": ("nambari", "row no"),
    "monthly_income": ("income per month", "income ksh"),
    "course_taken": ("kozi", "course", "course name"),
    "date_trained": ("training date", "trained on"),
    "has_device": ("owns device", "device owner"),
    "partner": ("mshirika", "partner org"),
}


def p2_found(spark: SparkSession, root: str) -> DataFrame:
    """Changes of each feed's header from version to version."""
    return schema_changes(table(spark, root, "file_headers"), FURTHER_NAMES)


def p2_table(spark: SparkSession, root: str) -> DataFrame:
    """The samples of all versions in one consistent table."""
    return consistent_table(table(spark, root, "file_headers"), FURTHER_NAMES)


def p4_found(spark: SparkSession, root: str) -> DataFrame:
    """Rejected records and the reason."""
    parsed = split_records(table(spark, root, "raw_records"))
    return parsed.where("reason IS NOT NULL").select("drive_file_id", "source_row_number", "reason")


def p4_loaded(spark: SparkSession, root: str) -> DataFrame:
    """The valid records as rows of canonical fields."""
    return loaded_records(split_records(table(spark, root, "raw_records")))


def p7_found(spark: SparkSession, root: str) -> DataFrame:
    """The instant that each date or time of participants states."""
    return utc_instants(table(spark, root, "participants"), ("registration_date", "completion_date", "date_trained"), table(spark, root, "partner_profiles"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (p2_found, p2_table, p4_found, p4_loaded, p7_found)}


def oracle_sql() -> dict[str, str]:
    return {}
