"""The canonical participant schema; every list of columns is derived from here."""

from __future__ import annotations

import re

from pyspark.sql import types as T

#: The canonical fields in schema order, each with its aliases.
CANONICAL: dict[str, tuple[str, ...]] = {
    "national_id": ("national id", "nationalid", "id number", "idnumber", "national id no", "id no", "id_number"),
    "full_name": ("full name", "fullname", "name", "participant name", "trainee name"),
    "first_name": ("first name", "firstname"),
    "last_name": ("last name", "lastname", "surname"),
    "gender": ("gender", "sex"),
    "email": ("email", "email address", "emailaddress"),
    "phone_number": ("phone number", "phone", "phonenumber", "mobile", "mobile number", "contact", "telephone"),
    "age": ("age",),
    "age_group": ("age group", "agegroup", "age bracket"),
    "county": ("county", "county name"),
    "sub_county": ("sub county", "subcounty"),
    "ward": ("ward",),
    "village": ("village", "village town", "town", "location"),
    "organization": ("organization", "organisation", "institution", "company"),
    "role": ("role", "designation", "position"),
    "state_department": ("state department", "department"),
    "directorate": ("directorate",),
    "disability": ("disability", "disability status", "pwd status"),
    "disability_type": ("disability type", "type of disability"),
    "device_type": ("device type", "device"),
    "device_description": ("device description", "device desc"),
    "education_level": ("education level", "education", "level of education"),
    "internet_access": ("internet access", "has internet"),
    "trainer_name": ("trainer name", "trainer"),
    "trainer_phone": ("trainer phone", "trainer contact"),
    "follow_up_consent": ("follow up consent", "consent"),
    "remarks": ("remarks", "comments", "notes"),
    "username": ("username", "user name"),
    "completion_date": ("completion date", "date completed"),
    "registration_date": ("registration date", "date registered", "reg date"),
    "training_time": ("training time", "time spent"),
    "quiz_average": ("quiz average", "average score", "quiz score"),
    "percent_complete": ("percent complete", "completion rate", "percentage complete", "pct complete"),
    "program_cohort": ("program cohort", "cohort", "program"),
    "cluster": ("cluster",),
    "label": ("label",),
    "serial_no": ("serial no", "serial number", "sno", "sn", "no"),
    "region": (),
    "region_group": (),
    "assistive_device": (),
    "primary_language": (),
    "employment_status": (),
    "income_activity": (),
    "monthly_income": (),
    "internet_frequency": (),
    "device_used": (),
    "self_rated_digital_skill": (),
    "cdc_name": (),
    "cdc_phone": (),
    "institution_level": (),
    "trainer_level": (),
    "course_taken": (),
    "course_category": (),
    "where_course_taken": (),
    "date_trained": (),
    "kictanet_cluster": (),
    "has_device": (),
    "internet_type": (),
    "source": (),
    "partner": (),
}

#: The fields added last; a backfill moves them out of the bag.
LATE_FIELDS = tuple(list(CANONICAL)[37:])
METADATA = ("row_hash", "source_system", "drive_file_id", "source_file", "source_sheet", "source_row_number")
INSERT_COLUMNS = (*METADATA, *CANONICAL, "extra_json")

#: How each field is cleaned; fields not named here are only trimmed.
TITLE = ("full_name", "first_name", "last_name", "county", "sub_county", "ward", "village", "organization", "role", "state_department", "directorate", "trainer_name")
YES_NO = ("disability", "follow_up_consent", "internet_access")
PHONE = ("phone_number", "trainer_phone")
PERCENT = ("percent_complete", "quiz_average")
DATE = ("completion_date", "registration_date")


def header_key(raw: str | None) -> str:
    """A header in the form in which aliases are looked up: words of a-z and 0-9 joined by a space."""
    return " ".join(re.findall("[a-z0-9]+", (raw or "").lower()))


#: Looked-up form -> canonical field.
LOOKUP: dict[str, str] = {header_key(name): field for field, aliases in CANONICAL.items() for name in (field, *aliases)}


def participants_schema() -> T.StructType:
    """The schema of the target table."""
    fields = [T.StructField("id", T.LongType()), T.StructField("row_hash", T.StringType(), False)]
    fields += [T.StructField(c, T.IntegerType() if c == "source_row_number" else T.StringType()) for c in METADATA[1:]]
    fields += [T.StructField(c, T.StringType()) for c in CANONICAL]
    fields += [T.StructField("extra_json", T.MapType(T.StringType(), T.StringType()))]
    return T.StructType([*fields, T.StructField("ingested_at", T.TimestampType()), T.StructField("updated_at", T.TimestampType())])
