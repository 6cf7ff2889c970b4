"""Schemas of the twelve clinical tables. Never inferred at run time."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "long": T.LongType(),
    "int": T.IntegerType(),
    "string": T.StringType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
    "ts": T.TimestampNTZType(),
}


def _table(text: str) -> T.StructType:
    fields = [part.split() for part in text.split(",")]
    return T.StructType(
        [T.StructField(name, _TYPES[kind], i > 0) for i, (name, kind) in enumerate(fields)]
    )


SCHEMAS: dict[str, T.StructType] = {
    "patient": _table("patient_id long, voided int"),
    "person": _table(
        "person_id long, gender string, birthdate date, dead int, death_date date, voided int"
    ),
    "person_name": _table(
        "person_name_id long, person_id long, given_name string, middle_name string, "
        "family_name string, preferred int, voided int"
    ),
    "person_address": _table(
        "person_address_id long, person_id long, county_district string, address1 string, "
        "address2 string, address5 string, address6 string, preferred int, voided int"
    ),
    "person_attribute": _table("person_id long, person_attribute_type_id int, value string"),
    "patient_identifier": _table(
        "patient_identifier_id long, patient_id long, identifier string, identifier_type int, "
        "preferred int, voided int"
    ),
    "location": _table("location_id long, name string"),
    "users": _table("user_id long, username string"),
    "encounter": _table(
        "encounter_id long, patient_id long, encounter_type int, encounter_datetime ts, "
        "location_id long, creator long, date_created ts, form_id int, voided int"
    ),
    "obs": _table(
        "person_id long, encounter_id long, obs_datetime ts, location_id long, concept_id int, "
        "value_coded int, value_numeric double, value_datetime ts, value_text string, voided int"
    ),
    "patient_program": _table(
        "patient_program_id long, patient_id long, program_id int, date_enrolled ts, "
        "location_id long, voided int"
    ),
    "patient_state": _table(
        "patient_program_id long, state int, start_date ts, end_date ts, voided int"
    ),
}
