from __future__ import annotations

import os
import sys
from datetime import date, datetime

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from carelens.params import ReportParams
from carelens.schema import SCHEMAS
from carelens.session import local_session
from carelens.sources.tables import ClinicalTables

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, 4)
    yield session
    session.stop()


def at(text: str) -> datetime:
    return datetime.fromisoformat(text)


class Clinic:
    """Hand-made rows; every row gets harmless values where none is given."""

    def __init__(self):
        self.rows = {name: [] for name in SCHEMAS}

    def add(self, table: str, **values):
        blank = {c: None for c in SCHEMAS[table].fieldNames()}
        if "voided" in blank:
            blank["voided"] = 0
        unknown = set(values) - set(blank)
        assert not unknown, unknown
        row = {**blank, **values}
        self.rows[table].append(tuple(row[c] for c in SCHEMAS[table].fieldNames()))
        return self

    def patient(self, n, voided=0, gender="F", birthdate=date(1980, 1, 1)):
        self.add("patient", patient_id=n, voided=voided)
        return self.add("person", person_id=n, gender=gender, birthdate=birthdate, dead=0)

    def visit(self, n, patient, kind, when, site=1, **more):
        when = at(when) if isinstance(when, str) else when
        self._when = {**getattr(self, "_when", {}), n: (patient, when, site)}
        return self.add(
            "encounter", encounter_id=n, patient_id=patient, encounter_type=kind,
            encounter_datetime=when, location_id=site, **more,
        )

    def answer(self, visit, concept, **more):
        patient, when, site = self._when[visit]
        values = {"person_id": patient, "obs_datetime": when, "location_id": site, **more}
        return self.add("obs", encounter_id=visit, concept_id=concept, **values)

    def program(self, n, patient, program, when, site=1, **more):
        return self.add(
            "patient_program", patient_program_id=n, patient_id=patient, program_id=program,
            date_enrolled=at(when), location_id=site, **more,
        )

    def state(self, program, state, start, end=None, **more):
        return self.add(
            "patient_state", patient_program_id=program, state=state, start_date=at(start),
            end_date=at(end) if end else None, **more,
        )

    def tables(self, spark) -> ClinicalTables:
        return ClinicalTables(
            **{n: spark.createDataFrame(rows, SCHEMAS[n]) for n, rows in self.rows.items()}
        )


@pytest.fixture
def clinic():
    return Clinic()


@pytest.fixture
def june():
    return ReportParams(date(2020, 6, 20), date(2019, 6, 21), 1)


def rows(df, *columns):
    """Sorted tuples of some columns."""
    found = [tuple(r) for r in df.select(*columns).collect()]
    return sorted(found, key=lambda r: tuple((x is None, str(x)) for x in r))
