from datetime import date

import pytest

from carelens.operators import evidence as E
from carelens.params import ReportParams
from conftest import Clinic, at, rows


def _evidence(voided_date=0):
    c = Clinic().patient(1)
    c.visit(1, 1, 6, "2020-01-10").answer(1, 1255, value_coded=1256)
    c.visit(2, 1, 9, "2020-01-20").answer(
        2, 1190, value_datetime=at("2020-01-05"), voided=voided_date
    )
    c.program(1, 1, 2, "2020-01-07").visit(3, 1, 18, "2020-01-09")
    return c


@pytest.mark.parametrize("voided, day", [(0, 5), (1, 7)])
def test_earliest_live_evidence(spark, june, voided, day):
    found = E.art_start(_evidence(voided).tables(spark), june)
    assert rows(found, "patient_id", "data_inicio") == [(1, at(f"2020-01-{day:02d}"))]


def test_deleted_patient_and_other_site_do_not_count(spark, june, clinic):
    clinic.patient(1, voided=1).visit(1, 1, 18, "2020-01-01")
    clinic.patient(2).visit(2, 2, 18, "2020-01-01", site=2)
    assert rows(E.art_start(clinic.tables(spark), june), "patient_id") == []
    anywhere = ReportParams(june.end_date)
    assert rows(E.art_start(clinic.tables(spark), anywhere, "all_sites"), "patient_id") == [(2,)]


def test_date_after_the_end_counts_only_without_bound(spark, june, clinic):
    clinic.patient(1).visit(1, 1, 6, "2020-01-10").answer(1, 1190, value_datetime=at("2020-08-01"))
    t = clinic.tables(spark)
    assert rows(E.art_start(t, june), "patient_id") == []
    assert rows(E.art_start(t, june, "files"), "data_inicio") == [(at("2020-08-01"),)]
    assert rows(E.art_start(t, june, "cards"), "data_inicio") == [(at("2020-08-01"),)]


def test_external_form_counts_for_any_yes_answer(spark, clinic):
    p = ReportParams(date(2020, 6, 20))
    clinic.patient(1).visit(1, 1, 52, "2020-03-01")
    clinic.answer(1, 23866, value_datetime=at("2020-02-11")).answer(1, 999, value_coded=1065)
    clinic.patient(2).visit(2, 2, 52, "2020-03-01")
    clinic.answer(2, 23866, value_datetime=at("2020-02-11")).answer(2, 999, value_coded=1066)
    found = E.art_start(clinic.tables(spark), p, "all_sites")
    assert rows(found, "patient_id", "data_inicio") == [(1, at("2020-02-11"))]


def test_the_end_means_midnight(spark, june, clinic):
    clinic.patient(1).visit(1, 1, 18, "2020-06-20")
    clinic.patient(2).visit(2, 2, 18, "2020-06-20T08:00:00")
    assert rows(E.art_start(clinic.tables(spark), june), "patient_id") == [(1,)]


def test_start_window(spark, clinic):
    p = ReportParams(date(2020, 7, 20), None, 1)
    for n, day in enumerate(["2020-03-20", "2020-03-21", "2020-04-20", "2020-04-21"]):
        clinic.patient(n).visit(n, n, 18, day)
    assert rows(E.art_start_in_window(clinic.tables(spark), p), "patient_id") == [(1,), (2,)]


def test_months_are_clamped(spark):
    p = ReportParams(date(2020, 5, 31), None, 1)
    back = spark.range(1).select(p.end_minus_months(3).alias("a"), p.end_minus_months(4, 1).alias("b"))
    assert rows(back, "a", "b") == [(at("2020-02-29"), at("2020-02-01"))]


def test_pregnancy_rules(spark, june, clinic):
    clinic.patient(1).visit(1, 1, 6, "2020-01-10").answer(1, 1982, value_coded=44)
    clinic.patient(2).visit(2, 2, 6, "2019-01-10").answer(2, 1279)  # too long ago
    clinic.patient(3).visit(3, 3, 53, "2020-01-10").answer(3, 5272, value_coded=1065)
    clinic.patient(4).visit(4, 4, 6, "2020-01-10").answer(4, 1982, value_coded=1465)
    clinic.patient(5, voided=1).program(5, 5, 8, "2020-02-01")  # no patient check here
    clinic.patient(6, voided=1).visit(6, 6, 6, "2020-01-10").answer(6, 1600)
    t = clinic.tables(spark)
    ids = lambda rule: [r[0] for r in rows(E.pregnant_ids(t, june, rule), "patient_id")]
    assert ids("recent") == [1, 5]
    assert ids("three_pickups") == [1, 2, 5]
    assert ids("suppressed") == [1, 2, 3, 4, 5]


def test_properties_of_the_start(spark):
    """A later end loses no patient and never moves a start; deleting an answer
    never adds evidence."""
    from pyspark.sql import functions as F

    from carelens.sources.star import clinical_from_star
    from carelens.sources.tables import ClinicalTables
    from conftest import SMALL

    t = clinical_from_star(spark, SMALL)
    early = dict(rows(E.art_start(t, ReportParams(date(1997, 1, 1), None, 1)), "patient_id", "data_inicio"))
    late = dict(rows(E.art_start(t, ReportParams(date(2000, 1, 1), None, 1)), "patient_id", "data_inicio"))
    assert early and all(late[n] <= day for n, day in early.items())
    fewer = t.obs.withColumn("voided", F.when(F.col("encounter_id") % 2 == 0, 1).otherwise(F.col("voided")))
    cut = ClinicalTables(**{**t.named(), "obs": fewer})
    left = dict(rows(E.art_start(cut, ReportParams(date(2000, 1, 1), None, 1)), "patient_id", "data_inicio"))
    assert all(late[n] <= day for n, day in left.items())
