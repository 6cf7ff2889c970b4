from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from carelens.functions import scalars as X
from carelens.operators import attach as A
from carelens.operators import differentiated as D
from carelens.operators import labs as L
from carelens.operators import tb as TB
from carelens.operators.choose import first_row, first_second_last
from carelens.params import ReportParams
from conftest import at, rows


def _load(clinic, n, days_ago, *values, end="2020-06-20", kind=13):
    clinic.patient(n).visit(n, n, kind, at(end) - timedelta(days=days_ago))
    for v in values:
        clinic.answer(n, 856, value_numeric=v)


def test_ties_give_two_rows_and_the_highest_in_the_other_form(spark, june, clinic):
    _load(clinic, 1, 30, 500.0, 5000.0)
    t = clinic.tables(spark)
    assert rows(L.last_viral_load(t, june), "valor_carga") == [("500",), ("5000",)]
    assert rows(L.last_vl_unfiltered(t, june), "valor_ultima_carga") == [(5000.0,)]


def test_equal_ties_are_kept(spark, june, clinic):
    _load(clinic, 1, 30, 500.0, 500.0)
    assert rows(L.last_viral_load(clinic.tables(spark), june), "valor_carga") == [("500",), ("500",)]


def test_load_as_text(spark):
    df = spark.createDataFrame([(-1.0,), (1000.0,), (10.5,), (0.0,), (None,)], "v double")
    texts = [r[0] for r in df.select(X.viral_load_text("v")).collect()]
    assert texts == ["INDETECTAVEL", "1000", "10.5", "0", None]


def test_due_for_a_test(spark, june, clinic):
    clinic.patient(1)  # never tested
    _load(clinic, 2, 344, 10.0)
    _load(clinic, 3, 345, 10.0)
    _load(clinic, 4, 360, 10.0)
    _load(clinic, 5, 400, 1000.0)
    _load(clinic, 6, 400, None)
    found = rows(L.vl_not_due_ids(clinic.tables(spark), june), "patient_id")
    assert found == [(2,), (5,), (6,)]


def test_failure_needs_more_than_90_days(spark, june, clinic):
    _load(clinic, 1, 90, 1000.0)
    _load(clinic, 2, 91, 1000.0)
    _load(clinic, 3, 91, 999.0)
    assert rows(L.vl_failure_filter(clinic.tables(spark), june), "patient_id") == [(2,)]


def test_a_newer_answer_of_any_kind_hides_the_load(spark, june, clinic):
    _load(clinic, 1, 30, 500.0)
    clinic.visit(9, 1, 13, "2020-06-10").answer(9, 5497, value_numeric=3.0, voided=1)
    assert rows(L.last_vl_unfiltered(clinic.tables(spark), june), "patient_id") == []


def test_first_load_only_if_suppressed(spark, june, clinic):
    _load(clinic, 1, 300, 500.0, 999.0)
    _load(clinic, 2, 300, 500.0, 1000.0)
    found = L.first_vl_suppressed(clinic.tables(spark), june)
    assert rows(found, "patient_id", "valor_primeira_carga") == [(1, 999.0)]


@pytest.mark.parametrize(
    "end, shown, days",
    [("2020-02-01", None, 140), ("2020-02-02", at("2020-02-02"), None), (None, None, 140)],
)
def test_isoniazid_end_counts_only_after_the_start(spark, june, clinic, end, shown, days):
    clinic.patient(1).visit(1, 1, 6, "2020-02-01").answer(1, 6122, value_coded=1256)
    if end:
        clinic.answer(1, 6129, value_datetime=at(end))
    t = clinic.tables(spark)
    assert rows(TB.inh_course(t, june), "data_fim_inh") == [(shown,)]
    assert rows(TB.inh_elapsed(t, june), "dias_inh") == [(days,)]


def test_rule_for_preventive_treatment(spark, june, clinic):
    def screened(n, answer, result=None, end=None):
        clinic.patient(n).visit(n, n, 6, "2020-02-01").answer(n, 6257, value_coded=answer)
        if result:
            clinic.answer(n, 6277, value_coded=result)
        if end:
            clinic.answer(n, 6122, value_coded=1256).answer(n, 6129, value_datetime=at(end))

    screened(1, 1066)
    screened(2, 1065, 703)
    screened(3, 1065, 664)
    screened(4, 1065)
    screened(5, 1066, end="2020-05-01")  # course over
    screened(6, 1066, end="2020-08-01")  # ends after the report
    found = rows(TB.tpt_rule(clinic.tables(spark), june), "patient_id")
    assert found == [(1,), (3,), (6,)]


def test_names(spark):
    df = spark.createDataFrame(
        [("Ana", None, "Sitoe"), (None, "M", "Cossa")],
        "given_name string, middle_name string, family_name string",
    )
    found = [tuple(r) for r in df.select(X.full_name(), X.short_name()).collect()]
    assert found == [("Ana  Sitoe", "Ana Sitoe"), (" M Cossa", None)]


def test_first_live_row_by_id(spark, clinic):
    for n, voided in ((1, 1), (2, 0), (3, 0)):
        clinic.add(
            "patient_identifier", patient_identifier_id=n, patient_id=7, identifier=f"id{n}", voided=voided
        )
    t = clinic.tables(spark)
    found = first_row(t.patient_identifier, "patient_id", "patient_identifier_id", "identifier")
    assert rows(found, "patient_id", "identifier") == [(7, "id2")]


def test_unknown_care_model_and_tie(spark, clinic):
    p = ReportParams(date(2020, 6, 20))
    clinic.patient(1).visit(1, 1, 6, "2020-01-01").answer(1, 23732, value_coded=1256)
    clinic.patient(2).visit(2, 2, 6, "2020-01-01")
    clinic.answer(2, 23730, value_coded=1256).answer(2, 23724, value_coded=1256)
    found = D.dsd_model_enrolment(clinic.tables(spark), p)
    assert rows(found, "patient_id", "tipo_modelo") == [(1, "OUTRO MODELO"), (2, "Gaac (GA)")]


def test_second_moment(spark):
    days = ["2020-01-01", "2020-01-02", "2020-01-03"]
    data = [(n, at(d)) for n in (1, 2, 3) for d in days[:n] for _ in range(2)]
    df = spark.createDataFrame(data, "patient_id long, seen timestamp_ntz")
    found = first_second_last(df, "patient_id", "seen", ("a", "b", "c"))
    assert rows(found, "patient_id", "a", "b", "c") == [
        (1, at(days[0]), at(days[0]), at(days[0])),
        (2, at(days[0]), at(days[1]), at(days[1])),
        (3, at(days[0]), at(days[1]), at(days[2])),
    ]


def test_contact_from_pairs_of_answers(spark, clinic, june):
    """Against all pairs, on small visits with every mix of answers."""
    import itertools

    kinds = [(1611, "c"), (1611, None), (6224, "b"), (6224, None), (999, "a"), (999, None)]
    visits = [v for size in (1, 2, 3) for v in itertools.combinations(kinds, size)]
    expected = []
    for n, told in enumerate(visits):
        clinic.patient(n).visit(n, n, 5, "2020-01-01")
        for concept, text in told:
            clinic.answer(n, concept, value_text=text)
        pairs = [(a, b) for a in told for b in told if a[0] == 1611 or b[0] == 6224]
        if pairs:
            texts = [a[1] if a[1] is not None else b[1] for a, b in pairs]
            known = [x for x in texts if x is not None]
            expected.append((n, min(known) if known else None))
    found = dict(rows(A.reference_person_fallback(clinic.tables(spark), june), "patient_id", "pessoa"))
    assert found == dict(expected)


def test_two_openings_on_one_day_keep_both_diagnoses(spark, clinic):
    p = ReportParams(date(2020, 6, 20))
    clinic.patient(1).visit(1, 1, 5, "2020-01-01").answer(1, 6123, value_datetime=at("2019-12-01"))
    clinic.visit(2, 1, 53, "2020-02-01").answer(2, 1040, value_coded=1065)
    clinic.answer(2, 23891, value_datetime=at("2020-01-01"))
    clinic.patient(2).visit(3, 2, 53, "2020-02-01").answer(3, 23779, value_coded=664)
    clinic.answer(3, 23891, value_datetime=at("2020-01-01"))
    found = D.first_enrolment_with_diagnosis(clinic.tables(spark), p)
    assert rows(found, "patient_id", "data_diagnostico") == [(1, at("2019-12-01")), (1, at("2020-02-01"))]


def test_register_entries_multiply_within_a_visit(spark, clinic, june):
    clinic.add("location", location_id=1, name="S1")
    clinic.patient(1).visit(1, 1, 32, "2020-01-01").answer(1, 6263, value_coded=6260)
    clinic.answer(1, 6265, value_numeric=4.0).answer(1, 6265, value_numeric=4.0).answer(1, 6265, value_numeric=5.0)
    found = A.register_book(clinic.tables(spark), june)
    assert rows(found, "livro", "pagina", "linha") == [
        ("LIVRO 2", 4.0, None), ("LIVRO 2", 4.0, None), ("LIVRO 2", 5.0, None),
    ]


def test_status_words(spark):
    df = spark.createDataFrame(
        [("OBITO", None), (None, None), (None, at("2020-04-21")), (None, at("2020-04-20"))],
        "s string, d timestamp_ntz",
    )
    p = ReportParams(date(2020, 6, 20))
    shown = df.select(X.care_status(F.col("s"), F.col("d"), p.end, "SEM FILA"))
    assert [r[0] for r in shown.collect()] == ["OBITO", "SEM FILA", "ACTIVO", "ABANDONO NAO NOTIFICADO"]
