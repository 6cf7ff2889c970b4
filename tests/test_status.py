from datetime import date

from carelens.operators import evidence as E
from carelens.operators import status as S
from carelens.params import ReportParams
from carelens.plans.reports import three_pickups
from conftest import at, rows


def _starts(spark, clinic, p):
    t = clinic.tables(spark)
    return t, E.art_start(t, p)


def test_latest_open_exit_wins_and_closed_ones_do_not_count(spark, june, clinic):
    for n in (1, 2, 3):
        clinic.patient(n).visit(n, n, 18, "2019-01-01").program(n, n, 2, "2019-01-01")
    clinic.state(1, 8, "2019-05-01").state(1, 9, "2019-06-01")
    clinic.state(2, 9, "2019-05-01", "2021-01-01")  # ends after the end, still closed
    clinic.state(3, 7, "2019-05-01").state(3, 10, "2019-05-01")  # tie: larger state
    t, starts = _starts(spark, clinic, june)
    found = S.exit_state_at_end(t, june, starts)
    assert rows(found, "patient_id", "estado_id", "estado") == [
        (1, 9, "ABANDONO"), (2, None, None), (3, 10, "OBITO"),
    ]


def _final(spark, clinic, p):
    t, starts = _starts(spark, clinic, p)
    found = S.with_final_state(t, p, S.last_pickup_and_visit(t, p, starts))
    return {r.patient_id: r for r in found.collect()}


def test_final_state_on_days_60_and_61(spark, june, clinic):
    clinic.patient(1).visit(1, 1, 18, "2020-03-01").answer(1, 5096, value_datetime=at("2020-04-21"))
    clinic.patient(2).visit(2, 2, 18, "2020-03-01").answer(2, 5096, value_datetime=at("2020-04-20"))
    found = _final(spark, clinic, june)
    assert found[1].estado_final == 6 and found[2].estado_final == 9


def test_final_state_without_any_booking(spark, june, clinic):
    clinic.patient(1).program(1, 1, 2, "2020-01-01")  # started, never picked up
    clinic.patient(2).visit(2, 2, 18, "2020-06-01")  # estimated visit only
    found = _final(spark, clinic, june)
    assert found[1].estado_final == 9
    assert found[2].estado_final == 6
    assert found[2].data_proximo_seguimento_estimada == at("2020-07-01")


def test_booking_at_a_later_visit_is_ignored(spark, june, clinic):
    clinic.patient(1).visit(1, 1, 18, "2020-01-01").visit(2, 1, 6, "2020-05-01")
    clinic.answer(2, 1410, value_datetime=at("2020-07-01"))
    found = _final(spark, clinic, june)
    assert found[1].data_seguimento == at("2020-01-01")
    assert found[1].data_proximo_seguimento is None and found[1].estado_final == 9


def test_latest_booking_of_ties(spark, june, clinic):
    clinic.patient(1).visit(1, 1, 18, "2020-06-01")
    clinic.answer(1, 5096, value_datetime=at("2020-07-01")).answer(1, 5096, value_datetime=at("2020-07-09"))
    assert _final(spark, clinic, june)[1].data_proximo_lev == at("2020-07-09")


WINDOW = ReportParams(date(2020, 7, 20), None, 1)


def test_pickups_within_99_days_and_transfer_in(spark, clinic):
    # start 2020-04-01: day 99 is 2020-07-09
    for n in (1, 2):
        clinic.patient(n)
        for k, day in enumerate(["2020-04-01", "2020-07-09", "2020-07-10"]):
            clinic.visit(10 * n + k, n, 18, day)
    clinic.program(2, 2, 2, "2020-04-02").state(2, 29, "2020-04-02")
    t = clinic.tables(spark)
    starts = E.art_start_in_window(t, WINDOW)
    for hot in (1, 1_000_000):
        found = S.pickups_within_99_days(t, WINDOW, starts, hot_rows=hot)
        assert rows(found, "patient_id", "levantamentos") == [(1, 2), (2, 0)]
    report = three_pickups(t, WINDOW)
    assert rows(report, "patient_id", "levantou") == [(1, ""), (2, "")]


def test_duplicate_exits_inflate_the_count(spark, clinic):
    clinic.patient(1).visit(1, 1, 18, "2020-04-01").visit(2, 1, 18, "2020-05-01")
    clinic.program(1, 1, 2, "2020-04-01").state(1, 9, "2020-05-01").state(1, 8, "2020-06-01")
    found = three_pickups(clinic.tables(spark), WINDOW)
    assert rows(found, "levantou", "estado", "data_saida") == [("SIM", "ABANDONO", at("2020-05-01"))]


def test_last_pickup_of_two_sources(spark, june, clinic):
    clinic.patient(1).visit(1, 1, 18, "2020-01-01").answer(1, 5096, value_datetime=at("2020-02-01"))
    clinic.visit(2, 1, 52, "2020-03-01").answer(2, 23865, value_coded=1065)
    found = S.last_pickup_multi_source(clinic.tables(spark), june)
    assert rows(found, "ultimo_levantamento", "proximo_lev") == [
        (at("2020-01-01"), at("2020-02-01")), (at("2020-03-01"), None),
    ]
