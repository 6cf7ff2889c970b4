"""Program states, latest pickups, next appointments and the state at the end."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from carelens.functions import codes as C
from carelens.functions.scalars import care_status, code_of_sql, decode_sql, moment_first_sql, moment_of_sql
from carelens.operators.choose import answers_by_moment, look_up
from carelens.operators.combine import repeat_rows, spread_join, tally
from carelens.operators.evidence import (
    any_of,
    in_start_window,
    last_given_trait,
    last_visit_trait,
    live_patients,
    patient_traits,
    programs,
    visits,
    when,
)
from carelens.params import ReportParams
from carelens.sources.tables import ClinicalTables


def program_states(t: ClinicalTables, p: ReportParams, program: int, states: tuple[int, ...]) -> DataFrame:
    """Live states of live enrolments at the site."""
    enrolled = programs(t, p, (program,)).select("patient_program_id", "patient_id", "date_enrolled")
    turned = t.patient_state.where(f"voided = 0 and {any_of('state', *states)}").select(
        "patient_program_id", "state", "start_date", "end_date"
    )
    return enrolled.join(turned, "patient_program_id")


def open_rows(t: ClinicalTables, p: ReportParams, program: int, texts: dict[int, str]) -> DataFrame:
    """States without an end date, begun up to the end."""
    rows = program_states(t, p, program, tuple(texts))
    return rows.where(f"end_date is null and start_date <= {p.end_sql}")


def latest_exit(t: ClinicalTables, p: ReportParams) -> DataFrame:
    """Latest open exit from treatment up to the end, one per patient: of two
    starting together the larger state. An exit with an end date, even a later
    one, does not count."""
    rows = open_rows(t, p, C.TREATMENT, C.TREATMENT_EXITS)
    return (
        rows.groupBy("patient_id")
        .agg(F.expr(f"max({moment_first_sql('start_date', 'state')})").alias("_exit"))
        .selectExpr(
            "patient_id", f"{moment_of_sql('_exit')} data_estado", f"cast({code_of_sql('_exit')} as int) estado_id"
        )
    )


def with_exit_state(t: ClinicalTables, p: ReportParams, starts: DataFrame) -> DataFrame:
    """Attach the exit state begun between treatment start and the end. The
    latest exit decides alone: when it precedes the start, so do all others."""
    counts = "data_estado >= data_inicio"
    return starts.join(latest_exit(t, p), "patient_id", "left").selectExpr(
        *starts.columns,
        f"{when(counts, 'data_estado')} data_estado",
        f"{when(counts, 'estado_id')} estado_id",
        f"{when(counts, decode_sql('estado_id', C.TREATMENT_EXITS, None))} estado",
    )


def exit_state_at_end(t: ClinicalTables, p: ReportParams, starts: DataFrame) -> DataFrame:
    return with_exit_state(t, p, starts).select("patient_id", "data_estado", "estado_id", "estado")


def open_states(
    t: ClinicalTables, p: ReportParams, program: int, texts: dict[int, str]
) -> DataFrame:
    """Open states begun up to the end, one row per state."""
    text = decode_sql("state", texts, C.OTHER)
    rows = open_rows(t, p, program, texts)
    return live_patients(
        t, rows.selectExpr("patient_id", "start_date data_saida", f"{text} estado")
    )


def open_exit_state(t: ClinicalTables, p: ReportParams) -> DataFrame:
    return open_states(t, p, C.TREATMENT, C.TREATMENT_EXITS)


def open_pre_art_state(t: ClinicalTables, p: ReportParams) -> DataFrame:
    return open_states(t, p, C.CARE, C.CARE_EXITS)


def transfer_in_ids(t: ClinicalTables, p: ReportParams) -> DataFrame:
    """Patients transferred in on the enrolment day, in the start window."""
    rows = program_states(t, p, C.TREATMENT, (C.TRANSFERRED_IN,)).where(
        f"start_date = date_enrolled and {in_start_window(p, 'start_date')}"
    )
    return live_patients(t, rows.select("patient_id").distinct())


def last_pickup_and_visit(t: ClinicalTables, p: ReportParams, starts: DataFrame) -> DataFrame:
    """Last pickup between treatment start and the end. The last visit shown
    by the reports is that same moment."""
    last = patient_traits(t, p, last_visit_trait(p, (C.PICKUP,), "data_fila"))
    pickup = when("data_fila >= data_inicio", "data_fila")
    return starts.join(last, "patient_id", "left").selectExpr(
        *starts.columns, f"{pickup} data_fila", f"{pickup} data_seguimento"
    )


def with_next_appointment(t: ClinicalTables, p: ReportParams, df: DataFrame) -> DataFrame:
    """Latest next pickup and next visit booked at the last pickup."""

    def booked(question: int) -> str:
        return f"max({when(f'concept_id = {question}', 'value_datetime')})"

    dates = answers_by_moment(
        t,
        (C.NEXT_PICKUP, C.NEXT_VISIT),
        site=p,
        data_proximo_lev=booked(C.NEXT_PICKUP),
        data_proximo_seguimento=booked(C.NEXT_VISIT),
    )
    return look_up(df, "data_fila", dates)


def estimated_next_visit() -> Column:
    """The booked next visit, else 30 days after the last one."""
    return F.expr("coalesce(data_proximo_seguimento, data_seguimento + interval 30 days)")


def final_state(p: ReportParams) -> Column:
    """The exit state, else abandoned when nothing is booked or the later date
    is over 60 days past, else active."""
    booked = "greatest(data_proximo_lev, data_proximo_seguimento_estimada)"
    late = f"{booked} is null or {p.end_sql} > {booked} + interval 60 days"
    return F.expr(
        f"coalesce(estado_id, case when {late} then {C.ABANDONED} else {C.ACTIVE} end)"
    )


def with_final_state(t: ClinicalTables, p: ReportParams, df: DataFrame) -> DataFrame:
    """From (patient_id, data_inicio, data_fila, ...) to the state at the end."""
    df = df.withColumn("data_seguimento", F.col("data_fila"))
    df = with_next_appointment(t, p, with_exit_state(t, p, df))
    return df.withColumn("data_proximo_seguimento_estimada", estimated_next_visit()).withColumn(
        "estado_final", final_state(p)
    )


def _booked_after(
    t: ClinicalTables, p: ReportParams, types: tuple[int, ...], moment: str, concept: int, booked: str
) -> DataFrame:
    last = live_patients(t, patient_traits(t, p, last_visit_trait(p, types, moment)))
    rows = look_up(last, moment, booked_dates(t, concept, booked))
    return repeat_rows(rows, F.coalesce("n", F.lit(1))).select("patient_id", moment, booked)


def booked_dates(t: ClinicalTables, concept: int, alias: str, n: str = "n") -> DataFrame:
    """Dates booked per patient and moment, with multiplicity, at any site."""
    return answers_by_moment(t, (concept,), f"value_datetime {alias}", **{n: "count(1)"})


def last_visit_next_date(t: ClinicalTables, p: ReportParams) -> DataFrame:
    """Last visit and the next visit booked there; ties give several rows."""
    return _booked_after(t, p, C.VISITS, "ultimo_segmento", C.NEXT_VISIT, "proxima_consulta")


def last_pickup_next_date(t: ClinicalTables, p: ReportParams) -> DataFrame:
    """Last pickup and the next pickup booked there; ties give several rows."""
    return _booked_after(t, p, (C.PICKUP,), "ultimo_levantamento", C.NEXT_PICKUP, "proximo_lev")


def last_pickup_multi_source(t: ClinicalTables, p: ReportParams) -> DataFrame:
    """Last pickup of each source (pharmacy form, external form marked as
    given) with the next date booked there: distinct rows."""
    pharmacy = last_visit_trait(p, (C.PICKUP,), "ultimo_levantamento")
    external = last_given_trait(p, "ultimo_levantamento")
    last = patient_traits(t, p, pharmacy).unionByName(patient_traits(t, p, external)).distinct()
    rows = look_up(
        live_patients(t, last), "ultimo_levantamento", booked_dates(t, C.NEXT_PICKUP, "proximo_lev")
    )
    return rows.select("patient_id", "ultimo_levantamento", "proximo_lev")


def pickups_within_99_days(
    t: ClinicalTables, p: ReportParams, starts: DataFrame, hot_rows: int | None = None
) -> DataFrame:
    """Pickups from treatment start to 99 days after, per patient of ``starts``
    (0 when transferred in)."""
    options = {} if hot_rows is None else {"hot_rows": hot_rows}
    first, last = p.end_minus_months_sql(4, plus_days=1), p.end_minus_months_sql(3)
    pickups = tally(
        visits(t, p, (C.PICKUP,), until_end=False).where(
            f"encounter_datetime between {first} and {last} + interval 99 days"
        ),
        "patient_id",
        "encounter_datetime",
    )
    moved = transfer_in_ids(t, p).withColumn("_moved", F.lit(True))
    own = starts.join(moved, "patient_id", "left")
    near = "encounter_datetime between data_inicio and data_inicio + interval 99 days"
    own = own.where("_moved is null").select("patient_id", "data_inicio").distinct()
    inside = spread_join(pickups, own, "patient_id", **options).where(near)
    counted = inside.groupBy("patient_id", "data_inicio").agg(F.sum("n").alias("levantamentos"))
    return starts.join(counted, ["patient_id", "data_inicio"], "left").select(
        *starts.columns, F.expr("coalesce(levantamentos, 0L)").alias("levantamentos")
    )


def care_status_rows(t: ClinicalTables, p: ReportParams) -> DataFrame:
    """Care status of each patient with a pickup, per open exit state."""
    rows = last_pickup_next_date(t, p).join(
        open_exit_state(t, p).select("patient_id", "estado"), "patient_id", "left"
    )
    status = care_status(F.col("estado"), F.col("proximo_lev"), p.end, "SEM FILA")
    return rows.withColumn("estado", status)
