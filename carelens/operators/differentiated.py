"""Differentiated care: file opening, care model, pickups and counselling."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from carelens.functions import codes as C
from carelens.functions.scalars import (
    code_of_sql,
    decode_sql,
    moment_first_sql,
    moment_of_sql,
    moments_sql,
    second_moment_of_sql,
)
from carelens.operators.choose import first_second_last
from carelens.operators.evidence import (
    any_of,
    concept,
    live_patients,
    visit_answers,
    visits,
    when,
)
from carelens.params import ReportParams
from carelens.sources.tables import ClinicalTables, live

PICKUP_NAMES = ("primeiro_levantamento", "segundo_levantamento", "ultimo_levantamento")
COUNSELLING_NAMES = ("primeira_fichaapss", "segunda_fichaapss", "ultima_fichaapss")


def _earliest_pair(df: DataFrame) -> DataFrame:
    pair = moments_sql("data_abertura", "data_diagnostico")
    return df.groupBy("patient_id").agg(F.expr(f"min({pair})").alias("_pair")).selectExpr(
        "patient_id", f"{moment_of_sql('_pair')} data_abertura", f"{second_moment_of_sql('_pair')} data_diagnostico"
    )


def first_enrolment_with_diagnosis(t: ClinicalTables, p: ReportParams) -> DataFrame:
    """Earliest file opening with its diagnosis date, from opening visits or
    from master cards with a positive test; both when they open together."""
    opened = visit_answers(t, p, C.OPENINGS, (C.DIAGNOSIS_DATE,), site=False, until_end=True).selectExpr(
        "patient_id", "encounter_datetime data_abertura", "value_datetime data_diagnostico"
    )
    tests = (C.PCR_TEST, C.RAPID_TEST_1, C.RAPID_TEST_2)
    answers = visit_answers(
        t, p, (C.MASTER_CARD,), (C.FILE_DATE, *tests), site=False, until_end=False
    )
    positive = (
        f"({concept(C.PCR_TEST)} and value_coded = {C.POSITIVE}) or"
        f" ({concept(C.RAPID_TEST_1, C.RAPID_TEST_2)} and {any_of('value_coded', C.POSITIVE, C.YES)})"
    )
    dated = when(f"{concept(C.FILE_DATE)} and value_datetime <= {p.end_sql}", "value_datetime")
    cards = (
        answers.groupBy("patient_id", "encounter_id", "encounter_datetime")
        .agg(
            F.expr(f"min({dated})").alias("data_abertura"),
            F.expr(f"max({positive})").alias("_positive"),
        )
        .where("data_abertura is not null and _positive")
        .selectExpr("patient_id", "data_abertura", "encounter_datetime data_diagnostico")
    )
    found = _earliest_pair(opened).withColumn("_source", F.lit(0)).unionByName(
        _earliest_pair(cards).withColumn("_source", F.lit(1))
    )
    # At most one row per source, so one aggregate holds both.
    both = found.groupBy("patient_id").agg(
        F.min("data_abertura").alias("data_abertura"),
        *[
            F.expr(f"min({when(f'_source = {s}', c)})").alias(f"_{c}_{s}")
            for s in (0, 1)
            for c in ("data_abertura", "data_diagnostico")
        ],
    )
    shown = ", ".join(
        when(
            f"_data_abertura_{s} = data_abertura",
            f"named_struct('data_diagnostico', _data_diagnostico_{s})",
        )
        for s in (0, 1)
    )
    # at most two entries per patient
    kept = both.selectExpr(
        "patient_id",
        "data_abertura",
        f"explode(array_distinct(array_compact(array({shown})))) _row",
    ).select("patient_id", "data_abertura", "_row.data_diagnostico")
    return live_patients(t, kept)


def dsd_model_enrolment(t: ClinicalTables, p: ReportParams) -> DataFrame:
    """First visit at which a care model was started, with that model; of
    several at once the smallest code."""
    rows = visit_answers(t, p, (C.PICKUP, *C.VISITS), C.CARE_MODEL, site=False, until_end=True).where(
        f"value_coded = {C.START}"
    )
    first = rows.groupBy("patient_id").agg(
        F.expr(f"min({moment_first_sql('encounter_datetime', 'concept_id')})").alias("_first")
    )
    return live_patients(t, first).selectExpr(
        "patient_id",
        f"{moment_of_sql('_first')} data_inclusao_mdc",
        f"{decode_sql('cast(' + code_of_sql('_first') + ' as int)', C.CARE_MODELS, C.OTHER_MODEL)} tipo_modelo",
    )


def pickup_moments(t: ClinicalTables, p: ReportParams) -> DataFrame:
    rows = visits(t, p, (C.PICKUP,), site=False)
    return first_second_last(rows, "patient_id", "encounter_datetime", PICKUP_NAMES)


def pickup_history(t: ClinicalTables, p: ReportParams) -> DataFrame:
    """First, second and last pickup of live patients with any answer at a
    pickup or clinical visit."""
    answered = (
        visits(t, p, (C.PICKUP, *C.VISITS), site=False)
        .select("encounter_id", "patient_id")
        .join(live(t.obs).select("encounter_id"), "encounter_id", "left_semi")
        .select("patient_id")
        .distinct()
    )
    return live_patients(t, pickup_moments(t, p).join(answered, "patient_id", "left_semi"))


def counselling_history(t: ClinicalTables, p: ReportParams) -> DataFrame:
    """First, second and last counselling visit on the wanted form."""
    rows = visits(t, p, C.COUNSELLING, site=False).where(f"form_id = {C.COUNSELLING_FORM}")
    found = first_second_last(rows, "patient_id", "encounter_datetime", COUNSELLING_NAMES)
    return live_patients(t, found)


def counselling_after_dsd(t: ClinicalTables, p: ReportParams) -> DataFrame:
    """Patients whose first counselling is not before the care model."""
    return (
        dsd_model_enrolment(t, p)
        .join(counselling_history(t, p), "patient_id")
        .where("primeira_fichaapss >= data_inclusao_mdc")
    )
