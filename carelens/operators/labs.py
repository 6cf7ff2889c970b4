"""Viral load, CD4 and clinical stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from carelens.functions import codes as C
from carelens.functions.scalars import decode_sql, viral_load_text, viral_load_text_sql
from carelens.operators.choose import answers_by_moment, look_up
from carelens.operators.combine import repeat_rows
from carelens.operators.evidence import (
    any_vl_trait,
    first_cd4_trait,
    first_stage_trait,
    first_vl_trait,
    kind,
    last_vl_trait,
    live_patients,
    patient_traits,
    visit_answers,
    when,
)
from carelens.params import ReportParams
from carelens.sources.tables import ClinicalTables


def _latest(t: ClinicalTables, p: ReportParams) -> DataFrame:
    return live_patients(t, patient_traits(t, p, last_vl_trait(p)))


def last_viral_load(t: ClinicalTables, p: ReportParams) -> DataFrame:
    """Latest viral load as text; ties at that moment give several rows."""
    values = answers_by_moment(t, (C.VIRAL_LOAD,), "value_numeric", site=p, n="count(1)")
    rows = look_up(_latest(t, p), "data_carga", values, "inner")
    return repeat_rows(rows, F.col("n")).select(
        "patient_id", "data_carga", viral_load_text("value_numeric").alias("valor_carga")
    )


def over_three_months(p: ReportParams) -> str:
    return f"datediff({p.end_sql}, data_carga) / 30 > 3"


def vl_failure_filter(t: ClinicalTables, p: ReportParams) -> DataFrame:
    """Latest viral load of 1000 or more that is over three months old."""
    values = answers_by_moment(t, (C.VIRAL_LOAD,), "value_numeric", site=p, n="count(1)")
    rows = look_up(_latest(t, p), "data_carga", values, "inner").where(
        f"value_numeric >= 1000 and {over_three_months(p)}"
    )
    return repeat_rows(rows, F.col("n")).select(
        "patient_id", "data_carga", F.col("value_numeric").alias("valor_carga")
    )


def lowest_load_at_moment(t: ClinicalTables, p: ReportParams) -> DataFrame:
    """Per patient and moment: the smallest text and whether any load is
    below 1000."""
    return answers_by_moment(
        t,
        (C.VIRAL_LOAD,),
        site=p,
        valor_carga=f"min({viral_load_text_sql('value_numeric')})",
        suprimida=f"max({when('value_numeric < 1000', '1')})",
    )


def not_due(p: ReportParams) -> str:
    """Tested before, unless the latest load is suppressed and a year old.
    Reads ``tem_carga``, ``suprimida`` and ``data_carga``."""
    old = f"suprimida is not null and round(datediff({p.end_sql}, data_carga) / 30) >= 12"
    return f"(tem_carga is not null and not coalesce({old}, false))"


def vl_not_due_ids(t: ClinicalTables, p: ReportParams) -> DataFrame:
    seen = live_patients(t, patient_traits(t, p, any_vl_trait(p), last_vl_trait(p)))
    rows = look_up(seen, "data_carga", lowest_load_at_moment(t, p))
    return rows.where(not_due(p)).select("patient_id")


def suppressed_loads(t: ClinicalTables, p: ReportParams) -> DataFrame:
    """Every viral load below 1000 up to the end, one row per load."""
    rows = visit_answers(
        t, p, (*C.VIRAL_LOAD_VISITS, C.MASTER_CARD), (C.VIRAL_LOAD,), until_end=True
    ).where("value_numeric < 1000")
    return rows.selectExpr("patient_id", "value_numeric cv", "encounter_datetime data_cv")


def vl_suppressed_rows(t: ClinicalTables, p: ReportParams) -> DataFrame:
    return live_patients(t, suppressed_loads(t, p))


def highest_at_moment(t: ClinicalTables, concept: int, alias: str) -> DataFrame:
    return answers_by_moment(t, (concept,), **{alias: "max(value_numeric)"})


def first_vl_suppressed(t: ClinicalTables, p: ReportParams) -> DataFrame:
    """First viral load, if the highest value at that moment is below 1000."""
    first = patient_traits(t, p, first_vl_trait(p))
    highest = highest_at_moment(t, C.VIRAL_LOAD, "valor_primeira_carga")
    return (
        look_up(first, "data_primeiro_carga", highest, "inner")
        .where("valor_primeira_carga < 1000")
        .select("patient_id", "data_primeiro_carga", "valor_primeira_carga")
    )


def last_answer_moment(t: ClinicalTables, p: ReportParams, alias: str) -> DataFrame:
    """Latest answer to any question at a laboratory or clinical visit, deleted
    ones included. Answers are reduced to one row per visit before the join."""
    seen = t.encounter.where(
        f"{kind(*C.VIRAL_LOAD_VISITS)} and encounter_datetime <= {p.end_sql}"
    ).select("encounter_id", "patient_id")
    per_visit = t.obs.groupBy("encounter_id").agg(F.max("obs_datetime").alias("_at"))
    return per_visit.join(seen, "encounter_id").groupBy("patient_id").agg(F.max("_at").alias(alias))


def last_vl_unfiltered(t: ClinicalTables, p: ReportParams) -> DataFrame:
    """The viral load recorded at the latest answer of any kind, if any."""
    highest = highest_at_moment(t, C.VIRAL_LOAD, "valor_ultima_carga")
    rows = look_up(last_answer_moment(t, p, "data_ultima_carga"), "data_ultima_carga", highest, "inner")
    return rows.select("patient_id", "data_ultima_carga", "valor_ultima_carga")


def first_cd4(t: ClinicalTables, p: ReportParams) -> DataFrame:
    """First CD4 moment and the highest value at it."""
    first = patient_traits(t, p, first_cd4_trait(p))
    rows = look_up(first, "data_cd4", highest_at_moment(t, C.CD4, "cd4"), "inner")
    return rows.select("patient_id", "data_cd4", "cd4")


def stages_at_moment(t: ClinicalTables, p: ReportParams, n: str = "n") -> DataFrame:
    stage = f"{decode_sql('value_coded', C.STAGES, None)} estadio"
    rows = answers_by_moment(t, (C.STAGE,), stage, site=p, **{n: "count(1)"})
    return rows.where("estadio is not null")


def first_who_stage(t: ClinicalTables, p: ReportParams) -> DataFrame:
    """First stage; ties at that moment give several rows."""
    first = live_patients(t, patient_traits(t, p, first_stage_trait(p)))
    rows = look_up(first, "data_estadio", stages_at_moment(t, p), "inner")
    return repeat_rows(rows, F.col("n")).select("patient_id", "data_estadio", "estadio")
