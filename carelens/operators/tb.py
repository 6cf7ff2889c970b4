"""TB screening, investigation and preventive treatment with isoniazid."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from carelens.functions import codes as C
from carelens.functions.scalars import months_between_rounded
from carelens.operators.choose import answers_by_moment, look_up
from carelens.operators.combine import repeat_rows, spread_join
from carelens.operators.evidence import Trait, any_of, concept, kind, live_patients, patient_traits, when
from carelens.params import ReportParams
from carelens.sources.tables import ClinicalTables


def _in_period(p: ReportParams, moment: str) -> str:
    return f"{moment} between {p.start_sql} and {p.end_sql}"


def _seen_in_period(p: ReportParams, ids: tuple[int, ...], more: str = "true") -> str:
    counts = f"{concept(*ids)} and {kind(*C.VISITS)} and {_in_period(p, 'encounter_datetime')} and {more}"
    return when(counts, "obs_datetime")


def screening_trait(p: ReportParams, answer: int, name: str) -> Trait:
    """Latest screening in the period with this answer."""
    moment = _seen_in_period(p, C.TB_SCREEN, f"value_coded = {answer}")
    return Trait(name, F.max, answer=moment, types=C.VISITS, concepts=C.TB_SCREEN)


def investigation_trait(p: ReportParams, name: str = "data_investigacao") -> Trait:
    moment = _seen_in_period(p, C.TB_INVESTIGATION)
    return Trait(name, F.max, answer=moment, types=C.VISITS, concepts=C.TB_INVESTIGATION)


def inh_start_trait(p: ReportParams, name: str = "data_inicio_inh") -> Trait:
    """Latest start in the period: a date answer, or a visit marked as start."""
    dated = f"{concept(C.INH_START)} and {kind(*C.VISITS)} and {_in_period(p, 'value_datetime')}"
    marked = (
        f"{concept(C.INH_COURSE)} and {kind(*C.VISITS)} and value_coded = {C.START}"
        f" and {_in_period(p, 'encounter_datetime')}"
    )
    return Trait(
        name,
        F.max,
        answer=f"coalesce({when(dated, 'value_datetime')}, {when(marked, 'encounter_datetime')})",
        types=C.VISITS,
        concepts=(C.INH_START, C.INH_COURSE),
    )


def inh_end_trait(p: ReportParams, name: str = "data_fim_inh") -> Trait:
    """Latest end: any date answer, or a visit up to the end marked as done."""
    types = (*C.VISITS, C.MASTER_CARD)
    dated = f"{concept(C.INH_END)} and {kind(*types)}"
    marked = (
        f"{concept(C.INH_COURSE)} and {kind(*C.VISITS)} and value_coded = {C.COMPLETED}"
        f" and encounter_datetime <= {p.end_sql}"
    )
    return Trait(
        name,
        F.max,
        answer=f"coalesce({when(dated, 'value_datetime')}, {when(marked, 'encounter_datetime')})",
        types=types,
        concepts=(C.INH_END, C.INH_COURSE),
    )


def tb_screening(t: ClinicalTables, p: ReportParams) -> DataFrame:
    found = patient_traits(
        t,
        p,
        screening_trait(p, C.NO, "data_rastreio_neg"),
        screening_trait(p, C.YES, "data_rastreio_pos"),
    )
    return live_patients(t, found)


_POSITIVE = any_of("value_coded", C.POSITIVE, C.YES)


def tb_investigation(t: ClinicalTables, p: ReportParams) -> DataFrame:
    """Results of the latest investigation; ties give several rows."""
    last = live_patients(t, patient_traits(t, p, investigation_trait(p)))
    result = f"case when {_POSITIVE} then 'POSITIVO' else 'NEGATIVO' end resultado"
    results = answers_by_moment(t, C.TB_INVESTIGATION, result, n="count(1)")
    rows = look_up(last, "data_investigacao", results, "inner")
    return repeat_rows(rows, F.col("n")).select("patient_id", "data_investigacao", "resultado")


def inh_start(t: ClinicalTables, p: ReportParams) -> DataFrame:
    return live_patients(t, patient_traits(t, p, inh_start_trait(p)))


def inh_end(t: ClinicalTables, p: ReportParams) -> DataFrame:
    return live_patients(t, patient_traits(t, p, inh_end_trait(p)))


def course_end() -> Column:
    """The end counts only with a start, and after it."""
    return F.expr(when("data_fim_inh > data_inicio_inh", "data_fim_inh"))


def inh_course(t: ClinicalTables, p: ReportParams) -> DataFrame:
    both = patient_traits(t, p, inh_start_trait(p), inh_end_trait(p))
    started = both.where("data_inicio_inh is not null")
    return live_patients(t, started.withColumn("data_fim_inh", course_end()))


def elapsed_days(p: ReportParams) -> Column:
    return F.when(F.col("data_fim_inh").isNull(), F.datediff(p.end, "data_inicio_inh"))


def elapsed_months(p: ReportParams) -> Column:
    return F.when(F.col("data_fim_inh").isNull(), months_between_rounded(p.end, "data_inicio_inh"))


def inh_elapsed(t: ClinicalTables, p: ReportParams) -> DataFrame:
    return inh_course(t, p).select(
        "patient_id", elapsed_days(p).alias("dias_inh"), elapsed_months(p).alias("meses_inh")
    )


def tpt_traits(p: ReportParams) -> tuple[Trait, ...]:
    return (
        screening_trait(p, C.NO, "data_rastreio_neg"),
        screening_trait(p, C.YES, "data_rastreio_pos"),
        investigation_trait(p),
        inh_start_trait(p),
        inh_end_trait(p),
    )


def with_tpt_rule(t: ClinicalTables, p: ReportParams, df: DataFrame) -> DataFrame:
    """Keep eligible patients of a frame with the ``tpt_traits``, and the
    number ``n_investigacao`` of investigation rows that make them eligible:
    all of them (at least one) after a negative screen, only the negative ones
    after a positive screen alone."""
    results = answers_by_moment(
        t,
        C.TB_INVESTIGATION,
        n_all="count(1)",
        n_negative=f"count_if(not coalesce({_POSITIVE}, false))",
    )
    rows = """case when data_rastreio_neg is not null then coalesce(n_all, 1L)
              when data_rastreio_pos is not null then coalesce(n_negative, 0L) else 0L end"""
    return (
        look_up(df.withColumn("data_fim_inh", course_end()), "data_investigacao", results)
        .withColumn("n_investigacao", F.expr(rows))
        .where(f"n_investigacao > 0 and (data_fim_inh is null or data_fim_inh > {p.end_sql})")
    )


def tpt_rule(t: ClinicalTables, p: ReportParams) -> DataFrame:
    """Patients eligible for preventive treatment."""
    found = live_patients(t, patient_traits(t, p, *tpt_traits(p)))
    return with_tpt_rule(t, p, found).select("patient_id", "data_inicio_inh", "data_fim_inh")


def patient_sites(t: ClinicalTables) -> DataFrame:
    """Distinct site names of each patient over all visits, deleted included.
    The pairs are reduced before the names are attached."""
    pairs = t.encounter.select("patient_id", "location_id").distinct()
    return spread_join(pairs, t.location, "location_id").select("patient_id", "name").distinct()
