"""Every operator and report as a named query over the star tables.

The clinical tables are derived from the star inside Spark, whole; a query never
restricts them beyond what its operator says.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from carelens.functions import codes as C
from carelens.functions import scalars as X
from carelens.operators import attach as A
from carelens.operators import differentiated as D
from carelens.operators import evidence as E
from carelens.operators import labs as L
from carelens.operators import status as S
from carelens.operators import tb as TB
from carelens.operators.choose import (
    answers_by_moment,
    earliest,
    first_row,
    first_second_last,
    latest,
    look_up,
    smallest_row,
)
from carelens.operators.combine import flag_exists, repeat_rows, union_distinct
from carelens.params import ReportParams
from carelens.plans.reports import REPORTS
from carelens.sources.star import clinical_from_star
from carelens.sources.tables import ClinicalTables, live

SITE = ReportParams(date(2000, 6, 20), date(1999, 6, 21), 1)
ALL_SITES = ReportParams(date(2000, 6, 20), date(1999, 6, 21))
WINDOW = ReportParams(date(1995, 7, 20), None, 1)
WHOLE = ReportParams(date(2002, 1, 1))

REPORT_PARAMS = {
    "three_pickups": WINDOW,
    "tpt_eligible": ALL_SITES,
    "dsd_followup": WHOLE,
}

_BUILD: dict[str, Callable[[ClinicalTables], DataFrame]] = {}


def query(build: Callable[[ClinicalTables], DataFrame]):
    _BUILD[build.__name__] = build
    return build


def _simple(name: str, build: Callable[[ClinicalTables], DataFrame]) -> None:
    _BUILD[name] = build


# --- scans, projections, filters ---------------------------------------------


@query
def scan_tables(t):
    counts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name, df in t.named().items()
    ]
    return reduce(DataFrame.unionByName, counts)


@query
def scan_live(t):
    return live(t.encounter).select("encounter_id", "patient_id", "encounter_type", "encounter_datetime")


@query
def result_set(t):
    return REPORTS["three_pickups"](t, WINDOW).select("patient_id", "estado", "levantou")


@query
def project_alias(t):
    return t.person_address.select(
        F.col("person_id").alias("patient_id"),
        *[F.col(a).alias(b) for a, b in zip(A.ADDRESS, A.ADDRESS_TITLES)],
    )


@query
def project_star(t):
    return t.patient_identifier.select("*")


@query
def filter_in_list(t):
    rows = t.encounter.where(F.col("encounter_type").isin(18, 6, 9))
    return rows.select("encounter_id", "encounter_type")


@query
def filter_range_inclusive(t):
    rows = t.encounter.where(F.col("encounter_datetime").between(SITE.start, SITE.end))
    return rows.select("encounter_id", "encounter_datetime")


@query
def filter_or_pairs(t):
    positive = ((F.col("concept_id") == C.PCR_TEST) & (F.col("value_coded") == C.POSITIVE)) | (
        F.col("concept_id").isin(C.RAPID_TEST_1, C.RAPID_TEST_2)
        & F.col("value_coded").isin(C.POSITIVE, C.YES)
    )
    return t.obs.where(positive).select("encounter_id", "concept_id", "value_coded")


@query
def filter_not_null(t):
    rows = t.obs.where((F.col("concept_id") == C.VIRAL_LOAD) & F.col("value_numeric").isNotNull())
    return rows.select("person_id", "obs_datetime", "value_numeric")


@query
def filter_computed_flag(t):
    seen = TB.tb_screening(t, ALL_SITES)
    flag = F.when(F.col("data_rastreio_neg").isNotNull(), F.lit("SIM")).otherwise(
        F.when(F.col("data_rastreio_pos") < ALL_SITES.end, F.lit("SIM")).otherwise(F.lit("NAO"))
    )
    return seen.where(flag == "SIM").select("patient_id")


# --- joins -------------------------------------------------------------------


@query
def join_inner_equi(t):
    rows = E.visit_answers(t, SITE, (18, 6, 9), (C.ART_MANAGEMENT,), site=False)
    return E.live_patients(t, rows).select("patient_id", "encounter_id", "value_coded")


@query
def join_left_equi(t):
    people = t.person.select(F.col("person_id").alias("patient_id"), "gender")
    return people.join(A.phone_attribute(t), "patient_id", "left")


@query
def join_left_filtered_right(t):
    booked = live(t.obs).where(F.col("concept_id") == C.NEXT_PICKUP)
    return E.visits(t, SITE, (C.PICKUP,)).select("encounter_id").join(
        booked.select("encounter_id", "value_datetime"), "encounter_id", "left"
    )


@query
def join_left_pred_on_left(t):
    enrolled = live(t.patient_program).select("patient_program_id", "program_id")
    turned = live(t.patient_state).select(F.col("patient_program_id").alias("_id"), "state")
    match = (F.col("patient_program_id") == F.col("_id")) & (F.col("program_id") == C.TREATMENT)
    return enrolled.join(turned, match, "left").drop("_id")


@query
def join_left_then_where(t):
    rows = t.encounter.where(F.col("encounter_type") == C.EXTERNAL_PICKUP).join(
        t.obs.select("encounter_id", "concept_id", "value_coded"), "encounter_id", "left"
    )
    given = (F.col("concept_id") == C.EXTERNAL_GIVEN) & (F.col("value_coded") == C.YES)
    return rows.where(given).select("encounter_id", "patient_id")


@query
def join_comma_where(t):
    last = latest(E.visits(t, SITE, (C.PICKUP,)), "patient_id", "encounter_datetime", "moment")
    rows = live(t.obs).where(F.col("concept_id") == C.REGIMEN)
    return last.join(
        rows.select(F.col("person_id").alias("patient_id"), F.col("obs_datetime").alias("moment"), "value_coded"),
        ["patient_id", "moment"],
    )


@query
def join_on_missing_where(t):
    first = earliest(live(t.patient_identifier), "patient_id", "patient_identifier_id", "patient_identifier_id")
    return t.patient_identifier.join(first, ["patient_id", "patient_identifier_id"]).select(
        "patient_id", "patient_identifier_id", "identifier"
    )


@query
def join_self_obs(t):
    dated = live(t.obs).where(F.col("concept_id") == C.FILE_DATE).select(
        "encounter_id", F.col("value_datetime").alias("data_abertura")
    )
    tests = live(t.obs).where(F.col("concept_id").isin(C.PCR_TEST, C.RAPID_TEST_1, C.RAPID_TEST_2))
    return tests.select("encounter_id", "concept_id", "value_coded").join(dated, "encounter_id")


@query
def join_theta_extra(t):
    starts = TB.inh_start(t, ALL_SITES)
    ends = TB.inh_end(t, ALL_SITES).withColumnRenamed("patient_id", "_id")
    match = (F.col("patient_id") == F.col("_id")) & (F.col("data_fim_inh") > F.col("data_inicio_inh"))
    return starts.join(ends, match, "left").drop("_id")


@query
def join_range_window(t):
    starts = E.art_start_in_window(t, WINDOW)
    pickups = E.visits(t, WINDOW, (C.PICKUP,), until_end=False).select(
        "patient_id", "encounter_id", "encounter_datetime"
    )
    near = "encounter_datetime between data_inicio and data_inicio + interval 99 days"
    return pickups.join(starts, "patient_id").where(near).drop("encounter_id")


@query
def join_semi(t):
    women = t.person.where(F.col("gender") == "F").select(F.col("person_id").alias("patient_id"))
    return women.join(E.pregnant_ids(t, SITE), "patient_id", "left_semi")


@query
def join_anti(t):
    return E.art_start(t, SITE).join(E.pregnant_ids(t, SITE), "patient_id", "left_anti")


@query
def join_flag_exists(t):
    ids = E.pregnant_ids(t, SITE, "suppressed")
    return flag_exists(E.art_start(t, SITE).select("patient_id"), ids, "patient_id", "gravida")


@query
def join_dim_lookup(t):
    rows = E.visits(t, SITE, (C.MASTER_CARD,), site=False).select("encounter_id", "location_id", "creator")
    users = t.users.select(F.col("user_id").alias("creator"), "username")
    named = rows.join(t.location, "location_id").join(users, "creator", "left")
    return named.select("encounter_id", "name", "username")


# --- aggregates and per-key selection ----------------------------------------


@query
def agg_min_max_by_key(t):
    rows = E.visits(t, SITE, (C.PICKUP,))
    return rows.groupBy("patient_id").agg(
        F.min("encounter_datetime").alias("primeiro"), F.max("encounter_datetime").alias("ultimo")
    )


@query
def agg_count(t):
    rows = E.visits(t, SITE, (C.PICKUP,), until_end=False).groupBy("patient_id")
    counted = rows.agg(F.count("encounter_datetime").alias("levantamentos"))
    return counted.withColumn("levantou", X.yes_flag(F.col("levantamentos") >= 3))


@query
def agg_having(t):
    rows = live(t.obs).where(F.col("concept_id") == C.VIRAL_LOAD).groupBy("person_id")
    return rows.agg(F.max("value_numeric").alias("maior_carga")).where(F.col("maior_carga") < 1000)


@query
def agg_having_tautology(t):
    # "some visit lies between the first and the last" holds for every patient
    rows = E.visits(t, WHOLE, C.COUNSELLING, site=False)
    return rows.groupBy("patient_id").agg(
        F.min("encounter_datetime").alias("primeira"), F.max("encounter_datetime").alias("ultima")
    )


@query
def agg_loose_group_by(t):
    rows = S.program_states(t, SITE, C.TREATMENT, tuple(C.TREATMENT_EXITS))
    return rows.groupBy("patient_id").agg(
        F.max("start_date").alias("data_estado"),
        F.max_by("state", F.struct("start_date", "state")).alias("estado_id"),
    )


@query
def distinct_rows(t):
    return t.encounter.select("patient_id", "location_id").distinct()


@query
def dedupe_by_key(t):
    names = t.person_name.select(F.col("person_id").alias("patient_id"), *A.NAME)
    phones = A.phone_attribute(t)
    return smallest_row(names.join(phones, "patient_id", "left"), "patient_id")


@query
def first_row_by_id(t):
    return (
        first_row(t.patient_identifier, "patient_id", "patient_identifier_id", "identifier")
        .join(A.first_name(t, "nome"), "patient_id", "left")
        .join(A.first_address(t), "patient_id", "left")
    )


@query
def latest_event(t):
    return latest(E.visits(t, SITE, C.VISITS), "patient_id", "encounter_datetime", "ultimo_segmento")


@query
def latest_event_join_value(t):
    last = latest(E.visits(t, SITE, (C.PICKUP,)), "patient_id", "encounter_datetime", "ultimo")
    booked = answers_by_moment(t, (C.NEXT_PICKUP,), "value_datetime", n="count(1)")
    return repeat_rows(look_up(last, "ultimo", booked, "inner"), F.col("n")).drop("n")


@query
def earliest_event_join_value(t):
    first = earliest(E.visits(t, SITE, (C.LABORATORY,)), "patient_id", "encounter_datetime", "primeiro")
    found = answers_by_moment(t, (C.CD4, C.VIRAL_LOAD), "value_numeric", n="count(1)")
    return repeat_rows(look_up(first, "primeiro", found, "inner"), F.col("n")).drop("n")


_simple(
    "first_second_last",
    lambda t: first_second_last(
        E.visits(t, SITE, C.VISITS), "patient_id", "encounter_datetime", ("primeira", "segunda", "ultima")
    ),
)


_simple(
    "union_distinct",
    lambda t: union_distinct(
        E.visits(t, SITE, (C.PICKUP,)).select("patient_id"),
        E.programs(t, SITE, (C.TREATMENT,)).select("patient_id"),
    ),
)


# --- scalar functions --------------------------------------------------------


def _names(t):
    return t.person_name.select("person_name_id", *A.NAME)


@query
def full_name(t):
    return _names(t).select(
        "person_name_id", X.full_name().alias("NomeCompleto"), X.short_name().alias("nome_curto")
    )


@query
def age_years_365(t):
    return t.person.select("person_id", X.age(SITE.end, "birthdate").alias("idade"))


@query
def age_years_360(t):
    return t.person.select("person_id", X.age(SITE.end, "birthdate", 360).alias("idade"))


@query
def child_flag(t):
    years = X.age(SITE.end, "birthdate")
    return t.person.select("person_id", X.child_flag(years).alias("crianca"))


@query
def fn_ifnull(t):
    return t.person_name.select("person_name_id", F.coalesce("middle_name", F.lit("")).alias("nome"))


@query
def fn_nested_if(t):
    rows = t.obs.where(F.col("concept_id").isin(6263, 6264))
    book = F.coalesce(X.decode("value_coded", {**C.PRE_BOOKS, **C.TREATMENT_BOOKS}, None), F.lit(""))
    return rows.select("encounter_id", "concept_id", book.alias("livro"))


@query
def fn_case(t):
    rows = t.obs.where(F.col("concept_id") == C.REFERRAL)
    return rows.select("encounter_id", X.decode("value_coded", C.REFERRALS, C.OTHER).alias("referencia"))


@query
def fn_round_datediff(t):
    return t.encounter.select(
        "encounter_id",
        F.datediff(SITE.end, "encounter_datetime").alias("dias"),
        X.months_between_rounded(SITE.end, "encounter_datetime").alias("meses"),
        (F.datediff(SITE.end, "encounter_datetime") / 30).alias("meses_exatos"),
    )


@query
def fn_add_days_months(t):
    return t.encounter.select(
        "encounter_id",
        X.plus_days("encounter_datetime", 60).alias("mais_60_dias"),
        X.plus_months("encounter_datetime", 6).alias("mais_6_meses"),
        X.plus_months("encounter_datetime", -10).alias("menos_10_meses"),
        F.to_date("date_created").alias("dia"),
    )


@query
def fn_min_max_count(t):
    return t.obs.groupBy("concept_id").agg(
        F.min("value_numeric").alias("menor"),
        F.max("value_numeric").alias("maior"),
        F.count("value_numeric").alias("n_valores"),
    )


@query
def fn_number_text(t):
    rows = t.obs.where(F.col("concept_id") == C.VIRAL_LOAD)
    return rows.select("encounter_id", X.viral_load_text("value_numeric").alias("valor_carga"))


# --- treatment start and pregnancy -------------------------------------------

for _key, _rule, _params in (
    ("art_start", "viral_load", SITE),
    ("art_start_three_pickups", "three_pickups", SITE),
    ("art_start_suppressed", "suppressed", SITE),
    ("art_start_all_sites", "all_sites", ALL_SITES),
    ("art_start_files", "files", SITE),
    ("art_start_cards", "cards", SITE),
):
    _simple(_key, lambda t, rule=_rule, p=_params: E.art_start(t, p, rule))

for _key, _rule in (
    ("pregnant_ids", "recent"),
    ("pregnant_ids_three_pickups", "three_pickups"),
    ("pregnant_ids_suppressed", "suppressed"),
):
    _simple(_key, lambda t, rule=_rule: E.pregnant_ids(t, SITE, rule))


@query
def art_start_plus_months(t):
    return E.art_start(t, SITE).select(
        "patient_id",
        X.plus_months("data_inicio", 6).alias("data6meses"),
        X.plus_months("data_inicio", 3).alias("data3meses"),
    )


@query
def months_on_art_filter(t):
    months = X.months_between_rounded(SITE.end, "data_inicio")
    days = F.datediff(SITE.end, "data_inicio")
    return E.art_start(t, SITE).where(months >= 3).select(
        "patient_id", (months >= 6).alias("seis_meses"), (days >= 180).alias("dias_180")
    )


# --- states, pickups, appointments -------------------------------------------


def _starts(t):
    return E.art_start(t, SITE)


@query
def next_appointment(t):
    rows = S.with_next_appointment(t, SITE, S.last_pickup_and_visit(t, SITE, _starts(t)))
    return rows.select("patient_id", "data_proximo_lev", "data_proximo_seguimento")


@query
def estimated_next_visit(t):
    rows = S.with_next_appointment(t, SITE, S.last_pickup_and_visit(t, SITE, _starts(t)))
    return rows.select("patient_id", S.estimated_next_visit().alias("data_proximo_seguimento_estimada"))


@query
def final_state(t):
    rows = S.last_pickup_and_visit(t, SITE, _starts(t))
    return S.with_final_state(t, SITE, rows).select("patient_id", "estado_final")


_OPERATORS = {
    "art_start_in_window": lambda t: E.art_start_in_window(t, WINDOW),
    "exit_state_at_end": lambda t: S.exit_state_at_end(t, SITE, _starts(t)),
    "open_exit_state": lambda t: S.open_exit_state(t, SITE),
    "open_pre_art_state": lambda t: S.open_pre_art_state(t, SITE),
    "transfer_in_ids": lambda t: S.transfer_in_ids(t, WINDOW),
    "last_pickup_and_visit": lambda t: S.last_pickup_and_visit(t, SITE, _starts(t)),
    "care_status_text": lambda t: S.care_status_rows(t, SITE),
    "last_visit_next_date": lambda t: S.last_visit_next_date(t, SITE),
    "last_pickup_next_date": lambda t: S.last_pickup_next_date(t, SITE),
    "last_pickup_multi_source": lambda t: S.last_pickup_multi_source(t, SITE),
    "pickups_within_99_days": lambda t: S.pickups_within_99_days(
        t, WINDOW, E.art_start_in_window(t, WINDOW)
    ),
    # laboratory
    "last_viral_load": lambda t: L.last_viral_load(t, SITE),
    "last_vl_unfiltered": lambda t: L.last_vl_unfiltered(t, ALL_SITES),
    "vl_failure_filter": lambda t: L.vl_failure_filter(t, SITE),
    "vl_suppressed_rows": lambda t: L.vl_suppressed_rows(t, SITE),
    "first_vl_suppressed": lambda t: L.first_vl_suppressed(t, ALL_SITES),
    "vl_not_due_ids": lambda t: L.vl_not_due_ids(t, SITE),
    "first_cd4": lambda t: L.first_cd4(t, SITE),
    "first_who_stage": lambda t: L.first_who_stage(t, SITE),
    # attachments
    "last_regimen": lambda t: A.last_regimen(t, SITE),
    "all_regimens": A.all_regimens,
    "referral_source": lambda t: A.referral_source(t, SITE),
    "reference_person": lambda t: A.reference_person(t, SITE),
    "reference_person_fallback": lambda t: A.reference_person_fallback(t, SITE),
    "phone_attribute": A.phone_attribute,
    "preferred_demographics": A.preferred_demographics,
    "file_opened_in_period": lambda t: A.file_opened_in_period(t, SITE, (5, 7, 53)),
    "part_b_opened": lambda t: A.part_b_opened(t, SITE),
    "register_book": lambda t: A.register_book(t, SITE),
    "program_enrolment": lambda t: reduce(
        DataFrame.unionByName,
        [
            A.program_enrolment(t, SITE, n, "date_enrolled").withColumn("program_id", F.lit(n))
            for n in (C.CARE, C.TREATMENT, C.TUBERCULOSIS, C.MATERNAL)
        ],
    ),
    # differentiated care
    "first_enrolment_with_diagnosis": lambda t: D.first_enrolment_with_diagnosis(t, WHOLE),
    "dsd_model_enrolment": lambda t: D.dsd_model_enrolment(t, WHOLE),
    "pickup_history": lambda t: D.pickup_history(t, WHOLE),
    "counselling_history": lambda t: D.counselling_history(t, WHOLE),
    "counselling_after_dsd": lambda t: D.counselling_after_dsd(t, WHOLE),
    # TB
    "tb_screening": lambda t: TB.tb_screening(t, ALL_SITES),
    "tb_investigation": lambda t: TB.tb_investigation(t, ALL_SITES),
    "inh_start": lambda t: TB.inh_start(t, ALL_SITES),
    "inh_end": lambda t: TB.inh_end(t, ALL_SITES),
    "inh_course": lambda t: TB.inh_course(t, ALL_SITES),
    "inh_elapsed": lambda t: TB.inh_elapsed(t, ALL_SITES),
    "tpt_rule": lambda t: TB.tpt_rule(t, ALL_SITES),
    "patient_sites": TB.patient_sites,
}
for _key, _op in _OPERATORS.items():
    _simple(_key, _op)

for _key, _report in REPORTS.items():
    _simple(_key, lambda t, report=_report, p=REPORT_PARAMS.get(_key, SITE): report(t, p))


def _bound(build: Callable[[ClinicalTables], DataFrame]):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(clinical_from_star(spark, sf_dir))

    return run


def on_tables(name: str, tables: ClinicalTables) -> DataFrame:
    """A query over clinical tables of one's own."""
    return _BUILD[name](tables)


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _bound(build) for name, build in _BUILD.items()}
