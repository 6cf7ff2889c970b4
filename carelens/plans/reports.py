"""The nine reports.

Each is a chain: one pass that gathers all per-patient evidence, then look-ups
and per-patient attachments. Where several matches would multiply rows, either
the rule picks one (and it is picked before the join, per attachment, which
equals picking the smallest row of the product because the attachments are
independent), or the matches are carried as multiplicities and the copies are
made in the last step.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, functions as F

from carelens.functions import codes as C
from carelens.functions.scalars import (
    age,
    care_status,
    child_flag,
    code_of_sql,
    decode_sql,
    full_name,
    moment_first_sql,
    moment_of_sql,
    place_sql,
    short_name,
    text_at_sql,
    yes_flag,
)
from carelens.operators import attach as A
from carelens.operators import differentiated as D
from carelens.operators import evidence as E
from carelens.operators import labs as L
from carelens.operators import status as S
from carelens.operators import tb as TB
from carelens.operators.choose import answers_by_moment, look_up
from carelens.operators.combine import TILE_ROWS, product_join, repeat_rows, spread_join, tally, times
from carelens.params import ReportParams
from carelens.sources.tables import ClinicalTables, live


def _people(t: ClinicalTables, *columns: str) -> DataFrame:
    return t.person.withColumnRenamed("person_id", "patient_id").select("patient_id", *columns)


def _on_treatment(p: ReportParams, months: int) -> str:
    return f"round(datediff({p.end_sql}, data_inicio) / 30) >= {months}"


def _shown_name(column: str = "NomeCompleto") -> Column:
    """Without a name row the blanks between the parts remain."""
    return F.coalesce(F.col(column), F.lit("  ")).alias(column)


def _one_site(p: ReportParams) -> ReportParams:
    if p.location is None:
        raise ValueError("this report is made for one site: set location")
    return p


# --- viral load: eligible and failing ----------------------------------------


def _with_contact_details(t: ClinicalTables, p: ReportParams, df: DataFrame) -> DataFrame:
    phones = A.phone_attribute(t).groupBy("patient_id").agg(F.min("contacto").alias("contacto"))
    return (
        look_up(df, "data_fila", A.regimens_by_moment(t, p))
        .join(A.first_identifier(t, "nid"), "patient_id", "left")
        .join(A.first_name(t, "nome"), "patient_id", "left")
        .join(phones, "patient_id", "left")
        .join(A.smallest_referral(t, p), "patient_id", "left")
        .join(A.reference_person(t, p), "patient_id", "left")
        .join(A.first_address(t), "patient_id", "left")
        .withColumn("idade", age(p.end, "birthdate", 360))
        .withColumn("nome", _shown_name("nome"))
    )


_ELIGIBLE_HEAD = ("nid", "nome", "gender", "idade")
_BOOKED = ("data_fila", "data_proximo_lev", "data_seguimento", "data_proximo_seguimento", "patient_id")


def _eligible(t: ClinicalTables, p: ReportParams, months: int, pregnant: bool) -> DataFrame:
    """Active patients due for a viral-load test."""
    p = _one_site(p)
    people = _people(t, "gender", "birthdate")
    wanted = "gravida is null"
    if pregnant:
        people, wanted = people.where("gender = 'F'"), "gravida is not null"
    found = E.patient_traits(
        t,
        p,
        E.start_trait(p, "viral_load"),
        E.last_visit_trait(p, (C.PICKUP,), "data_fila"),
        E.pregnancy_trait(p, "recent"),
        E.any_vl_trait(p),
        E.last_vl_trait(p),
    ).where(f"data_inicio is not null and {_on_treatment(p, months)} and {wanted}")
    tested = look_up(
        E.live_patients(t, found).join(people, "patient_id"),
        "data_carga",
        L.lowest_load_at_moment(t, p),
    )
    due = tested.where(f"not {L.not_due(p)}")
    active = S.with_final_state(t, p, due).where(f"estado_final = {C.ACTIVE}")
    return _with_contact_details(t, p, active)


def vl_eligible_general(t: ClinicalTables, p: ReportParams) -> DataFrame:
    """Active, not pregnant, six months on treatment, due for a viral load."""
    return _eligible(t, p, 6, pregnant=False).select(
        *_ELIGIBLE_HEAD, *A.ADDRESS_TITLES, "contacto", "pessoa", "data_inicio", "ultimo_regime",
        "data_carga", "valor_carga", "referencia", *_BOOKED,
    )


def vl_eligible_pregnant(t: ClinicalTables, p: ReportParams) -> DataFrame:
    """Active pregnant women, three months on treatment, due for a viral load."""
    return _eligible(t, p, 3, pregnant=True).select(
        *_ELIGIBLE_HEAD, *A.ADDRESS_TITLES, "contacto", "pessoa", "referencia", "data_inicio",
        "ultimo_regime", "data_carga", "valor_carga", *_BOOKED,
    )


def vl_failure(t: ClinicalTables, p: ReportParams) -> DataFrame:
    """Active patients whose latest viral load is high and over 3 months old."""
    p = _one_site(p)
    found = E.patient_traits(
        t,
        p,
        E.start_trait(p, "viral_load"),
        E.last_visit_trait(p, (C.PICKUP,), "data_fila"),
        E.last_vl_trait(p),
    ).where(
        f"data_inicio is not null and {_on_treatment(p, 6)} and {L.over_three_months(p)}"
    )
    high = answers_by_moment(
        t,
        (C.VIRAL_LOAD,),
        site=p,
        valor_carga=f"min({E.when('value_numeric >= 1000', 'value_numeric')})",
    ).where("valor_carga is not null")
    tested = look_up(E.live_patients(t, found), "data_carga", high, "inner")
    active = S.with_final_state(t, p, tested).where(f"estado_final = {C.ACTIVE}")
    return _with_contact_details(
        t, p, active.join(_people(t, "gender", "birthdate"), "patient_id")
    ).select(
        *_ELIGIBLE_HEAD, "data_inicio", *A.ADDRESS_TITLES, "contacto", "pessoa", "referencia",
        "ultimo_regime", "data_carga", "valor_carga", *_BOOKED,
    )


# --- viral load: suppressed --------------------------------------------------


def vl_suppressed(t: ClinicalTables, p: ReportParams, **spread) -> DataFrame:
    """Patients at least 180 days on treatment with each load below 1000.

    The rows asked for are distinct, so every attachment is made distinct
    first; their product then has no duplicates."""
    p = _one_site(p)
    found = E.patient_traits(
        t,
        p,
        E.start_trait(p, "suppressed"),
        E.pregnancy_trait(p, "suppressed"),
        E.last_visit_trait(p, C.VISITS, "ultimo_segmento"),
        E.last_visit_trait(p, (C.PICKUP,), "_pharmacy"),
        E.last_given_trait(p, "_external"),
    ).where(f"data_inicio is not null and datediff({p.end_sql}, data_inicio) >= 180")

    # Both last pickups; without any, one row with no next date.
    pickups = "array_distinct(array_compact(array(_pharmacy, _external)))"
    spine = E.live_patients(t, found).selectExpr(
        "patient_id", "data_inicio", "gravida", "ultimo_segmento",
        f"explode_outer({pickups}) ultimo_levantamento",
    )
    spine = look_up(spine, "ultimo_levantamento", S.booked_dates(t, C.NEXT_PICKUP, "proximo_lev"))
    spine = look_up(
        spine, "ultimo_segmento", S.booked_dates(t, C.NEXT_VISIT, "proxima_consulta", "_m")
    )
    spine = spine.select(
        "patient_id", "data_inicio", "gravida", "proxima_consulta", "proximo_lev"
    ).distinct()

    names = A.preferred_names(t, live_only=False).select(
        "patient_id", short_name().alias("NomeCompleto")
    )
    years = age(p.end, "birthdate")
    one = (
        spine.join(A.preferred_identifiers(t).distinct(), "patient_id")
        .join(names.distinct(), "patient_id", "left")
        .join(A.preferred_addresses(t).distinct(), "patient_id", "left")
        .join(A.phone_attribute(t).distinct(), "patient_id", "left")
        .join(A.reference_person_fallback(t, p), "patient_id", "left")
        .join(_people(t, "gender", "birthdate"), "patient_id")
    )
    loads = L.suppressed_loads(t, p).distinct()
    return spread_join(loads, one, "patient_id", **spread).select(
        "patient_id",
        F.col("identifier").alias("NID"),
        "NomeCompleto",
        "gender",
        years.alias("idade_actual"),
        child_flag(years).alias("crianca"),
        "data_inicio",
        "cv",
        "data_cv",
        yes_flag(F.col("gravida").isNotNull()).alias("gravida"),
        "proxima_consulta",
        "proximo_lev",
        *A.ADDRESS_TITLES,
        "contacto",
        "pessoa",
    )


# --- files keyed in during a period ------------------------------------------


def _opened(t: ClinicalTables, p: ReportParams, types: tuple[int, ...]) -> DataFrame:
    """Openings of live persons, equal ones counted."""
    rows = A.openings(t, p, types).selectExpr(
        "patient_id", "encounter_datetime data_abertura", "creator"
    )
    return tally(rows, "patient_id", "data_abertura", "creator", n="n_opened")


def _profiles(t: ClinicalTables, opened: DataFrame, traits: DataFrame) -> DataFrame:
    """One row per live patient and person with an opening, with what is known
    of them."""
    ids = E.live_patients(t, opened.select("patient_id").distinct())
    return ids.join(A.live_people(t), "patient_id").join(traits, "patient_id", "left")


def _names(t: ClinicalTables) -> DataFrame:
    names = A.preferred_names(t, live_only=True).select("patient_id", full_name().alias("NomeCompleto"))
    return tally(names, "patient_id", "NomeCompleto", n="n_name")


def _enrolled(t: ClinicalTables, p: ReportParams, program: int, alias: str) -> DataFrame:
    rows = E.programs(t, p, (program,)).selectExpr("patient_id", f"date_enrolled {alias}")
    return tally(rows, "patient_id", alias, n=f"n_{alias}")


def _states(t: ClinicalTables, p: ReportParams, program: int, texts: dict[int, str], alias: str) -> DataFrame:
    rows = S.open_rows(t, p, program, texts)
    text = decode_sql("state", texts, C.OTHER)
    return tally(rows.selectExpr("patient_id", f"{text} {alias}"), "patient_id", alias, n=f"n_{alias}")


def _only_count(df: DataFrame, n: str) -> DataFrame:
    """An attachment that is not shown but still multiplies rows."""
    return df.groupBy("patient_id").agg(F.sum(n).alias(n))


def _addresses(t: ClinicalTables) -> DataFrame:
    return tally(A.preferred_addresses(t), "patient_id", n="n_address")


def _referrals(t: ClinicalTables, p: ReportParams) -> DataFrame:
    return tally(A.referral_rows(t, p), "patient_id", "referencia", n="n_referral")


def _with_users(t: ClinicalTables, df: DataFrame, **spread) -> DataFrame:
    """Attach the user who keyed in the file; one user may have keyed in most."""
    users = t.users.selectExpr("user_id creator", "username utilizador")
    return spread_join(df, users, "creator", "left", **spread)


def _combined(one: DataFrame, named: DataFrame, sides: tuple[DataFrame, ...], tile_rows: int) -> DataFrame:
    """Every opening of a patient with every combination of the attachments."""
    return product_join(
        one, [*((side, "left") for side in sides), (named, "inner")], "patient_id", tile_rows
    )


def entered_master_card(
    t: ClinicalTables, p: ReportParams, tile_rows: int = TILE_ROWS, **spread
) -> DataFrame:
    """Patients whose master card was keyed in during the period."""
    p = _one_site(p)
    opened = _opened(t, p, (C.MASTER_CARD,))
    traits = E.patient_traits(
        t,
        p,
        E.start_trait(p, "cards"),
        E.last_visit_trait(p, C.VISITS, "data_ultimo_segmento"),
        E.first_stage_trait(p),
        extra=E.start_extra(t, p, "cards"),
    )
    one = _profiles(t, opened, traits)
    one = look_up(
        one, "data_ultimo_segmento",
        S.booked_dates(t, C.NEXT_VISIT, "data_proximo_segmento", "n_visit"),
    )
    stages = answers_by_moment(
        t, (C.STAGE,), site=p, n_stage=f"count_if({E.any_of('value_coded', *C.STAGES)})"
    ).where("n_stage > 0")
    one = look_up(one, "data_estadio", stages)
    sides = (
        _names(t),
        A.first_identifier(t, "NID"),
        _referrals(t, p),
        _enrolled(t, p, C.CARE, "inscricao_cuidado"),
        _addresses(t),
        _only_count(_states(t, p, C.TREATMENT, C.TREATMENT_EXITS, "exit"), "n_exit"),
        _only_count(_enrolled(t, p, C.TUBERCULOSIS, "tb"), "n_tb"),
        _only_count(_enrolled(t, p, C.MATERNAL, "ptv"), "n_ptv"),
    )
    copies = times(
        "n_visit", "n_stage", "n_name", "n_referral", "n_inscricao_cuidado", "n_address",
        "n_exit", "n_tb", "n_ptv",
    )
    joined = _combined(one, _with_users(t, opened, **spread), sides, tile_rows)
    rows = A.with_ages(p, joined.withColumn("n_copies", copies), "data_abertura")
    return repeat_rows(rows, F.col("n_opened") * F.col("n_copies")).select(
        "patient_id", "NID", _shown_name(), "sexo", "dead", "death_date", "idade_abertura",
        "idade", "referencia", "inscricao_cuidado", "data_inicio", "data_ultimo_segmento",
        "data_proximo_segmento", "utilizador",
    )


def entered_full(
    t: ClinicalTables, p: ReportParams, tile_rows: int = TILE_ROWS, **spread
) -> DataFrame:
    """All files opened in the period, with registers, states, CD4 and stage."""
    p = _one_site(p)
    opened = _opened(t, p, (*C.OPENINGS, C.MASTER_CARD))
    traits = E.patient_traits(
        t,
        p,
        E.start_trait(p, "files"),
        E.last_visit_trait(p, C.VISITS, "data_ultimo_segmento"),
        E.last_visit_trait(p, (C.PICKUP,), "data_ultimo"),
        E.first_cd4_trait(p),
        E.first_stage_trait(p),
        A.part_b_trait(),
        extra=E.start_extra(t, p, "files"),
    )
    one = _profiles(t, opened, traits)
    one = look_up(
        one, "data_ultimo_segmento",
        S.booked_dates(t, C.NEXT_VISIT, "data_proximo_segmento", "n_visit"),
    )
    one = look_up(one, "data_ultimo", S.booked_dates(t, C.NEXT_PICKUP, "data_proximo", "n_pickup"))
    one = look_up(one, "data_cd4", L.highest_at_moment(t, C.CD4, "CD4"))
    one = look_up(one, "data_estadio", L.stages_at_moment(t, p, "n_stage"))

    def register(rows: DataFrame, name: str) -> DataFrame:
        titles = [f"{c} {name}_{c}" for c in ("livro", "pagina", "linha")]
        entered = f"data_inscricao data_inscricao_{name}"
        return rows.selectExpr("patient_id", entered, *titles, f"n_{name}")

    sides = (
        _names(t),
        A.first_identifier(t, "NID"),
        _referrals(t, p),
        register(A.pre_register(t, p, "n_pretarv", tile_rows), "pretarv"),
        register(A.treatment_register(t, p, "n_tarv", tile_rows), "tarv"),
        _enrolled(t, p, C.CARE, "inscricao_cuidado"),
        _enrolled(t, p, C.TREATMENT, "inscricao_tratamento"),
        _enrolled(t, p, C.TUBERCULOSIS, "programa_tb"),
        _enrolled(t, p, C.MATERNAL, "programa_ptv"),
        _states(t, p, C.CARE, C.CARE_EXITS, "pre"),
        _states(t, p, C.TREATMENT, C.TREATMENT_EXITS, "exit"),
        _addresses(t),
    )
    copies = times(
        "n_visit", "n_pickup", "n_stage", "n_name", "n_referral", "n_pretarv", "n_tarv",
        "n_inscricao_cuidado", "n_inscricao_tratamento", "n_programa_tb", "n_programa_ptv",
        "n_pre", "n_exit", "n_address",
    )
    joined = _combined(one, _with_users(t, opened, **spread), sides, tile_rows)
    rows = A.with_ages(p, joined.withColumn("n_copies", copies), "data_abertura")
    before = care_status(
        F.col("pre"), F.col("data_proximo_segmento"), p.end, "SEM DATA DA PROXIMA CONSULTA"
    )
    after = care_status(F.col("exit"), F.col("data_proximo"), p.end, "SEM FILA")
    return repeat_rows(rows, F.col("n_opened") * F.col("n_copies")).select(
        "patient_id", "NID", _shown_name(), "sexo", "dead", "death_date", "idade_abertura",
        "idade", F.col("data_abertura").alias("parteA"), "parteB", "referencia",
        "data_inscricao_pretarv", "pretarv_livro", "pretarv_pagina", "pretarv_linha",
        "inscricao_cuidado", before.alias("estado_pre_tarv"), "data_inicio",
        "data_inscricao_tarv", "tarv_livro", "tarv_pagina", "tarv_linha",
        "inscricao_tratamento", after.alias("estado_tarv"), "data_ultimo_segmento",
        "data_proximo_segmento", "data_ultimo", "data_proximo", "CD4", "estadio",
        "programa_tb", "programa_ptv", "utilizador",
    )


# --- differentiated care -----------------------------------------------------


def dsd_followup(t: ClinicalTables, p: ReportParams) -> DataFrame:
    """Patients in differentiated care whose first counselling came with or
    after the care model; distinct rows, so attachments are made distinct."""
    p = replace(p, location=None)
    started = E.patient_traits(
        t,
        p,
        E.start_trait(p, "all_sites", "data_inicio_tarv"),
        E.first_vl_trait(p),
        extra=E.start_extra(t, p, "all_sites", "data_inicio_tarv"),
    )
    first = L.highest_at_moment(t, C.VIRAL_LOAD, "valor_primeira_carga").where(
        "valor_primeira_carga < 1000"
    )
    names = A.preferred_names(t, live_only=False).select("patient_id", full_name().alias("NomeCompleto"))
    # A patient with a care model has an answer at a live visit, which is all
    # that the pickup history asks for besides pickups.
    kept = (
        D.counselling_after_dsd(t, p)
        .join(D.first_enrolment_with_diagnosis(t, p).drop("data_abertura").distinct(), "patient_id")
        .join(started, "patient_id", "left")
        .join(L.last_answer_moment(t, p, "data_ultima_carga"), "patient_id", "left")
    )
    kept = look_up(kept, "data_primeiro_carga", first)
    kept = look_up(
        kept, "data_ultima_carga", L.highest_at_moment(t, C.VIRAL_LOAD, "carga_viral_MDS")
    )
    return (
        kept.join(D.pickup_moments(t, p), "patient_id", "left")
        .join(A.all_regimens(t).distinct(), "patient_id", "left")
        .join(A.first_identifier(t, "NID"), "patient_id", "left")
        .join(_people(t, "gender", "birthdate"), "patient_id", "left")
        .join(names.distinct(), "patient_id", "left")
        .select(
            "patient_id",
            "NID",
            _shown_name(),
            age(p.end, "birthdate").alias("idade_actual"),
            F.col("gender").alias("sexo"),
            "data_diagnostico",
            "data_inicio_tarv",
            F.coalesce("ultimo_regime", F.lit(C.OTHER)).alias("ultimo_regime"),
            F.when(F.col("valor_primeira_carga").isNotNull(), F.col("data_primeiro_carga")).alias(
                "data_primeira_cv_suprimida"
            ),
            F.col("valor_primeira_carga").alias("primeira_cv_suprimida"),
            "data_inclusao_mdc",
            "tipo_modelo",
            "carga_viral_MDS",
            *[F.col(c).alias(f"{c}_MDS") for c in D.PICKUP_NAMES],
            *D.COUNSELLING_NAMES,
        )
    )


# --- three consecutive pickups -----------------------------------------------


def three_pickups(t: ClinicalTables, p: ReportParams, **spread) -> DataFrame:
    """Whether patients who started three to four months before the end picked
    up drugs three times in 99 days. The count is taken over the joined rows,
    so it is the product of all multiplicities."""
    p = _one_site(p)
    found = E.patient_traits(
        t,
        p,
        E.start_trait(p, "three_pickups"),
        E.pregnancy_trait(p, "three_pickups"),
        E.last_visit_trait(p, C.VISITS, "data_ultimo"),
        E.last_visit_trait(p, (C.PICKUP,), "ultimo_levantamento"),
    ).where(E.in_start_window(p, "data_inicio"))
    df = S.pickups_within_99_days(t, p, E.live_patients(t, found), **spread)

    def booked(concept: int, alias: str, n: str) -> DataFrame:
        return answers_by_moment(
            t, (concept,), **{alias: "min(value_datetime)", n: "count(1)"}
        )

    df = look_up(df, "data_ultimo", booked(C.NEXT_VISIT, "proximo_consulta", "n_visit"))
    df = look_up(df, "ultimo_levantamento", booked(C.NEXT_PICKUP, "data_proximo", "n_pickup"))
    exits = (
        S.open_rows(t, p, C.TREATMENT, C.TREATMENT_EXITS)
        .groupBy("patient_id")
        .agg(
            F.expr(f"min({moment_first_sql('start_date', place_sql('state', C.TREATMENT_EXITS, C.OTHER))})").alias("_exit"),
            F.count(F.lit(1)).alias("n_exit"),
        )
        .selectExpr(
            "patient_id",
            f"{text_at_sql(code_of_sql('_exit'), C.TREATMENT_EXITS, C.OTHER)} estado",
            f"{moment_of_sql('_exit')} data_saida",
            "n_exit",
        )
    )
    names = (
        A.preferred_names(t, live_only=False)
        .groupBy("patient_id")
        .agg(F.min(full_name()).alias("NomeCompleto"), F.count(F.lit(1)).alias("n_name"))
    )
    counted = F.col("levantamentos") * times("n_visit", "n_pickup", "n_exit", "n_name")
    return (
        df.join(A.first_identifier(t, "NID"), "patient_id", "left")
        .join(_people(t, "gender", "birthdate"), "patient_id", "left")
        .join(names, "patient_id", "left")
        .join(exits, "patient_id", "left")
        .select(
            "patient_id",
            "NID",
            _shown_name(),
            age(p.end, "birthdate").alias("idade_actual"),
            "gender",
            "data_inicio",
            yes_flag(F.col("gravida").isNotNull()).alias("gravida"),
            "data_ultimo",
            "proximo_consulta",
            "ultimo_levantamento",
            "data_proximo",
            "data_saida",
            care_status(F.col("estado"), F.col("data_proximo"), p.end, "SEM FILA").alias("estado"),
            yes_flag(counted >= 3).alias("levantou"),
        )
    )


# --- TB preventive treatment -------------------------------------------------


def tpt_eligible(t: ClinicalTables, p: ReportParams) -> DataFrame:
    """Patients enrolled in the period who are eligible for TB preventive
    treatment; one row per enrolment visit, site, name and tie."""
    p = replace(p, location=None)
    visits = E.visits(t, p, (C.PRE_REGISTER, C.MASTER_CARD), site=False).where(
        f"encounter_datetime >= {p.start_sql}"
    )
    enrolled = E.live_patients(t, tally(visits, "patient_id", n="n_enrolled"))
    traits = E.patient_traits(
        t,
        p,
        *TB.tpt_traits(p),
        E.start_trait(p, "all_sites", "data_inicio_tarv"),
        E.last_visit_trait(p, C.VISITS, "ultimo_segmento"),
        extra=E.start_extra(t, p, "all_sites", "data_inicio_tarv"),
    )
    kept = TB.with_tpt_rule(t, p, enrolled.join(traits, "patient_id", "left"))
    kept = look_up(
        kept, "ultimo_segmento", answers_by_moment(t, (C.NEXT_VISIT,), n_visit="count(1)")
    )
    names = live(t.person_name).withColumnRenamed("person_id", "patient_id").select(
        "patient_id", full_name().alias("NomeCompleto")
    )
    people = live(t.person).withColumnRenamed("person_id", "patient_id")
    rows = (
        kept.join(TB.patient_sites(t), "patient_id")
        .join(A.first_identifier(t, "NID"), "patient_id", "left")
        .join(people.select("patient_id", "gender", "birthdate"), "patient_id", "left")
        .join(tally(names, "patient_id", "NomeCompleto", n="n_name"), "patient_id", "left")
    )
    copies = F.col("n_enrolled") * F.col("n_investigacao") * times("n_visit", "n_name")
    return repeat_rows(rows, copies).select(
        "name",
        "patient_id",
        "NID",
        _shown_name(),
        "gender",
        age(p.end, "birthdate").alias("idade_actual"),
        "data_inicio_inh",
        "data_fim_inh",
        "data_inicio_tarv",
        TB.elapsed_days(p).alias("dias_inh"),
        TB.elapsed_months(p).alias("meses_inh"),
    )


REPORTS: dict[str, Callable[[ClinicalTables, ReportParams], DataFrame]] = {
    f.__name__: f
    for f in (
        vl_eligible_general,
        vl_eligible_pregnant,
        vl_failure,
        vl_suppressed,
        entered_master_card,
        entered_full,
        dsd_followup,
        three_pickups,
        tpt_eligible,
    )
}
