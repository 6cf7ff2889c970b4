"""Evidence about patients, gathered in one pass.

A report needs many facts per patient ("first treatment date", "ever pregnant",
"latest viral load", ...), each over visits and their coded answers. They are
all expressed as conditional minima or maxima and computed together: one join of
visits to answers, one aggregate per patient with a map-side part. The live
patient test and every other per-patient test come after that aggregate.

Conditions are SQL expressions over the columns of ``visit_answers``, of the
visits, or of the program enrolments.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from carelens.functions import codes as C
from carelens.params import ReportParams
from carelens.sources.tables import ClinicalTables, live


def any_of(column: str, *values: int) -> str:
    return f"{column} in ({', '.join(map(str, values))})"


def concept(*ids: int) -> str:
    return any_of("concept_id", *ids)


def kind(*types: int) -> str:
    return any_of("encounter_type", *types)


def when(condition: str, value: str) -> str:
    return f"case when {condition} then {value} end"


def at_site(df: DataFrame, p: ReportParams) -> DataFrame:
    return df if p.location is None else df.where(p.site_sql)


def live_patients(t: ClinicalTables, df: DataFrame) -> DataFrame:
    """Rows of patients that are not deleted. Reports apply it to frames with
    one row per patient; where an operator applies it to all its rows, both
    sides are plain shuffles, which run-time skew handling can split."""
    return df.join(live(t.patient).select("patient_id"), "patient_id", "left_semi")


def visits(
    t: ClinicalTables,
    p: ReportParams,
    types: tuple[int, ...],
    *,
    site: bool = True,
    until_end: bool = True,
) -> DataFrame:
    """Live visits of some types."""
    tests = ["voided = 0", kind(*types)]
    if site:
        tests.append(p.site_sql)
    if until_end:
        tests.append(f"encounter_datetime <= {p.end_sql}")
    return t.encounter.where(" and ".join(tests))


def answers(t: ClinicalTables, *concepts: int) -> DataFrame:
    """Live answers to some concepts."""
    return t.obs.where(f"voided = 0 and {concept(*concepts)}")


def visit_answers(
    t: ClinicalTables,
    p: ReportParams,
    types: tuple[int, ...],
    concepts: tuple[int, ...],
    *,
    site: bool = True,
    until_end: bool = False,
) -> DataFrame:
    """Live answers to some concepts given at live visits of some types."""
    seen = visits(t, p, types, site=site, until_end=until_end).select(
        "encounter_id", "patient_id", "encounter_type", "encounter_datetime"
    )
    told = answers(t, *concepts).select(
        "encounter_id", "concept_id", "obs_datetime", "location_id",
        "value_coded", "value_numeric", "value_datetime", "value_text",
    )
    return seen.join(told, "encounter_id")


def programs(t: ClinicalTables, p: ReportParams, wanted: tuple[int, ...], *, site: bool = True) -> DataFrame:
    tests = ["voided = 0", any_of("program_id", *wanted)]
    if site:
        tests.append(p.site_sql)
    return t.patient_program.where(" and ".join(tests))


@dataclass(frozen=True)
class Trait:
    """One value per patient: ``pick`` (F.min or F.max) of a value read from the
    answers, the visits and/or the program enrolments. The value expressions are
    null for rows that do not count."""

    name: str
    pick: Callable[[str], Column]
    answer: str | None = None
    types: tuple[int, ...] = ()
    concepts: tuple[int, ...] = ()
    visit: str | None = None
    visit_types: tuple[int, ...] = ()
    program: str | None = None
    program_ids: tuple[int, ...] = ()


def _merged(groups) -> tuple[int, ...]:
    return tuple(sorted({x for group in groups for x in group}))


def patient_traits(
    t: ClinicalTables, p: ReportParams, *traits: Trait, extra: tuple[DataFrame, ...] = ()
) -> DataFrame:
    """One row per patient with at least one trait. ``extra`` holds further
    (patient_id, trait) rows."""
    parts = list(extra)
    asked = [x for x in traits if x.answer is not None]
    if asked:
        rows = visit_answers(
            t, p, _merged(x.types for x in asked), _merged(x.concepts for x in asked)
        )
        parts.append(rows.selectExpr("patient_id", *[f"{x.answer} {x.name}" for x in asked]))
    seen = [x for x in traits if x.visit is not None]
    if seen:
        rows = visits(t, p, _merged(x.visit_types for x in seen), until_end=False)
        parts.append(rows.selectExpr("patient_id", *[f"{x.visit} {x.name}" for x in seen]))
    enrolled = [x for x in traits if x.program is not None]
    if enrolled:
        rows = programs(t, p, _merged(x.program_ids for x in enrolled))
        parts.append(rows.selectExpr("patient_id", *[f"{x.program} {x.name}" for x in enrolled]))
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    known = " or ".join(f"{x.name} is not null" for x in traits)
    return rows.where(known).groupBy("patient_id").agg(
        *[x.pick(x.name).alias(x.name) for x in traits]
    )


# --- treatment start ---------------------------------------------------------


@dataclass(frozen=True)
class StartRule:
    """Which evidence counts as the start of treatment."""

    management: tuple[int, ...]  # visit types of "treatment management: start"
    dated: tuple[int, ...]  # visit types of the recorded start date
    other_sources: bool = True  # enrolment and first pickup; all up to the end
    given: bool = False  # external pickup form marked as given
    external_date: bool = False  # date on an external pickup form
    answer_site: bool = False  # start dates go by the site of the answer


START_RULES = {
    "viral_load": StartRule((18, 6, 9), (18, 6, 9)),
    "three_pickups": StartRule((18, 6, 9, 53), (18, 6, 9, 53)),
    "suppressed": StartRule((18, 6, 9), (18, 6, 9, 53), given=True),
    "all_sites": StartRule((18, 6, 9), (18, 6, 9, 53), external_date=True),
    "files": StartRule((6, 9), (6, 9), other_sources=False, answer_site=True),
    "cards": StartRule((), (6, 9), other_sources=False, answer_site=True),
}

_GIVEN = f"{concept(C.EXTERNAL_GIVEN)} and value_coded = {C.YES} and {kind(C.EXTERNAL_PICKUP)}"


def start_trait(p: ReportParams, rule: str, name: str = "data_inicio") -> Trait:
    r = START_RULES[rule]

    def dated(condition: str, moment: str) -> str:
        bound = f" and {moment} <= {p.end_sql}" if r.other_sources else ""
        return when(condition + bound, moment)

    branches, types, concepts = [], [], []
    if r.management:
        started = f"{concept(C.ART_MANAGEMENT)} and value_coded = {C.START}"
        branches.append(dated(f"{started} and {kind(*r.management)}", "encounter_datetime"))
        types += r.management
        concepts.append(C.ART_MANAGEMENT)
    if not r.answer_site:
        branches.append(dated(f"{concept(C.ART_START_DATE)} and {kind(*r.dated)}", "value_datetime"))
        types += r.dated
        concepts.append(C.ART_START_DATE)
    if r.given:
        branches.append(dated(_GIVEN, "encounter_datetime"))
        types.append(C.EXTERNAL_PICKUP)
        concepts.append(C.EXTERNAL_GIVEN)
    others = r.other_sources
    return Trait(
        name,
        F.min,
        answer=f"coalesce({', '.join(branches)})" if branches else None,
        types=tuple(types),
        concepts=tuple(concepts),
        visit=dated(kind(C.PICKUP), "encounter_datetime") if others else None,
        visit_types=(C.PICKUP,),
        program=dated(any_of("program_id", C.TREATMENT), "date_enrolled") if others else None,
        program_ids=(C.TREATMENT,),
    )


def start_extra(t: ClinicalTables, p: ReportParams, rule: str, name: str = "data_inicio") -> tuple[DataFrame, ...]:
    """Start evidence that is not a plain answer at a visit of the site."""
    r = START_RULES[rule]
    found = []
    if r.answer_site:
        rows = at_site(visit_answers(t, p, r.dated, (C.ART_START_DATE,), site=False), p)
        found.append(rows.selectExpr("patient_id", f"value_datetime {name}"))
    if r.external_date:
        # The form counts when any of its answers is "yes", whatever the question.
        forms = (
            t.obs.where(f"voided = 0 and ({concept(C.EXTERNAL_DATE)} or value_coded = {C.YES})")
            .select("encounter_id", "concept_id", "value_coded", "value_datetime")
            .join(
                visits(t, p, (C.EXTERNAL_PICKUP,), until_end=False).select("encounter_id", "patient_id"),
                "encounter_id",
            )
        )
        dated = when(
            f"{concept(C.EXTERNAL_DATE)} and value_datetime <= {p.end_sql}", "value_datetime"
        )
        found.append(
            forms.groupBy("encounter_id", "patient_id")
            .agg(F.expr(f"min({dated})").alias(name), F.expr(f"max(value_coded = {C.YES})").alias("_yes"))
            .where("_yes")
            .select("patient_id", name)
        )
    return tuple(found)


def art_start(t: ClinicalTables, p: ReportParams, rule: str = "viral_load") -> DataFrame:
    """Earliest treatment start of each live patient."""
    found = patient_traits(t, p, start_trait(p, rule), extra=start_extra(t, p, rule))
    return live_patients(t, found)


def in_start_window(p: ReportParams, column: str) -> str:
    first, last = p.end_minus_months_sql(4, plus_days=1), p.end_minus_months_sql(3)
    return f"{column} between {first} and {last}"


def art_start_in_window(t: ClinicalTables, p: ReportParams) -> DataFrame:
    """Patients who started between three and four months before the end."""
    return art_start(t, p, "three_pickups").where(in_start_window(p, "data_inicio"))


# --- pregnancy ---------------------------------------------------------------


@dataclass(frozen=True)
class PregnancyRule:
    types: tuple[int, ...]
    answers: tuple[int, ...]
    months: int | None = None  # only this far back from the end
    card: bool = False  # the master card's own question also counts


PREGNANCY_RULES = {
    "recent": PregnancyRule((5, 6), (C.PREGNANT_YES,), months=10),
    "three_pickups": PregnancyRule((5, 6, 53), (C.PREGNANT_YES,)),
    "suppressed": PregnancyRule((5, 6), (C.PREGNANT_YES, C.PREGNANT_ALSO), card=True),
}


def pregnancy_trait(p: ReportParams, rule: str, name: str = "gravida") -> Trait:
    """1 for a patient with any evidence of pregnancy."""
    r = PREGNANCY_RULES[rule]

    def in_time(moment: str) -> str:
        if r.months is None:
            return f"{moment} <= {p.end_sql}"
        return f"{moment} between {p.end_minus_months_sql(r.months)} and {p.end_sql}"

    said = f"({concept(C.PREGNANT)} and {any_of('value_coded', *r.answers)})"
    implied = concept(C.PREGNANCY_WEEKS, C.DUE_DATE)
    counts = f"({kind(*r.types)} and ({said} or {implied}))"
    types, concepts = r.types, (C.PREGNANT, C.PREGNANCY_WEEKS, C.DUE_DATE)
    if r.card:
        counts += f" or ({kind(C.MASTER_CARD)} and {concept(C.PREGNANT_CARD)} and value_coded = {C.YES})"
        types, concepts = (*types, C.MASTER_CARD), (*concepts, C.PREGNANT_CARD)
    return Trait(
        name,
        F.max,
        answer=when(f"({counts}) and {in_time('encounter_datetime')}", "1"),
        types=types,
        concepts=concepts,
        program=when(f"program_id = {C.MATERNAL} and {in_time('date_enrolled')}", "1"),
        program_ids=(C.MATERNAL,),
    )


def pregnant_ids(t: ClinicalTables, p: ReportParams, rule: str = "recent") -> DataFrame:
    """Patients with evidence of pregnancy. Answers count for live patients;
    an enrolment in the maternal program counts for any."""
    whole = pregnancy_trait(p, rule)
    told = Trait("gravida", F.max, answer=whole.answer, types=whole.types, concepts=whole.concepts)
    enrolled = Trait("gravida", F.max, program=whole.program, program_ids=whole.program_ids)
    return (
        live_patients(t, patient_traits(t, p, told))
        .unionByName(patient_traits(t, p, enrolled))
        .select("patient_id")
        .distinct()
    )


# --- first and latest events -------------------------------------------------


def _event(
    p: ReportParams, name: str, pick, moment: str, types: tuple[int, ...], ids: tuple[int, ...], more: str = "true"
) -> Trait:
    """Moment of the first or latest answer to a concept up to the end."""
    counts = f"{concept(*ids)} and {kind(*types)} and encounter_datetime <= {p.end_sql} and {more}"
    return Trait(name, pick, answer=when(counts, moment), types=types, concepts=ids)


def last_visit_trait(p: ReportParams, types: tuple[int, ...], name: str) -> Trait:
    counts = f"{kind(*types)} and encounter_datetime <= {p.end_sql}"
    return Trait(name, F.max, visit=when(counts, "encounter_datetime"), visit_types=types)


def last_given_trait(p: ReportParams, name: str) -> Trait:
    """Latest external pickup form marked as given."""
    return _event(
        p, name, F.max, "encounter_datetime", (C.EXTERNAL_PICKUP,), (C.EXTERNAL_GIVEN,),
        f"value_coded = {C.YES}",
    )


def last_vl_trait(p: ReportParams, name: str = "data_carga") -> Trait:
    """Moment of the latest viral load that has a value."""
    return _event(
        p, name, F.max, "obs_datetime", C.VIRAL_LOAD_VISITS, (C.VIRAL_LOAD,), "value_numeric is not null"
    )


def any_vl_trait(p: ReportParams, name: str = "tem_carga") -> Trait:
    """1 for a patient with any viral-load row, even without a value."""
    return _event(p, name, F.max, "1", C.VIRAL_LOAD_VISITS, (C.VIRAL_LOAD,))


def first_vl_trait(p: ReportParams, name: str = "data_primeiro_carga") -> Trait:
    return _event(p, name, F.min, "obs_datetime", C.VIRAL_LOAD_VISITS, (C.VIRAL_LOAD,))


def first_cd4_trait(p: ReportParams, name: str = "data_cd4") -> Trait:
    return _event(p, name, F.min, "obs_datetime", (C.LABORATORY,), (C.CD4,))


def first_stage_trait(p: ReportParams, name: str = "data_estadio") -> Trait:
    return _event(p, name, F.min, "encounter_datetime", C.VISITS, (C.STAGE,))
