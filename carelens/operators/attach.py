"""Demographics, regimens, referral, contacts, registers and opened files."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from carelens.functions import codes as C
from carelens.functions.scalars import age, decode_sql, full_name, smallest_text_sql
from carelens.operators.choose import answers_by_moment, first_row, look_up
from carelens.operators.combine import TILE_ROWS, product_join, repeat_rows, tally, times
from carelens.operators.evidence import (
    Trait,
    answers,
    at_site,
    kind,
    last_visit_trait,
    live_patients,
    patient_traits,
    programs,
    visit_answers,
    visits,
    when,
)
from carelens.params import ReportParams
from carelens.sources.tables import ClinicalTables, live

ADDRESS = ("county_district", "address2", "address6", "address5", "address1")
ADDRESS_TITLES = ("Distrito", "PAdministrativo", "Localidade", "Bairro", "PontoReferencia")
_TITLED = [f"{a} {b}" for a, b in zip(ADDRESS, ADDRESS_TITLES)]
NAME = ("given_name", "middle_name", "family_name")


def _as_patient(df: DataFrame) -> DataFrame:
    return df.withColumnRenamed("person_id", "patient_id")


def first_identifier(t: ClinicalTables, alias: str) -> DataFrame:
    found = first_row(t.patient_identifier, "patient_id", "patient_identifier_id", "identifier")
    return found.select("patient_id", F.col("identifier").alias(alias))


def first_name(t: ClinicalTables, alias: str) -> DataFrame:
    found = _as_patient(first_row(t.person_name, "person_id", "person_name_id", *NAME))
    return found.select("patient_id", full_name().alias(alias))


def first_address(t: ClinicalTables) -> DataFrame:
    found = _as_patient(first_row(t.person_address, "person_id", "person_address_id", *ADDRESS))
    return found.selectExpr("patient_id", *_TITLED)


def preferred_names(t: ClinicalTables, *, live_only: bool) -> DataFrame:
    rows = live(t.person_name) if live_only else t.person_name
    return _as_patient(rows.where("preferred = 1"))


def preferred_addresses(t: ClinicalTables) -> DataFrame:
    return t.person_address.where("preferred = 1 and voided = 0").selectExpr(
        "person_id patient_id", *_TITLED
    )


def preferred_identifiers(t: ClinicalTables) -> DataFrame:
    """Preferred identifiers of the two patient-number types, deleted or not."""
    rows = t.patient_identifier.where("identifier_type in (2, 13) and preferred = 1")
    return rows.select("patient_id", "identifier")


def preferred_demographics(t: ClinicalTables) -> DataFrame:
    """Preferred name, address and identifier of each person that has one."""
    names = preferred_names(t, live_only=False).select("patient_id", full_name().alias("NomeCompleto"))
    return (
        preferred_identifiers(t)
        .join(names, "patient_id", "left")
        .join(preferred_addresses(t), "patient_id", "left")
    )


def phone_attribute(t: ClinicalTables) -> DataFrame:
    """Phone numbers; one row per number."""
    rows = t.person_attribute.where("person_attribute_type_id = 9")
    return rows.selectExpr("person_id patient_id", "value contacto")


def regimens_by_moment(t: ClinicalTables, p: ReportParams, n: str | None = None) -> DataFrame:
    """Regimens recorded per patient and moment: the smallest text, or every
    text with its multiplicity ``n``."""
    text = decode_sql("value_coded", C.REGIMENS, C.OTHER)
    if n is None:
        smallest = smallest_text_sql("value_coded", C.REGIMENS, C.OTHER)
        return answers_by_moment(t, (C.REGIMEN,), site=p, ultimo_regime=smallest)
    return answers_by_moment(t, (C.REGIMEN,), f"{text} ultimo_regime", site=p, **{n: "count(1)"})


def last_regimen(t: ClinicalTables, p: ReportParams) -> DataFrame:
    """Regimen at the last pickup; ties give several rows."""
    last = live_patients(t, patient_traits(t, p, last_visit_trait(p, (C.PICKUP,), "data_regime")))
    rows = look_up(last, "data_regime", regimens_by_moment(t, p, "n"), "inner")
    return repeat_rows(rows, F.col("n")).select("patient_id", "ultimo_regime", "data_regime")


def all_regimens(t: ClinicalTables) -> DataFrame:
    """Every live regimen answer, whenever given."""
    text = decode_sql("value_coded", C.CARE_REGIMENS, C.OTHER)
    return answers(t, C.REGIMEN).selectExpr("person_id patient_id", f"{text} ultimo_regime")


def referral_rows(t: ClinicalTables, p: ReportParams) -> DataFrame:
    rows = _referral_answers(t, p)
    text = decode_sql("value_coded", C.REFERRALS, C.OTHER)
    return rows.selectExpr("patient_id", f"{text} referencia")


def _referral_answers(t: ClinicalTables, p: ReportParams) -> DataFrame:
    return visit_answers(t, p, C.OPENINGS, (C.REFERRAL,))


def referral_source(t: ClinicalTables, p: ReportParams) -> DataFrame:
    """Where the patient came from; one row per answer."""
    return live_patients(t, referral_rows(t, p))


def smallest_referral(t: ClinicalTables, p: ReportParams) -> DataFrame:
    """The smallest referral text."""
    smallest = smallest_text_sql("value_coded", C.REFERRALS, C.OTHER)
    rows = _referral_answers(t, p).select("patient_id", "value_coded")
    return rows.groupBy("patient_id").agg(F.expr(smallest).alias("referencia"))


def reference_person(t: ClinicalTables, p: ReportParams) -> DataFrame:
    """The contact person: the smallest text. Deleted visits count here."""
    seen = at_site(t.encounter.where(kind(*C.OPENINGS)), p)
    return (
        seen.select("encounter_id", "patient_id")
        .join(answers(t, C.CONTACT).select("encounter_id", "value_text"), "encounter_id")
        .groupBy("patient_id")
        .agg(F.min("value_text").alias("pessoa"))
    )


def reference_person_fallback(t: ClinicalTables, p: ReportParams) -> DataFrame:
    """The contact person from any pair of live answers of one visit, where the
    first answers the main question or the second answers the other one: the
    first's text, else the second's. Smallest text per patient.

    Per visit the pairs are never formed: their smallest text follows from a few
    minima and from whether each kind of answer exists. Only visits with an answer
    to either question count, so the folders of these two questions are read
    first, and all other answers of those visits only.
    """
    asked = answers(t, C.CONTACT, C.CONTACT_SECOND).select("encounter_id").distinct()
    seen = at_site(t.encounter.where(kind(*C.OPENINGS, C.MASTER_CARD)), p).join(
        asked, "encounter_id", "left_semi"
    )
    main, other = f"concept_id = {C.CONTACT}", f"concept_id = {C.CONTACT_SECOND}"
    of_visit = {
        "_main": f"min({when(main, 'value_text')})",
        "_main_silent": f"max({main} and value_text is null)",
        "_any": "min(value_text)",
        "_any_silent": "max(value_text is null)",
        "_has_other": f"max({other})",
        "_other": f"min({when(other, 'value_text')})",
        "_counts": f"max({main} or {other})",
    }
    # main question answered: paired with every answer of the visit;
    # other question answered: every answer of the visit comes first
    smallest = (
        f"least(_main, {when('_main_silent', '_any')},"
        f" {when('_has_other', '_any')}, {when('_any_silent', '_other')})"
    )
    return (
        live(t.obs)
        .join(seen.select("encounter_id", "patient_id"), "encounter_id")
        .groupBy("patient_id", "encounter_id")
        .agg(*[F.expr(value).alias(name) for name, value in of_visit.items()])
        .where("_counts")
        .groupBy("patient_id")
        .agg(F.expr(f"min({smallest})").alias("pessoa"))
    )


def openings(t: ClinicalTables, p: ReportParams, types: tuple[int, ...]) -> DataFrame:
    """Opening visits keyed in during the period (whole days of data entry)."""
    return visits(t, p, types, until_end=False).where(
        f"to_date(date_created) between date'{p.start_date}' and date'{p.end_date}'"
    )


def live_people(t: ClinicalTables) -> DataFrame:
    return live(t.person).selectExpr(
        "person_id patient_id", "gender sexo", "dead", "death_date", "birthdate"
    )


def with_ages(p: ReportParams, df: DataFrame, opened: str) -> DataFrame:
    """Age at opening and at the end."""
    return (
        df.withColumn("idade_abertura", age(F.col(opened), "birthdate"))
        .withColumn("idade", age(p.end, "birthdate"))
        .drop("birthdate")
    )


def file_opened_in_period(t: ClinicalTables, p: ReportParams, types: tuple[int, ...]) -> DataFrame:
    """Opening visits of live patients and persons, one row per visit."""
    rows = openings(t, p, types).selectExpr(
        "patient_id", "encounter_id", "encounter_datetime data_abertura", "creator"
    )
    joined = rows.join(live_patients(t, live_people(t)), "patient_id")
    return with_ages(p, joined.drop("encounter_id"), "data_abertura")


def part_b_trait(name: str = "parteB") -> Trait:
    return Trait(
        name,
        F.min,
        visit=when(kind(*C.PART_B), "encounter_datetime"),
        visit_types=C.PART_B,
    )


def part_b_opened(t: ClinicalTables, p: ReportParams) -> DataFrame:
    """First part-B visit; deleted patients are not left out here."""
    return patient_traits(t, p, part_b_trait())


def register_rows(
    t: ClinicalTables, p: ReportParams, register: int, book: int, page: int, line: int,
    books: dict[int, str], n: str = "n", tile_rows: int = TILE_ROWS,
) -> DataFrame:
    """Book, page and row of each register entry, with multiplicity. An entry with
    many answers to each question has their product, which is made in tiles."""

    def told(question: int, value: str, alias: str) -> DataFrame:
        rows = answers(t, question).selectExpr("encounter_id", f"{value} {alias}")
        return tally(rows, "encounter_id", alias, n=f"_{alias}")

    entries = visits(t, p, (register,)).selectExpr(
        "encounter_id", "patient_id", "location_id", "encounter_datetime data_inscricao"
    )
    # a register entry without the question shows '', like an unknown book
    shown = f"coalesce({decode_sql('value_coded', books, None)}, '')"
    entries = entries.join(t.location.select("location_id"), "location_id", "left_semi")
    sides = (told(book, shown, "livro"), told(page, "value_numeric", "pagina"), told(line, "value_numeric", "linha"))
    return (
        product_join(entries, [(side, "left") for side in sides], "encounter_id", tile_rows)
        .withColumn("livro", F.expr("coalesce(livro, '')"))
        .groupBy("patient_id", "data_inscricao", "livro", "pagina", "linha")
        .agg(F.sum(times("_livro", "_pagina", "_linha")).alias(n))
    )


def pre_register(
    t: ClinicalTables, p: ReportParams, n: str = "n", tile_rows: int = TILE_ROWS
) -> DataFrame:
    return register_rows(t, p, C.PRE_REGISTER, 6263, 6265, 6267, C.PRE_BOOKS, n, tile_rows)


def treatment_register(
    t: ClinicalTables, p: ReportParams, n: str = "n", tile_rows: int = TILE_ROWS
) -> DataFrame:
    return register_rows(
        t, p, C.TREATMENT_REGISTER, 6264, 6266, 6268, C.TREATMENT_BOOKS, n, tile_rows
    )


def register_book(t: ClinicalTables, p: ReportParams, tile_rows: int = TILE_ROWS) -> DataFrame:
    """Entries of both registers, one row per entry and combination."""
    both = pre_register(t, p, tile_rows=tile_rows).withColumn("registo", F.lit("pre")).unionByName(
        treatment_register(t, p, tile_rows=tile_rows).withColumn("registo", F.lit("tarv"))
    )
    return repeat_rows(live_patients(t, both), F.col("n")).drop("n")


def program_enrolment(t: ClinicalTables, p: ReportParams, program: int, alias: str) -> DataFrame:
    rows = programs(t, p, (program,))
    return live_patients(t, rows.selectExpr("patient_id", f"date_enrolled {alias}"))
