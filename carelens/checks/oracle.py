"""The same questions as plain SQL for another engine.

Written from the meaning of each operator in the most literal way (row by row
joins, ranking, no multiplicities), so that the shortcuts of the Spark plans are
put to the test. The clinical tables are common table expressions over the star.
"""

from __future__ import annotations

from carelens.functions import codes as C

END = "timestamp '2000-06-20 00:00:00'"
START = "timestamp '1999-06-21 00:00:00'"
END3 = "timestamp '1995-07-20 00:00:00'"
END_ALL = "timestamp '2002-01-01 00:00:00'"


def _pick(key: str, values: str) -> str:
    return f"list_extract([{values}], cast(({key}) % {len(values.split(','))} as int) + 1)"


_VOID = "case when c_custkey%50=7 then 1 else 0 end"

TABLES = f"""
patient as (select c_custkey patient_id, {_VOID} voided from customer),
person as (select c_custkey person_id,
  case when (c_custkey//2)%2=0 then 'F' else 'M' end gender,
  cast(timestamp '1955-01-01 00:00:00' + cast((c_custkey*37)%15000 as int) * interval '1' day as date) birthdate,
  cast(case when c_custkey%29=0 then 1 else 0 end as int) dead,
  case when c_custkey%29=0 then date '2001-06-01' end death_date, {_VOID} voided from customer),
person_name as (select c_custkey*2+k person_name_id, c_custkey person_id, c_mktsegment given_name,
  case when c_custkey%3=0 then null else 'M'||cast(k as varchar) end middle_name, c_name family_name,
  1-k preferred, case when k=0 and c_custkey%19=5 then 1 else 0 end voided
  from customer cross join (values (0),(1)) t(k) where k=0 or c_custkey%5=2),
person_address as (select c_custkey*2+k person_address_id, c_custkey person_id, n_name county_district,
  'A1-'||cast(k as varchar) address1, 'A2' address2, 'A5' address5, 'A6' address6,
  1-k preferred, case when k=0 and c_custkey%23=6 then 1 else 0 end voided
  from customer join nation on n_nationkey=c_nationkey cross join (values (0),(1)) t(k)
  where k=0 or c_custkey%7=3),
person_attribute as (select c_custkey person_id, case when c_custkey%4=0 then 8 else 9 end person_attribute_type_id,
  'tel-'||cast(c_custkey as varchar) as value from customer),
patient_identifier as (select c_custkey*2+k patient_identifier_id, c_custkey patient_id,
  c_name||'/'||cast(k as varchar) identifier,
  cast(case when c_custkey%3=0 then 13 when c_custkey%11=0 then 5 else 2 end as int) identifier_type,
  cast(1-k as int) preferred, cast(case when k=0 and c_custkey%17=4 then 1 else 0 end as int) voided
  from customer cross join (values (0),(1)) t(k) where k=0 or c_custkey%4=1),
location as (select cast(n_nationkey as bigint) location_id, n_name name from nation),
users as (select s_suppkey user_id, s_name username from supplier),
encounter as (select o_orderkey encounter_id, o_custkey patient_id,
  {_pick('o_orderkey', '18,6,18,9,13,5,6,18,53,18,6,32,33,35,52,7,1,3,34,18')} encounter_type,
  o_orderdate encounter_datetime, o_custkey%2 location_id, o_orderkey%10 creator,
  o_orderdate + interval '1' day date_created,
  case when o_orderkey%20 in (13,18) then 164 end form_id,
  case when o_orderkey%41=3 then 1 else 0 end voided from orders),
obs as (select patient_id person_id, encounter_id, encounter_datetime obs_datetime, location_id, cid concept_id,
  cast(case when cid=1255 then {_pick('v', '1256,1257')}
   when cid=1088 then {_pick('v', '1651,6324,1703,6243,6108,23784,9999')}
   when cid=1982 then {_pick('v', '44,1465,1066')} when cid in (6257,23758) then 1065+v%2
   when cid in (6277,23761) then {_pick('v', '703,664,1065')} when cid=6122 then {_pick('v', '1256,1267')}
   when cid=5356 then 1204+v%5 when cid=1594 then {_pick('v', '1595,1596,1414,9999')}
   when cid in (23779,1030) then 703 when cid in (1040,23865,5272) then 1065
   when cid=6263 then 6259+v%2 when cid=6264 then 6261+v%2 when cid in (23724,23730) then 1256 end as int) value_coded,
  case when cid=856 then case when v%11=0 then -1.0 when v%13=0 then null else l_extendedprice/50 end
   when cid=5497 then l_extendedprice/100 when cid in (6265,6266,6267,6268) then l_quantity end value_numeric,
  case when cid in (5096,1410) then encounter_datetime + cast(10+l_quantity as int) * interval '1' day
   when cid in (1190,6123,23866,23891,6128) then encounter_datetime - cast(l_quantity as int) * interval '1' day
   when cid=6129 then encounter_datetime + interval '180' day end value_datetime,
  case when cid in (1611,6224) then 'ref-'||cast(v as varchar) end value_text,
  case when v%43=5 then 1 else 0 end voided
  from (select e.*, l_quantity, l_extendedprice, cast(l_suppkey+l_linenumber as int) v,
   case when encounter_type=18 then {_pick('l_partkey', '1088,5096,1255,1190,23724,23730')}
    when encounter_type in (6,9) then {_pick('l_partkey', '856,1410,1255,1190,5356,1982,1600,1279,6257,23758,6277,23761,6128,6122,6129,23730')}
    when encounter_type=13 then {_pick('l_partkey', '856,5497')}
    when encounter_type in (5,7) then {_pick('l_partkey', '1594,1611,6123,1982,1279,1600,6224')}
    when encounter_type=53 then {_pick('l_partkey', '1190,1255,23891,23779,1030,1040,856,5272,6129,1611,6224')}
    when encounter_type=52 then {_pick('l_partkey', '23865,23866')}
    when encounter_type=32 then {_pick('l_partkey', '6263,6265,6267')}
    when encounter_type=33 then {_pick('l_partkey', '6264,6266,6268')} end cid
   from encounter e join lineitem l on l.l_orderkey=e.encounter_id) x where cid is not null),
patient_program as (select o_orderkey patient_program_id, o_custkey patient_id,
  {_pick('o_orderkey', '1,2,2,5,8')} program_id, o_orderdate date_enrolled, o_custkey%2 location_id,
  case when o_orderkey%41=3 then 1 else 0 end voided from orders where o_orderkey%3=0),
patient_state as (select patient_program_id,
  cast(case when program_id=1 then {_pick('patient_program_id//15', '2,3,4,5')}
   else {_pick('patient_program_id//15', '7,8,9,10,29')} end as int) state,
  date_enrolled + cast(case when (patient_program_id//15)%5=4 then 0 else 200 end as int) * interval '1' day start_date,
  case when (patient_program_id//7)%3=0 then null else date_enrolled + interval '400' day end end_date,
  case when patient_program_id%37=5 then 1 else 0 end voided from patient_program),
lp as (select patient_id from patient where voided = 0),
lv as (select patient_id, encounter_id, encounter_type kind, encounter_datetime seen, location_id site,
  creator, date_created, form_id from encounter where voided = 0),
la as (select person_id patient_id, encounter_id, concept_id concept, value_coded coded, value_numeric num,
  value_datetime dt, value_text txt, obs_datetime told, location_id told_site from obs where voided = 0),
va as (select lv.*, concept, coded, num, dt, txt, told, told_site from lv join la using (encounter_id)),
lprog as (select patient_program_id, patient_id, program_id, date_enrolled, location_id site
  from patient_program where voided = 0),
lstate as (select g.*, state, start_date, end_date from lprog g
  join patient_state s using (patient_program_id) where s.voided = 0)
"""


def sql(body: str, *ctes: str) -> str:
    body = body.strip()
    return "with " + ",\n".join([TABLES.strip(), *[c.strip() for c in ctes]]) + "\n" + body


def _case(column: str, texts: dict[int, str], other: str | None) -> str:
    whens = " ".join(f"when {code} then '{text}'" for code, text in texts.items())
    tail = "" if other is None else f" else '{other}'"
    return f"(case {column} {whens}{tail} end)"


def _int(x: str) -> str:
    return f"cast({x} as int)"


def _days(a: str, b: str) -> str:
    """Whole days from b to a."""
    return f"date_diff('day', cast({b} as date), cast({a} as date))"


def _months(a: str, b: str) -> str:
    return f"cast(round({_days(a, b)} / 30) as int)"


def _years(a: str, b: str, year: int = 365) -> str:
    return f"cast(round({_days(a, b)} / {year}) as int)"


_NUMBER = r"regexp_replace(cast(cast(num as decimal(18,4)) as varchar), '\.?0+$', '')"
_VL_TEXT = f"case when num < 0 then 'INDETECTAVEL' else {_NUMBER} end"


def _full(n: str) -> str:
    parts = " || ' ' || ".join(f"coalesce({n}.{c}, '')" for c in ("given_name", "middle_name", "family_name"))
    return f"({parts})"


def _status(state: str, due: str, end: str, none: str) -> str:
    late = _days(end, due)
    return (
        f"coalesce({state}, case when {due} is null then '{none}'"
        f" when {late} > 60 then 'ABANDONO NAO NOTIFICADO' else 'ACTIVO' end)"
    )


# --- shared pieces -----------------------------------------------------------


def start_rows(management: str, dated: str, end: str, site: str, more: str = "") -> str:
    return f"""
 select patient_id, min(d) data_inicio from (
  select patient_id, seen d from va where concept = 1255 and coded = 1256 and kind in ({management})
   and seen <= {end} {site}
  union all select patient_id, dt from va where concept = 1190 and kind in ({dated}) and dt <= {end} {site}
  union all select patient_id, date_enrolled from lprog where program_id = 2 and date_enrolled <= {end} {site}
  union all select patient_id, seen from lv where kind = 18 and seen <= {end} {site}
  {more}) x where patient_id in (select patient_id from lp) group by patient_id"""


ONE = "and site = 1"

START_SQL = {
    "art_start": start_rows("18,6,9", "18,6,9", END, ONE),
    "art_start_three_pickups": start_rows("18,6,9,53", "18,6,9,53", END, ONE),
    "art_start_suppressed": start_rows(
        "18,6,9", "18,6,9,53", END, ONE,
        f"union all select patient_id, seen from va where concept = 23865 and coded = 1065"
        f" and kind = 52 and seen <= {END} {ONE}",
    ),
}


def _external(end: str) -> str:
    return (
        f"union all select a.patient_id, a.dt from va a join va b using (encounter_id)"
        f" where a.kind = 52 and a.concept = 23866 and a.dt <= {end} and b.coded = 1065"
    )


START_SQL["art_start_all_sites"] = start_rows("18,6,9", "18,6,9,53", END, "", _external(END))
START_SQL["art_start_files"] = """
 select patient_id, min(d) data_inicio from (
  select patient_id, seen d from va where concept = 1255 and coded = 1256 and kind in (6,9) and site = 1
  union all select patient_id, dt from va where concept = 1190 and kind in (6,9) and dt is not null and told_site = 1
 ) x where patient_id in (select patient_id from lp) group by patient_id"""
START_SQL["art_start_cards"] = """
 select patient_id, min(dt) data_inicio from va where concept = 1190 and kind in (6,9) and dt is not null
  and told_site = 1 and patient_id in (select patient_id from lp) group by patient_id"""

WINDOW_STARTS = f"""
 select * from ({start_rows("18,6,9,53", "18,6,9,53", END3, ONE)}) s
 where data_inicio between {END3} - interval 4 month + interval 1 day and {END3} - interval 3 month"""


def pregnant(kinds: str, answers: str, when: str, enrolled: str, more: str = "false") -> str:
    return f"""
 select patient_id from va where site = 1 and patient_id in (select patient_id from lp) and {when}
  and ((kind in ({kinds}) and ((concept = 1982 and coded in ({answers})) or concept in (1279, 1600))) or {more})
 union select patient_id from lprog where program_id = 8 and site = 1 and {enrolled}"""


_RECENT = f"between {END} - interval 10 month and {END}"
PREGNANT_SQL = {
    "pregnant_ids": pregnant("5,6", "44", f"seen {_RECENT}", f"date_enrolled {_RECENT}"),
    "pregnant_ids_three_pickups": pregnant("5,6,53", "44", f"seen <= {END}", f"date_enrolled <= {END}"),
    "pregnant_ids_suppressed": pregnant(
        "5,6", "44,1465", f"seen <= {END}", f"date_enrolled <= {END}",
        "(kind = 53 and concept = 5272 and coded = 1065)",
    ),
}
PREGNANT_WINDOW = pregnant("5,6,53", "44", f"seen <= {END3}", f"date_enrolled <= {END3}")


def last_seen(kinds: str, end: str, alias: str, site: str = ONE) -> str:
    return (
        f"select patient_id, max(seen) {alias} from lv where kind in ({kinds}) and seen <= {end} {site}"
        f" and patient_id in (select patient_id from lp) group by patient_id"
    )


def booked(kinds: str, concept: int, end: str, moment: str, alias: str, site: str = ONE) -> str:
    return (
        f"select l.patient_id, l.{moment}, o.dt {alias} from ({last_seen(kinds, end, moment, site)}) l"
        f" left join la o on o.patient_id = l.patient_id and o.told = l.{moment} and o.concept = {concept}"
    )


LAST_VL = f"""
 select l.patient_id, l.data_carga, o.num from
  (select patient_id, max(told) data_carga from va where concept = 856 and kind in (13,6,9) and num is not null
    and seen <= {END} and site = 1 and patient_id in (select patient_id from lp) group by patient_id) l
  join la o on o.patient_id = l.patient_id and o.told = l.data_carga and o.concept = 856 and o.told_site = 1"""

NOT_DUE = f"""
 select distinct patient_id from va where concept = 856 and kind in (13,6,9) and seen <= {END} and site = 1
  and patient_id in (select patient_id from lp)
  and patient_id not in (select patient_id from ({LAST_VL}) v where num < 1000 and {_months(END, 'data_carga')} >= 12)"""

LAST_REGIMEN = f"""
 select l.patient_id, l.data_regime, {_case('o.coded', C.REGIMENS, C.OTHER)} ultimo_regime
 from ({last_seen('18', END, 'data_regime')}) l
 join la o on o.patient_id = l.patient_id and o.told = l.data_regime and o.concept = 1088 and o.told_site = 1"""

REFERRAL = f"""
 select patient_id, {_case('coded', C.REFERRALS, C.OTHER)} referencia from va
 where concept = 1594 and kind in (5,7) and site = 1 and patient_id in (select patient_id from lp)"""

CONTACT = """
 select e.patient_id, min(o.txt) pessoa from encounter e join la o using (encounter_id)
 where e.encounter_type in (5,7) and e.location_id = 1 and o.concept = 1611 group by e.patient_id"""

CONTACT_PAIR = """
 select e.patient_id, min(coalesce(a.txt, b.txt)) pessoa from encounter e
 join la a on a.encounter_id = e.encounter_id join la b on b.encounter_id = e.encounter_id
 where e.encounter_type in (5,7,53) and e.location_id = 1 and (a.concept = 1611 or b.concept = 6224)
 group by e.patient_id"""

FIRST_ID = """
 select patient_id, identifier from patient_identifier where voided = 0
 qualify row_number() over (partition by patient_id order by patient_identifier_id) = 1"""
FIRST_NAME = """
 select * from person_name where voided = 0
 qualify row_number() over (partition by person_id order by person_name_id) = 1"""
FIRST_ADDRESS = """
 select * from person_address where voided = 0
 qualify row_number() over (partition by person_id order by person_address_id) = 1"""


def titles(a: str) -> str:
    return (
        f'{a}.county_district "Distrito", {a}.address2 "PAdministrativo", {a}.address6 "Localidade",'
        f' {a}.address5 "Bairro", {a}.address1 "PontoReferencia"'
    )


def exits(program: int, texts: dict[int, str], end: str = END) -> str:
    return (
        f"select patient_id, start_date data_saida, {_case('state', texts, C.OTHER)} estado from lstate"
        f" where program_id = {program} and state in ({','.join(map(str, texts))}) and end_date is null"
        f" and start_date <= {end} and site = 1 and patient_id in (select patient_id from lp)"
    )


STATE_AT_END = f"""
begun as ({START_SQL['art_start']}),
ended as (select b.patient_id, s.start_date data_estado, s.state estado_id from begun b
  join lstate s on s.patient_id = b.patient_id and s.program_id = 2 and s.site = 1 and s.state in (7,8,9,10)
   and s.start_date between b.data_inicio and {END} and s.end_date is null
  qualify row_number() over (partition by b.patient_id order by s.start_date desc, s.state desc) = 1),
filed as (select b.*, max(e.seen) data_fila, max(e.seen) data_seguimento from begun b
  left join lv e on e.patient_id = b.patient_id and e.kind = 18 and e.site = 1
   and e.seen between b.data_inicio and {END} group by b.patient_id, b.data_inicio),
planned as (select f.*, p.dt data_proximo_lev, s.dt data_proximo_seguimento,
   coalesce(s.dt, f.data_seguimento + interval 30 day) data_proximo_seguimento_estimada
  from filed f
  left join la p on p.patient_id = f.patient_id and p.told = f.data_fila and p.concept = 5096 and p.told_site = 1
  left join la s on s.patient_id = f.patient_id and s.told = f.data_seguimento and s.concept = 1410 and s.told_site = 1
  qualify row_number() over (partition by f.patient_id order by p.dt desc nulls last, s.dt desc nulls last,
   p.encounter_id, s.encounter_id) = 1),
judged as (select p.*, x.data_estado, x.estado_id,
   case when x.estado_id is not null then x.estado_id
    when greatest(data_proximo_lev, data_proximo_seguimento_estimada) is null then 9
    when {END} > greatest(data_proximo_lev, data_proximo_seguimento_estimada) + interval 60 day then 9
    else 6 end estado_final
  from planned p left join ended x using (patient_id))"""


def _one_each(columns: str, source: str) -> str:
    """The smallest row of each patient by all columns, nulls last."""
    names = [c.strip() for c in columns.split(",")]
    order = ", ".join(f'"{c}" asc nulls last' for c in names if c != "patient_id")
    shown = ", ".join(f'"{c}"' for c in names)
    return (
        f"select {shown} from ({source}) z qualify row_number() over"
        f" (partition by patient_id order by {order}) = 1"
    )


def _vl_report(columns: str, vl_join: str, where: str, value: str) -> str:
    source = f"""
 select i.identifier nid, {_full('n')} nome, pe.gender, {_years(END, 'pe.birthdate', 360)} idade,
  {titles('ad')}, ph.value contacto, c.pessoa, j.data_inicio, r.ultimo_regime, v.data_carga,
  {value} valor_carga, f.referencia, j.data_fila, j.data_proximo_lev, j.data_seguimento,
  j.data_proximo_seguimento, j.patient_id
 from judged j join person pe on pe.person_id = j.patient_id
 {vl_join} ({LAST_VL}) v on v.patient_id = j.patient_id
 left join ({LAST_REGIMEN}) r on r.patient_id = j.patient_id
 left join ({REFERRAL}) f on f.patient_id = j.patient_id
 left join ({FIRST_ID}) i on i.patient_id = j.patient_id
 left join ({FIRST_NAME}) n on n.person_id = j.patient_id
 left join ({FIRST_ADDRESS}) ad on ad.person_id = j.patient_id
 left join person_attribute ph on ph.person_id = j.patient_id and ph.person_attribute_type_id = 9
 left join ({CONTACT}) c on c.patient_id = j.patient_id
 where j.estado_final = 6 and {where}"""
    return sql(_one_each(columns, source), STATE_AT_END)


_HEAD = "nid, nome, gender, idade"
_ADDR = "Distrito, PAdministrativo, Localidade, Bairro, PontoReferencia"
_TAIL = "data_fila, data_proximo_lev, data_seguimento, data_proximo_seguimento, patient_id"

OPENED_PERSON = f"""
 select e.patient_id, e.seen data_abertura, e.creator, e.site, gender sexo, dead, death_date,
  {_years('e.seen', 'pe.birthdate')} idade_abertura, {_years(END, 'pe.birthdate')} idade, e.kind
 from lv e join lp using (patient_id) join person pe on pe.person_id = e.patient_id and pe.voided = 0
 where e.site = 1 and cast(e.date_created as date) between cast({START} as date) and cast({END} as date)"""


def register(kind: int, book: int, page: int, line: int, texts: dict[int, str]) -> str:
    return f"""
 select e.patient_id, e.seen data_inscricao, coalesce({_case('b.coded', texts, None)}, '') livro,
  pg.num pagina, ln.num linha
 from lv e join lp using (patient_id) join location l on l.location_id = e.site
 left join la b on b.encounter_id = e.encounter_id and b.concept = {book}
 left join la pg on pg.encounter_id = e.encounter_id and pg.concept = {page}
 left join la ln on ln.encounter_id = e.encounter_id and ln.concept = {line}
 where e.kind = {kind} and e.seen <= {END} and e.site = 1"""


PRE_BOOK = register(32, 6263, 6265, 6267, C.PRE_BOOKS)
ART_BOOK = register(33, 6264, 6266, 6268, C.TREATMENT_BOOKS)


def enrolled(program: int) -> str:
    return (
        f"select patient_id, date_enrolled from lprog where program_id = {program} and site = 1"
        f" and patient_id in (select patient_id from lp)"
    )


CD4 = f"""
 select f.patient_id, f.data_cd4, max(o.num) cd4 from
  (select patient_id, min(told) data_cd4 from va where kind = 13 and concept = 5497 and seen <= {END}
    and site = 1 group by patient_id) f
 join la o on o.patient_id = f.patient_id and o.told = f.data_cd4 and o.concept = 5497
 group by f.patient_id, f.data_cd4"""

STAGE = f"""
 select f.patient_id, f.data_estadio, {_case('o.coded', C.STAGES, C.OTHER)} estadio from
  (select patient_id, min(seen) data_estadio from va where kind in (6,9) and concept = 5356 and seen <= {END}
    and site = 1 and patient_id in (select patient_id from lp) group by patient_id) f
 join la o on o.patient_id = f.patient_id and o.told = f.data_estadio and o.concept = 5356
  and o.told_site = 1 and o.coded in (1204,1205,1206,1207)"""

PART_B = "select patient_id, min(seen) \"parteB\" from lv where kind in (1,3) and site = 1 group by patient_id"


# --- TB ----------------------------------------------------------------------

_PERIOD = f"between {START} and {END}"


def _screen(answer: int, alias: str) -> str:
    return f"""
 select patient_id, max(told) {alias} from va where kind in (6,9) and concept in (6257, 23758)
  and coded = {answer} and seen {_PERIOD} and patient_id in (select patient_id from lp) group by patient_id"""


INVESTIGATION = f"""
 select m.patient_id, m.data_investigacao,
  case when o.coded in (703, 1065) then 'POSITIVO' else 'NEGATIVO' end resultado
 from (select patient_id, max(told) data_investigacao from va where kind in (6,9) and concept in (6277, 23761)
   and seen {_PERIOD} and patient_id in (select patient_id from lp) group by patient_id) m
 join la o on o.patient_id = m.patient_id and o.told = m.data_investigacao and o.concept in (6277, 23761)"""

INH_START = f"""
 select patient_id, max(d) data_inicio_inh from (
  select patient_id, dt d from va where kind in (6,9) and concept = 6128 and dt {_PERIOD}
  union select patient_id, seen from va where kind in (6,9) and concept = 6122 and coded = 1256 and seen {_PERIOD}) x
 where patient_id in (select patient_id from lp) group by patient_id"""

INH_END = f"""
 select patient_id, max(d) data_fim_inh from (
  select patient_id, dt d from va where kind in (6,9,53) and concept = 6129
  union select patient_id, seen from va where kind in (6,9) and concept = 6122 and coded = 1267 and seen <= {END}) x
 where patient_id in (select patient_id from lp) group by patient_id having max(d) is not null"""

INH_COURSE = f"""
 select s.patient_id, s.data_inicio_inh, f.data_fim_inh from ({INH_START}) s
 left join ({INH_END}) f on f.patient_id = s.patient_id and f.data_fim_inh > s.data_inicio_inh"""

SITES = """
 select distinct e.patient_id, l.name from encounter e join location l on l.location_id = e.location_id"""

# --- differentiated care -----------------------------------------------------

_TESTED = "((t.concept = 23779 and t.coded = 703) or (t.concept in (1030, 1040) and t.coded in (703, 1065)))"
ENROLMENT = f"""
 select distinct patient_id, data_abertura, data_diagnostico from (
  (select patient_id, seen data_abertura, dt data_diagnostico from va
    where kind in (5,7) and concept = 6123 and seen <= {END_ALL} and patient_id in (select patient_id from lp)
    qualify row_number() over (partition by patient_id order by seen, dt nulls first) = 1)
  union all
  (select t.patient_id, d.dt, t.seen from va t join la d on d.encounter_id = t.encounter_id and d.concept = 23891
    where t.kind = 53 and {_TESTED} and d.dt <= {END_ALL} and t.patient_id in (select patient_id from lp)
    qualify row_number() over (partition by t.patient_id order by d.dt, t.seen) = 1)) x
 qualify rank() over (partition by patient_id order by data_abertura) = 1"""

CARE_MODEL = f"""
 select patient_id, seen data_inclusao_mdc, {_case('concept', C.CARE_MODELS, C.OTHER_MODEL)} tipo_modelo from va
 where kind in (18,6,9) and concept in ({','.join(map(str, C.CARE_MODEL))}) and coded = 1256 and seen <= {END_ALL}
  and patient_id in (select patient_id from lp)
 qualify row_number() over (partition by patient_id order by seen, concept) = 1"""


def three_moments(source: str, a: str, b: str, c: str) -> str:
    return f"""
 select patient_id, min(seen) {a}, coalesce(min(case when nth = 2 then seen end), min(seen)) {b}, max(seen) {c}
 from (select patient_id, seen, dense_rank() over (partition by patient_id order by seen) nth from ({source}) s) r
 group by patient_id"""


PICKUPS = three_moments(
    f"select patient_id, seen from lv where kind = 18 and seen <= {END_ALL}",
    "primeiro_levantamento", "segundo_levantamento", "ultimo_levantamento",
)
PICKUP_HISTORY = f"""
 select * from ({PICKUPS}) x where patient_id in (select patient_id from va where kind in (18,6,9)
  and seen <= {END_ALL} and patient_id in (select patient_id from lp))"""
COUNSELLING = three_moments(
    f"select patient_id, seen from lv where kind in (34,35) and form_id = 164 and seen <= {END_ALL}"
    " and patient_id in (select patient_id from lp)",
    "primeira_fichaapss", "segunda_fichaapss", "ultima_fichaapss",
)


def first_vl(end: str) -> str:
    return f"""
 select f.patient_id, f.data_primeiro_carga, max(o.num) valor_primeira_carga from
  (select patient_id, min(told) data_primeiro_carga from va where kind in (13,6,9) and concept = 856
    and seen <= {end} group by patient_id) f
 join la o on o.patient_id = f.patient_id and o.told = f.data_primeiro_carga and o.concept = 856
 group by f.patient_id, f.data_primeiro_carga having max(o.num) < 1000"""


def unfiltered_vl(end: str) -> str:
    return f"""
 select f.patient_id, f.data_ultima_carga, max(o.num) valor_ultima_carga from
  (select e.patient_id, max(o.obs_datetime) data_ultima_carga from encounter e join obs o using (encounter_id)
    where e.encounter_type in (13,6,9) and e.encounter_datetime <= {end} group by e.patient_id) f
 join la o on o.patient_id = f.patient_id and o.told = f.data_ultima_carga and o.concept = 856
 group by f.patient_id, f.data_ultima_carga"""


REGIMENS = f"select patient_id, {_case('coded', C.CARE_REGIMENS, C.OTHER)} ultimo_regime from la where concept = 1088"

SUPPRESSED = f"""
 select patient_id, num cv, seen data_cv from va where kind in (13,6,9,53) and concept = 856 and num < 1000
  and seen <= {END} and site = 1 and patient_id in (select patient_id from lp)"""

TWO_PICKUPS = f"""
 select distinct m.patient_id, m.ultimo_levantamento, o.dt proximo_lev from (
  {last_seen('18', END, 'ultimo_levantamento')}
  union select patient_id, max(seen) from va where kind = 52 and concept = 23865 and coded = 1065
   and seen <= {END} and site = 1 and patient_id in (select patient_id from lp) group by patient_id) m
 left join la o on o.patient_id = m.patient_id and o.told = m.ultimo_levantamento and o.concept = 5096"""

MOVED_IN = f"""
 select patient_id from lstate where program_id = 2 and state = 29 and start_date = date_enrolled and site = 1
  and start_date between {END3} - interval 4 month + interval 1 day and {END3} - interval 3 month
  and patient_id in (select patient_id from lp)"""

PICKED_99 = f"""
 select s.patient_id, s.data_inicio, e.seen from ({WINDOW_STARTS}) s
 left join lv e on e.patient_id = s.patient_id and e.kind = 18 and e.site = 1
  and e.seen between s.data_inicio and s.data_inicio + interval 99 day
  and s.patient_id not in ({MOVED_IN})"""


def _reports() -> dict[str, str]:
    due = f"j.patient_id not in ({NOT_DUE})"
    pregnant_ids = PREGNANT_SQL["pregnant_ids"]
    months = _months(END, "j.data_inicio")
    out = {
        "vl_eligible_general": _vl_report(
            f"{_HEAD}, {_ADDR}, contacto, pessoa, data_inicio, ultimo_regime, data_carga, valor_carga, referencia, {_TAIL}",
            "left join",
            f"{due} and j.patient_id not in ({pregnant_ids}) and {months} >= 6",
            _VL_TEXT.replace("num", "v.num"),
        ),
        "vl_eligible_pregnant": _vl_report(
            f"{_HEAD}, {_ADDR}, contacto, pessoa, referencia, data_inicio, ultimo_regime, data_carga, valor_carga, {_TAIL}",
            "left join",
            f"{due} and j.patient_id in ({pregnant_ids}) and pe.gender = 'F' and {months} >= 3",
            _VL_TEXT.replace("num", "v.num"),
        ),
        "vl_failure": _vl_report(
            f"{_HEAD}, data_inicio, {_ADDR}, contacto, pessoa, referencia, ultimo_regime, data_carga, valor_carga, {_TAIL}",
            "join",
            f"v.num >= 1000 and {_days(END, 'v.data_carga')} / 30 > 3 and {months} >= 6",
            "v.num",
        ),
    }
    years = _years(END, "pe.birthdate")
    out["vl_suppressed"] = sql(f"""
 select distinct s.patient_id, i.identifier "NID", n.given_name || ' ' || n.family_name "NomeCompleto", pe.gender,
  {years} idade_actual, case when {years} < 5 then 'Criança (<5 anos)' else '' end crianca, s.data_inicio,
  v.cv, v.data_cv, case when s.patient_id in ({PREGNANT_SQL['pregnant_ids_suppressed']}) then 'SIM' else '' end gravida,
  c.proxima_consulta, u.proximo_lev, {titles('ad')}, ph.value contacto, r.pessoa
 from ({START_SQL['art_start_suppressed']}) s
 join ({SUPPRESSED}) v on v.patient_id = s.patient_id
 join patient_identifier i on i.patient_id = s.patient_id and i.identifier_type in (2,13) and i.preferred = 1
 join person pe on pe.person_id = s.patient_id
 left join person_name n on n.person_id = s.patient_id and n.preferred = 1
 left join person_address ad on ad.person_id = s.patient_id and ad.preferred = 1 and ad.voided = 0
 left join person_attribute ph on ph.person_id = s.patient_id and ph.person_attribute_type_id = 9
 left join ({CONTACT_PAIR}) r on r.patient_id = s.patient_id
 left join ({booked('6,9', 1410, END, 'ultimo', 'proxima_consulta')}) c on c.patient_id = s.patient_id
 left join ({TWO_PICKUPS}) u on u.patient_id = s.patient_id
 where {_days(END, 's.data_inicio')} >= 180""")

    shared = f"""
 left join person_address ad on ad.person_id = o.patient_id and ad.preferred = 1 and ad.voided = 0
 left join person_name n on n.person_id = o.patient_id and n.preferred = 1 and n.voided = 0
 left join users us on us.user_id = o.creator
 left join ({FIRST_ID}) i on i.patient_id = o.patient_id
 left join ({REFERRAL}) f on f.patient_id = o.patient_id
 left join ({booked('6,9', 1410, END, 'ultimo', 'proximo')}) c on c.patient_id = o.patient_id
 left join ({enrolled(1)}) p1 on p1.patient_id = o.patient_id
 left join ({exits(2, C.TREATMENT_EXITS)}) x on x.patient_id = o.patient_id
 left join ({CD4}) cd on cd.patient_id = o.patient_id
 left join ({STAGE}) st on st.patient_id = o.patient_id
 left join ({enrolled(5)}) p5 on p5.patient_id = o.patient_id
 left join ({enrolled(8)}) p8 on p8.patient_id = o.patient_id"""
    who = f"""o.patient_id, i.identifier "NID", {_full('n')} "NomeCompleto", o.sexo, o.dead, o.death_date,
  o.idade_abertura, o.idade"""
    out["entered_master_card"] = sql(f"""
 select {who}, f.referencia, p1.date_enrolled inscricao_cuidado, s.data_inicio, c.ultimo data_ultimo_segmento,
  c.proximo data_proximo_segmento, us.username utilizador
 from (select * from ({OPENED_PERSON}) z where kind = 53) o
 left join ({START_SQL['art_start_cards']}) s on s.patient_id = o.patient_id {shared}""")
    out["entered_full"] = sql(f"""
 select {who}, o.data_abertura "parteA", b."parteB", f.referencia, r1.data_inscricao data_inscricao_pretarv,
  r1.livro pretarv_livro, r1.pagina pretarv_pagina, r1.linha pretarv_linha, p1.date_enrolled inscricao_cuidado,
  {_status('y.estado', 'c.proximo', END, 'SEM DATA DA PROXIMA CONSULTA')} estado_pre_tarv, s.data_inicio,
  r2.data_inscricao data_inscricao_tarv, r2.livro tarv_livro, r2.pagina tarv_pagina, r2.linha tarv_linha,
  p2.date_enrolled inscricao_tratamento, {_status('x.estado', 'u.proximo', END, 'SEM FILA')} estado_tarv,
  c.ultimo data_ultimo_segmento, c.proximo data_proximo_segmento, u.ultimo data_ultimo, u.proximo data_proximo,
  cd.cd4 "CD4", st.estadio, p5.date_enrolled programa_tb, p8.date_enrolled programa_ptv, us.username utilizador
 from (select * from ({OPENED_PERSON}) z where kind in (5,7,53)) o
 left join ({START_SQL['art_start_files']}) s on s.patient_id = o.patient_id {shared}
 left join ({PART_B}) b on b.patient_id = o.patient_id
 left join ({PRE_BOOK}) r1 on r1.patient_id = o.patient_id
 left join ({ART_BOOK}) r2 on r2.patient_id = o.patient_id
 left join ({booked('18', 5096, END, 'ultimo', 'proximo')}) u on u.patient_id = o.patient_id
 left join ({enrolled(2)}) p2 on p2.patient_id = o.patient_id
 left join ({exits(1, C.CARE_EXITS)}) y on y.patient_id = o.patient_id""")

    out["dsd_followup"] = sql(f"""
 select distinct a.patient_id, i.identifier "NID", {_full('n')} "NomeCompleto", {_years(END_ALL, 'pe.birthdate')} idade_actual,
  pe.gender sexo, a.data_diagnostico, s.data_inicio data_inicio_tarv, coalesce(r.ultimo_regime, 'OUTRO') ultimo_regime,
  v.data_primeiro_carga data_primeira_cv_suprimida, v.valor_primeira_carga primeira_cv_suprimida,
  m.data_inclusao_mdc, m.tipo_modelo, w.valor_ultima_carga "carga_viral_MDS",
  p.primeiro_levantamento "primeiro_levantamento_MDS", p.segundo_levantamento "segundo_levantamento_MDS",
  p.ultimo_levantamento "ultimo_levantamento_MDS", k.primeira_fichaapss, k.segunda_fichaapss, k.ultima_fichaapss
 from ({ENROLMENT}) a
 join ({CARE_MODEL}) m on m.patient_id = a.patient_id
 join ({COUNSELLING}) k on k.patient_id = m.patient_id and k.primeira_fichaapss >= m.data_inclusao_mdc
 left join ({PICKUP_HISTORY}) p on p.patient_id = m.patient_id
 left join ({FIRST_ID}) i on i.patient_id = a.patient_id
 left join person pe on pe.person_id = a.patient_id
 left join person_name n on n.person_id = a.patient_id and n.preferred = 1
 left join ({start_rows('18,6,9', '18,6,9,53', END_ALL, '', _external(END_ALL))}) s on s.patient_id = a.patient_id
 left join ({REGIMENS}) r on r.patient_id = a.patient_id
 left join ({first_vl(END_ALL)}) v on v.patient_id = a.patient_id
 left join ({unfiltered_vl(END_ALL)}) w on w.patient_id = a.patient_id""")

    columns = (
        "patient_id, NID, NomeCompleto, idade_actual, gender, data_inicio, gravida, data_ultimo, proximo_consulta,"
        " ultimo_levantamento, data_proximo, data_saida, estado, levantou"
    )
    rows = f"""
 select s.patient_id, i.identifier "NID", {_full('n')} "NomeCompleto", {_years(END3, 'pe.birthdate')} idade_actual,
  pe.gender, s.data_inicio, case when s.patient_id in ({PREGNANT_WINDOW}) then 'SIM' else '' end gravida,
  c.ultimo data_ultimo, c.proximo proximo_consulta, u.ultimo ultimo_levantamento, u.proximo data_proximo,
  x.data_saida, {_status('x.estado', 'u.proximo', END3, 'SEM FILA')} estado,
  case when count(s.seen) over (partition by s.patient_id) >= 3 then 'SIM' else '' end levantou
 from ({PICKED_99}) s
 left join ({FIRST_ID}) i on i.patient_id = s.patient_id
 left join person pe on pe.person_id = s.patient_id
 left join person_name n on n.person_id = s.patient_id and n.preferred = 1
 left join ({booked('6,9', 1410, END3, 'ultimo', 'proximo')}) c on c.patient_id = s.patient_id
 left join ({booked('18', 5096, END3, 'ultimo', 'proximo')}) u on u.patient_id = s.patient_id
 left join ({exits(2, C.TREATMENT_EXITS, END3)}) x on x.patient_id = s.patient_id"""
    out["three_pickups"] = sql(_one_each(columns, rows))
    out["result_set"] = sql(f"select patient_id, estado, levantou from ({_one_each(columns, rows)}) q")

    out["tpt_eligible"] = sql(f"""
 select us.name, e.patient_id, i.identifier "NID", {_full('n')} "NomeCompleto", pe.gender,
  {_years(END, 'pe.birthdate')} idade_actual, h.data_inicio_inh, h.data_fim_inh, s.data_inicio data_inicio_tarv,
  case when h.data_fim_inh is null then {_int(_days(END, 'h.data_inicio_inh'))} end dias_inh,
  case when h.data_fim_inh is null then {_months(END, 'h.data_inicio_inh')} end meses_inh
 from lv e join lp using (patient_id) join ({SITES}) us on us.patient_id = e.patient_id
 left join ({booked('6,9', 1410, END, 'ultimo', 'proximo', '')}) c on c.patient_id = e.patient_id
 left join ({FIRST_ID}) i on i.patient_id = e.patient_id
 left join person_name n on n.person_id = e.patient_id and n.voided = 0
 left join person pe on pe.person_id = e.patient_id and pe.voided = 0
 left join ({_screen(1066, 'neg')}) sn on sn.patient_id = e.patient_id
 left join ({_screen(1065, 'pos')}) sp on sp.patient_id = e.patient_id
 left join ({INVESTIGATION}) v on v.patient_id = e.patient_id
 left join ({INH_COURSE}) h on h.patient_id = e.patient_id
 left join ({START_SQL['art_start_all_sites']}) s on s.patient_id = e.patient_id
 where e.kind in (32, 53) and e.seen {_PERIOD}
  and (sn.neg is not null or (sp.pos is not null and v.resultado = 'NEGATIVO'))
  and (h.data_fim_inh is null or h.data_fim_inh > {END})""")
    return out


def _operators() -> dict[str, str]:
    names = "patient person person_name person_address person_attribute patient_identifier location users".split()
    names += "encounter obs patient_program patient_state".split()
    begun = START_SQL["art_start"]
    q: dict[str, str] = {
        "scan_tables": " union all ".join(f"select '{n}' table_name, count(*) n_rows from {n}" for n in names),
        "scan_live": "select encounter_id, patient_id, kind encounter_type, seen encounter_datetime from lv",
        "project_alias": f"select person_id patient_id, {titles('a')} from person_address a",
        "project_star": "select * from patient_identifier",
        "filter_in_list": "select encounter_id, encounter_type from encounter where encounter_type in (6, 9, 18)",
        "filter_range_inclusive": f"select encounter_id, encounter_datetime from encounter where encounter_datetime {_PERIOD}",
        "filter_or_pairs": f"select encounter_id, concept_id, value_coded from (select *, concept_id concept, value_coded coded from obs) t where {_TESTED}",
        "filter_not_null": "select person_id, obs_datetime, value_numeric from obs where concept_id = 856 and value_numeric is not null",
        "filter_computed_flag": f"""select patient_id from (select coalesce(a.patient_id, b.patient_id) patient_id,
          case when neg is not null then 'SIM' when pos < {END} then 'SIM' else 'NAO' end flag
          from ({_screen(1066, 'neg')}) a full join ({_screen(1065, 'pos')}) b on a.patient_id = b.patient_id) z where flag = 'SIM'""",
        "join_inner_equi": f"select patient_id, encounter_id, coded value_coded from va join lp using (patient_id) where concept = 1255 and kind in (18,6,9)",
        "join_left_equi": "select p.person_id patient_id, gender, a.value contacto from person p left join person_attribute a on a.person_id = p.person_id and a.person_attribute_type_id = 9",
        "join_left_filtered_right": f"select e.encounter_id, o.dt value_datetime from lv e left join la o on o.encounter_id = e.encounter_id and o.concept = 5096 where e.kind = 18 and e.seen <= {END} and e.site = 1",
        "join_left_pred_on_left": "select g.patient_program_id, g.program_id, s.state from lprog g left join patient_state s on s.patient_program_id = g.patient_program_id and s.voided = 0 and g.program_id = 2",
        "join_left_then_where": "select e.encounter_id, e.patient_id from encounter e left join obs o on o.encounter_id = e.encounter_id where e.encounter_type = 52 and o.concept_id = 23865 and o.value_coded = 1065",
        "join_comma_where": f"select l.patient_id, l.moment, o.coded value_coded from la o, (select patient_id, max(seen) moment from lv where kind = 18 and site = 1 and seen <= {END} group by 1) l where o.patient_id = l.patient_id and o.told = l.moment and o.concept = 1088",
        "join_on_missing_where": "select a.patient_id, a.patient_identifier_id, a.identifier from patient_identifier a, (select patient_id, min(patient_identifier_id) id from patient_identifier where voided = 0 group by 1) b where a.patient_id = b.patient_id and a.patient_identifier_id = b.id",
        "join_self_obs": "select t.encounter_id, t.concept concept_id, t.coded value_coded, d.dt data_abertura from la t join la d on d.encounter_id = t.encounter_id and d.concept = 23891 where t.concept in (23779, 1030, 1040)",
        "join_theta_extra": INH_COURSE,
        "join_range_window": f"select s.patient_id, s.data_inicio, e.seen encounter_datetime from ({WINDOW_STARTS}) s join lv e on e.patient_id = s.patient_id and e.kind = 18 and e.site = 1 and e.seen between s.data_inicio and s.data_inicio + interval 99 day",
        "join_semi": f"select person_id patient_id from person where gender = 'F' and person_id in ({PREGNANT_SQL['pregnant_ids']})",
        "join_anti": f"select * from ({begun}) s where patient_id not in ({PREGNANT_SQL['pregnant_ids']})",
        "join_flag_exists": f"select patient_id, case when patient_id in ({PREGNANT_SQL['pregnant_ids_suppressed']}) then 'SIM' else '' end gravida from ({begun}) s",
        "join_dim_lookup": f"select e.encounter_id, l.name, u.username from lv e join location l on l.location_id = e.site left join users u on u.user_id = e.creator where e.kind = 53 and e.seen <= {END}",
        "agg_min_max_by_key": f"select patient_id, min(seen) primeiro, max(seen) ultimo from lv where kind = 18 and site = 1 and seen <= {END} group by 1",
        "agg_count": "select patient_id, count(seen) levantamentos, case when count(seen) >= 3 then 'SIM' else '' end levantou from lv where kind = 18 and site = 1 group by 1",
        "agg_having": "select patient_id person_id, max(num) maior_carga from la where concept = 856 group by 1 having max(num) < 1000",
        "agg_having_tautology": f"select patient_id, min(seen) primeira, max(seen) ultima from lv where kind in (34,35) and seen <= {END_ALL} group by 1 having arg_min(seen, encounter_id) between min(seen) and max(seen)",
        "agg_loose_group_by": "select patient_id, start_date data_estado, state estado_id from lstate where program_id = 2 and site = 1 and state in (7,8,9,10) qualify row_number() over (partition by patient_id order by start_date desc, state desc) = 1",
        "distinct_rows": "select distinct patient_id, location_id from encounter",
        "dedupe_by_key": """select n.person_id patient_id, given_name, middle_name, family_name, a.value contacto from person_name n
          left join person_attribute a on a.person_id = n.person_id and a.person_attribute_type_id = 9
          qualify row_number() over (partition by n.person_id order by given_name nulls last, middle_name nulls last, family_name nulls last, a.value nulls last) = 1""",
        "first_row_by_id": f"""select i.patient_id, i.identifier, case when n.person_id is not null then {_full('n')} end nome, {titles('ad')}
          from ({FIRST_ID}) i left join ({FIRST_NAME}) n on n.person_id = i.patient_id left join ({FIRST_ADDRESS}) ad on ad.person_id = i.patient_id""",
        "latest_event": f"select patient_id, max(seen) ultimo_segmento from lv where kind in (6,9) and site = 1 and seen <= {END} group by 1",
        "latest_event_join_value": f"select l.patient_id, l.ultimo, o.dt value_datetime from (select patient_id, max(seen) ultimo from lv where kind = 18 and site = 1 and seen <= {END} group by 1) l join la o on o.patient_id = l.patient_id and o.told = l.ultimo and o.concept = 5096",
        "earliest_event_join_value": f"select l.patient_id, l.primeiro, o.num value_numeric from (select patient_id, min(seen) primeiro from lv where kind = 13 and site = 1 and seen <= {END} group by 1) l join la o on o.patient_id = l.patient_id and o.told = l.primeiro and o.concept in (856, 5497)",
        "first_second_last": three_moments(f"select patient_id, seen from lv where kind in (6,9) and site = 1 and seen <= {END}", "primeira", "segunda", "ultima"),
        "union_distinct": f"select patient_id from lv where kind = 18 and site = 1 and seen <= {END} union select patient_id from lprog where program_id = 2 and site = 1",
        "full_name": f"select person_name_id, {_full('n')} \"NomeCompleto\", given_name || ' ' || family_name nome_curto from person_name n",
        "age_years_365": f"select person_id, {_years(END, 'birthdate')} idade from person",
        "age_years_360": f"select person_id, {_years(END, 'birthdate', 360)} idade from person",
        "child_flag": f"select person_id, case when {_years(END, 'birthdate')} < 5 then 'Criança (<5 anos)' else '' end crianca from person",
        "fn_ifnull": "select person_name_id, ifnull(middle_name, '') nome from person_name",
        "fn_nested_if": "select encounter_id, concept_id, case when value_coded in (6259, 6261) then 'LIVRO 1' else case when value_coded in (6260, 6262) then 'LIVRO 2' else '' end end livro from obs where concept_id in (6263, 6264)",
        "fn_case": f"select encounter_id, {_case('value_coded', C.REFERRALS, C.OTHER)} referencia from obs where concept_id = 1594",
        "fn_round_datediff": f"select encounter_id, {_int(_days(END, 'encounter_datetime'))} dias, {_months(END, 'encounter_datetime')} meses, {_days(END, 'encounter_datetime')} / 30 meses_exatos from encounter",
        "fn_add_days_months": "select encounter_id, encounter_datetime + interval 60 day mais_60_dias, encounter_datetime + interval 6 month mais_6_meses, encounter_datetime - interval 10 month menos_10_meses, cast(date_created as date) dia from encounter",
        "fn_min_max_count": "select concept_id, min(value_numeric) menor, max(value_numeric) maior, count(value_numeric) n_valores from obs group by concept_id",
        "fn_number_text": f"select encounter_id, {_VL_TEXT.replace('num', 'value_numeric')} valor_carga from obs where concept_id = 856",
        "art_start_plus_months": f"select patient_id, data_inicio + interval 6 month data6meses, data_inicio + interval 3 month data3meses from ({begun}) s",
        "months_on_art_filter": f"select patient_id, {_months(END, 'data_inicio')} >= 6 seis_meses, {_days(END, 'data_inicio')} >= 180 dias_180 from ({begun}) s where {_months(END, 'data_inicio')} >= 3",
        "art_start_in_window": WINDOW_STARTS,
        "open_exit_state": exits(2, C.TREATMENT_EXITS),
        "open_pre_art_state": exits(1, C.CARE_EXITS),
        "transfer_in_ids": f"select distinct patient_id from ({MOVED_IN}) m",
        "care_status_text": f"""select u.patient_id, u.ultimo_levantamento, u.proximo_lev, {_status('x.estado', 'u.proximo_lev', END, 'SEM FILA')} estado
          from ({booked('18', 5096, END, 'ultimo_levantamento', 'proximo_lev')}) u left join ({exits(2, C.TREATMENT_EXITS)}) x on x.patient_id = u.patient_id""",
        "last_visit_next_date": booked("6,9", 1410, END, "ultimo_segmento", "proxima_consulta"),
        "last_pickup_next_date": booked("18", 5096, END, "ultimo_levantamento", "proximo_lev"),
        "last_pickup_multi_source": TWO_PICKUPS,
        "pickups_within_99_days": f"select patient_id, data_inicio, count(seen) levantamentos from ({PICKED_99}) s group by 1, 2",
        "last_viral_load": f"select patient_id, data_carga, {_VL_TEXT} valor_carga from ({LAST_VL}) v",
        "last_vl_unfiltered": unfiltered_vl(END),
        "vl_failure_filter": f"select patient_id, data_carga, num valor_carga from ({LAST_VL}) v where num >= 1000 and {_days(END, 'data_carga')} / 30 > 3",
        "vl_suppressed_rows": SUPPRESSED,
        "first_vl_suppressed": first_vl(END),
        "vl_not_due_ids": NOT_DUE,
        "first_cd4": CD4,
        "first_who_stage": STAGE,
        "last_regimen": LAST_REGIMEN,
        "all_regimens": REGIMENS,
        "referral_source": REFERRAL,
        "reference_person": CONTACT,
        "reference_person_fallback": CONTACT_PAIR,
        "phone_attribute": "select person_id patient_id, value contacto from person_attribute where person_attribute_type_id = 9",
        "preferred_demographics": f"""select i.patient_id, i.identifier, case when n.person_id is not null then {_full('n')} end "NomeCompleto", {titles('ad')}
          from patient_identifier i left join person_name n on n.person_id = i.patient_id and n.preferred = 1
          left join person_address ad on ad.person_id = i.patient_id and ad.preferred = 1 and ad.voided = 0
          where i.identifier_type in (2, 13) and i.preferred = 1""",
        "file_opened_in_period": f"select patient_id, data_abertura, creator, sexo, dead, death_date, idade_abertura, idade from ({OPENED_PERSON}) z where kind in (5, 7, 53)",
        "part_b_opened": PART_B,
        "register_book": f"select *, 'pre' registo from ({PRE_BOOK}) a union all select *, 'tarv' registo from ({ART_BOOK}) b",
        "program_enrolment": "select patient_id, date_enrolled, program_id from lprog where program_id in (1, 2, 5, 8) and site = 1 and patient_id in (select patient_id from lp)",
        "first_enrolment_with_diagnosis": ENROLMENT,
        "dsd_model_enrolment": CARE_MODEL,
        "pickup_history": PICKUP_HISTORY,
        "counselling_history": COUNSELLING,
        "counselling_after_dsd": f"select m.*, k.primeira_fichaapss, k.segunda_fichaapss, k.ultima_fichaapss from ({CARE_MODEL}) m join ({COUNSELLING}) k on k.patient_id = m.patient_id and k.primeira_fichaapss >= m.data_inclusao_mdc",
        "tb_screening": f"select coalesce(a.patient_id, b.patient_id) patient_id, data_rastreio_neg, data_rastreio_pos from ({_screen(1066, 'data_rastreio_neg')}) a full join ({_screen(1065, 'data_rastreio_pos')}) b on a.patient_id = b.patient_id",
        "tb_investigation": INVESTIGATION,
        "inh_start": INH_START,
        "inh_end": INH_END,
        "inh_course": INH_COURSE,
        "inh_elapsed": f"select patient_id, case when data_fim_inh is null then {_int(_days(END, 'data_inicio_inh'))} end dias_inh, case when data_fim_inh is null then {_months(END, 'data_inicio_inh')} end meses_inh from ({INH_COURSE}) c",
        "tpt_rule": f"""select distinct p.patient_id, h.data_inicio_inh, h.data_fim_inh from lp p
          left join ({_screen(1066, 'neg')}) sn on sn.patient_id = p.patient_id left join ({_screen(1065, 'pos')}) sp on sp.patient_id = p.patient_id
          left join ({INVESTIGATION}) v on v.patient_id = p.patient_id left join ({INH_COURSE}) h on h.patient_id = p.patient_id
          where (sn.neg is not null or (sp.pos is not null and v.resultado = 'NEGATIVO')) and (h.data_fim_inh is null or h.data_fim_inh > {END})""",
        "patient_sites": SITES,
    }
    q.update(START_SQL)
    q.update(PREGNANT_SQL)
    out = {name: sql(body) for name, body in q.items()}
    state = _case("estado_id", C.TREATMENT_EXITS, None)
    out["exit_state_at_end"] = sql(f"select patient_id, data_estado, estado_id, {state} estado from judged", STATE_AT_END)
    out["last_pickup_and_visit"] = sql("select patient_id, data_inicio, data_fila, data_seguimento from filed", STATE_AT_END)
    out["next_appointment"] = sql("select patient_id, data_proximo_lev, data_proximo_seguimento from planned", STATE_AT_END)
    out["estimated_next_visit"] = sql("select patient_id, data_proximo_seguimento_estimada from planned", STATE_AT_END)
    out["final_state"] = sql("select patient_id, cast(estado_final as int) estado_final from judged", STATE_AT_END)
    return out


def all_oracles() -> dict[str, str]:
    return {**_operators(), **_reports()}
