"""The clinical tables as a view of an order star (used for checks and timing).

Customers are patients, orders are visits, line items are observations. The
values are arbitrary but deterministic; ``FIXTURES.md`` part B gives the rule.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from carelens.schema import SCHEMAS
from carelens.sources.tables import ClinicalTables, typed


def _pick(key: str, values: str) -> str:
    size = len(values.split(","))
    return f"element_at(array({values}), cast(({key}) % {size} as int) + 1)"


# The visit types and, per visit type, the concepts observed.
_VISIT_TYPES = "18,6,18,9,13,5,6,18,53,18,6,32,33,35,52,7,1,3,34,18"
_CONCEPTS = {
    "18": "1088,5096,1255,1190,23724,23730",
    "6,9": "856,1410,1255,1190,5356,1982,1600,1279,6257,23758,6277,23761,6128,6122,6129,23730",
    "13": "856,5497",
    "5,7": "1594,1611,6123,1982,1279,1600,6224",
    "53": "1190,1255,23891,23779,1030,1040,856,5272,6129,1611,6224",
    "52": "23865,23866",
    "32": "6263,6265,6267",
    "33": "6264,6266,6268",
}

_CODED = (
    f"case when cid = 1255 then {_pick('v', '1256,1257')}"
    f" when cid = 1088 then {_pick('v', '1651,6324,1703,6243,6108,23784,9999')}"
    f" when cid = 1982 then {_pick('v', '44,1465,1066')}"
    " when cid in (6257,23758) then cast(1065+v%2 as int)"
    f" when cid in (6277,23761) then {_pick('v', '703,664,1065')}"
    f" when cid = 6122 then {_pick('v', '1256,1267')}"
    " when cid = 5356 then 1204+v%5"
    f" when cid = 1594 then {_pick('v', '1595,1596,1414,9999')}"
    " when cid in (23779,1030) then 703 when cid in (1040,23865,5272) then 1065"
    " when cid = 6263 then 6259+v%2 when cid = 6264 then 6261+v%2"
    " when cid in (23724,23730) then 1256 end"
)

_BIRTH = (
    "cast(timestamp_ntz'1955-01-01 00:00:00' + make_dt_interval(cast((c_custkey*37)%15000 as int))"
    " as date)"
)
_VOID_PATIENT = "case when c_custkey%50 = 7 then 1 else 0 end"


def _copies(customer: DataFrame, second: str) -> DataFrame:
    """One row k=0 per customer and one more, k=1, where ``second`` holds."""
    return customer.withColumn(
        "k", F.explode(F.expr(f"case when {second} then array(0, 1) else array(0) end"))
    )


def _concept_rule() -> tuple[str, str]:
    """Whether a line's visit has observations, and the concept, by the visit's key and
    the part: one flat list, where each visit type has a first place and a number of
    places. Lines without a visit may hold any keys, so these give null and no error."""
    flat: list[str] = []
    first, size = {}, {}
    for kinds, values in _CONCEPTS.items():
        own = values.split(",")
        for kind in kinds.split(","):
            first[kind], size[kind] = len(flat), len(own)
        flat += own
    kinds = _VISIT_TYPES.split(",")

    def get(values, place: str) -> str:
        # as element_at counts: places below 0 from the end, and none before the first
        shown = ",".join("null" if v is None else str(v) for v in values)
        return f"get(array({shown}), cast(pmod({place}, {len(values) + 1}) as int))"

    kind = f"l_orderkey % {len(kinds)}"
    places = get([size.get(k) for k in kinds], kind)
    return f"{places} is not null", get(flat, f"{get([first.get(k) for k in kinds], kind)} + l_partkey % {places}")


class _Star:
    """The clinical tables, each as a view of the star tables it needs."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark, self._dir = spark, sf_dir
        self._found: dict[str, DataFrame] = {}

    def _read(self, name: str) -> DataFrame:
        if name not in self._found:
            self._found[name] = self._spark.read.parquet(f"{self._dir}/{name}.parquet")
        return self._found[name]

    def patient(self) -> DataFrame:
        return self._read("customer").selectExpr("c_custkey patient_id", f"{_VOID_PATIENT} voided")

    def person(self) -> DataFrame:
        return self._read("customer").selectExpr(
            "c_custkey person_id",
            "case when (c_custkey div 2)%2 = 0 then 'F' else 'M' end gender",
            f"{_BIRTH} birthdate",
            "case when c_custkey%29 = 0 then 1 else 0 end dead",
            "case when c_custkey%29 = 0 then date'2001-06-01' end death_date",
            f"{_VOID_PATIENT} voided",
        )

    def person_name(self) -> DataFrame:
        return _copies(self._read("customer"), "c_custkey%5 = 2").selectExpr(
            "c_custkey*2+k person_name_id",
            "c_custkey person_id",
            "c_mktsegment given_name",
            "case when c_custkey%3 = 0 then null else concat('M', k) end middle_name",
            "c_name family_name",
            "1-k preferred",
            "case when k = 0 and c_custkey%19 = 5 then 1 else 0 end voided",
        )

    def person_address(self) -> DataFrame:
        return (
            _copies(self._read("customer"), "c_custkey%7 = 3")
            .join(self._read("nation"), F.col("n_nationkey") == F.col("c_nationkey"))
            .selectExpr(
                "c_custkey*2+k person_address_id",
                "c_custkey person_id",
                "n_name county_district",
                "concat('A1-', k) address1",
                "'A2' address2",
                "'A5' address5",
                "'A6' address6",
                "1-k preferred",
                "case when k = 0 and c_custkey%23 = 6 then 1 else 0 end voided",
            )
        )

    def person_attribute(self) -> DataFrame:
        return self._read("customer").selectExpr(
            "c_custkey person_id",
            "case when c_custkey%4 = 0 then 8 else 9 end person_attribute_type_id",
            "concat('tel-', c_custkey) value",
        )

    def patient_identifier(self) -> DataFrame:
        return _copies(self._read("customer"), "c_custkey%4 = 1").selectExpr(
            "c_custkey*2+k patient_identifier_id",
            "c_custkey patient_id",
            "concat(c_name, '/', k) identifier",
            "case when c_custkey%3 = 0 then 13 when c_custkey%11 = 0 then 5 else 2 end identifier_type",
            "1-k preferred",
            "case when k = 0 and c_custkey%17 = 4 then 1 else 0 end voided",
        )

    def location(self) -> DataFrame:
        return self._read("nation").selectExpr("n_nationkey location_id", "n_name name")

    def users(self) -> DataFrame:
        return self._read("supplier").selectExpr("s_suppkey user_id", "s_name username")

    def encounter(self) -> DataFrame:
        return self._read("orders").selectExpr(
            "o_orderkey encounter_id",
            "o_custkey patient_id",
            f"{_pick('o_orderkey', _VISIT_TYPES)} encounter_type",
            "o_orderdate encounter_datetime",
            "o_custkey%2 location_id",
            "o_orderkey%10 creator",
            "o_orderdate + interval '1' day date_created",
            "case when o_orderkey%20 in (13, 18) then 164 end form_id",
            "case when o_orderkey%41 = 3 then 1 else 0 end voided",
        )

    def obs(self) -> DataFrame:
        # visits of other types have no observations
        seen = self.encounter().where(f"encounter_type in ({','.join(_CONCEPTS)})").select(
            "encounter_id", "patient_id", "encounter_datetime", "location_id"
        )
        # the visit type, and with it the concept, follows from the key that lines and visits
        # are joined on, so a report's choice of concepts is made before the join
        observed, concept = _concept_rule()
        return (
            self._read("lineitem")
            .where(observed)
            .selectExpr(
                "l_orderkey encounter_id", f"{concept} cid", "l_quantity", "l_extendedprice",
                "cast(l_suppkey+l_linenumber as int) v",
            )
            .join(seen, "encounter_id")
            .selectExpr(
                "patient_id person_id",
                "encounter_id",
                "encounter_datetime obs_datetime",
                "location_id",
                "cid concept_id",
                f"{_CODED} value_coded",
                "case when cid = 856 then case when v%11 = 0 then -1.0D when v%13 = 0 then null"
                " else l_extendedprice/50 end when cid = 5497 then l_extendedprice/100"
                " when cid in (6265,6266,6267,6268) then l_quantity end value_numeric",
                "case when cid in (5096,1410) then encounter_datetime"
                " + make_dt_interval(cast(10+l_quantity as int))"
                " when cid in (1190,6123,23866,23891,6128) then encounter_datetime"
                " - make_dt_interval(cast(l_quantity as int))"
                " when cid = 6129 then encounter_datetime + interval '180' day end value_datetime",
                "case when cid in (1611,6224) then concat('ref-', v) end value_text",
                "case when v%43 = 5 then 1 else 0 end voided",
            )
        )

    def patient_program(self) -> DataFrame:
        return self._read("orders").where("o_orderkey%3 = 0").selectExpr(
            "o_orderkey patient_program_id",
            "o_custkey patient_id",
            f"{_pick('o_orderkey', '1,2,2,5,8')} program_id",
            "o_orderdate date_enrolled",
            "o_custkey%2 location_id",
            "case when o_orderkey%41 = 3 then 1 else 0 end voided",
        )

    def patient_state(self) -> DataFrame:
        turn = "patient_program_id div 15"
        return self.patient_program().selectExpr(
            "patient_program_id",
            f"case when program_id = 1 then {_pick(turn, '2,3,4,5')}"
            f" else {_pick(turn, '7,8,9,10,29')} end state",
            f"date_enrolled + make_dt_interval(case when ({turn})%5 = 4 then 0 else 200 end) start_date",
            "case when (patient_program_id div 7)%3 = 0 then null"
            " else date_enrolled + interval '400' day end end_date",
            "case when patient_program_id%37 = 5 then 1 else 0 end voided",
        )


def clinical_from_star(spark: SparkSession, sf_dir: str) -> ClinicalTables:
    """Views of the star. The observations are a join of its two largest tables
    wherever they are read; ``store_tables`` to a path of one's own and
    ``load_tables`` from it spare that where many reports are made."""
    star = _Star(spark, sf_dir)
    return ClinicalTables(**{name: (lambda name=name: typed(name, getattr(star, name)())) for name in SCHEMAS})
