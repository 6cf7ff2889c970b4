"""Where the clinical tables come from: Parquet, or a live database over JDBC."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from carelens.schema import SCHEMAS


class ClinicalTables:
    """The twelve tables as attributes. A table may be given as a function,
    which is called when the table is first used."""

    def __init__(self, **tables: DataFrame | Callable[[], DataFrame]):
        missing = set(SCHEMAS) ^ set(tables)
        if missing:
            raise ValueError(f"tables missing or unknown: {sorted(missing)}")
        self._tables = tables

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in self._tables:
            raise AttributeError(name)
        found = self._tables[name]
        if not isinstance(found, DataFrame):
            found = self._tables[name] = found()
        return found

    def named(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in SCHEMAS}


# The column on which a database read is cut into ranges.
_RANGE_KEY = {
    "patient": "patient_id",
    "person": "person_id",
    "person_name": "person_name_id",
    "person_address": "person_address_id",
    "person_attribute": "person_id",
    "patient_identifier": "patient_identifier_id",
    "location": "location_id",
    "users": "user_id",
    "encounter": "encounter_id",
    "obs": "encounter_id",
    "patient_program": "patient_program_id",
    "patient_state": "patient_program_id",
}


@dataclass(frozen=True)
class JdbcSource:
    """A database read. Each table is read in up to ``pieces`` parallel ranges of its key
    with about equally many rows each, whatever gaps the keys have: the database is asked
    for the first key of each such part, which is a row per piece. ``cuts`` gives a table's
    cut points instead; ``bounds`` gives its smallest and largest key, between which
    ranges are equally wide."""

    url: str
    properties: dict[str, str] = field(default_factory=dict)
    bounds: dict[str, tuple[int, int]] = field(default_factory=dict)
    pieces: int = 64
    cuts: dict[str, list[int]] = field(default_factory=dict)

    def _cuts(self, spark: SparkSession, name: str) -> list[int]:
        """Ascending keys at which a new range begins."""
        if name in self.cuts:
            return sorted(set(self.cuts[name]))
        key = _RANGE_KEY[name]
        parts = f"select {key} k, ntile({self.pieces}) over (order by {key}) part from {name} where {key} is not null"
        asked = f"(select min(k) cut from ({parts}) ranked group by part) cuts"
        found = spark.read.jdbc(self.url, asked, properties=dict(self.properties)).collect()
        return sorted({int(r[0]) for r in found})[1:]

    def predicates(self, spark: SparkSession, name: str) -> list[str]:
        """Conditions that every row meets exactly one of; missing keys go with the
        smallest. A key with very many rows is one range, since cuts lie between keys."""
        key, cuts = _RANGE_KEY[name], self._cuts(spark, name)
        if not cuts:
            return ["1 = 1"]
        inner = [f"{key} >= {a} and {key} < {b}" for a, b in zip(cuts, cuts[1:], strict=False)]
        return [f"{key} < {cuts[0]} or {key} is null", *inner, f"{key} >= {cuts[-1]}"]

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        options: dict = {"properties": dict(self.properties)}
        if name in self.bounds:
            low, high = self.bounds[name]
            options.update(column=_RANGE_KEY[name], lowerBound=low, upperBound=high + 1, numPartitions=self.pieces)
        else:
            options["predicates"] = self.predicates(spark, name)
        return spark.read.option("preferTimestampNTZ", "true").jdbc(self.url, name, **options)


def typed(name: str, df: DataFrame) -> DataFrame:
    """The columns of a table in order, cast to its types."""
    return df.selectExpr(
        *[f"cast({c.name} as {c.dataType.simpleString()}) {c.name}" for c in SCHEMAS[name]]
    )


def read_table(spark: SparkSession, name: str, path: str) -> DataFrame:
    schema = SCHEMAS[name]
    return spark.read.schema(schema).parquet(path).select(schema.fieldNames())


def load_tables(spark: SparkSession, source: str | JdbcSource) -> ClinicalTables:
    """The twelve tables of a folder of Parquet tables or of a database."""

    def reader(name: str) -> Callable[[], DataFrame]:
        if isinstance(source, JdbcSource):
            return lambda: typed(name, source.read(spark, name))
        return lambda: read_table(spark, name, f"{source}/{name}")

    return ClinicalTables(**{name: reader(name) for name in SCHEMAS})


# Folders by which the two fact tables are pruned: every report names the visit
# types and the concepts it looks at, so whole folders are never opened.
_FOLDERS = {"encounter": "encounter_type", "obs": "concept_id"}


def store_table(name: str, df: DataFrame, path: str) -> None:
    """Write one table, a fact table in folders. The rebalance gathers a folder
    in few files, and splits it over many tasks where it is large: a concept
    that holds a third of all rows is not written by one task."""
    folder = _FOLDERS.get(name)
    if folder is None:
        df.write.mode("overwrite").parquet(path)
    else:
        df.hint("rebalance", folder).write.mode("overwrite").partitionBy(folder).parquet(path)


def store_tables(tables: ClinicalTables, target: str) -> None:
    """Write an extract that ``load_tables`` reads back."""
    for name, df in tables.named().items():
        store_table(name, df, f"{target}/{name}")


def live(df: DataFrame) -> DataFrame:
    """Rows that are not soft-deleted; the test reaches the reader."""
    return df.where("voided = 0")
