"""Helpers that several operators share."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A word, for counting: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path for an intermediate table, in the shared folder that
    ``spark.checkpoint.dir`` names. A single-machine session without that
    setting (tests) gets a temporary folder; a cluster without it is refused,
    because its machines would not see each other's files."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="carelens-"))
        folder = context.getCheckpointDir()
    return f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes a table to the shared folder and reads it again: what follows
    doesn't depend on executors that made it, and its size is known."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_of(column: str | Column = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def held_out(column: str = "doc_id") -> Column:
    """Rows that nothing is learned from: crc32 of the id as text, modulo 4, is 2."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % 4 == 2


def packed(df: DataFrame, **own: Column) -> DataFrame:
    """The whole input row as ``row`` and the operator's own columns beside it,
    so that no column name of the input can clash with them."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"),
                     *[c.alias(n) for n, c in own.items()])


#: What tasks add to a row: Spark's names with the types on either side.
KINDS = {
    "bigint": (T.LongType(), pa.int64()),
    "int": (T.IntegerType(), pa.int32()),
    "double": (T.DoubleType(), pa.float64()),
    "string": (T.StringType(), pa.string()),
    "boolean": (T.BooleanType(), pa.bool_()),
    "binary": (T.BinaryType(), pa.binary()),
}


def carrying(docs: DataFrame, columns: list[str], text: str, *more: Column) -> DataFrame:
    """(row, text, ...): some columns of the input row, and its text, for a task."""
    row = F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row")
    return docs.select(row, text_of(text).alias("text"), *more)


def give_back() -> None:
    """Gives the system what earlier tasks of this Python worker have freed: workers are
    used again by later stages, beside an executor that needs the memory."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # GNU's C library has it
    if trim:
        trim(0)


def mapped(
    rows: DataFrame, make: Callable[[], Callable[..., Iterable[Sequence]]], added: dict[str, str],
    at_once: int | None = None,
) -> DataFrame:
    """``row`` and the added columns of ``rows`` (row, text and maybe more columns).

    ``make`` is called once in each task and returns a function from the lists of
    texts, and of the other columns' values, to one sequence per added column. The
    input row passes as it is, so whatever its columns hold comes back unchanged.
    With ``at_once``, lists have that many rows at most, whatever Spark sends together."""
    schema = T.StructType([rows.schema["row"]])
    for name, kind in added.items():
        schema.add(name, KINDS[kind][0])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        run = make()
        for whole in batches:
            step = at_once or max(whole.num_rows, 1)
            for batch in (whole.slice(k, step) for k in range(0, whole.num_rows, step)):
                values = [batch.column(i).to_pylist() for i in range(1, batch.num_columns)]
                made = [pa.array(v, type=KINDS[kind][1]) for v, kind in zip(run(*values), added.values(), strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0), *made], ["row", *added])

    return rows.mapInArrow(task, schema)


def chosen(docs: DataFrame, text: str, make: Callable[[], Callable[[list[str]], Sequence[bool]]]) -> DataFrame:
    """The rows of ``docs`` for whose texts the made function says yes, unchanged."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        run = make()
        for batch in batches:
            if batch.num_rows:
                texts = [t or "" for t in batch.column(batch.schema.get_field_index(text)).to_pylist()]
                yield batch.filter(pa.array(run(texts), type=pa.bool_()))

    return docs.mapInArrow(task, docs.schema)


#: Names of the columns that ``with_keys`` adds.
KEY, REPEATED = "__key", "__repeated"
#: Repeated ids up to which their list (9 bytes each) is broadcast; it is joined beyond.
BROADCAST_IDS = 500_000


def with_keys(docs: DataFrame) -> DataFrame:
    """``docs`` with KEY, an id that rows of different texts never share, and REPEATED,
    whether other rows carry the row's id.

    The key is the id, but of an id with several texts it is a hash of id and text, from
    2^62 on: after all other ids. Rows without an id have no key. Only ids and hashes
    are grouped, and texts are joined with repeated ids alone."""
    hashed = docs.select(F.col("doc_id").alias("__id"), F.xxhash64(text_of()).alias("h")).where(F.col("__id").isNotNull())
    ids = stored(hashed.groupBy("__id").agg(F.count("*").alias("n"), F.min("h").alias("lo"), F.max("h").alias("hi"))
                 .where("n > 1").select("__id", (F.col("lo") != F.col("hi")).alias("several")), "repeated-ids")
    n = ids.count()
    if not n:
        return docs.withColumn(KEY, F.col("doc_id")).withColumn(REPEATED, F.lit(False))
    own = F.xxhash64("doc_id", text_of()).bitwiseAND(F.lit((1 << 62) - 1)) + F.lit(1 << 62)
    marked = docs.join(F.broadcast(ids) if n <= BROADCAST_IDS else ids, F.col("doc_id") == F.col("__id"), "left")
    return marked.withColumn(KEY, F.when(F.col("several"), own).otherwise(F.col("doc_id"))).withColumn(
        REPEATED, F.col("__id").isNotNull()).drop("__id", "several")
