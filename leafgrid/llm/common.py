"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space, as a character class body.
BLANK = r"\x20\x09-\x0D"
#: A word: a maximal run of anything else.
WORD = rf"[^{BLANK}]+"
BLANK_CHARS = "\x20\x09\x0a\x0b\x0c\x0d"

#: A side of a join is sent to every executor only up to this many rows of a few
#: dozen bytes each; beyond it the same join runs as a shuffle.
BROADCAST_ROWS = 500_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.  Only a local master, whose tasks all
    see the driver's disk, may go without: then it is a temporary folder."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("intermediate tables need a folder that all executors share: set spark.checkpoint.dir")
        named = "file://" + tempfile.mkdtemp(prefix="leafgrid-")
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


def new_path(spark: SparkSession, what: str) -> str:
    return f"{shared_dir(spark)}/leafgrid-{what}-{uuid.uuid4().hex}"


def written(df: DataFrame, what: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read again: lineage ends at
    files that every executor sees, so the loss of an executor costs a re-read."""
    path = new_path(df.sparkSession, what)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.written_path = path
    return out


def discard(df: DataFrame) -> None:
    """Removes the files of a frame that ``written`` returned and nothing reads any more."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(df.written_path)
    path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


#: What this worker keeps from task to task, one thing at a time.
KEPT: dict = {}


def kept(key: tuple, make: Callable[[], object]) -> object:
    """What the worker keeps under ``key``, made at first use in place of anything else."""
    if key not in KEPT:
        forget()
        KEPT[key] = make()
    return KEPT[key]


def give_back() -> None:
    """Freed memory goes back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def forget() -> None:
    if KEPT:
        KEPT.clear()
        give_back()


def lean(mapper: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], keeps: bool = False) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A mapper whose worker gives freed memory back when the task ends: workers live on
    beside the executor's own memory, and what they keep adds up over the stages of a job.
    Unless it ``keeps``, it starts by freeing what another mapper has :func:`kept`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not keeps:
            forget()
        try:
            yield from mapper(batches)
        finally:
            give_back()

    return run


def quoted(name: str) -> str:
    """A column's name as an expression, whatever characters it has."""
    return "`" + name.replace("`", "``") + "`"


def row_of(docs: DataFrame) -> Column:
    """All columns of ``docs`` as the struct ``row``, so that none can clash."""
    return F.struct(*[F.col(quoted(c)).alias(c) for c in docs.columns]).alias("row")


def row_columns(names: list[str]) -> list[Column]:
    """The columns out of the struct ``row`` again."""
    return [F.col("row").getField(c).alias(c) for c in names]


def maybe_broadcast(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """A broadcast hint only after ``df`` has been counted and is within ``limit``."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once for the row, not once per use."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def running_sums(sizes: Column, chunk: int = 256) -> Column:
    """For each element the sum of it and all before.  The fold appends to arrays of at
    most ``chunk`` elements and to one of a chunk each, so the work is about linear."""
    zero = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<bigint>").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        now = acc["at"] + x
        return F.struct(now.alias("at"), F.concat(acc["out"], F.array(now)).alias("out"))

    def whole(x: Column) -> Column:
        starts = F.sequence(F.lit(0), F.floor((F.size(x) - 1) / chunk).cast("int"))
        parts = F.transform(starts, lambda c: F.aggregate(F.slice(x, c * chunk + 1, chunk), zero, step))

        def moved(own: Column) -> Column:
            ends = F.aggregate(F.transform(own, lambda a: a["at"]), zero, step, lambda acc: acc["out"])
            return let(ends, lambda e: F.flatten(F.transform(own, lambda a, i: F.transform(a["out"], lambda v: v + F.coalesce(F.get(e, i - 1), F.lit(0))))))

        return let(parts, moved)

    return let(sizes, lambda x: F.when(F.size(x) > 0, whole(x)).otherwise(F.array().cast("array<bigint>")))


def word_count(text: Column) -> Column:
    """Number of words; null counts as empty.  Builds one short string and no array."""
    marks = F.regexp_replace(F.coalesce(text, F.lit("")), rf"[{BLANK}]*{WORD}", "x")
    return F.length(F.rtrim(marks, F.lit(BLANK_CHARS))).cast("long")


def words(text: Column) -> Column:
    """The words as an array; null and empty texts give an empty array."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(rf"({WORD})"), F.lit(1))
