"""Progress of running jobs from their log lines, in batch and as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The forms of the log lines that carry progress.
COUNT = r"\[(\d+)/(\d+)\]\s+(\d+)%"
STEP = r"(s\d+)\s+(\w+):"
PHASE = r"(Phase \d+.*?|s\d+ \w+|分析|预处理|版面检测|字符网格).*?(\d+)\s*张"
DONE = r"(完成|全部完成|Done)"


def parse(lines: DataFrame, text: str = "value") -> DataFrame:
    """With ``phase, step, done, total, pct, finished``; a line says only what it holds: a
    phase's line tells its name and how many pages it has."""
    number = lambda k: F.try_element_at(F.regexp_extract_all(text, F.lit(COUNT), F.lit(k)), F.lit(1)).cast("int")
    step = F.when(F.col(text).rlike(STEP), F.concat_ws(" ", F.regexp_extract(text, STEP, 1), F.regexp_extract(text, STEP, 2)))
    finished = F.col(text).rlike(DONE)
    begins = F.col(text).rlike(PHASE)
    phase = F.coalesce(step, F.when(begins, F.trim(F.regexp_extract(text, PHASE, 1))))
    pages = F.when(begins, F.regexp_extract(text, PHASE, 2).try_cast("int"))
    return lines.withColumns({"phase": phase, "step": step, "done": number(1), "total": F.coalesce(number(2), pages), "pct": F.when(finished, 100).otherwise(number(3)), "finished": finished})


def latest(parsed: DataFrame, job: str = "job") -> DataFrame:
    """Per job the furthest percentage, and whether it has finished.  On a stream this is a
    running aggregate of one row per job."""
    return parsed.groupBy(job).agg(F.max("pct").alias("pct"), F.coalesce(F.bool_or("finished"), F.lit(False)).alias("finished"))


def watch(spark: SparkSession, folder: str) -> DataFrame:
    """The log files of ``folder`` as a stream, a job per file."""
    lines = spark.readStream.text(folder)
    return parse(lines.withColumn("job", F.regexp_extract(F.input_file_name(), r"([^/]+)\.[^.]*$", 1)))


def new_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Page files as they arrive, bytes included, for an incremental page pass."""
    from ..sources.scan import select_pages

    return select_pages(spark.readStream.format("binaryFile").option("recursiveFileLookup", True).load(folder))
