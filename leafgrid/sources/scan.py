"""Page listings: which files are pages, in which order, and how many."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.scalars import clean_stem, last_number

# Endings of page images, and stems that name outputs.
IMAGE_ENDINGS = ("jpg", "jpeg", "png", "bmp", "tif", "tiff")
OUTPUT_STEMS = ("_lsd", "_borders", "_annotated", "_preprocessed")


def select_pages(
    files: DataFrame, path: str = "path", keys: tuple[str, ...] = (), skip_pages: tuple[int, ...] = (), names: DataFrame | None = None,
    limit: int | None = None, endings: tuple[str, ...] | None = IMAGE_ENDINGS, ties: tuple[str, ...] = (),
) -> DataFrame:
    """The page files of ``files`` with ``stem`` and ``page_no`` (the stem's last number):
    by ending (any, if None) and stem, then without the pages to skip, then those in ``names``
    (column ``stem``), then the first ``limit`` of each key by path, then ``ties``."""
    stem = clean_stem(F.col(path))
    pages = files if endings is None else files.where(F.lower(path).rlike(rf"\.({'|'.join(endings)})$"))
    pages = pages.withColumn("stem", stem)
    pages = pages.where(~F.col("stem").rlike(f"({'|'.join(OUTPUT_STEMS)})$")).withColumn("page_no", last_number(F.col("stem")))
    if skip_pages:
        pages = pages.where(F.col("page_no").isNull() | ~F.col("page_no").isin(*skip_pages))
    if names is not None:
        pages = pages.join(names.select("stem").distinct(), "stem", "left_semi")
    if limit is not None:
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy(path, *ties))
        pages = pages.withColumn("_rank", rank).where(F.col("_rank") <= limit).drop("_rank")
    return pages


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """``path, page_no, image`` of the readable page images under ``path``; the image struct
    holds its size and BGR rows.  Filters on ``path`` come before any decoding."""
    images = spark.read.format("image").option("dropInvalid", True).option("recursiveFileLookup", True).load(path)
    return select_pages(images.withColumn("path", F.col("image.origin")))


def volume_pages(files: DataFrame, path: str = "path", keys: tuple[str, ...] = (), ties: tuple[str, ...] = ()) -> DataFrame:
    """The files whose stem ends in a number after its last ``_`` (``page_no``), placed by it:
    ``place`` from 0, and ``padded``, the number as wide as the key's largest."""
    number = F.element_at(F.split(clean_stem(F.col(path)), "_"), -1).try_cast("int")
    pages = files.withColumn("page_no", number).where("page_no is not null")
    place = F.row_number().over(Window.partitionBy(*keys).orderBy("page_no", path, *ties)) - 1
    wide = F.length(F.max("page_no").over(Window.partitionBy(*keys)).cast("string"))
    return pages.withColumn("place", place).withColumn("padded", F.lpad(F.col("page_no").cast("string"), wide, F.lit("0")))


def half_names(names: DataFrame, stem: str = "stem") -> DataFrame:
    """The names of the halves that pages become when they are cut, with the pages' own."""
    return names.withColumn("half", F.explode(F.array(F.col(stem), F.concat(F.col(stem), F.lit("_left")), F.concat(F.col(stem), F.lit("_right")))))


def read_documents(spark: SparkSession, path: str, schema: str, suffix: str) -> DataFrame:
    """The JSON documents ``*suffix.json`` below ``path``, a row each, with ``stem``, the file's
    name without the suffix, and the folder's name as ``book``."""
    raw = spark.read.schema(schema).option("pathGlobFilter", f"*{suffix}.json").option("recursiveFileLookup", True).json(path, multiLine=True)
    name = F.input_file_name()
    return raw.withColumn("stem", F.regexp_replace(clean_stem(name), f"{suffix}$", "")).withColumn("book", F.element_at(F.split(name, "/"), -2))
