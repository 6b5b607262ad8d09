"""Mixing sources to target weights (native).

Every document gets a hash-random key.  Within its source the documents stand in
key order; distributed prefix sums of their word counts say where each one begins,
and the source's budget cuts the order at an exact word.  A budget above the
source's own size repeats whole epochs first.

The order inside a source is a range sort without a sort of the source: keys are
uniform, so equal key ranges ("buckets") hold about ``BUCKET_ROWS`` rows each.
Buckets are summed with map-side combining; their prefix sums are taken inside blocks of
``BLOCK_BUCKETS`` and then over blocks, and only the rows of one bucket, the buckets of one
block, or a source's blocks ever meet in a window.  A source with a
third of all rows is thus many buckets over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import BLANK, BLANK_CHARS, quoted, row_of, table, word_count, written

WEIGHTS = (3, 1, 2)
SHARE = 1.5
CAP = 2
BUCKET_ROWS, BLOCK_BUCKETS = 512, 1024


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, cap: int = CAP) -> DataFrame:
    """One row per source: ``source, source_size, n_docs, weight, target``.

    Sources in code-point order (null last) take ``weights`` in turn and share
    ``share`` times the words of all.  A target stops at ``cap`` times its source's
    size; what is over is shared again by weight until none is above.  That fixed
    point is a water level L with target = min(cap * size, L * weight): ordered by
    cap * size / weight, the sources up to some point are full and the others split
    the rest.  The windows here run over one row per source.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    turn = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    per = per.withColumn("weight", F.get(F.array(*[F.lit(int(w)) for w in weights]), turn))
    per = per.withColumn("full_at", F.lit(cap) * F.col("source_size") / F.col("weight"))
    everything = Window.partitionBy()
    before = Window.orderBy("full_at", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    per = (
        per.withColumn("all_words", F.sum("source_size").over(everything))
        .withColumn("all_weight", F.sum("weight").over(everything))
        .withColumn("words_before", F.coalesce(F.sum(F.lit(cap) * F.col("source_size")).over(before), F.lit(0)))
        .withColumn("weight_before", F.coalesce(F.sum("weight").over(before), F.lit(0)))
        .withColumn("level", (F.lit(share) * F.col("all_words") - F.col("words_before")) / (F.col("all_weight") - F.col("weight_before")))
    )
    open_at = F.when(F.col("level") <= F.col("full_at"), F.struct("full_at", "level"))
    level = F.min(open_at).over(everything)["level"]
    full = F.lit(float(cap)) * F.col("source_size")
    target = F.when(level.isNull() | (F.col("full_at") <= level), full).otherwise(F.least(full, level * F.col("weight")))
    return per.select("source", "source_size", "n_docs", "weight", target.alias("target"))


def hash_key(seed: int) -> Column:
    """60 uniform bits from the id and the text, by a function that SQL engines share."""
    part = F.concat_ws(":", F.lit(str(seed)), F.col("doc_id").cast("string"), F.md5(F.coalesce("text", F.lit(""))))
    return F.conv(F.substring(F.md5(part), 1, 15), 16, 10).cast("long")


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, cap: int = CAP, seed: int = 7, keep: Sequence[str] = ()) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` for every row of ``docs``.

    ``taken`` counts the words that the mix takes of a document, repeats included;
    the taken words of a source add up to its rounded target.  The columns named in
    ``keep`` are carried along in a struct ``row``.

    Null text is empty (size 0, taken 0); a null source is a source of its own, the
    last; identical rows are told apart only by their place, which is the same
    multiset at each run; an empty table gives no rows.  Other columns of ``docs``
    are ignored, whatever their names.
    """
    key = hash_key(seed)
    columns = [F.col("doc_id"), F.col("source"), word_count(F.col("text")).alias("size"), key.alias("key")]
    if keep:
        columns.append(row_of(docs.select(*map(quoted, keep))))
    sized = docs.select(*columns)
    if not keep:
        sized = written(sized, "sizes")
        per = source_targets(sized, weights, share, cap)
    else:
        per = source_targets(docs.select("source", word_count(F.col("text")).alias("size")), weights, share, cap)
    per = written(
        per.withColumn("buckets", F.ceil(F.col("n_docs") / BUCKET_ROWS))
        .withColumn("budget", F.round("target").cast("long")),
        "targets",
    )
    epochs = F.when(F.col("source_size") > 0, F.expr("budget div source_size")).otherwise(F.lit(0))
    bucket = F.floor(F.col("key") / F.lit(2.0**60) * F.col("buckets"))
    held = sized.withColumnRenamed("source", "of").join(per, F.col("of").eqNullSafe(F.col("source"))).drop("of")
    held = held.withColumn("bucket", F.least(bucket, F.col("buckets") - 1))
    narrow = held if not keep else held.drop("row")
    block = F.floor(F.col("bucket") / BLOCK_BUCKETS)
    sums = written(narrow.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size")).withColumn("block", block), "buckets")
    before = lambda *by: Window.partitionBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    blocks = sums.groupBy("source", "block").agg(F.sum("bucket_size").alias("block_size")).select(
        F.col("source").alias("block_source"), F.col("block").alias("block_at"),
        F.coalesce(F.sum("block_size").over(before("source").orderBy("block")), F.lit(0)).alias("block_base"),
    )
    inside_block = F.coalesce(F.sum("bucket_size").over(before("source", "block").orderBy("bucket")), F.lit(0))
    bases = sums.withColumn("inside", inside_block).join(blocks, F.col("source").eqNullSafe(F.col("block_source")) & (F.col("block") == F.col("block_at")))
    bases = bases.select(F.col("source").alias("base_source"), F.col("bucket").alias("base_bucket"), (F.col("inside") + F.col("block_base")).alias("base"))
    placed = held.join(bases, F.col("source").eqNullSafe(F.col("base_source")) & (F.col("bucket") == F.col("base_bucket")))
    inside = Window.partitionBy("source", "bucket").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    begins = F.col("base") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    rest = F.col("budget") - epochs * F.col("source_size")
    cut = F.greatest(F.lit(0), F.least(F.col("size"), rest - begins))
    out = placed.withColumn("taken", (epochs * F.col("size") + cut).cast("long"))
    return out.select("doc_id", "size", "source_size", "target", "taken", *(["row"] if keep else []))


def mixed_documents(docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, cap: int = CAP, seed: int = 7) -> DataFrame:
    """The mix itself, with the columns of ``docs``: a row for each whole repeat of a
    document, and the one document per source at which the budget ends cut to its
    taken words (joined by blanks; ``n_chars``, if there, is counted again).

    Texts without a word, null ones among them, have nothing to take and no row; a null
    source is one of its own; repeated rows are documents each; an empty table gives no
    rows; other columns, whatever their names, are carried along.
    """
    names = docs.columns
    taken = mix(docs, weights, share, cap, seed, keep=names).where(F.col("taken") > 0)
    left = F.col("taken") % F.col("size")
    copies = F.concat(
        F.array_repeat(F.lit(0), F.expr("cast(taken div size as int)")),
        F.when(left > 0, F.array(left.cast("int"))).otherwise(F.array().cast("array<int>")),
    )
    rows = taken.select("row", F.explode(copies).alias("only"))
    trimmed = F.ltrim(F.col("row.text"), F.lit(BLANK_CHARS))
    first = F.array_join(F.slice(F.split(trimmed, f"[{BLANK}]+"), 1, F.greatest(F.col("only"), F.lit(1))), " ")
    text = F.when(F.col("only") > 0, first).otherwise(F.col("row.text"))
    done = rows.select(*[text.alias(c) if c == "text" else F.col("row").getField(c).alias(c) for c in names])
    if "n_chars" in names:
        done = done.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return done


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))


OP3_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5(concat_ws(':', '7', doc_id::VARCHAR, md5(coalesce(text, '')))), 1, 15))::BIGINT AS key
  FROM documents),
per AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight FROM per),
leveled AS (
  SELECT *, 2 * source_size / weight::DOUBLE AS full_at,
         (1.5 * sum(source_size) OVER ()::DOUBLE
            - coalesce(sum(2 * source_size) OVER w, 0)::DOUBLE)
         / (sum(weight) OVER () - coalesce(sum(weight) OVER w, 0))::DOUBLE AS level
  FROM weighed
  WINDOW w AS (ORDER BY 2 * source_size / weight::DOUBLE, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
water AS (SELECT min({'f': full_at, 'l': level}) AS open_at FROM leveled WHERE level <= full_at),
targets AS (
  SELECT source, source_size,
         CASE WHEN open_at IS NULL OR full_at <= open_at.l THEN 2.0 * source_size
              ELSE least(2.0 * source_size, open_at.l * weight) END::DOUBLE AS target
  FROM leveled, water),
placed AS (
  SELECT s.doc_id, s.size, t.source_size, t.target, round(t.target)::BIGINT AS budget,
         coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.key, s.doc_id NULLS FIRST, s.size
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS begins
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END * size
        + greatest(0, least(size, CASE WHEN source_size > 0 THEN budget % source_size ELSE budget END - begins)))::BIGINT AS taken
FROM placed
"""
