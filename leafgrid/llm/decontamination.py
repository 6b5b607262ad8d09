"""Benchmark decontamination by template canonicalisation (native).

Numbers, names and units become typed placeholders; every window of ``WINDOW``
canonical tokens is hashed and joined to the hashed windows of the benchmark.  A
document that covers enough of an item's windows is a leak if its slots agree: each
value in the benchmark's slots must turn into one value in the document.  Copies and
re-parameterised questions both pass that, chance overlaps of form do not.

Slots are compared where an item's windows first occur in the document.  If they
disagree there, every alignment of item and document is judged by itself: a copy that
stands after a passage of the same form is a leak as well.  Items whose windows are
nearly all slots keep them all, and leak by an alignment with the very same values, or
with all of their form and agreeing slots.

The windows of documents are produced and probed in one stage when the benchmark's
windows are few enough to broadcast (they are counted first); beyond that the same
join is a shuffle, whose hot windows the adaptive planner splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, let, maybe_broadcast, row_columns, row_of, table, written

WINDOW = 8
#: Of a benchmark window's tokens, the least share of fixed words.
FIXED = 0.6
#: Of an item's windows, the least share that a leak covers.
COVERAGE = 0.3
#: Of the slot values compared, the most that may turn into more than one value.
CONFLICTS = 0.25

CLOSE, NUMBER, NAME, UNIT, AFTER = "\ue000", "\ue001", "\ue002", "\ue003", "\ue004"
#: A capitalised run that does not begin a sentence, after what comes before it.
NAME_PATTERN = r"([\p{Ll}0-9,;:]\x20)(\p{Lu}\p{Ll}+(?:\x20\p{Lu}\p{Ll}+)*)"
TOKEN_PATTERN = r"(\x{E002}[^\x{E000}]+\x{E000}|[0-9]+(?:[.,:/][0-9]+)*|[\p{L}\p{M}]+|[%€$£])"
NUMBER_WORDS = (
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen "
    "eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million half double twice"
).split()
UNITS = (
    "% $ € £ kg g mg t lb lbs oz km m cm mm mi mile miles ft feet foot inch inches yard yards meter meters metre metres "
    "l ml liter liters litre litres s sec second seconds min minute minutes h hr hour hours day days week weeks month "
    "months year years cent cents dollar dollars euro euros pound pounds percent degree degrees kmh mph w kw v hz"
).split()


def tokens(text: Column) -> Column:
    """Lower-case tokens: marked names, numbers, words, currency and percent signs."""
    clean = F.translate(F.coalesce(text, F.lit("")), CLOSE + NUMBER + NAME + UNIT, "")
    marked = F.regexp_replace(clean, NAME_PATTERN, f"$1{NAME}$2{CLOSE}")
    return F.regexp_extract_all(F.lower(marked), F.lit(TOKEN_PATTERN), F.lit(1))


def _between(x: Column, low: str, high: str) -> Column:
    return (x >= low) & (x < high)


def canonical(tokens_: Column) -> Column:
    """The tokens with each slot replaced by its kind."""

    def number(x: Column) -> Column:
        return _between(x, "0", ":") | x.isin(NUMBER_WORDS)

    def one(x: Column, i: Column) -> Column:
        after_number = F.coalesce(number(F.get(tokens_, i - 1)), F.lit(False))
        return F.when(number(x), NUMBER).when(_between(x, NAME, UNIT), NAME).when(x.isin(UNITS) & after_number, UNIT).otherwise(x)

    return F.transform(tokens_, one)


def windows(canon: Column, lengths: list[int]) -> Column:
    """``array<struct<p, h>>``: start and hash of each window of the given lengths."""

    def of_length(h: Column, n: int) -> Column:
        at = F.sequence(F.lit(0), F.size(h) - n)
        some = F.transform(at, lambda i: F.struct(i.alias("p"), F.xxhash64(F.lit(n), F.slice(h, i + 1, n)).alias("h")))
        return F.when(F.size(h) >= n, some).otherwise(F.array().cast("array<struct<p:int,h:bigint>>"))

    def of(h: Column) -> Column:
        each = [of_length(h, n) for n in lengths]
        return each[0] if len(each) == 1 else F.concat(*each)

    return let(F.transform(canon, lambda x: F.xxhash64(x)), of)


def is_slot(x: Column) -> Column:
    return _between(x, NUMBER, AFTER)


def benchmark_items(benchmark: DataFrame) -> DataFrame:
    """``item_id, tokens, canon, n``; null ids and items without tokens are left out."""
    item = benchmark.where("item_id is not null").select(F.col("item_id"), tokens(F.col("text")).alias("tokens"))
    item = item.where(F.size("tokens") > 0).dropDuplicates(["item_id"])
    item = item.withColumn("canon", canonical(F.col("tokens")))
    return item.withColumn("n", F.least(F.size("tokens"), F.lit(WINDOW)))


def leaks(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, conflicts: float = CONFLICTS) -> DataFrame:
    """``doc_id, text_hash, item_id, matched, item_windows, slots, slot_conflicts`` for
    each distinct document (id and text) and each item that it leaks.

    Items shorter than a window match as a whole.  Null texts leak nothing; null doc
    ids are kept; a document repeated in full is reported once; items with repeated or
    null ids count once or not at all; empty tables give no rows; other columns are
    ignored.
    """
    items = written(benchmark_items(benchmark), "items")
    lengths = sorted(r[0] for r in items.select("n").distinct().collect()) or [WINDOW]  # WINDOW at most
    each = [items.where(F.col("n") == n).select("item_id", "n", "canon", F.explode(windows(F.col("canon"), [n])).alias("w")) for n in lengths]
    own = each[0]
    for more in each[1:]:
        own = own.unionAll(more)
    fixed = F.size(F.filter(F.slice(F.col("canon"), F.col("w.p") + 1, F.col("n")), lambda x: ~is_slot(x)))
    own = own.select("item_id", F.col("w.p").alias("item_pos"), F.col("w.h").alias("h"), fixed.alias("fixed"), (fixed >= F.ceil(F.col("n") * FIXED)).alias("is_fixed"))
    own = own.withColumn("dense", ~F.max("is_fixed").over(Window.partitionBy("item_id"))).where("is_fixed or dense")
    own = written(own.drop("is_fixed"), "places")
    bench = written(own.groupBy("item_id", "h").agg(F.min("item_pos").alias("item_pos")), "windows")
    total = own.groupBy("item_id").agg(F.count_distinct("h").alias("item_windows"), F.first("dense").alias("dense"), (F.min("fixed") > 0).alias("has_form"))

    found = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.explode(windows(canonical_of(F.col("text")), lengths)).alias("w"))
    found = found.select("doc_id", "text_hash", F.col("w.p").alias("pos"), F.col("w.h").alias("h"))
    hits = found.join(maybe_broadcast(bench), "h")
    once = hits.groupBy("doc_id", "text_hash", "item_id", "item_pos").agg(F.min("pos").alias("pos"))
    by_item = once.groupBy("doc_id", "text_hash", "item_id").agg(
        F.count(F.lit(1)).alias("matched"),
        F.sort_array(F.collect_list(F.struct("item_pos", "pos"))).alias("pairs"),  # as long as an item at most
    )
    covered = written(
        by_item.join(total, "item_id").where(F.col("matched") >= F.ceil(F.lit(coverage) * F.col("item_windows"))), "covered"
    )
    with_slots = items.where(F.exists("canon", is_slot)).select(F.col("item_id").alias("slot_item"), F.col("tokens").alias("ours"), "canon", F.col("n").alias("width"))
    plain = covered.join(with_slots, F.col("item_id") == F.col("slot_item"), "left_anti")
    checked = covered.join(with_slots, F.col("item_id") == F.col("slot_item"))
    columns = ["doc_id", "text_hash", "item_id", "matched", "item_windows"]
    figures = [*columns, "slots", "slot_conflicts"]
    result = plain.select(*columns, F.lit(0).alias("slots"), F.lit(0).alias("slot_conflicts"))
    checked = written(checked, "slots")
    if checked.isEmpty():
        return result

    theirs = docs.select(F.col("doc_id").alias("d"), F.xxhash64("text").alias("th"), "text").dropDuplicates(["d", "th"])
    few = maybe_broadcast(checked, BROADCAST_ROWS // 50)
    both = theirs.join(few, F.col("d").eqNullSafe(F.col("doc_id")) & (F.col("th") == F.col("text_hash")))
    both = both.withColumn("theirs", tokens(F.col("text"))).drop("text")

    def values(p: Column) -> Column:
        at = F.filter(F.sequence(F.lit(0), F.col("width") - 1), lambda k: is_slot(F.get(F.col("canon"), p["item_pos"] + k)))
        pair = lambda k: F.struct(F.get(F.col("ours"), p["item_pos"] + k).alias("a"), F.get(F.col("theirs"), p["pos"] + k).alias("b"))
        return F.transform(at, pair)

    compared = both.withColumn("values", F.array_distinct(F.flatten(F.transform("pairs", values))))
    compared = written(_with_conflicts(compared).select(*figures, "dense", "has_form"), "first")
    agreed = ~F.col("dense") & (F.col("slot_conflicts") <= F.floor(F.lit(conflicts) * F.col("slots")))
    result = result.unionByName(compared.where(agreed).select(*figures))
    doubtful = compared.where(~agreed).select("doc_id", "text_hash", "item_id", "item_windows", "dense", "has_form")
    if doubtful.isEmpty():
        return result
    return result.unionByName(_aligned(docs, doubtful, items, own, lengths, coverage, conflicts).select(*figures))


def _with_conflicts(df: DataFrame) -> DataFrame:
    """``slots`` and ``slot_conflicts`` of the distinct pairs in ``values``."""
    slots = F.size(F.array_distinct(F.transform("values", lambda v: v["a"])))
    return df.withColumn("slots", slots).withColumn("slot_conflicts", F.size("values") - F.col("slots"))


def _aligned(docs: DataFrame, doubtful: DataFrame, items: DataFrame, own: DataFrame, lengths: list[int], coverage: float, conflicts: float) -> DataFrame:
    """The pairs of ``doubtful`` with an alignment that is a leak, and the figures of the
    best one.  Alignments are hits of one offset between document and item, or of a range
    of offsets as wide as the item (two rows of ranges, half a width apart), so that copies
    with words put in or left out are whole in one.
    """
    texts = docs.select(F.col("doc_id").alias("d"), F.xxhash64("text").alias("th"), "text").dropDuplicates(["d", "th"])
    named = doubtful.select("doc_id", "text_hash").distinct()
    texts = texts.join(maybe_broadcast(named, BROADCAST_ROWS // 50), F.col("d").eqNullSafe(F.col("doc_id")) & (F.col("th") == F.col("text_hash")))
    words = texts.select("doc_id", "text_hash", tokens(F.col("text")).alias("theirs"))
    at = F.transform(windows(canonical(F.col("theirs")), lengths), lambda w: F.struct(w["p"].alias("pos"), w["h"].alias("h"), F.slice("theirs", w["p"] + 1, WINDOW).alias("theirs")))
    places = words.select("doc_id", "text_hash", F.inline(at))

    ours = own.join(items.select("item_id", "tokens", "canon", "n"), "item_id")
    ours = ours.select(
        "item_id", "item_pos", "h", F.size("tokens").alias("long"),
        F.slice("tokens", F.col("item_pos") + 1, F.col("n")).alias("ours"), F.slice("canon", F.col("item_pos") + 1, F.col("n")).alias("form"),
    )
    ours = ours.join(doubtful.select("item_id").distinct(), "item_id", "left_semi")
    slot_at = F.filter(F.sequence(F.lit(0), F.size("form") - 1), lambda k: is_slot(F.get("form", k)))
    pairs = F.transform(slot_at, lambda k: F.struct(F.get("ours", k).alias("a"), F.get("theirs", k).alias("b")))
    offset = F.col("pos") - F.col("item_pos")
    half = F.col("long") / 2
    kinds = [offset, F.floor(offset / F.col("long")), F.floor((offset + half) / F.col("long"))]
    kinds = F.array(*[F.struct(F.lit(k).alias("kind"), v.cast("long").alias("which")) for k, v in enumerate(kinds)])
    hits = places.join(maybe_broadcast(ours), "h").withColumn("values", pairs)
    hits = hits.select("doc_id", "text_hash", "item_id", "item_pos", "pos", "h", "values", F.inline(kinds))

    by = ["doc_id", "text_hash", "item_id", "kind", "which"]
    once = hits.groupBy(*by, "item_pos").agg(F.min_by(F.struct("h", "values"), "pos").alias("x"))
    same = F.forall("x.values", lambda v: v["a"] == v["b"])
    each = once.groupBy(*by).agg(
        F.count_distinct("x.h").alias("matched"), F.count_distinct(F.when(same, F.col("x.h"))).alias("literal"),
        F.array_distinct(F.flatten(F.collect_set("x.values"))).alias("values"),  # as long as an item at most
    )
    key = doubtful.select(F.col("doc_id").alias("d"), F.col("text_hash").alias("th"), F.col("item_id").alias("i"), "item_windows", "dense", "has_form")
    judged = _with_conflicts(each).join(key, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("th")) & (F.col("item_id") == F.col("i")))
    least = F.ceil(F.lit(coverage) * F.col("item_windows"))
    agree = F.col("slot_conflicts") <= F.floor(F.lit(conflicts) * F.col("slots"))
    alike = F.when(F.col("dense"), F.col("has_form") & (F.col("matched") == F.col("item_windows"))).otherwise(F.col("matched") >= least)
    judged = judged.where((agree & alike) | (F.col("literal") >= least))
    best = F.max(F.struct("matched", (-F.col("slot_conflicts")).alias("agreed"), "slots", "item_windows")).alias("best")
    return judged.groupBy("doc_id", "text_hash", "item_id").agg(best).select(
        "doc_id", "text_hash", "item_id", "best.matched", "best.item_windows", "best.slots", (-F.col("best.agreed")).alias("slot_conflicts")
    )


def canonical_of(text: Column) -> Column:
    return let(tokens(text), canonical)


def decontaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, all columns, that leak no item.

    Null and empty texts leak nothing and stay; repeated rows stay or go together; without
    items every row stays; an empty table gives no rows.
    """
    bad = written(leaks(docs, benchmark, **options).select(F.col("doc_id").alias("bad_id"), F.col("text_hash").alias("bad_hash")).distinct(), "leaks")
    same = F.col("row.doc_id").eqNullSafe(F.col("bad_id")) & (F.xxhash64("row.text") == F.col("bad_hash"))
    return docs.select(row_of(docs)).join(maybe_broadcast(bad), same, "left_anti").select(*row_columns(docs.columns))


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The leaks: documents that leak nothing have no row."""
    got = leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return got.drop("text_hash")


def _sql_list(words: list[str]) -> str:
    return ", ".join(f"'{w}'" for w in words)


#: The same by lists and string keys; private-use characters are written with chr().
OP1_SQL = rf"""
WITH texts AS (SELECT 'd' AS kind, doc_id AS id, text FROM (SELECT DISTINCT doc_id, text FROM documents)
  UNION ALL SELECT 'b', item_id, min(text) FROM benchmark WHERE item_id IS NOT NULL GROUP BY item_id),
tok AS (SELECT row_number() OVER () AS u, kind, id, regexp_extract_all(lower(regexp_replace(
    translate(coalesce(text, ''), chr(57344) || chr(57345) || chr(57346) || chr(57347), ''),
    '{NAME_PATTERN}', '\1' || chr(57346) || '\2' || chr(57344), 'g')), '{TOKEN_PATTERN}', 1) AS w FROM texts),
num AS (SELECT u, kind, id, w, list_transform(w, lambda x: (x >= '0' AND x < ':') OR x IN ({_sql_list(NUMBER_WORDS)})) AS n FROM tok WHERE len(w) > 0),
canon AS (SELECT u, kind, id, w, list_transform(range(1, len(w) + 1), lambda i: CASE WHEN n[i] THEN chr(57345)
    WHEN w[i] >= chr(57346) AND w[i] < chr(57347) THEN chr(57346)
    WHEN i > 1 AND n[i-1] AND w[i] IN ({_sql_list(UNITS)}) THEN chr(57347) ELSE w[i] END) AS c FROM num),
items AS (SELECT u, id AS item_id, w, c, least(len(c), {WINDOW}) AS n FROM canon WHERE kind = 'b'),
own AS (SELECT item_id, n, unnest(range(1, len(c) - n + 2)) AS p, c FROM items),
bench AS (SELECT item_id, n, array_to_string(c[p:p+n-1], ' ') AS k, min(p) AS p FROM own
  WHERE len(list_filter(c[p:p+n-1], lambda x: NOT (x >= chr(57345) AND x < chr(57348)))) >= ceil(n * {FIXED}) GROUP BY ALL),
total AS (SELECT item_id, count(*) AS item_windows FROM bench GROUP BY 1),
sizes AS (SELECT DISTINCT n FROM items),
docs AS (SELECT u, n, unnest(range(1, len(c) - n + 2)) AS p, c FROM canon, sizes WHERE kind = 'd' AND len(c) >= n),
found AS (SELECT u, n, p, array_to_string(c[p:p+n-1], ' ') AS k FROM docs),
once AS (SELECT u, item_id, b.p AS item_pos, min(f.p) AS pos, any_value(n) AS n FROM found f JOIN bench b USING (n, k) GROUP BY ALL),
hits AS (SELECT u, item_id, count(*) AS matched, list(struct_pack(i := item_pos, d := pos, n := n)) AS pairs FROM once GROUP BY ALL),
covered AS (SELECT h.*, item_windows FROM hits h JOIN total USING (item_id) WHERE matched >= ceil({COVERAGE} * item_windows)),
places AS (SELECT u, item_id, unnest(pairs) AS x FROM covered),
cells AS (SELECT DISTINCT p.u, p.item_id, i.w[x.i + o.k] AS a, d.w[x.d + o.k] AS b
  FROM places p JOIN items i USING (item_id) JOIN canon d ON d.u = p.u, (SELECT unnest(range(0, {WINDOW})) AS k) o
  WHERE o.k < x.n AND i.c[x.i + o.k] >= chr(57345) AND i.c[x.i + o.k] < chr(57348)),
slots AS (SELECT u, item_id, count(DISTINCT a)::INT AS slots, (count(*) - count(DISTINCT a))::INT AS slot_conflicts FROM cells GROUP BY ALL)
SELECT d.id AS doc_id, c.item_id, c.matched, c.item_windows, coalesce(slots, 0)::INT AS slots, coalesce(slot_conflicts, 0)::INT AS slot_conflicts
FROM covered c JOIN canon d USING (u) LEFT JOIN slots s USING (u, item_id)
WHERE coalesce(slot_conflicts, 0) <= floor({CONFLICTS} * coalesce(slots, 0))
"""
