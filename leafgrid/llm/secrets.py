"""Secret scans (native): pattern spans, and the corpus-wide frequency of each value.

Three patterns give the base spans of a text.  Live-looking values (the assigned value,
or a long run of letters and digits) are hashed, and for each hash the corpus is asked
how many distinct owners and repositories hold it.  A value of one owner and few
repositories is that owner's credential and adds a span of kind ``live``; a value that
several owners hold, or one owner in many repositories, is a copied example and adds none.

Only rows with values take part in the count.  It combines per task first, on (hash,
owner, repository), then (hash, owner), then hash, so a value in a third of all rows is a
few rows per task.  The join back is on the hash, with only the live ones on its small
side; the adaptive planner splits a hot one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import let, running_sums, table, written

ASSIGN = r"""((?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))"""
ACCESS = r"(AKIA[A-Z0-9]+)"
HEX = r"([0-9a-f]{32,})"
RUN = r"([A-Za-z0-9+/_=-]{20,})"
KINDS = ("assign", "access", "hex", "live")
MIN_ASSIGNED, MIN_ACCESS = 8, 16
#: A live-looking value has a digit, a letter and so many different characters.
MIN_DISTINCT = 8
#: Beyond so many owners, or repositories (each counted under its owner), a value is a copy.
MAX_OWNERS, MAX_REPOSITORIES = 1, 5

SPAN = "array<struct<start:int,end:int,value:string>>"


def spans(text: Column, pattern: str, value_group: int = 1) -> Column:
    """``array<struct<start, end, value>>`` of the leftmost matches that do not overlap,
    in code points.  ``pattern`` has one group around all of it.

    The matches and the pieces between them alternate, so the places are running sums
    of their lengths."""

    def placed(s: Column) -> Column:
        ends = running_sums(F.transform(s["w"], lambda x, k: (F.length(F.get(s["p"], k)) + F.length(x)).cast("long")))

        def span(e: Column) -> Column:
            of = lambda x, k: F.struct((F.get(e, k) - F.length(x)).cast("int").alias("start"), F.get(e, k).cast("int").alias("end"), F.get(s["v"], k).alias("value"))
            return F.transform(s["w"], of)

        return let(ends, span)

    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(1))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(value_group))
    lists = F.struct(F.split(text, pattern, -1).alias("p"), whole.alias("w"), value.alias("v"))
    return F.when(text.rlike(pattern), let(lists, placed)).otherwise(F.array().cast(SPAN))


def united(a: Column, b: Column) -> Column:
    """The distinct spans of both, in order; linear but for the sort."""
    return let(F.sort_array(F.concat(a, b)), lambda x: F.filter(x, lambda v, i: (i == 0) | (F.get(x, i - 1) != v)))


def of_kind(spans_: Column, kind: int) -> Column:
    return F.transform(spans_, lambda s: F.struct(s["start"].alias("start"), F.lit(kind).alias("kind"), s["end"].alias("end")))


def joined(spans_: Column) -> Column:
    """``kind:start:end`` by start, then kind, then end."""
    name = F.array(*[F.lit(k) for k in KINDS])
    text = lambda s: F.concat_ws(":", F.get(name, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(F.sort_array(spans_), text), ",")


def live_looking(spans_: Column) -> Column:
    def ok(s: Column) -> Column:
        v = s["value"]
        return v.rlike("[0-9]") & v.rlike("[A-Za-z]") & (F.size(F.array_distinct(F.split(v, ""))) >= MIN_DISTINCT)

    return F.filter(spans_, ok)


def scan(docs: DataFrame, owner: str = "source", repository: str = "doc_id", max_owners: int = MAX_OWNERS, max_repositories: int = MAX_REPOSITORIES) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_live, n_copied`` for every
    row of ``docs``; ``owner`` and ``repository`` name its columns for the count.

    Null texts are empty; a null owner or repository is one of its own; repeated rows
    stay; an empty table gives no rows; other columns are ignored.
    """
    text = docs.select(
        F.col("doc_id"), F.coalesce(F.col(owner).cast("string"), F.lit("\x00")).alias("o"),
        F.coalesce(F.col(repository).cast("string"), F.lit("\x00")).alias("r"), F.coalesce("text", F.lit("")).alias("t"),
    )
    found = text.select(
        "doc_id", "o", "r",
        F.filter(spans(F.col("t"), ASSIGN, 2), lambda s: F.length(s["value"]) >= MIN_ASSIGNED).alias("assign"),
        F.filter(spans(F.col("t"), ACCESS), lambda s: s["end"] - s["start"] >= MIN_ACCESS).alias("access"),
        spans(F.col("t"), HEX).alias("hex"),
        spans(F.col("t"), RUN).alias("run"),
    )
    assigned = F.transform("assign", lambda s: F.struct((s["end"] - F.length(s["value"])).alias("start"), s["end"].alias("end"), s["value"].alias("value")))
    values = live_looking(united(assigned, F.col("run")))
    hashed = F.transform(values, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.sha2(s["value"], 256).alias("hash")))
    base = F.concat(*[of_kind(F.col(c), k) for k, c in enumerate(KINDS[:3])])
    rows = written(
        found.select(
            F.monotonically_increasing_id().alias("uid"), "doc_id", "o", "r", F.size("assign").cast("long").alias("n_assign"),
            F.size("access").cast("long").alias("n_access"), F.size("hex").cast("long").alias("n_hex"), base.alias("base"), hashed.alias("values"),
        ),
        "spans",
    )
    each = rows.where(F.size("values") > 0).select("uid", "o", "r", F.explode("values").alias("v")).select("uid", "o", "r", "v.start", "v.end", F.col("v.hash").alias("hash"))
    held = each.groupBy("hash", "o", "r").agg(F.lit(1).alias("one")).groupBy("hash", "o").agg(F.count(F.lit(1)).alias("repositories"))
    verdict = held.groupBy("hash").agg(F.count(F.lit(1)).alias("owners"), F.sum("repositories").alias("repositories"))
    few = (F.col("owners") <= max_owners) & (F.col("repositories") <= max_repositories)
    live = verdict.where(few).select(F.col("hash").alias("live"))
    told = each.join(live, F.col("hash") == F.col("live"), "left").select("uid", "start", "end", F.col("live").isNotNull().alias("is_live"))
    span = F.struct("start", F.lit(3).alias("kind"), "end")
    added = told.groupBy("uid").agg(
        F.collect_list(F.when(F.col("is_live"), span)).alias("added"),
        F.count_if("is_live").alias("n_live"), F.count_if(~F.col("is_live")).alias("n_copied"),
    ).withColumnRenamed("uid", "of")
    both = rows.join(added, F.col("uid") == F.col("of"), "left")
    every = F.concat("base", F.coalesce("added", F.array().cast("array<struct<start:int,kind:int,end:int>>")))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return both.select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(every).alias("spans"), zero("n_live"), zero("n_copied")
    )


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document stands for a repository, its source for the owner."""
    return scan(table(spark, sf_dir, "documents"))


OP6_SQL = r"""
WITH patterns(kind, k, re, grp, least) AS (VALUES
  ('assign', 0, '((?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+))', 2, 8),
  ('access', 1, '(AKIA[A-Z0-9]+)', 1, 16),
  ('hex', 2, '([0-9a-f]{32,})', 1, 32),
  ('run', 9, '([A-Za-z0-9+/_=-]{20,})', 1, 20)),
docs AS (SELECT row_number() OVER () AS uid, doc_id, coalesce(source, chr(1)) AS o, coalesce(doc_id::VARCHAR, chr(1)) AS r, coalesce(text, '') AS t FROM documents),
split AS (
  SELECT uid, o, r, kind, k, least, string_split_regex(t, re) AS p, regexp_extract_all(t, re, 1) AS w,
         CASE grp WHEN 2 THEN regexp_extract_all(t, '((?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+))', 2) ELSE regexp_extract_all(t, re, 1) END AS v
  FROM docs, patterns WHERE regexp_matches(t, re)),
each AS (SELECT uid, o, r, kind, k, least, p, w, v, unnest(range(1, len(w) + 1)) AS i FROM split),
placed AS (
  SELECT uid, o, r, kind, k, v[i] AS value,
         (list_sum(list_transform(p[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(w[1:i-1], lambda x: length(x))), 0))::BIGINT AS s,
         length(w[i]) AS n
  FROM each WHERE length(v[i]) >= least),
base AS (SELECT uid, kind, k, s, s + n AS e FROM placed WHERE k < 3),
vals AS (
  SELECT DISTINCT uid, o, r, s + n - length(value) AS s, s + n AS e, value FROM placed
  WHERE k IN (0, 9) AND regexp_matches(value, '[0-9]') AND regexp_matches(value, '[A-Za-z]') AND len(list_distinct(string_split(value, ''))) >= 8),
owners AS (SELECT value, count(DISTINCT o) AS owners, count(DISTINCT {'o': o, 'r': r}) AS repositories FROM vals GROUP BY value),
told AS (SELECT v.uid, v.s, v.e, owners <= 1 AND repositories <= 5 AS live FROM vals v JOIN owners USING (value)),
every AS (SELECT uid, kind, k, s, e FROM base UNION ALL SELECT uid, 'live', 3, s, e FROM told WHERE live),
b AS (SELECT uid, string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, k, e) AS joined, count(*) FILTER (k = 0) AS a, count(*) FILTER (k = 1) AS c, count(*) FILTER (k = 2) AS h FROM base GROUP BY uid),
x AS (SELECT uid, string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, k, e) AS joined FROM every GROUP BY uid),
n AS (SELECT uid, count(*) FILTER (live) AS n_live, count(*) FILTER (NOT live) AS n_copied FROM told GROUP BY uid)
SELECT doc_id, coalesce(a, 0) AS n_assign, coalesce(c, 0) AS n_access, coalesce(h, 0) AS n_hex, sha256(coalesce(b.joined, '')) AS base_sha256,
       coalesce(x.joined, '') AS spans, coalesce(n_live, 0) AS n_live, coalesce(n_copied, 0) AS n_copied
FROM docs LEFT JOIN b USING (uid) LEFT JOIN x USING (uid) LEFT JOIN n USING (uid)
"""
