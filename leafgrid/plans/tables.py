"""Queries over the shared tables, one per kernel, each with its DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import scalars as fn
from ..operators import aggregates as ag
from ..operators import equidistant as eq
from ..operators import grid as gr
from ..operators import interlinear as il
from ..operators import joins as jn
from ..operators import layout
from ..operators import sequence as sq
from ..sources import profiles as pf
from ..sources import scan

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str):
    def register(f):
        QUERIES[f.__name__] = f
        ORACLE_SQL[f.__name__] = sql
        return f

    return register


def t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def micros(c: str):
    return F.unix_micros(F.col(c).cast("timestamp"))


def daily(spark: SparkSession, sf: str) -> DataFrame:
    """``flag, pos, n``: lines shipped per return flag and day, days counted from 0."""
    per = t(spark, sf, "lineitem").groupBy(F.col("l_returnflag").alias("flag"), F.to_date("l_shipdate").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    return sq.place(per, ["flag"], ["day"]).select("flag", "pos", "n")


DAILY = """daily AS (SELECT l_returnflag AS flag, l_shipdate::DATE AS day, count(*) AS n FROM lineitem GROUP BY 1, 2),
series AS (SELECT flag, (row_number() OVER (PARTITION BY flag ORDER BY day) - 1)::INT AS pos, n FROM daily)"""


def user_events(spark: SparkSession, sf: str) -> DataFrame:
    """``user_id, pos, s, value``: events of a user in time order, ``s`` in seconds."""
    e = t(spark, sf, "events").select("user_id", "event_id", "event_type", "value", F.floor(micros("ts") / 1_000_000).alias("s"))
    return sq.place(e, ["user_id"], ["s", "event_id"])


EVENTS = """ev AS (SELECT user_id, event_id, event_type, value, floor(epoch_us(ts) / 1000000.0)::BIGINT AS s FROM events),
e AS (SELECT *, (row_number() OVER (PARTITION BY user_id ORDER BY s, event_id) - 1)::INT AS pos FROM ev)"""


# --- scans and filters --------------------------------------------------------------


@query("""
WITH p AS (SELECT page_id, url, regexp_replace(regexp_replace(url, '^.*/', ''), '\\.[^.]*$', '') AS stem, regexp_extract(url, '^https?://([^/]+)', 1) AS host FROM pages),
q AS (SELECT *, try_cast(list_extract(regexp_extract_all(stem, '(\\d+)', 1), -1) AS INT) AS page_no FROM p),
r AS (SELECT *, row_number() OVER (PARTITION BY host ORDER BY url, page_id) AS k FROM q WHERE page_no IS NULL OR page_no NOT IN (3, 7))
SELECT page_id, host, stem, page_no FROM r WHERE k <= 10
""")
def page_scan_filter(spark, sf):
    p = t(spark, sf, "pages").select("page_id", "url", F.regexp_extract("url", "^https?://([^/]+)", 1).alias("host"))
    return scan.select_pages(p, "url", ("host",), skip_pages=(3, 7), limit=10, endings=None, ties=("page_id",)).select("page_id", "host", "stem", "page_no")


@query("""
WITH p AS (SELECT page_id, url, regexp_extract(url, '^https?://([^/]+)', 1) AS host, try_cast(string_split(regexp_replace(regexp_replace(url, '^.*/', ''), '\\.[^.]*$', ''), '_')[-1] AS INT) AS page_no FROM pages)
SELECT page_id, host, page_no, (row_number() OVER (PARTITION BY host ORDER BY page_no, url, page_id) - 1)::INT AS place,
  lpad(page_no::VARCHAR, length(max(page_no) OVER (PARTITION BY host)::VARCHAR)::INT, '0') AS padded FROM p WHERE page_no IS NOT NULL
""")
def volume_listing(spark, sf):
    p = t(spark, sf, "pages").select("page_id", "url", F.regexp_extract("url", "^https?://([^/]+)", 1).alias("host"))
    return scan.volume_pages(p, "url", ("host",), ("page_id",)).select("page_id", "host", "page_no", "place", "padded")


@query("SELECT page_id, unnest(['' || page_id, page_id || '_left', page_id || '_right']) AS half FROM pages")
def half_names(spark, sf):
    p = t(spark, sf, "pages").select("page_id", F.col("page_id").cast("string").alias("stem"))
    return scan.half_names(p).select("page_id", "half")


@query("""
SELECT o_orderkey, q.spec FROM orders, (VALUES ('all'), ('3-6'), ('1,9,12')) q(spec)
WHERE spec = 'all' OR (spec = '3-6' AND o_orderkey BETWEEN 3 AND 6) OR (spec = '1,9,12' AND o_orderkey IN (1, 9, 12))
""")
def volume_dsl(spark, sf):
    """Three choices of numbers, each over all orders."""
    specs = spark.sql("select explode(array('all', '3-6', '1,9,12')) as spec")
    o = t(spark, sf, "orders").select("o_orderkey")
    return o.join(F.broadcast(specs)).where(fn.in_numbers(F.col("o_orderkey").cast("int"), F.col("spec"))).select("o_orderkey", "spec")


@query("""
WITH r AS (SELECT unnest(string_split('3-6,9,20-25', ',')) AS p),
n AS (SELECT unnest(range(string_split(p, '-')[1]::INT, coalesce(string_split(p, '-')[2], string_split(p, '-')[1])::INT + 1)) AS k FROM r)
SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_orderkey IN (SELECT k FROM n)
""")
def range_dsl_filter(spark, sf):
    keys = spark.sql("select '3-6,9,20-25' as r").select(F.explode(fn.expand_ranges(F.col("r"))).alias("o_orderkey"))
    return t(spark, sf, "orders").join(keys, "o_orderkey", "left_semi").select("o_orderkey", "o_custkey", "o_orderstatus")


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')")
def resume_anti(spark, sf):
    done = t(spark, sf, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return t(spark, sf, "orders").join(done, "o_orderkey", "left_anti").select("o_orderkey", "o_orderstatus")


@query("""
SELECT c_custkey, c_mktsegment, count(o_orderkey) AS n_orders, coalesce(max(o_totalprice), 0) AS max_price
FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY 1, 2
""")
def stem_left_join(spark, sf):
    o = t(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("o_orderkey").alias("n"), F.max("o_totalprice").alias("m"))
    both = t(spark, sf, "customer").join(o, "c_custkey", "left")
    return both.select("c_custkey", "c_mktsegment", F.coalesce("n", F.lit(0)).alias("n_orders"), F.coalesce("m", F.lit(0.0)).alias("max_price"))


@query("""
WITH s AS (SELECT l_returnflag AS flag, l_quantity - 25 AS dx, l_extendedprice / 1000.0 - 20 AS dy FROM lineitem),
k AS (SELECT flag, sqrt(dx * dx + dy * dy) AS len, abs(degrees(atan2(abs(dx), abs(dy)))) AS a FROM s)
SELECT flag, count(*) FILTER (a <= 10) AS n_vertical, count(*) FILTER (a > 10 AND a >= 80) AS n_horizontal,
       count(*) FILTER (a > 10 AND a < 80) AS n_other, round(sum(len), 3) AS total_length
FROM k WHERE len >= 5 GROUP BY flag
""")
def segment_classify(spark, sf):
    s = t(spark, sf, "lineitem").select(F.col("l_returnflag").alias("flag"), (F.col("l_quantity") - 25).alias("dx"), (F.col("l_extendedprice") / 1000 - 20).alias("dy"))
    s = s.withColumn("len", F.sqrt(F.col("dx") * F.col("dx") + F.col("dy") * F.col("dy"))).where("len >= 5")
    s = s.withColumn("kind", fn.segment_kind(fn.angle_from_vertical(F.col("dx"), F.col("dy"))))
    count = lambda k: F.count_if(F.col("kind") == k).alias(f"n_{k}")
    return s.groupBy("flag").agg(count("vertical"), count("horizontal"), count("other"), F.round(F.sum("len"), 3).alias("total_length"))


# --- sequences ----------------------------------------------------------------------


@query(f"""
WITH {EVENTS}, i AS (SELECT user_id, s, s + 600 AS x FROM e),
r AS (SELECT *, max(x) OVER (PARTITION BY user_id ORDER BY s, x ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM i),
g AS (SELECT *, sum(CASE WHEN reach IS NULL OR s > reach + 1800 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY s, x ROWS UNBOUNDED PRECEDING) AS grp FROM r)
SELECT user_id, min(s) AS m_start, max(x) AS m_end, count(*) AS parts FROM g GROUP BY user_id, grp
""")
def interval_merge(spark, sf):
    i = user_events(spark, sf).select("user_id", "s", (F.col("s") + 600).alias("x"))
    return sq.merge_intervals(i, ["user_id"], "s", "x", 1800)


RUNS = f"""{EVENTS}, f AS (SELECT user_id, pos, pos - row_number() OVER (PARTITION BY user_id ORDER BY pos) AS island FROM e WHERE value > 50),
r AS (SELECT user_id, min(pos)::INT AS run_start, max(pos)::INT + 1 AS run_end, max(pos)::INT + 1 - min(pos)::INT AS run_length FROM f GROUP BY user_id, island)"""


@query(f"WITH {RUNS} SELECT * FROM r")
def runs_true(spark, sf):
    return sq.runs(user_events(spark, sf), ["user_id"], "pos", F.col("value") > 50)


@query(f"WITH {RUNS} SELECT user_id, run_start, run_length FROM r QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY run_length DESC, run_start) = 1")
def longest_run(spark, sf):
    return sq.longest_run(user_events(spark, sf), ["user_id"], "pos", F.col("value") > 50)


@query(f"""
WITH {EVENTS}, j AS (SELECT *, coalesce(CASE WHEN s - lag(s) OVER (PARTITION BY user_id ORDER BY s, event_id) > 86400 THEN 1 ELSE 0 END, 0) AS jump FROM e),
g AS (SELECT *, sum(jump) OVER (PARTITION BY user_id ORDER BY s, event_id ROWS UNBOUNDED PRECEDING) AS grp FROM j),
a AS (SELECT user_id, grp::BIGINT AS grp, count(*) AS n, max(s) - min(s) AS span FROM g GROUP BY 1, 2)
SELECT user_id, grp, n, span FROM a QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY -abs(n - 3) DESC, n DESC, span DESC, grp) = 1
""")
def gap_groups_best(spark, sf):
    g = sq.gap_groups(user_events(spark, sf), ["user_id"], ["s", "event_id"], F.col("s"), 86400)
    a = g.groupBy("user_id", "grp").agg(F.count(F.lit(1)).alias("n"), (F.max("s") - F.min("s")).alias("span"))
    best = F.max_by(F.struct("grp", "n", "span"), F.struct(-F.abs(F.col("n") - 3), "n", "span", -F.col("grp")))
    return a.groupBy("user_id").agg(best.alias("b")).select("user_id", "b.grp", "b.n", "b.span")


PEAKS = f"""{DAILY}, m AS (SELECT *, avg(n) OVER (PARTITION BY flag) AS mean, count(*) OVER (PARTITION BY flag) AS size,
  max(n) OVER (PARTITION BY flag ORDER BY pos ROWS BETWEEN 20 PRECEDING AND 19 FOLLOWING) AS around FROM series),
peaks AS (SELECT flag, pos, n FROM m WHERE pos > 0 AND pos < size - 1 AND n >= mean AND n = around)"""


def peaks_of(spark, sf):
    d = daily(spark, sf)
    d = d.withColumn("mean", F.avg("n").over(Window.partitionBy("flag")))
    return sq.local_maxima(d, ["flag"], "pos", "n", 20, F.col("mean")).drop("mean")


@query(f"WITH {PEAKS} SELECT * FROM peaks")
def local_maxima(spark, sf):
    return peaks_of(spark, sf)


KEPT = f"""{PEAKS.replace('daily AS', 'daily AS', 1)}, ranked AS (SELECT flag, pos, row_number() OVER (PARTITION BY flag ORDER BY pos) AS k FROM peaks),
walk AS (SELECT flag, pos, k, pos AS kept FROM ranked WHERE k = 1
  UNION ALL SELECT r.flag, r.pos, r.k, CASE WHEN r.pos - w.kept >= 20 THEN r.pos ELSE w.kept END FROM walk w JOIN ranked r ON r.flag = w.flag AND r.k = w.k + 1),
spaced AS (SELECT flag, pos FROM walk WHERE pos = kept)"""


@query(f"WITH RECURSIVE {KEPT} SELECT flag, pos FROM spaced")
def refractory(spark, sf):
    return sq.spaced(peaks_of(spark, sf), ["flag"], "pos", 20)


@query(f"""
WITH RECURSIVE {KEPT}, sp AS (SELECT flag, pos AS a, lead(pos) OVER (PARTITION BY flag ORDER BY pos) AS b FROM spaced),
w AS (SELECT flag, a, b, b - a AS width FROM sp WHERE b IS NOT NULL),
size AS (SELECT flag, greatest(count(*) * 0.03, 10) AS bin FROM series GROUP BY flag),
top AS (SELECT w.flag, max(width) AS most, any_value(bin) AS bin, greatest(floor(max(width) / any_value(bin)) + 1, 3) AS bins FROM w JOIN size USING (flag) GROUP BY w.flag),
h AS (SELECT w.flag, least(floor(width / ((most + bin) / bins)), bins - 1) AS k, (most + bin) / bins AS step, count(*) AS n FROM w JOIN top USING (flag) GROUP BY ALL),
best AS (SELECT flag, (k + 0.5) * step AS center FROM h QUALIFY row_number() OVER (PARTITION BY flag ORDER BY n DESC, k) = 1),
ok AS (SELECT w.* FROM w JOIN best USING (flag) WHERE width BETWEEN center * 0.6 AND center * 1.4),
est AS (SELECT flag, count(*) AS n, median(width) AS mid, round_even((max(b) - min(a)) / median(width), 0)::INT AS lines FROM ok GROUP BY flag)
SELECT flag, round(mid, 4) AS spacing, CASE WHEN n >= 2 AND lines BETWEEN 3 AND 15 THEN lines END AS lines FROM est
""")
def line_count_estimate(spark, sf):
    """How many text columns a profile shows: peaks, their usual spacing, and how often it
    fits between the first and the last peak of that spacing."""
    sizes = daily(spark, sf).groupBy("flag").agg(F.count(F.lit(1)).alias("size"))
    got = sq.usual_spacing(sq.spaced(peaks_of(spark, sf), ["flag"], "pos", 20), sizes, ["flag"], "pos", "size")
    return got.select("flag", F.round("spacing", 4).alias("spacing"), "lines")


@query(f"""
WITH RECURSIVE {DAILY}, m AS (SELECT flag, pos, n, avg(n) OVER (PARTITION BY flag) AS mean, (max(pos) OVER (PARTITION BY flag) + 1)::INT AS size,
  min(n) OVER (PARTITION BY flag ORDER BY pos ROWS BETWEEN 6 PRECEDING AND 6 FOLLOWING) AS low FROM (SELECT flag, pos, (n - 1) * (pos % 23) AS n FROM series)),
v AS (SELECT flag, pos, row_number() OVER (PARTITION BY flag ORDER BY pos) AS k FROM m WHERE pos BETWEEN 6 AND size - 7 AND n = low AND n < mean * 0.35),
walk AS (SELECT flag, k, pos AS kept FROM v WHERE k = 1
  UNION ALL SELECT v.flag, v.k, CASE WHEN v.pos - w.kept >= 20 THEN v.pos ELSE w.kept END FROM walk w JOIN v ON v.flag = w.flag AND v.k = w.k + 1),
cut_at AS (SELECT DISTINCT flag, kept AS c FROM walk),
ends AS (SELECT flag, c FROM cut_at UNION ALL SELECT DISTINCT flag, size FROM m),
o AS (SELECT flag, c::INT AS c, row_number() OVER (PARTITION BY flag ORDER BY c) AS k FROM ends),
fold AS (SELECT flag, k, CASE WHEN c >= 10 THEN [0, c] ELSE [0] END AS cuts FROM o WHERE k = 1
  UNION ALL SELECT o.flag, o.k, CASE WHEN o.c - f.cuts[-1] >= 10 THEN list_append(f.cuts, o.c) WHEN len(f.cuts) > 1 THEN list_append(f.cuts[:-2], o.c) ELSE f.cuts END
  FROM fold f JOIN o ON o.flag = f.flag AND o.k = f.k + 1),
last AS (SELECT flag, cuts FROM fold QUALIFY row_number() OVER (PARTITION BY flag ORDER BY k DESC) = 1),
x AS (SELECT flag, cuts, unnest(range(1, len(cuts))) AS i FROM last)
SELECT flag, cuts[i]::INT AS cut_start, cuts[i + 1]::INT AS cut_end FROM x
""")
def valley_split(spark, sf):
    """A long stretch cut where its profile, made hilly here, has clear valleys."""
    d = daily(spark, sf).select("flag", "pos", ((F.col("n") - 1) * (F.col("pos") % 23)).alias("n"))
    return sq.valley_cuts(d, ["flag"], "pos", "n", 40.0)


@query(f"""
WITH RECURSIVE {DAILY}, s AS (SELECT flag, pos, n::DOUBLE AS n, avg(n) OVER (PARTITION BY flag) AS mean FROM series),
ranked AS (SELECT flag, pos, n, row_number() OVER (PARTITION BY flag ORDER BY pos) AS k FROM s WHERE n > mean * 1.2),
walk AS (SELECT flag, k, [{{'p': pos, 's': n}}] AS kept FROM ranked WHERE k = 1
  UNION ALL SELECT r.flag, r.k, CASE WHEN r.pos - w.kept[-1].p > 25 THEN list_append(w.kept, {{'p': r.pos, 's': r.n}})
    WHEN r.n > w.kept[-1].s THEN list_append(w.kept[:-2], {{'p': r.pos, 's': r.n}}) ELSE w.kept END
  FROM walk w JOIN ranked r ON r.flag = w.flag AND r.k = w.k + 1),
last AS (SELECT flag, kept FROM walk QUALIFY row_number() OVER (PARTITION BY flag ORDER BY k DESC) = 1),
out AS (SELECT flag, unnest(kept) AS x FROM last)
SELECT flag, x.p::INT AS pos, x.s AS n FROM out
""")
def stronger_replaces(spark, sf):
    d = daily(spark, sf).withColumn("mean", F.avg("n").over(Window.partitionBy("flag"))).where("n > mean * 1.2")
    return sq.stronger_replaces(d, ["flag"], "pos", "n", 25)


@query(f"""
WITH {DAILY} SELECT flag, pos, round(sum(n) OVER (PARTITION BY flag ORDER BY pos ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING) / 7.0, 4) AS smooth FROM series
""")
def moving_average(spark, sf):
    return sq.moving_average(daily(spark, sf), ["flag"], "pos", "n", 7, "smooth").select("flag", "pos", F.round("smooth", 4).alias("smooth"))


@query(f"""
WITH {EVENTS} SELECT user_id, coalesce(min(CASE WHEN NOT value > 20 THEN pos END), least(15, max(pos) + 1))::INT AS depth FROM e WHERE pos < 15 GROUP BY user_id
""")
def prefix_scan(spark, sf):
    return sq.first_failure(user_events(spark, sf), ["user_id"], "pos", F.col("value") > 20, 15)


@query(f"""
WITH {EVENTS}, w AS (SELECT user_id, pos, count(*) OVER (PARTITION BY user_id) AS n, avg(value) OVER (PARTITION BY user_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING) AS m FROM e),
k AS (SELECT *, CASE WHEN pos <= n - least(5, n) AND m > 60 THEN 1 ELSE 0 END AS ok FROM w)
SELECT user_id, pos, max(ok) OVER (PARTITION BY user_id ORDER BY pos ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) = 1 AS marked FROM k
""")
def window_mark(spark, sf):
    ahead = Window.partitionBy("user_id").orderBy("pos").rowsBetween(0, 4)
    e = user_events(spark, sf).withColumn("m", F.avg("value").over(ahead))
    return sq.window_mark(e, ["user_id"], "pos", F.col("m") > 60, 5).select("user_id", "pos", "marked")


@query(f"""
WITH {EVENTS}, n AS (SELECT user_id, least(count(*), 20) AS n, min(CASE WHEN pos = 0 THEN floor((s % 1000000) / 50000.0) END) AS first FROM e GROUP BY user_id)
SELECT e.user_id, e.event_id, (greatest(0, least(20 - n, first)) + e.pos)::BIGINT AS slot FROM e JOIN n USING (user_id) WHERE e.pos < 20
""")
def slot_assign(spark, sf):
    """The first 20 items of a key (all that it has slots for) take consecutive slots, from the
    one on that the first item's place falls into."""
    e = user_events(spark, sf)
    return sq.consecutive_slots(e, ["user_id"], "pos", F.col("s") % 1_000_000, F.lit(0), F.lit(50_000), F.lit(20)).select("user_id", "event_id", F.col("slot").cast("long").alias("slot"))


@query("""
WITH s AS (SELECT s_nationkey, s_acctbal AS x, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_acctbal, s_suppkey) AS k FROM supplier),
c AS (SELECT s_nationkey, x AS left_x, lead(x) OVER (PARTITION BY s_nationkey ORDER BY k) AS right_x FROM s),
d AS (SELECT *, right_x - left_x AS width FROM c WHERE right_x IS NOT NULL)
SELECT s_nationkey, row_number() OVER (PARTITION BY s_nationkey ORDER BY left_x DESC, right_x DESC)::INT AS idx, left_x, right_x, round(width, 4) AS width,
  CASE WHEN width > 1.5 * avg(width) OVER (PARTITION BY s_nationkey) THEN round_even(width / avg(width) OVER (PARTITION BY s_nationkey), 0)::INT ELSE 1 END AS pieces
FROM d
""")
def boundaries_to_columns(spark, sf):
    """Neighbouring boundaries as columns numbered from the right, and into how many a wide
    one would be split."""
    s = sq.place(t(spark, sf, "supplier").select("s_nationkey", "s_suppkey", F.col("s_acctbal").alias("x")), ["s_nationkey"], ["x", "s_suppkey"])
    nxt = F.lead("x").over(Window.partitionBy("s_nationkey").orderBy("pos"))
    d = s.withColumn("right_x", nxt).where("right_x is not null").withColumnRenamed("x", "left_x").withColumn("width", F.col("right_x") - F.col("left_x"))
    mean = F.avg("width").over(Window.partitionBy("s_nationkey"))
    pieces = F.when(F.col("width") > 1.5 * mean, fn.round_half_even(F.col("width") / mean).cast("int")).otherwise(F.lit(1))
    idx = F.row_number().over(Window.partitionBy("s_nationkey").orderBy(F.desc("left_x"), F.desc("right_x")))
    return d.select("s_nationkey", idx.alias("idx"), "left_x", "right_x", F.round("width", 4).alias("width"), pieces.alias("pieces"))


@query(f"""
WITH {EVENTS}, b AS (SELECT user_id, pos, s AS top, s + 40000 AS bottom, event_type = 'click' AS m FROM e),
n AS (SELECT *, lead(top) OVER w AS next_top, lead(m) OVER w AS next_m, lag(bottom) OVER w AS last_bottom FROM b WINDOW w AS (PARTITION BY user_id ORDER BY pos)),
r AS (SELECT user_id, pos, CASE WHEN m AND last_bottom > top THEN last_bottom ELSE top END AS top, CASE WHEN m AND NOT next_m AND next_top < bottom THEN next_top ELSE bottom END AS bottom FROM n)
SELECT user_id, pos, top, greatest(top, bottom) AS bottom FROM r
""")
def overlap_resolve(spark, sf):
    """Intervals of users in order; clicks give way to others, and the later of two clicks."""
    b = user_events(spark, sf).select("user_id", "pos", F.col("s").alias("top"), (F.col("s") + 40000).alias("bottom"), (F.col("event_type") == "click").alias("m"))
    return sq.resolve_overlaps(b, ["user_id"], "pos", "top", "bottom", F.col("m")).drop("m")


MARKED = f"""{EVENTS}, w AS (SELECT user_id, pos, count(*) OVER (PARTITION BY user_id) AS n, avg(value) OVER (PARTITION BY user_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING) AS mean FROM e),
k AS (SELECT *, CASE WHEN pos <= n - least(5, n) AND mean > 60 THEN 1 ELSE 0 END AS ok FROM w),
marked AS (SELECT user_id, pos, max(ok) OVER (PARTITION BY user_id ORDER BY pos ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) = 1 AS m FROM k),
i AS (SELECT user_id, pos, pos - row_number() OVER (PARTITION BY user_id ORDER BY pos) AS island FROM marked WHERE m),
dbl AS (SELECT user_id, min(pos)::INT AS first, max(pos)::INT AS last FROM i GROUP BY user_id, island HAVING count(*) >= 2)"""


def double_rows_of(spark, sf):
    ahead = Window.partitionBy("user_id").orderBy("pos").rowsBetween(0, 4)
    e = user_events(spark, sf).withColumn("ok", F.avg("value").over(ahead) > 60)
    return e, il.double_rows(e, ["user_id"])


@query(f"WITH {MARKED} SELECT * FROM dbl")
def double_rows(spark, sf):
    """Runs of items that lie in some window of five with a high mean."""
    return double_rows_of(spark, sf)[1]


@query(f"""
WITH {MARKED}, h AS (SELECT e.user_id, e.pos, coalesce(max(d.first), -1) AS row FROM e LEFT JOIN dbl d ON d.user_id = e.user_id AND e.pos BETWEEN d.first AND d.last GROUP BY 1, 2),
o AS (SELECT *, CASE WHEN lag(row) OVER w IS DISTINCT FROM row THEN 1 ELSE 0 END AS opened FROM h WINDOW w AS (PARTITION BY user_id ORDER BY pos)),
g AS (SELECT *, sum(opened) OVER (PARTITION BY user_id ORDER BY pos ROWS UNBOUNDED PRECEDING) - 1 AS seg FROM o)
SELECT user_id, seg::BIGINT AS seg, CASE WHEN any_value(row) < 0 THEN 'normal' ELSE 'double' END AS kind, min(pos)::INT AS first, max(pos)::INT AS last FROM g GROUP BY user_id, seg
""")
def alternating_segments(spark, sf):
    """A key's items as normal and marked stretches in turn."""
    e, rows = double_rows_of(spark, sf)
    return il.alternating(e, rows, ["user_id"])


@query(f"""
WITH {EVENTS}, r AS (SELECT user_id, pos, s / 1000.0 AS r_top, s / 1000.0 + 60 + event_id % 90 AS r_bottom FROM e),
g AS (SELECT *, (lead(r_top) OVER w + lead(r_bottom) OVER w) / 2 - (r_top + r_bottom) / 2 AS gap, r_bottom - lead(r_top) OVER w AS over FROM r WINDOW w AS (PARTITION BY user_id ORDER BY r_top, r_bottom)),
h AS (SELECT user_id, median(CASE WHEN gap > 40 AND gap < 200 THEN gap END) AS m, coalesce(bool_or(over > 30), false) AS "overlaps" FROM g GROUP BY user_id)
SELECT user_id, round(CASE WHEN m IS NULL THEN 100 ELSE greatest(least(m, 130), 70) END, 4) AS char_height, "overlaps" FROM h
""")
def char_height(spark, sf):
    r = user_events(spark, sf).select("user_id", (F.col("s") / 1000).alias("r_top"), (F.col("s") / 1000 + 60 + F.col("event_id") % 90).alias("r_bottom"))
    return gr.usual_height(r, ["user_id"], F.lit(100.0)).select("user_id", F.round("char_height", 4).alias("char_height"), "overlaps")


@query("SELECT c_nationkey, coalesce(avg(c_acctbal) FILTER (c_acctbal > 9000), 0) AS char_height FROM customer GROUP BY 1")
def mean_char_height(spark, sf):
    """The mean over the columns of a page that have a height, 0 where none has."""
    c = t(spark, sf, "customer").select("c_nationkey", F.when(F.col("c_acctbal") > 9000, F.col("c_acctbal")).alias("char_height"))
    return gr.mean_height(c, ["c_nationkey"])


@query("""
WITH d AS (SELECT user_id, ts::DATE AS day, count(*) AS n FROM events GROUP BY 1, 2),
b AS (SELECT user_id, min(day) AS a, max(day) AS z FROM d GROUP BY 1),
g AS (SELECT user_id, unnest(generate_series(a, z, INTERVAL 1 DAY))::DATE AS day FROM b),
f AS (SELECT g.user_id, g.day, n FROM g LEFT JOIN d USING (user_id, day))
SELECT user_id, count(*) AS days, count(*) FILTER (n IS NULL) AS empty_days, sum(coalesce(n, 0))::BIGINT AS events FROM f GROUP BY user_id
""")
def fill_gaps(spark, sf):
    d = t(spark, sf, "events").groupBy("user_id", F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    ends = d.groupBy("user_id").agg(F.min("day").alias("a"), F.max("day").alias("z"))
    g = ends.select("user_id", F.explode(F.sequence("a", "z")).alias("day"))
    f = g.join(d, ["user_id", "day"], "left")
    return f.groupBy("user_id").agg(F.count(F.lit(1)).alias("days"), F.count_if(F.col("n").isNull()).alias("empty_days"), F.sum(F.coalesce("n", F.lit(0))).alias("events"))


# --- joins --------------------------------------------------------------------------


@query(f"""
WITH {EVENTS}, r AS (SELECT user_id, event_id AS region_id, s AS c FROM e WHERE event_type = 'view'),
b AS (SELECT user_id, event_id AS box_id, s - 3600 - (event_id % 5) * 600 AS lo, s + 3600 AS hi, s AS c_box FROM e WHERE event_type = 'click'),
h AS (SELECT user_id, median(hi - lo) * 1.5 AS reach FROM b GROUP BY 1),
p AS (SELECT r.user_id, region_id, box_id, c BETWEEN lo AND hi AS inside, abs(c - c_box) AS dist, reach FROM r JOIN b USING (user_id) JOIN h USING (user_id))
SELECT user_id, region_id, box_id, dist, inside FROM p WHERE inside OR dist <= reach
QUALIFY row_number() OVER (PARTITION BY user_id, region_id ORDER BY NOT inside, dist, box_id) = 1
""")
def nearest_containment(spark, sf):
    e = user_events(spark, sf)
    r = e.where("event_type = 'view'").select("user_id", F.col("event_id").alias("region_id"), F.col("s").alias("c"))
    b = e.where("event_type = 'click'").select("user_id", F.col("event_id").alias("box_id"), (F.col("s") - 3600 - (F.col("event_id") % 5) * 600).alias("lo"), (F.col("s") + 3600).alias("hi"), F.col("s").alias("c_box"))
    return jn.containment_or_nearest(r, b, ["user_id"])


@query("""
WITH p AS (SELECT c_nationkey AS k, c_custkey AS a, s_suppkey AS b, abs(c_acctbal - s_acctbal) AS dist FROM customer JOIN supplier ON c_nationkey = s_nationkey)
SELECT k, a, b, dist FROM p WHERE dist < 500 QUALIFY row_number() OVER (PARTITION BY k, a ORDER BY dist, b) = 1
""")
def nearest_tolerance(spark, sf):
    c = t(spark, sf, "customer").select(F.col("c_nationkey").alias("k"), F.col("c_custkey").alias("a"), F.col("c_acctbal").alias("x"))
    s = t(spark, sf, "supplier").select(F.col("s_nationkey").alias("k"), F.col("s_suppkey").alias("b"), F.col("s_acctbal").alias("y"))
    return jn.nearest_within(c, s, ["k"], "a", "x", "b", "y", 500.0)


@query("""
SELECT p_partkey, p_brand FROM part a WHERE EXISTS (SELECT 1 FROM part b WHERE b.p_brand = a.p_brand AND b.p_size >= 10
  AND b.p_retailprice - a.p_retailprice > 5 AND b.p_retailprice - a.p_retailprice <= 40)
""")
def companion_exists(spark, sf):
    a = t(spark, sf, "part").select("p_partkey", "p_brand", "p_retailprice")
    b = t(spark, sf, "part").where("p_size >= 10").select("p_brand", F.col("p_retailprice").alias("price"))
    return jn.exists_between(a, b, ["p_brand"], "p_retailprice", "price", 5.0, 40.0).select("p_partkey", "p_brand")


LINES = """line AS (SELECT p_partkey // 40 AS page, p_partkey AS id, (p_partkey * 613) % 1000 AS x, p_size * 20.0 AS length FROM part)"""


@query(f"""
WITH {LINES}, c AS (SELECT *, row_number() OVER (PARTITION BY page ORDER BY x, id) AS k FROM line WHERE length >= 300),
med AS (SELECT page, median(length) * 0.5 AS least, count(*) AS many FROM c GROUP BY page),
p AS (SELECT a.page, a.k AS ka, b.k AS kb, a.x AS ax, b.x AS bx, a.id AS ia, b.id AS ib, a.length AS la, b.length AS lb, (b.x - a.x) / 3.0 AS sp
  FROM c a JOIN c b ON a.page = b.page AND b.k >= a.k + 3 AND b.x - a.x >= 300),
q AS (SELECT p.*, m.k AS k1, m.id AS i1, m.length AS l1, abs(m.x - (ax + sp)) AS d1 FROM p JOIN c m ON m.page = p.page AND m.k > ka AND m.k < kb
  QUALIFY row_number() OVER (PARTITION BY p.page, ka, kb ORDER BY abs(m.x - (ax + sp)), m.k) = 1),
r AS (SELECT q.*, m.id AS i2, m.length AS l2, abs(m.x - (ax + 2 * sp)) AS d2 FROM q JOIN c m ON m.page = q.page AND m.k > k1 AND m.k < kb WHERE d1 <= 0.3 * sp
  QUALIFY row_number() OVER (PARTITION BY q.page, ka, kb ORDER BY abs(m.x - (ax + 2 * sp)), m.k) = 1),
f AS (SELECT r.*, least, [la, l1, l2, lb] AS ls, least(80, sp * 0.5) AS reach FROM r JOIN med USING (page) WHERE d2 <= 0.3 * sp),
s AS (SELECT page, ka, kb, [ia, i1, i2, ib] AS ids, sp, (d1 + d2) / (3 * sp) + list_stddev_pop(ls) / list_median(ls)
  - CASE WHEN EXISTS (SELECT 1 FROM line l WHERE l.page = f.page AND l.length >= least AND ax - l.x > 5 AND ax - l.x <= reach) THEN 0.15 ELSE 0 END
  - CASE WHEN EXISTS (SELECT 1 FROM line l WHERE l.page = f.page AND l.length >= least AND l.x - bx > 5 AND l.x - bx <= reach) THEN 0.15 ELSE 0 END
  + CASE WHEN ax < 150 THEN 0.3 * (1 - ax / 150.0) ELSE 0 END + CASE WHEN 1000 - bx < 150 THEN 0.3 * (1 - (1000 - bx) / 150.0) ELSE 0 END AS score FROM f)
SELECT page, array_to_string(ids, ',') AS ids, round(sp, 4) AS spacing, round(score, 6) AS score FROM s
QUALIFY row_number() OVER (PARTITION BY page ORDER BY round(score, 9), ka, kb) = 1
""")
def equidistant_pairs(spark, sf):
    """The four of a page's lines that part it best into three columns."""
    p = t(spark, sf, "part").select(F.expr("p_partkey div 40").alias("page"), F.col("p_partkey").alias("id"), ((F.col("p_partkey") * 613) % 1000).cast("double").alias("x"), (F.col("p_size") * 20.0).alias("length"))
    pages = p.select("page").distinct().select("page", F.lit(1000).alias("page_width"), F.lit(1000).alias("page_height"))
    got = eq.equidistant(p, pages, ["page"], 3)
    return got.select("page", F.array_join(F.transform("ids", lambda x: x.cast("string")), ",").alias("ids"), F.round("spacing", 4).alias("spacing"), F.round("score", 6).alias("score"))


@query("""
SELECT s_suppkey, s_nationkey FROM supplier QUALIFY row_number() OVER (PARTITION BY s_nationkey ORDER BY s_acctbal, s_suppkey) > 1
  AND row_number() OVER (PARTITION BY s_nationkey ORDER BY s_acctbal DESC, s_suppkey DESC) > 1
""")
def anti_border(spark, sf):
    """Lines that are neither border of their key, told by id."""
    s = t(spark, sf, "supplier").select("s_suppkey", "s_nationkey", "s_acctbal")
    ends = s.groupBy("s_nationkey").agg(F.min(F.struct("s_acctbal", "s_suppkey")).alias("a"), F.max(F.struct("s_acctbal", "s_suppkey")).alias("z"))
    border = ends.select(F.explode(F.array("a.s_suppkey", "z.s_suppkey")).alias("s_suppkey"))
    return s.join(border, "s_suppkey", "left_anti").select("s_suppkey", "s_nationkey")


@query("""
WITH h AS (SELECT s_nationkey AS page, s_suppkey AS i, s_acctbal AS hb, (s_suppkey % 7) * 0.001::DOUBLE AS hm FROM supplier), v AS (SELECT c_nationkey AS page, c_custkey AS j, c_acctbal AS vb, (c_custkey % 5) * (-0.0005)::DOUBLE AS vm FROM customer),
p AS (SELECT h.page, i, j, (hm * vb + hb) / (1 - hm * vm) AS y, vb, vm FROM h JOIN v USING (page))
SELECT page, i, j, floor((vm * y + vb) * 1000)::BIGINT AS x1000, floor(y * 1000)::BIGINT AS y1000, trunc(y)::INT AS yi FROM p
""")
def cross_grid(spark, sf):
    """Where every level line of a page meets every upright one, in thousandths: all pairs of a page, tile by tile."""
    h = t(spark, sf, "supplier").select(F.col("s_nationkey").alias("page"), F.col("s_suppkey").alias("i"), F.col("s_acctbal").alias("hb"), (F.col("s_suppkey") % 7 * 0.001).alias("hm"))
    v = t(spark, sf, "customer").select(F.col("c_nationkey").alias("page"), F.col("c_custkey").alias("j"), F.col("c_acctbal").alias("vb"), (F.col("c_custkey") % 5 * -0.0005).alias("vm"))
    x, y = jn.intersection(F.col("hm"), F.col("hb"), F.col("vm"), F.col("vb"))
    return jn.all_pairs(h, v, ["page"]).select("page", "i", "j", F.floor(x * 1000).alias("x1000"), F.floor(y * 1000).alias("y1000"), y.cast("int").alias("yi"))


@query("""
WITH b AS (SELECT p_brand, row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice, p_partkey) AS band, p_retailprice AS b_start, p_retailprice + p_size / 10.0 AS b_end, p_size AS depth FROM part),
p AS (SELECT x.p_brand, x.band, y.band AS band_2, x.depth + y.depth AS score, (x.b_end + y.b_start) / 2 AS center FROM b x JOIN b y ON x.p_brand = y.p_brand AND x.band < y.band AND y.b_start - x.b_end BETWEEN 10 AND 60)
SELECT p_brand, band, band_2, score, round(center, 4) AS center FROM p QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY score, band, band_2) = 1
""")
def band_pairs(spark, sf):
    p = sq.place(t(spark, sf, "part"), ["p_brand"], ["p_retailprice", "p_partkey"])
    b = p.select("p_brand", (F.col("pos") + 1).cast("long").alias("band"), F.col("p_retailprice").alias("b_start"), (F.col("p_retailprice") + F.col("p_size") / 10).alias("b_end"), F.col("p_size").alias("depth"))
    return jn.band_pairs(b, ["p_brand"], 10.0, 60.0).withColumn("center", F.round("center", 4))


@query("""
WITH c AS (SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn) AS k FROM conversations)
SELECT u.conv_id, u.k, length(u.text) AS asked, length(a.text) AS answered FROM c u JOIN c a ON u.conv_id = a.conv_id AND u.k = a.k AND u.role = 'user' AND a.role = 'assistant'
""")
def positional_zip(spark, sf):
    c = t(spark, sf, "conversations").withColumn("k", F.row_number().over(Window.partitionBy("conv_id", "role").orderBy("turn")))
    side = lambda role, name: c.where(F.col("role") == role).select("conv_id", F.col("k").cast("long").alias("k"), F.length("text").cast("long").alias(name))
    return side("user", "asked").join(side("assistant", "answered"), ["conv_id", "k"])


@query("""
WITH c AS (SELECT s_nationkey, s_suppkey, s_acctbal + 1000 AS width, (s_suppkey % 2)::INT AS side, avg(s_acctbal + 1000) OVER (PARTITION BY s_nationkey) AS mean FROM supplier)
SELECT s_nationkey, side, s_suppkey, round(abs(width - mean), 4) AS diff FROM c WHERE width BETWEEN 0.5 * mean AND 1.5 * mean
QUALIFY row_number() OVER (PARTITION BY s_nationkey ORDER BY abs(width - mean), side, s_suppkey) = 1
""")
def candidate_best(spark, sf):
    c = t(spark, sf, "supplier").select("s_nationkey", "s_suppkey", (F.col("s_acctbal") + 1000).alias("width"), (F.col("s_suppkey") % 2).cast("int").alias("side"))
    c = c.withColumn("mean", F.avg("width").over(Window.partitionBy("s_nationkey")))
    return jn.best_candidate(c, ["s_nationkey"], "width", "mean", "side", "s_suppkey").withColumn("diff", F.round("diff", 4))


@query("SELECT coalesce(r_regionkey, n_nationkey) AS k, r_name, n_name, r_name IS NOT DISTINCT FROM n_name AS same FROM region FULL JOIN nation ON r_regionkey = n_nationkey")
def full_outer_diff(spark, sf):
    r, n = t(spark, sf, "region"), t(spark, sf, "nation")
    both = r.join(n, F.col("r_regionkey") == F.col("n_nationkey"), "full")
    return both.select(F.coalesce("r_regionkey", "n_nationkey").alias("k"), "r_name", "n_name", F.col("r_name").eqNullSafe(F.col("n_name")).alias("same"))


# --- aggregates ---------------------------------------------------------------------


@query("""
WITH c AS (SELECT o_custkey, o_orderpriority AS mode, count(*) AS n, min(o_orderkey) AS first FROM orders GROUP BY 1, 2)
SELECT o_custkey, mode, n AS votes, n / sum(n) OVER (PARTITION BY o_custkey) AS share FROM c QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY n DESC, first) = 1
""")
def mode_first(spark, sf):
    return ag.mode_first(t(spark, sf, "orders"), ["o_custkey"], "o_orderpriority", "o_orderkey")


@query("""
WITH s AS (SELECT lang, count(*) AS n, avg(toxic::DOUBLE) AS share FROM documents JOIN labels USING (doc_id) GROUP BY 1)
SELECT lang, n, round(share, 6) AS share, CASE WHEN share > 0.3 THEN 'most' WHEN share >= 0.1 THEN 'some' ELSE 'few' END AS verdict FROM s
""")
def vote_ratio(spark, sf):
    both = t(spark, sf, "documents").select("doc_id", "lang").join(t(spark, sf, "labels").select("doc_id", "toxic"), "doc_id")
    s = both.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.avg(F.col("toxic").cast("double")).alias("share"))
    verdict = F.when(F.col("share") > 0.3, "most").when(F.col("share") >= 0.1, "some").otherwise("few")
    return s.select("lang", "n", F.round("share", 6).alias("share"), verdict.alias("verdict"))


@query("""
SELECT l_suppkey, round(avg(l_quantity), 4) AS mean, round(stddev_pop(l_quantity), 4) AS sd, round(stddev_pop(l_quantity) / avg(l_quantity), 4) AS cv,
  stddev_pop(l_quantity) / avg(l_quantity) < 0.58 AS uniform FROM lineitem GROUP BY 1
""")
def cv_uniform(spark, sf):
    q = F.col("l_quantity")
    a = t(spark, sf, "lineitem").groupBy("l_suppkey").agg(F.avg(q).alias("mean"), F.stddev_pop(q).alias("sd"), ag.variation(q).alias("cv"))
    return a.select("l_suppkey", F.round("mean", 4).alias("mean"), F.round("sd", 4).alias("sd"), F.round("cv", 4).alias("cv"), (F.col("cv") < 0.58).alias("uniform"))


@query("SELECT l_returnflag, median(l_quantity) AS mid, round(quantile_cont(l_extendedprice, 0.9), 4) AS p90, count(*) FILTER (l_discount > 0.05) AS discounted FROM lineitem GROUP BY 1")
def median_p90(spark, sf):
    """Exact percentiles of a few groups of many rows, by bins."""
    lines = t(spark, sf, "lineitem")
    some = lines.groupBy("l_returnflag").agg(F.count_if(F.col("l_discount") > 0.05).alias("discounted"))
    mid = ag.exact_percentiles(lines, ["l_returnflag"], "l_quantity", [0.5]).withColumnRenamed("p0", "mid")
    high = ag.exact_percentiles(lines, ["l_returnflag"], "l_extendedprice", [0.9])
    return some.join(mid, "l_returnflag").join(high, "l_returnflag").select("l_returnflag", "mid", F.round("p0", 4).alias("p90"), "discounted")


@query("""
WITH b AS (SELECT p_brand, CASE WHEN p_retailprice BETWEEN 900 AND 2100 THEN least(floor((p_retailprice - 900) / (1200.0 / 36)), 35) END AS bin FROM part),
n AS (SELECT p_brand, bin::BIGINT AS bin, count(*) AS votes FROM b WHERE bin IS NOT NULL GROUP BY 1, 2)
SELECT * FROM n QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY votes DESC, bin) = 1
""")
def hist_argmax(spark, sf):
    b = t(spark, sf, "part").select("p_brand", ag.fixed_bins(F.col("p_retailprice"), 900.0, 2100.0, 36).alias("k"))
    return ag.histogram_peak(b, ["p_brand"], "k")


@query("""
WITH r AS (SELECT l_suppkey AS k, l_quantity AS x, l_extendedprice AS y, (1 + l_discount) * (1 + l_discount) AS c FROM lineitem),
u AS (SELECT *, x - avg(x) OVER (PARTITION BY k) AS u, avg(x) OVER (PARTITION BY k) AS mid FROM r),
s AS (SELECT k, count(*) AS n, max(x) - min(x) AS rng, avg(y) AS mean, any_value(mid) AS mid, sum(c) AS s0, sum(c*u) AS s1, sum(c*u*u) AS s2, sum(c*y) AS t0, sum(c*u*y) AS t1 FROM u GROUP BY k),
l AS (SELECT *, (s0*t1 - s1*t0) / nullif(s0*s2 - s1*s1, 0) AS m FROM s)
SELECT k, round(CASE WHEN n < 2 OR rng < 5 OR m IS NULL THEN 0 ELSE m END, 4) AS slope, round(CASE WHEN n < 2 OR rng < 5 OR m IS NULL THEN mean ELSE (t0 - m*s1)/s0 - m*mid END, 3) AS intercept FROM l
""")
def wls_fit(spark, sf):
    rows = t(spark, sf, "lineitem").withColumnRenamed("l_suppkey", "k")
    line = ag.weighted_line(rows, ["k"], F.col("l_quantity"), F.col("l_extendedprice"), 1 + F.col("l_discount"))
    return line.select("k", F.round("slope", 4).alias("slope"), F.round("intercept", 3).alias("intercept"))


@query("""
WITH m AS (SELECT o_orderstatus, median(o_totalprice) AS mid FROM orders GROUP BY 1)
SELECT o_orderkey, round(o_totalprice / mid, 6) AS scale FROM orders JOIN m USING (o_orderstatus)
""")
def corpus_median_scale(spark, sf):
    o = t(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    m = ag.exact_percentiles(o, ["o_orderstatus"], "o_totalprice", [0.5]).withColumnRenamed("p0", "mid")
    return o.join(m, "o_orderstatus").select("o_orderkey", F.round(F.col("o_totalprice") / F.col("mid"), 6).alias("scale"))


@query("SELECT conv_id, string_agg(upper(substr(role, 1, 1)), '' ORDER BY turn) AS roles, sum(length(text))::BIGINT AS chars FROM conversations GROUP BY 1")
def ordered_concat(spark, sf):
    letter = F.struct("turn", F.upper(F.substring("role", 1, 1)).alias("r"))
    g = t(spark, sf, "conversations").groupBy("conv_id").agg(F.sort_array(F.collect_list(letter)).alias("a"), F.sum(F.length("text")).alias("chars"))
    return g.select("conv_id", F.array_join(F.transform("a", lambda x: x["r"]), "").alias("roles"), "chars")


@query("SELECT user_id, count(*) AS total, count(*) FILTER (event_type = 'click') AS n_click, count(*) FILTER (event_type = 'view') AS n_view FROM events GROUP BY 1")
def count_by_type(spark, sf):
    k = lambda v: F.count_if(F.col("event_type") == v).alias(f"n_{v}")
    return t(spark, sf, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("total"), k("click"), k("view"))


@query("SELECT event_type, count(*) AS n, coalesce(avg(value) FILTER (value >= 15), 0) AS mean_kept FROM events GROUP BY 1")
def conf_filter_mean(spark, sf):
    kept = F.coalesce(F.avg(F.when(F.col("value") >= 15, F.col("value"))), F.lit(0.0))
    return t(spark, sf, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), kept.alias("mean_kept"))


# --- scalars and documents ----------------------------------------------------------


@query(f"""
SELECT doc_id, translate('管三草青' || text, '{fn.CONFUSED}', '{fn.RIGHT}') AS corrected, regexp_replace(lower(text), '[^à-ÿ]', '', 'g') AS accents FROM documents
""")
def char_correct(spark, sf):
    d = t(spark, sf, "documents")
    return d.select("doc_id", fn.correct_characters(F.concat(F.lit("管三草青"), "text")).alias("corrected"), fn.only(F.lower("text"), "à-ÿ").alias("accents"))


@query(f"""
WITH r AS (SELECT doc_id, doc_id % 3 AS row, text || '一初木日宫x二百' || source AS line FROM documents),
k AS (SELECT doc_id, line, regexp_replace(line, CASE row WHEN 0 THEN '[^{fn.YEAR}]' WHEN 1 THEN '[^{fn.WEEKDAY}]' ELSE '[^{fn.ASTRO}]' END, '', 'g') AS kept FROM r)
SELECT doc_id, kept, length(line) - length(kept) AS removed FROM k
""")
def charset_filter(spark, sf):
    """Whole texts with some letters of each kind of row put in, filtered as rows of their kind."""
    d = t(spark, sf, "documents").select("doc_id", F.concat("text", F.lit("一初木日宫x二百"), "source").alias("line"))
    kept = F.regexp_replace("line", F.concat(F.lit("[^"), fn.charset_of_row(F.col("doc_id") % 3), F.lit("]")), F.lit(""))
    return d.select("doc_id", kept.alias("kept"), F.length("line").alias("n")).select("doc_id", "kept", (F.col("n") - F.length("kept")).cast("long").alias("removed"))


@query("SELECT conv_id, turn, CASE WHEN turn % 3 = 0 THEN (turn + 1)::VARCHAR ELSE (turn + 1) || '.' || turn % 3 END AS label FROM conversations")
def cell_labels(spark, sf):
    sub = F.when(F.col("turn") % 3 > 0, F.col("turn") % 3)
    return t(spark, sf, "conversations").select("conv_id", "turn", fn.cell_label(F.col("turn"), sub).alias("label"))


@query("""
SELECT l_orderkey, l_linenumber, round_even(l_quantity / 2, 0)::BIGINT AS even, floor((l_quantity - 30) / 7)::BIGINT AS floored, trunc((l_quantity - 30) / 7)::BIGINT AS cut, greatest(10, least(l_quantity, 40)) AS clamped FROM lineitem
""")
def rounding(spark, sf):
    q = F.col("l_quantity")
    return t(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", fn.round_half_even(q / 2).cast("long").alias("even"), fn.floor_div(q - 30, F.lit(7)).alias("floored"),
        ((q - 30) / 7).cast("long").alias("cut"), F.greatest(F.lit(10.0), F.least(q, F.lit(40.0))).alias("clamped"),
    )


@query("SELECT event_id, (props::JSON->>'k')::INT AS k, CASE WHEN (props::JSON->>'k')::INT > 50 THEN 'high' ELSE 'low' END AS band FROM events")
def json_project(spark, sf):
    k = F.from_json("props", "k int")["k"]
    return t(spark, sf, "events").select("event_id", k.alias("k"), F.when(k > 50, "high").otherwise("low").alias("band"))


@query("""
SELECT * FROM (VALUES ('book2','cut_half','regular','white','black',[]::VARCHAR[],8,21), ('book3','cut_half','regular','xuan','red',[]::VARCHAR[],8,NULL),
 ('book7','cut_half','table','white','black',['spine_shadow','margin'],0,NULL), ('old','cut_half','table','other','black',[]::VARCHAR[],8,NULL), ('both','spread','regular','xuan','black',[]::VARCHAR[],8,NULL))
 v(book, layout, content_format, background_color, border_color, interferences, lines_per_page, chars_per_line)
""")
def legacy_normalise(spark, sf):
    rows = [
        '{"book":"book2","layout":"cut_half","background_color":null,"interferences":[],"chars_per_line":21}',
        '{"book":"book3","layout":"cut_half","background_color":"orange","border_color":"orange","interferences":["stains"]}',
        '{"book":"book7","layout":"cut_half","content_format":"table","lines_per_page":0,"interferences":["spine_shadow","white_margin"]}',
        '{"book":"old","page_type":"table","background_color":"red"}',
        '{"book":"both","layout":"spread","page_type":"table","background_color":"yellow"}',
    ]
    raw = spark.createDataFrame([(r,) for r in rows], "j string").select(F.from_json("j", f"book string, {pf.READ_SCHEMA}").alias("p")).select("p.*")
    return pf.normalise(raw).select("book", "layout", "content_format", "background_color", "border_color", "interferences", "lines_per_page", "chars_per_line")


@query("""
WITH p(book, spread, uncut, colored, mark, skip) AS (VALUES ('a', false, false, false, false, ''), ('b', false, true, true, true, 'deskew'), ('c', true, false, false, false, 'crop')),
s(sp, number, step) AS (VALUES (false,1,'remove_watermark'),(false,2,'deskew'),(false,3,'crop'),(false,4,'enhance_lines'),(false,5,'split'),(false,6,'binarize'),
 (true,1,'remove_watermark'),(true,2,'split'),(true,3,'deskew'),(true,4,'crop'),(true,5,'enhance_lines'),(true,6,'binarize')),
n AS (SELECT *, CASE step WHEN 'remove_watermark' THEN mark WHEN 'split' THEN spread OR uncut WHEN 'binarize' THEN NOT colored ELSE true END AS needed FROM p JOIN s ON sp = spread)
SELECT book, number, step, needed AND skip <> step AS active, CASE WHEN skip = step THEN 'skipped by profile' WHEN NOT needed THEN 'not needed' ELSE '' END AS reason FROM n
""")
def step_plan(spark, sf):
    rows = [
        '{"book":"a"}',
        '{"book":"b","layout":"uncut_full","color_mode":"colored","interferences":["watermark"],"skip_steps":["deskew"]}',
        '{"book":"c","layout":"spread","skip_steps":["crop"]}',
    ]
    raw = spark.createDataFrame([(r,) for r in rows], "j string").select(F.from_json("j", f"book string, {pf.READ_SCHEMA}").alias("p")).select("p.*")
    return pf.plan_steps(pf.normalise(raw))


@query("SELECT user_id, max_by(event_type, (epoch_us(ts), event_id)) AS last_type, list_sort(list_distinct(list(event_type))) AS types FROM events GROUP BY 1")
def dict_merge_last_wins(spark, sf):
    e = t(spark, sf, "events")
    return e.groupBy("user_id").agg(F.max_by("event_type", F.struct(micros("ts"), "event_id")).alias("last_type"), F.array_sort(F.collect_set("event_type")).alias("types"))


# --- layout steps on tables ---------------------------------------------------------


@query("""
WITH c AS (SELECT conv_id, turn, CASE role WHEN 'user' THEN 1 ELSE 2 END AS side, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn) AS i FROM conversations WHERE role IN ('user', 'assistant'))
SELECT conv_id, i, side, turn, row_number() OVER (PARTITION BY conv_id ORDER BY i, side) AS pos FROM c
""")
def interleave(spark, sf):
    """Two ordered sides of a key taken in turn: row i of the first, then of the second."""
    c = t(spark, sf, "conversations").where("role in ('user', 'assistant')")
    c = c.withColumn("i", F.row_number().over(Window.partitionBy("conv_id", "role").orderBy("turn")).cast("long"))
    c = c.withColumn("side", F.when(F.col("role") == "user", 1).otherwise(2))
    return il.interleaved(c, ["conv_id"], "side", "i").select("conv_id", "i", "side", "turn", F.col("place").alias("pos"))


UPRIGHT = """line AS (SELECT p_brand, p_partkey::INT AS id, (p_partkey * 37) % 1000 + 100.5 AS x, p_size / 1000.0 AS slope, p_size AS n FROM part)"""


def upright_lines(spark, sf):
    """Parts as the upright lines of a page each brand: ``p_brand``, as clusters have it."""
    n = F.col("p_size")
    return t(spark, sf, "part").select(
        "p_brand", F.lit("v").alias("axis"), F.col("p_partkey").cast("int").alias("cluster_id"), ((F.col("p_partkey") * 37) % 1000 + 100.5).alias("intercept"),
        (n / 1000).alias("slope"), F.array(F.struct(F.lit(0.0).alias("s"), (n * 20.0).alias("e"))).alias("segments"), (n * 20.0).alias("total_length"), n.cast("double").alias("avg_width"), n.alias("line_count"),
    )


def brand_pages(spark, sf):
    return t(spark, sf, "part").select("p_brand").distinct().select("p_brand", F.lit(1200).alias("page_width"), F.lit(1000).alias("page_height"))


FRAME = f"""{UPRIGHT}, c AS (SELECT *, x AS depth, 'left' AS side FROM line WHERE n >= 5 UNION ALL SELECT *, -x, 'right' FROM line WHERE n >= 5),
r AS (SELECT *, row_number() OVER w AS k, first(x) OVER w AS x0, first(slope) OVER w AS s0, first(id) OVER w AS o FROM c WINDOW w AS (PARTITION BY p_brand, side ORDER BY depth, id)),
pair AS (SELECT p_brand, side, any_value(o) AS outer_id, min_by(id, k) FILTER (k > 1 AND abs(x - x0) <= 80 AND abs(slope - s0) <= 0.02) AS inner_id FROM r GROUP BY p_brand, side)"""


@query(f"WITH {FRAME} SELECT * FROM pair")
def outer_pair(spark, sf):
    """The outer and the inner border at the left and right of every page."""
    got = layout.frame_pairs(upright_lines(spark, sf), brand_pages(spark, sf), ["p_brand"])
    return got.select("p_brand", "side", F.col("outer.cluster_id").alias("outer_id"), F.col("inner.cluster_id").alias("inner_id"))


COLUMNS = """cut AS (SELECT s_nationkey AS page, s_acctbal AS x, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_acctbal, s_suppkey) AS k FROM supplier),
col AS (SELECT page, x AS left_x, lead(x) OVER (PARTITION BY page ORDER BY k) AS right_x FROM cut), wide AS (SELECT *, right_x - left_x AS width FROM col WHERE right_x IS NOT NULL)"""


def supplier_columns(spark, sf):
    s = t(spark, sf, "supplier").select(F.col("s_nationkey").alias("page"), F.col("s_acctbal").alias("left_x"), "s_suppkey")
    nxt = F.lead("left_x").over(Window.partitionBy("page").orderBy("left_x", "s_suppkey"))
    return s.withColumn("right_x", nxt).where("right_x is not null").withColumn("width", F.col("right_x") - F.col("left_x")).drop("s_suppkey")


@query(f"""
WITH {COLUMNS}, u AS (SELECT *, count(*) OVER p AS many, coalesce(stddev_pop(width) OVER p / nullif(avg(width) OVER p, 0), 0) AS cv, (max(right_x) OVER p - min(left_x) OVER p) / 60.0 AS usual FROM wide WINDOW p AS (PARTITION BY page)),
n AS (SELECT *, CASE WHEN many < 60 AND cv >= 0.15 AND width > 1.5 * usual THEN round_even(width / usual, 0)::INT ELSE 1 END AS pieces FROM u),
x AS (SELECT *, unnest(range(0, pieces)) AS k FROM n)
SELECT page, row_number() OVER (PARTITION BY page ORDER BY left_x + k * (width / pieces) DESC, CASE WHEN pieces > 1 THEN left_x + k * (width / pieces) + width / pieces ELSE right_x END DESC)::INT AS idx,
  round(left_x + k * (width / pieces), 4) AS left_x, round(width / pieces, 4) AS width FROM x
""")
def columns_corrected(spark, sf):
    """Pages with fewer than sixty columns: too wide ones cut into as many as they hold."""
    got = layout.corrected(supplier_columns(spark, sf), ["page"], F.lit(60))
    return got.select("page", "idx", F.round("left_x", 4).alias("left_x"), F.round("width", 4).alias("width"))


@query(f"""
WITH {FRAME}, {COLUMNS.replace("s_nationkey AS page", "(s_nationkey + 1)::VARCHAR AS page")},
usual AS (SELECT p_brand, 20.0 + n AS mean, n % 2 * 0.2 AS cv FROM (SELECT p_brand, count(*) % 7 AS n FROM part GROUP BY 1)),
page AS (SELECT p_brand, 400.0 AS l, 700.0 AS r, mean, cv FROM usual),
free AS (SELECT line.p_brand, id, x, CASE WHEN x > r + 10 AND x <= 1195 THEN 0 WHEN x < l - 10 AND x >= 5 THEN 1 END AS side, CASE WHEN x > r THEN x - r ELSE l - x END AS width, mean FROM line JOIN page USING (p_brand)
  WHERE n >= 5 AND NOT EXISTS (SELECT 1 FROM pair WHERE pair.p_brand = line.p_brand AND line.id IN (outer_id, inner_id))),
best AS (SELECT * FROM free WHERE side IS NOT NULL AND width BETWEEN 0.5 * mean AND 1.5 * mean QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY abs(width - mean), side, id) = 1)
SELECT p_brand, CASE side WHEN 0 THEN 'right' ELSE 'left' END AS side, x AS "at", 'line' AS origin FROM best
UNION ALL SELECT p_brand, 'right', 700 + mean, 'width' FROM page WHERE cv < 0.10 AND p_brand NOT IN (SELECT p_brand FROM best)
""")
def frame_recovery(spark, sf):
    """Faint borders of pages framed at 400 and 700 whose columns are too few: a line whose
    column would be as wide as the others, else the mean width beyond the roomier side."""
    lines, pages = upright_lines(spark, sf), brand_pages(spark, sf)
    n = t(spark, sf, "part").groupBy("p_brand").agg((F.count(F.lit(1)) % 7).alias("n"))
    # two columns of widths mean * (1 - cv) and mean * (1 + cv)
    mean, cv = 20.0 + F.col("n"), F.col("n") % 2 * 0.2
    cols = n.select("p_brand", F.explode(F.array(mean * (1 - cv), mean * (1 + cv))).alias("width"))
    frame = pages.select("p_brand", "page_width", "page_height", F.lit(0.0).alias("top"), F.lit(1000.0).alias("bottom"), F.lit(400.0).alias("left"), F.lit(700.0).alias("right"))
    pairs = layout.frame_pairs(lines, pages, ["p_brand"])
    return layout.recovered(lines, frame, cols, pairs, ["p_brand"], F.lit(9)).select("p_brand", "side", "at", "origin")


@query("""
SELECT * FROM (VALUES ('a', 15.0, 60.0, 0.3), ('b', 19.5, 90.0, 0.21)) v(book, pos_tol, max_gap, min_coverage)
""")
def wear_tolerances(spark, sf):
    p = pf.normalise(spark.sql("select * from values ('a', 'light'), ('b', 'heavy') as v(book, border_wear)"))
    got = layout.tolerances(p)
    return got.select("book", F.round("pos_tol", 4).alias("pos_tol"), F.round("max_gap", 4).alias("max_gap"), F.round("min_coverage", 4).alias("min_coverage"))


@query("SELECT * FROM (VALUES ('a', 'spread', 12, 'red', 'given'), ('b', 'cut_half', 8, 'black', 'stored'), ('c', 'uncut_full', 9, 'black', 'found')) v(book, layout, lines_per_page, border_color, origin)")
def profile_resolution(spark, sf):
    """The profile given, else the stored, else the found one; then a patch over it."""
    of = lambda rows: pf.normalise(spark.sql(f"select * from values {rows} as v(book, layout, lines_per_page)"))
    found = of("('a', 'cut_half', 7), ('b', 'spread', 7), ('c', 'uncut_full', 9)")
    best = pf.resolved(of("('a', 'spread', 10)"), of("('a', 'cut_half', 8), ('b', 'cut_half', 8)"), found)
    patch = spark.sql("select * from values ('a', 12, 'red', 'no such field') as v(book, lines_per_page, border_color, unknown)")
    return pf.patched(best, patch).join(best.select("book", "origin"), "book").select("book", "layout", "lines_per_page", "border_color", "origin")


@query("SELECT * FROM (VALUES ('a', 's6_binarize', 'layout=cut_half, content=regular, color=bw, lines=8'), ('b', 's5_split', 'layout=uncut_full, content=table, color=colored, columns=12, interferences=margin')) v(book, folder, text)")
def profile_text(spark, sf):
    """The folder of the last active step, and the profile in words."""
    rows = ['{"book":"a"}', '{"book":"b","layout":"uncut_full","content_format":"table","lines_per_page":12,"color_mode":"colored","interferences":["white_margin"]}']
    raw = spark.createDataFrame([(r,) for r in rows], "j string").select(F.from_json("j", f"book string, {pf.READ_SCHEMA}").alias("p")).select("p.*")
    p = pf.normalise(raw)
    return pf.final_folder(pf.plan_steps(p)).join(pf.described(p), "book")


@query("""
WITH l AS (SELECT p_brand, p_partkey::INT AS id, p_retailprice AS x, p_size / 50.0 AS cov FROM part UNION ALL SELECT p_brand, NULL, min(p_retailprice) - 20, NULL FROM part GROUP BY 1
  UNION ALL SELECT p_brand, NULL, max(p_retailprice) + 20, NULL FROM part GROUP BY 1),
n AS (SELECT *, lead(x) OVER w AS nx, lead(id) OVER w AS nid, lead(cov) OVER w AS ncov, lead(x) OVER w - x AS width FROM l WINDOW w AS (PARTITION BY p_brand ORDER BY x, id NULLS FIRST)),
u AS (SELECT p_brand, median(width) AS usual, count(width) AS many FROM n GROUP BY 1),
d AS (SELECT DISTINCT p_brand, CASE WHEN id IS NULL THEN nid WHEN nid IS NULL THEN id WHEN cov <= ncov THEN id ELSE nid END AS id FROM n JOIN u USING (p_brand) WHERE width IS NOT NULL AND many >= 3 AND width < usual * 0.3),
k AS (SELECT l.* FROM l WHERE id IS NULL OR NOT EXISTS (SELECT 1 FROM d WHERE d.p_brand = l.p_brand AND d.id = l.id)),
c AS (SELECT p_brand, x AS left_x, lead(x) OVER (PARTITION BY p_brand ORDER BY x, id NULLS FIRST) AS right_x FROM k)
SELECT p_brand, row_number() OVER (PARTITION BY p_brand ORDER BY left_x DESC, right_x DESC)::INT AS idx, left_x, right_x, round(right_x - left_x, 4) AS width FROM c WHERE right_x IS NOT NULL
""")
def narrow_repair(spark, sf):
    """Columns between dividers, without the weaker divider beside a too narrow one."""
    p = t(spark, sf, "part")
    lines = p.select("p_brand", F.col("p_partkey").cast("int").alias("cluster_id"), F.col("p_retailprice").alias("intercept"), (F.col("p_size") / 50).alias("coverage"))
    frame = p.groupBy("p_brand").agg((F.min("p_retailprice") - 20).alias("left"), (F.max("p_retailprice") + 20).alias("right"))
    return layout.columns(lines, frame, ["p_brand"]).withColumn("width", F.round("width", 4))
