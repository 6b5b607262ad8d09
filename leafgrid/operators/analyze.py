"""Book-level decisions from page-level measures.

One Arrow-batched pass decodes each sampled page once and measures it
(:mod:`leafgrid.functions.measures`); an analyzer is a name and the aggregate over a book's
measures that decides, with how sure it is.  :data:`ANALYZERS` can be added to.  Results are
joined on the book, and their confidences become one map.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import measures as ms
from ..sources import store
from . import aggregates as ag
from . import pages as pg

SAMPLE = 10
#: Aspects below which a page is half a leaf, and above which it is a whole one or a spread.
NARROW, WIDE = 0.9, 1.1
#: Prefix of the columns that say how sure a decision is.
SURE = "sure_"


def sample(pages: DataFrame, book: str = "book", path: str = "path", n: int = SAMPLE) -> DataFrame:
    """The first pages of each book, by path: all that an analysis looks at.  Ranks are taken
    on the names alone; the images are then picked where they are read."""
    first = pages.select(F.col(book).alias("_book"), F.col(path).alias("_path")).distinct()
    first = first.withColumn("_rank", F.row_number().over(Window.partitionBy("_book").orderBy("_path"))).where(F.col("_rank") <= n).drop("_rank")
    return pages.join(store.small(first), F.col(book).eqNullSafe(F.col("_book")) & (F.col(path) == F.col("_path")), "left_semi")


def measured(pages: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``keys`` and the measures of every page."""
    return pg.per_image(pages, keys, ms.SCHEMA, lambda image: [ms.page(image)])


def _share(flag: Column) -> Column:
    return F.avg(flag.cast("double"))


def mode_or(counts: DataFrame, book: str, value: str, order: str, fallback: Column | int) -> DataFrame:
    """The count most pages agree on (first seen on ties), and the share that does, up by 0.2
    within 4 to 15; the fallback without any."""
    m = ag.mode_first(counts.where(F.col(value).isNotNull()), [book], value, order)
    share = F.when(F.col("mode").between(4, 15), F.least(F.lit(1.0), F.col("share") + 0.2)).otherwise(F.col("share"))
    back = (F.lit(fallback) if isinstance(fallback, int) else fallback).alias("_back")
    every = counts.groupBy(book).agg(F.first(back).alias("_back")).join(m, book, "left")
    return every.select(book, F.coalesce("mode", "_back").cast("int").alias(value), F.coalesce(F.round(share, 2), F.lit(0.3)).alias(f"{SURE}{value}"))


def color(m: DataFrame, book: str, order: str) -> DataFrame:
    """Colour mode by the mean saturated share; background by the fullest hue of the coloured
    pages, first on ties; red text and red borders by their shares."""
    mean = m.groupBy(book).agg(
        F.avg("saturated").alias("mean"), F.avg("text_red").alias("text"), F.try_divide(F.sum("red_strips"), F.sum("strips")).alias("border"),
        F.bool_or(F.col("saturated") > 0.08).alias("some"),
    )
    bins = m.where(F.col("saturated") > 0.08).select(book, F.posexplode("hue_bins").alias("bin", "n")).groupBy(book, "bin").agg(F.sum("n").alias("n"))
    top = bins.groupBy(book).agg(F.max_by("bin", F.struct("n", -F.col("bin"))).alias("bin"))
    colored = F.col("mean") > 0.08
    hued = colored & F.col("some")
    back = F.when(~hued, "white").when((F.col("bin") * 5).between(5, 40), "xuan").otherwise("other")
    red = lambda on: F.when(F.coalesce(on, F.lit(False)), "red").otherwise("black")
    return mean.join(top, book, "left").select(
        book, F.when(colored, "colored").otherwise("bw").alias("color_mode"), back.alias("background_color"), red(F.col("text") > 0.3).alias("text_color"),
        red(hued & (F.col("border") > 0.3)).alias("border_color"), F.least(F.lit(1.0), F.abs(F.col("mean") - 0.08) * 10 + 0.5).alias(f"{SURE}color_mode"),
    )


def layout(m: DataFrame, book: str, order: str) -> DataFrame:
    """Half leaf, whole leaf or spread, by mean aspect, folds, middle rules and symmetry; then
    what the page holds, how many lines, and on which side of a half leaf the fold is."""
    s = m.groupBy(book).agg(
        F.avg("aspect").alias("a"), F.avg("symmetry").alias("sym"), _share(F.col("gap") < 0.01).alias("g"), F.avg("rule").alias("r"), _share(F.col("is_table")).alias("tables"),
        _share(F.col("is_mixed")).alias("mixed"), _share(F.col("pictured")).alias("pic"), _share(F.col("pictured_right")).alias("pic_right"),
        F.bool_or(F.col("ruled") | F.col("colored_rules")).alias("rules"), F.bool_or(F.col("lines").isNotNull()).alias("some_lines"),
        F.sum("fold_left").alias("left"), F.sum("fold_right").alias("right"),
    )
    spread, wide, narrow = (F.col("a") > NARROW) & (F.col("g") > 0.5), F.col("a") > WIDE, F.col("a") < NARROW
    kind = (
        F.when(spread, "spread").when(wide, F.when(F.col("r") >= 0.03, "spread").otherwise("uncut_full"))
        .when(narrow, "cut_half").otherwise(F.when(F.col("sym") > 0.7, "uncut_full").otherwise("cut_half"))
    )
    by_wide = F.least(F.lit(1.0), F.least(F.lit(1.0), (F.col("a") - WIDE) * 5 + 0.6) + F.abs(F.col("r") - 0.03) * 10)
    sure = (
        F.when(spread, F.least(F.lit(1.0), 0.7 + (F.col("a") - 1) * 2)).when(wide, by_wide)
        .when(narrow, F.least(F.lit(1.0), (NARROW - F.col("a")) * 5 + 0.6)).otherwise(0.5 + F.col("sym") * 0.3)
    )
    s = s.withColumn("layout", kind).withColumn("full", F.col("layout").isin("uncut_full", "spread"))
    table = ~spread & narrow & (F.col("tables") >= 0.3)
    pictured = F.when(F.col("full"), F.col("pic_right")).otherwise(F.col("pic")) > 0.5
    bare = (F.col("layout") == "cut_half") & ~F.col("rules") & F.col("some_lines")
    content = F.when(table, F.when(F.col("mixed") > 0.3, "mixed").otherwise("table")).when(pictured, "illustration").when(bare, "no_line").otherwise("regular")
    side = F.when(F.col("layout") == "cut_half", F.when(F.col("left") > F.col("right"), "left").otherwise("right"))
    head = s.select(book, "layout", "full", content.alias("content_format"), side.alias("banxin_position"), sure.alias(f"{SURE}layout"))
    counted = m.join(head.select(book, "full"), book).withColumn("lines_per_page", F.when(F.col("full"), F.col("lines_right")).otherwise(F.col("lines")))
    lines = mode_or(counted, book, "lines_per_page", order, F.when(F.col("full"), 9).otherwise(8))
    return head.drop("full").join(lines, book)


def interference(m: DataFrame, book: str, order: str) -> DataFrame:
    """Spine shadows and photographed margins that most of a page's mean confidence shows, and
    the margin's usual colour (first seen on ties)."""
    s = m.groupBy(book).agg(F.avg("spine").alias("spine"), F.avg("margin").alias("margin"))
    shade = ag.mode_first(m.where(F.col("margin") > 0.5), [book], "margin_color", order).select(book, "mode")
    found = F.array_compact(F.array(F.when(F.col("margin") > 0.5, "margin"), F.when(F.col("spine") > 0.5, "spine_shadow")))
    sure = lambda c: F.when(F.col(c) > 0.5, F.col(c))
    return s.join(shade, book, "left").select(
        book, found.alias("interferences"), F.when(F.col("margin") > 0.5, F.col("mode")).alias("margin_color"), sure("spine").alias(f"{SURE}spine_shadow"), sure("margin").alias(f"{SURE}margin")
    )


def border(m: DataFrame, book: str, order: str) -> DataFrame:
    """Double upright and level borders by their shares of the edges that could be read, and
    how much of the borders is there."""
    side = m.select(book, F.posexplode("sides").alias("k", "double"))
    upright = F.col("k") < 2
    share = lambda on: F.coalesce(F.avg(F.when(on, F.col("double").cast("double"))), F.lit(0.0))
    votes = side.groupBy(book).agg(share(upright).alias("v"), share(~upright).alias("h"), F.count("double").alias("n"), F.count_if(F.col("double")).alias("d"))
    worn = m.groupBy(book).agg(F.avg("coverage").alias("c"))
    style = F.when((F.col("v") >= 0.4) & (F.col("h") < 0.3), "hsingle_vdouble").when((F.col("v") >= 0.3) | (F.col("h") >= 0.3), "double").otherwise("single")
    sure = F.coalesce(F.round(F.try_divide(F.greatest(F.col("d"), F.col("n") - F.col("d")), F.col("n")), 2), F.lit(0.3))
    return worn.join(votes, book, "left").select(
        book, style.alias("border_style"), pg.line_wear(F.col("c")).alias("border_wear"), sure.alias(f"{SURE}border_style"),
        F.round(F.least(F.lit(1.0), 0.5 + 2 * F.abs(F.col("c") - 0.55)), 2).alias(f"{SURE}border_wear"),
    )


def text(m: DataFrame, book: str, order: str) -> DataFrame:
    """Characters per line, fixed when half of the pages or more agree and the variance is 4
    or less; whether small notes stand between the lines."""
    known = m.where("characters is not null")
    spread = known.groupBy(book).agg(F.var_pop("characters").alias("var"))
    usual = ag.mode_first(known, [book], "characters", order).join(spread, book)
    notes = m.groupBy(book).agg(_share(F.col("notes")).alias("noted"))
    fixed = (F.col("share") >= 0.5) & (F.col("var") <= 4)
    many = F.col("noted") > 0.3
    return notes.join(usual, book, "left").select(
        book, F.coalesce(fixed, F.lit(True)).alias("fixed_chars_per_line"), F.when(fixed, F.col("mode")).alias("chars_per_line"), many.alias("has_marginal_notes"),
        F.when(fixed, F.round("share", 2)).when(F.col("share").isNull(), 0.2).otherwise(0.3).alias(f"{SURE}chars_per_line"),
        F.round(F.when(many, F.col("noted")).otherwise(1 - F.col("noted")), 2).alias(f"{SURE}has_marginal_notes"),
    )


def font(m: DataFrame, book: str, order: str) -> DataFrame:
    """Printed when most of the tests that could be made (even areas, even strokes) hold."""
    s = m.groupBy(book).agg(F.avg("area_cv").alias("a"), F.avg("stroke_cv").alias("s"))
    tests = F.col("a").isNotNull().cast("int") + F.col("s").isNotNull().cast("int")
    passed = F.coalesce((F.col("a") < 0.65).cast("int"), F.lit(0)) + F.coalesce((F.col("s") < 0.70).cast("int"), F.lit(0))
    printed = (tests == 0) | (passed > tests / 2)
    share = F.when(tests == 0, 0.3).when(printed, passed / tests).otherwise((tests - passed) / tests)
    return s.select(book, F.when(printed, "printed").otherwise("handwritten").alias("font_type"), F.round(F.least(F.lit(1.0), share + 0.3), 2).alias(f"{SURE}font_type"))


def cut(m: DataFrame, book: str, order: str = "path") -> DataFrame:
    """Whether pages show an empty fold, upright or level, to be cut at, and how sure."""
    s = m.groupBy(book).agg(F.avg("v_cut").alias("v"), F.avg("h_cut").alias("h"))
    kind = F.when(F.col("v") > 0.5, "vertical_cut").when(F.col("h") > 0.5, "horizontal_cut").otherwise("none")
    sure = F.when(F.col("v") > 0.5, F.col("v")).when(F.col("h") > 0.5, F.col("h")).otherwise(1 - F.greatest("v", "h"))
    return s.select(book, kind.alias("cut_type"), F.round(F.least(F.lit(1.0), sure), 2).alias(f"{SURE}cut_type"))


Analyzer = Callable[[DataFrame, str, str], DataFrame]
#: In order; of decisions with one name the last one's holds.
ANALYZERS: dict[str, Analyzer] = {"color": color, "layout": layout, "interference": interference, "border": border, "text": text, "font": font}


def merged(parts: Sequence[DataFrame], book: str) -> DataFrame:
    """The decisions side by side, a later part's column in place of an earlier one's, and
    ``detection_confidence``, the map of what is known of how sure they are."""
    last = {c: k for k, p in enumerate(parts) for c in p.columns if c != book}
    kept = [p.select(book, *[c for c in p.columns if last.get(c) == k]) for k, p in enumerate(parts)]
    out = reduce(lambda a, b: a.join(b, book, "full"), kept)
    sure = [c for c in out.columns if c.startswith(SURE)]
    entries = F.array_compact(F.array(*[F.when(F.col(c).isNotNull(), F.struct(F.lit(c.removeprefix(SURE)).alias("key"), F.col(c).cast("double").alias("value"))) for c in sure]))
    return out.withColumn("detection_confidence", F.map_from_entries(entries)).drop(*sure)


def analyze(pages: DataFrame, keys: Sequence[str] = ("book", "path"), analyzers: dict[str, Analyzer] | None = None) -> DataFrame:
    """One row per book: every registered analyzer over its first pages (``keys`` begin with
    ``book``)."""
    m = store.cut(measured(sample(pages, keys[0], keys[-1]), keys))  # a row a page; images are decoded once
    return merged([f(m, keys[0], keys[-1]) for f in (analyzers or ANALYZERS).values()], keys[0])
