"""Book profiles: schema, normalisation of older vocabularies, and step planning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The profile's fields with their types and defaults (SQL literals).
FIELDS = (
    ("layout", "string", "'cut_half'"), ("banxin_position", "string", "null"), ("content_format", "string", "'regular'"),
    ("font_type", "string", "'printed'"), ("lines_per_page", "int", "8"), ("fixed_chars_per_line", "boolean", "true"),
    ("chars_per_line", "int", None), ("has_marginal_notes", "boolean", "false"), ("color_mode", "string", "'bw'"),
    ("background_color", "string", "'white'"), ("text_color", "string", "'black'"), ("border_color", "string", "'black'"),
    ("border_style", "string", "'double'"), ("border_wear", "string", "'medium'"), ("interferences", "array<string>", "array()"),
    ("margin_color", "string", "null"), ("skip_pages", "array<int>", "array()"), ("skip_steps", "array<string>", "array()"),
    ("auto_detected", "boolean", "true"), ("detection_confidence", "map<string,double>", "map()"),
)
SCHEMA = ", ".join(f"{n} {t}" for n, t, _ in FIELDS)
#: What older files may hold besides.
READ_SCHEMA = f"{SCHEMA}, page_type string"

# The steps in order, and the condition under which each one runs.
STEPS = ("remove_watermark", "deskew", "crop", "enhance_lines", "split", "binarize")
STEPS_SPREAD = ("remove_watermark", "split", "deskew", "crop", "enhance_lines", "binarize")


def read_profiles(spark: SparkSession, path: str) -> DataFrame:
    """Raw profiles, one row per JSON file, the folder's name as ``book``."""
    raw = spark.read.schema(READ_SCHEMA).json(path, multiLine=True)
    return raw.withColumn("book", F.element_at(F.split(F.input_file_name(), "/"), -2))


def normalise(raw: DataFrame) -> DataFrame:
    """Older values rewritten, missing fields defaulted, unknown ones dropped.

    ``raw`` has some of the profile's fields (and ``page_type``); others stay as they
    are if they are named ``book``.  An explicit null count of characters stays null.
    """
    there = {c.lower() for c in raw.columns}
    col = lambda n, t: F.col(n) if n in there else F.lit(None).cast(t)
    old = col("page_type", "string")
    table_page = col("layout", "string").isNull() & (old == "table")
    value: dict[str, Column] = {n: col(n, t) for n, t, _ in FIELDS}
    value["layout"] = F.coalesce(value["layout"], F.when(old == "table", "cut_half").otherwise(old))
    value["content_format"] = F.coalesce(value["content_format"], F.when(table_page, "table"))
    back = value["background_color"]
    value["background_color"] = F.when(back.isin("orange", "yellow"), "xuan").when(back == "red", "other").otherwise(back)
    value["border_color"] = F.when(value["border_color"] == "orange", "red").otherwise(value["border_color"])
    kept = F.filter(value["interferences"], lambda x: ~x.isin("stains", "water_damage"))
    value["interferences"] = F.transform(kept, lambda x: F.when(x == "white_margin", "margin").otherwise(x))
    out = [(F.coalesce(value[n], F.expr(d).cast(t)) if d else value[n]).cast(t).alias(n) for n, t, d in FIELDS]
    return raw.select(*(["book"] if "book" in there else []), *out)


def derived(profiles: DataFrame) -> DataFrame:
    """With the profile's derived booleans."""
    layout = F.col("layout")
    return profiles.withColumns({
        "is_colored": F.col("color_mode") == "colored", "is_uncut": layout == "uncut_full", "is_spread": layout == "spread",
        "is_table": F.col("content_format") == "table", "needs_split": layout.isin("uncut_full", "spread"),
        "has_spine_shadow": F.array_contains("interferences", "spine_shadow"), "has_margin": F.array_contains("interferences", "margin"),
    })


def plan_steps(profiles: DataFrame) -> DataFrame:
    """``book, number, step, active, reason``: the steps of each book's table in order.  A
    step runs unless it is skipped by name or its condition fails."""
    p = derived(profiles)
    listed = lambda names: F.array(*[F.struct(F.lit(k + 1).alias("number"), F.lit(s).alias("step")) for k, s in enumerate(names)])
    steps = F.when(F.col("is_spread"), listed(STEPS_SPREAD)).otherwise(listed(STEPS))
    each = p.select("book", "is_spread", "is_uncut", "is_colored", "interferences", "skip_steps", F.explode(steps).alias("s")).select("*", "s.*")
    needed = (
        F.when(F.col("step") == "remove_watermark", F.array_contains("interferences", "watermark"))
        .when(F.col("step") == "split", F.col("is_spread") | F.col("is_uncut"))
        .when(F.col("step") == "binarize", ~F.col("is_colored"))
        .otherwise(F.lit(True))
    )
    skipped = F.array_contains("skip_steps", F.col("step"))
    reason = F.when(skipped, "skipped by profile").when(~needed, "not needed")
    return each.select("book", "number", "step", (needed & ~skipped).alias("active"), F.coalesce(reason, F.lit("")).alias("reason"))


def patched(profiles: DataFrame, patches: DataFrame) -> DataFrame:
    """Profiles with the known fields that ``patches`` (``book`` and some fields) sets; nulls
    set nothing, unknown fields are passed over."""
    known = [n for n, _, _ in FIELDS if n in patches.columns]
    own = patches.select("book", *[F.col(n).alias(f"_{n}") for n in known])
    return profiles.join(own, "book", "left").select("book", *[F.coalesce(f"_{n}", n).alias(n) if n in known else n for n, _, _ in FIELDS])


def resolved(given: DataFrame, stored: DataFrame, found: DataFrame) -> DataFrame:
    """One profile per book: the one given, else the stored, else the one that an analysis
    found; ``origin`` says which."""
    parts = [d.withColumn("_rank", F.lit(k)).withColumn("origin", F.lit(o)) for k, (o, d) in enumerate((("given", given), ("stored", stored), ("found", found)))]
    every = parts[0].unionByName(parts[1], allowMissingColumns=True).unionByName(parts[2], allowMissingColumns=True)
    names = [c for c in every.columns if c not in ("book", "_rank")]
    best = F.min_by(F.struct(*names), "_rank").alias("p")
    return every.groupBy("book").agg(best).select("book", "p.*")


def described(profiles: DataFrame) -> DataFrame:
    """``book, text``: what a profile says, in one line."""
    lines = F.when(F.col("content_format").isin("regular", "no_line"), F.concat(F.lit("lines="), F.col("lines_per_page")))
    lines = lines.when(F.col("content_format") == "table", F.concat(F.lit("columns="), F.col("lines_per_page")))
    notes = F.when(F.col("content_format").isin("regular", "no_line") & F.col("has_marginal_notes"), "with small notes")
    harm = F.when(F.size("interferences") > 0, F.concat(F.lit("interferences="), F.array_join("interferences", "+")))
    name = lambda c, label: F.concat(F.lit(f"{label}="), F.col(c))
    return profiles.select("book", F.concat_ws(", ", name("layout", "layout"), name("content_format", "content"), name("color_mode", "color"), lines, notes, harm).alias("text"))


def final_folder(steps: DataFrame) -> DataFrame:
    """``book, folder``: where a book's prepared pages are: the folder of its last active step
    (``plan_steps``), the book's own (``.``) without one."""
    name = F.concat(F.lit("s"), F.col("number").cast("string"), F.lit("_"), F.col("step"))
    last = F.max_by(F.when(F.col("active"), name), F.when(F.col("active"), F.col("number")))
    return steps.groupBy("book").agg(F.coalesce(last, F.lit(".")).alias("folder"))
