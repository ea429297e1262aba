"""Quality checks: coverage, completeness, integrity, conservation, samples, audits, roll-ups.

A check is a row (check, total, hits, ratio, passed); a report is the union of checks.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from lodegraph.operators import rules


def ratio_check(df: DataFrame, name: str, hit: Column, least: float | None = None, most: float | None = None) -> DataFrame:
    """Share of rows for which ``hit`` holds, against a bound. An empty table passes with ratio 1."""
    d = df.agg(F.count(F.lit(1)).alias("total"), F.count_if(hit).alias("hits"))
    ratio = F.when(F.col("total") == 0, 1.0).otherwise(F.col("hits") / F.col("total"))
    d = d.withColumn("ratio", F.round(ratio, 6))
    ok = (F.col("ratio") >= least) if least is not None else (F.col("ratio") <= most)
    return d.select(F.lit(name).alias("check"), "total", "hits", "ratio", (ok | (F.col("total") == 0)).alias("passed"))


def report(checks: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)


def verdict(checks: DataFrame) -> DataFrame:
    return checks.agg(F.bool_and("passed").alias("passed"), F.count_if(~F.col("passed")).alias("failed"), F.count(F.lit(1)).alias("checks"))


def coverage(have: DataFrame, want: DataFrame, key: str) -> DataFrame:
    """(mapped, missing, extra, ratio) of two key sets."""
    h, w = have.select(key).distinct().withColumn("h", F.lit(1)), want.select(key).distinct().withColumn("w", F.lit(1))
    j = h.join(w, key, "full").agg(F.count_if(F.col("h").isNotNull() & F.col("w").isNotNull()).alias("mapped"), F.count_if(F.col("h").isNull()).alias("missing"), F.count_if(F.col("w").isNull()).alias("extra"))
    return j.withColumn("ratio", F.round(F.col("mapped") / F.greatest(F.col("mapped") + F.col("missing"), F.lit(1)), 6))


def blank_fields(df: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """(key, field) for every required field that is null or blank."""
    hits = F.array_compact(F.array(*[F.when(F.coalesce(F.trim(F.col(f).cast("string")), F.lit("")) == "", F.lit(f)) for f in fields]))
    return df.select(key, F.explode(hits).alias("field"))


def repeated_keys(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def null_census(df: DataFrame, fields: list[str]) -> DataFrame:
    """(field, filled, empty) in one pass."""
    one = df.agg(F.count(F.lit(1)).alias("n"), *[F.count(f).alias(f) for f in fields])
    pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("filled"), (F.col("n") - F.col(f)).alias("empty")) for f in fields]))
    return one.select(pairs.alias("x")).select("x.*")


def token_set(text: Column) -> Column:
    """Distinct lower-case words of a text without tags and comments."""
    t = F.lower(F.regexp_replace(F.regexp_replace(F.coalesce(text, F.lit("")), r"(?s)<!--.*?-->", " "), r"<[^>]+>", " "))
    return F.array_distinct(F.filter(F.split(t, r"[^\w가-힣]+"), lambda x: x != ""))


def containment(left: Column, right: Column) -> Column:
    """Share of the left tokens that the right has; 1 if there are none."""
    n = F.size(left)
    return F.when(n == 0, 1.0).otherwise(F.round(F.size(F.array_intersect(left, right)) / n, 6))


def numbers(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"\d+(?:,\d{3})*(?:\.\d+)?"), F.lit(0))


def number_kept(number: Column, text: Column) -> Column:
    """A number is kept if a text has it as written, without commas, without trailing zeros or with ``.0``."""
    bare = F.regexp_replace(number, ",", "")
    short = F.regexp_replace(bare, r"\.0+$|(\.\d*?)0+$", "$1")
    return text.contains(number) | text.contains(bare) | text.contains(short) | text.contains(F.concat(bare, F.lit(".0")))


def foreign_sections(chunks: DataFrame, known: DataFrame) -> DataFrame:
    """(chunk_id, foreign): section ids in a text that exist, but are neither the chunk's own nor its ancestors,
    descendants or direct neighbours."""
    x = chunks.select("chunk_id", F.substring_index("section_id", "#", 1).alias("own"), F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(r"(?m)^(\d{1,2}-\d{1,2}(?:-\d{1,3})?)\s"), F.lit(1)))).alias("foreign"))
    x = x.join(known.select(F.col("id").alias("foreign")).distinct(), "foreign", "left_semi")
    head = lambda c: F.regexp_replace(c, r"-?\d+$", "")
    tail = lambda c: F.regexp_extract(c, r"(\d+)$", 1).cast("int")
    near = (head(F.col("own")) == head(F.col("foreign"))) & (F.abs(tail(F.col("own")) - tail(F.col("foreign"))) <= 1)
    kin = (F.col("own") == F.col("foreign")) | F.col("own").startswith(F.concat("foreign", F.lit("-"))) | F.col("foreign").startswith(F.concat("own", F.lit("-"))) | near
    return x.filter(~kin).select("chunk_id", "foreign")


def flat(text: Column) -> Column:
    """A text without spaces and case; of a text that many names are looked for in, work it out once."""
    return F.lower(F.regexp_replace(text, r"\s+", ""))


def name_stage(name: Column, t: Column) -> Column:
    """First way in which a name is found in a flat text: exact, without parentheses, without numbers and units,
    all of its words, first 4 characters; null if none."""
    bare = F.regexp_replace(name, r"\([^)]*\)", "")
    numberless = F.regexp_replace(bare, r"[\d.,]+\s*(?:mm|cm|m|kg|t|kW|%)?", "")
    words = F.filter(F.split(name, r"[\s()/·,]+"), lambda w: F.length(w) >= 2)
    return (
        F.when(t.contains(flat(name)), "exact")
        .when((flat(bare) != "") & t.contains(flat(bare)), "no_parens")
        .when((F.length(flat(numberless)) >= 2) & t.contains(flat(numberless)), "no_numbers")
        .when((F.size(words) > 0) & F.forall(words, lambda w: t.contains(F.lower(w))), "words")
        .when((F.length(flat(name)) >= 4) & t.contains(F.substring(flat(name), 1, 4)), "prefix")
    )


def name_lints(name: Column, normal: Column) -> Column:
    """Reasons a name breaks the naming rules."""
    checks = {
        "double_space": name.rlike(r"\s{2,}"), "edges": name.rlike(r"^\s|\s$"), "space_in_normal": normal.contains(" "), "one_char": F.length(F.trim(name)) == 1,
        "long": F.length(name) > 200, "control": name.rlike(r"[\x00-\x08\x0b-\x1f]"), "wide_parens": name.rlike("[（）]"), "blank": F.trim(name) == "",
    }
    return F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(k)) for k, c in checks.items()]))


def coverage_bands(src: DataFrame, got: DataFrame, key: str) -> DataFrame:
    """Rows by key on both sides with a severity band: under 50 %, 80 %, 95 % of the source, or missing."""
    a = src.groupBy(key).agg(F.sum("n").alias("src_rows"))
    b = got.groupBy(key).agg(F.sum("n").alias("got_rows"))
    j = a.join(b, key, "full").na.fill(0, ["src_rows", "got_rows"])
    pct = F.round(F.col("got_rows") * 100.0 / F.col("src_rows"), 2)
    band = F.when(F.col("src_rows") == 0, "extra").when(F.col("got_rows") == 0, "missing").when(pct < 50, "critical").when(pct < 80, "warn").when(pct < 95, "info").otherwise("ok")
    return j.withColumn("pct", F.when(F.col("src_rows") > 0, pct)).withColumn("band", band)


def unit_class(unit: Column) -> Column:
    return F.when(F.coalesce(F.trim(unit), F.lit("")) == "", "blank").when(unit.contains("/"), "compound").when(unit.rlike("[가-힣]"), "hangul").when(unit.rlike(r"^[A-Za-z0-9 .,]+$"), "latin").otherwise("symbol")


def isolated_edges(edges: DataFrame, ids: DataFrame) -> DataFrame:
    """Node ids that no edge uses."""
    used = edges.select(F.col("source_id").alias("id")).union(edges.select(F.col("target_id").alias("id"))).distinct()
    return ids.join(used, "id", "left_anti")


def strict_split(e: DataFrame, chunks: DataFrame) -> DataFrame:
    """(row_id, valid): an entity is valid if its name or one of its words is in its chunk's text or tables; notes
    always are; rows without a chunk are not."""
    one = chunks.groupBy("chunk_id").agg(F.max("all_text").alias("all_text"))
    d = e.join(one.select(F.col("chunk_id").alias("source_chunk_id"), "all_text"), "source_chunk_id", "left")
    flat = F.lower(F.regexp_replace("all_text", r"\s+", ""))
    words = F.filter(F.split(F.regexp_replace("name", r"[^\w가-힣]+", " "), r"\s+"), lambda w: F.length(w) >= 2)
    hit = F.exists(words, lambda w: flat.contains(F.lower(w))) | flat.contains(F.lower(F.regexp_replace("name", r"\s+", "")))
    return d.select("row_id", ((F.col("type") == "Note") | F.coalesce(hit, F.lit(False))).alias("valid"))


def quantity_in_text(quantity: Column, text: Column) -> Column:
    """A quantity occurs in a text in one of two spellings."""
    plain = F.regexp_replace(quantity.cast("string"), r"\.0$", "")
    flat = F.regexp_replace(text, r"[\s,]+", "")
    return flat.contains(quantity.cast("string")) | flat.contains(plain)


def stage_counts(stages: dict[str, DataFrame], by: str) -> DataFrame:
    """Rows of each stage by a key, one column a stage."""
    u = reduce(DataFrame.unionByName, [df.select(by).withColumn("stage", F.lit(k)) for k, df in stages.items()])
    return u.groupBy(by).pivot("stage", list(stages)).agg(F.count(F.lit(1))).na.fill(0)


def counts(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(k).alias("name"), "n") for k, df in tables.items()])


def top_names(df: DataFrame, col: str, k: int) -> DataFrame:
    """The k most frequent values, ties by value."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), col).limit(k)


def valid_directions(r: DataFrame) -> DataFrame:
    return r.withColumn("ok", F.coalesce(rules.allowed(F.col("type"), F.col("source_type"), F.col("target_type")), ~F.col("type").isin(*rules.DIRECTIONS)))


def proportional_sample(df: DataFrame, by: str, key: str, n: int) -> DataFrame:
    """About n rows, each group by its share, at least one: the smallest hashes."""
    sizes = df.groupBy(by).agg(F.count(F.lit(1)).alias("__n"))
    total = sizes.agg(F.sum("__n").alias("__t"))
    quota = sizes.crossJoin(F.broadcast(total)).select(by, F.greatest(F.lit(1), F.floor(F.col("__n") * n / F.col("__t"))).alias("__q"))  # total is one row
    w = Window.partitionBy(by).orderBy(F.md5(F.col(key).cast("string")), key)
    return df.withColumn("__r", F.row_number().over(w)).join(quota, by).filter("__r <= __q").drop("__r", "__q")


def plain_number(number: Column) -> Column:
    """One spelling of a number: no commas, no zeros behind a decimal point."""
    bare = F.regexp_replace(number, ",", "")
    return F.when(bare.contains("."), F.regexp_replace(bare, r"\.?0+$", "")).otherwise(bare)


def comparable_cell(cell: Column) -> Column:
    """A cell without blanks, commas, joints of heads, raised marks and trailing zeros."""
    t = F.regexp_replace(F.regexp_replace(cell, r"(?U)\s+|&nbsp;", ""), r"[_^,]", "")
    return F.regexp_replace(F.regexp_replace(t, r"(\d+\.\d*?)0+$", "$1"), r"\.$", "")


def kept_share(source: DataFrame, made: DataFrame, by: list[str], item: str, of: str, least: float) -> DataFrame:
    """(by, n, matched, share, passed): different items of a group on both sides over those of one side (``of`` is
    source or made); groups that lack a side are left out. Items are rows, so a group of any size is spread."""
    u = source.select(*by, item, F.lit(True).alias("s"), F.lit(False).alias("m")).unionByName(made.select(*by, item, F.lit(False).alias("s"), F.lit(True).alias("m")))
    g = u.filter(F.col(item).isNotNull() & (F.col(item) != "")).groupBy(*by, item).agg(F.bool_or("s").alias("s"), F.bool_or("m").alias("m"))
    g = g.groupBy(*by).agg(F.count_if("s").alias("ns"), F.count_if("m").alias("nm"), F.count_if(F.col("s") & F.col("m")).alias("matched")).filter("ns > 0 and nm > 0")
    n = F.col("ns" if of == "source" else "nm")
    share = F.round(F.col("matched") / n, 6)
    return g.select(*by, n.alias("n"), "matched", share.alias("share"), (share >= least).alias("passed"))


def severity(passed: DataFrame) -> DataFrame:
    """(checked, passed, rate, severity) of a check: PASS from 95 % of its groups on, WARN from 85 %, else FAIL."""
    d = passed.agg(F.count(F.lit(1)).alias("checked"), F.count_if("passed").alias("passed"))
    rate = F.when(F.col("checked") == 0, 0.0).otherwise(F.col("passed") / F.col("checked"))
    return d.withColumn("rate", F.round(rate, 6)).withColumn("severity", F.when(rate >= 0.95, "PASS").when(rate >= 0.85, "WARN").otherwise("FAIL"))
