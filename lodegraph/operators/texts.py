"""Text cleaning and packing: notes, conditions, references, years, bases, token counts, parts under a budget."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from lodegraph.operators.tables import split_rows

# The patterns of notes and circled numbers.
NOTE_BLOCK = r"(?s)\[주\]\s*\n(.*?)(?=\n\n(?!\s*[①-⑩])|\n(?=\d+-\d+)|\z)"
CIRCLED = "①②③④⑤⑥⑦⑧⑨⑩⑪⑫⑬⑭⑮"


# The patterns of a revision mark and of a basis.
REVISION = r"\('?(\d{2,4})(?:,\s*'?\d{2,4})*년\s*보완\)"
UNIT_BASIS = r"\(([^)]*당)\)"


def notes(text: Column) -> Column:
    """Items of the note blocks, without their circled numbers."""
    blocks = F.regexp_extract_all(text, F.lit(NOTE_BLOCK), F.lit(1))
    items = F.flatten(F.transform(blocks, lambda b: F.split(b, f"(?=[{CIRCLED}])")))
    clean = F.transform(items, lambda x: F.trim(F.regexp_replace(F.regexp_replace(x, r"^\s+|\s+$", ""), f"^[{CIRCLED}]\\s*", "")))
    return F.filter(clean, lambda x: x != "")


def without_notes(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(text, NOTE_BLOCK, ""), r"(?m)^\[주\]\s*$", ""), r"^\s+|\s+$", "")


def rates(text: Column) -> Column:
    """Surcharges: (condition, rate, type) where a clause names a case, a percentage and an action."""
    pattern = r"([^\n.]{2,60}?(?:경우|때|면))[^\n%]{0,60}?(\d+)%[^\n]{0,40}?(가산|감산|감하여|할증|더한다|늘려|증)"
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    kind = lambda x: F.when(F.regexp_extract(x, pattern, 3).contains("감"), "deduct").otherwise("add")
    return F.transform(hits, lambda x: F.struct(F.trim(F.regexp_extract(x, pattern, 1)).alias("condition"), F.concat(F.regexp_extract(x, pattern, 2), F.lit("%")).alias("rate"), kind(x).alias("type")))


# Fixed value: the pattern of a cross reference.
CROSS_REF = r"(?:제(\d+)장\s+)?(\d+-\d+(?:-\d+)?)\s*(?:항?\s*)?(?:참조|준용|적용|따른다)"


def cross_references(text: Column) -> Column:
    hits = F.regexp_extract_all(text, F.lit(CROSS_REF), F.lit(0))
    return F.transform(hits, lambda x: F.struct(F.regexp_extract(x, CROSS_REF, 2).alias("target_section_id"), F.regexp_extract(x, CROSS_REF, 1).alias("target_chapter")))


def revision_year(text: Column) -> Column:
    """First year of a revision mark; two digits below 50 are of this century. Blank if there is none."""
    y = F.regexp_extract(text, REVISION, 1)
    return F.when(F.length(y) == 2, F.concat(F.when(y.try_cast("int") < 50, "20").otherwise("19"), y)).otherwise(y)


def unit_basis(text: Column) -> Column:
    return F.regexp_extract(text, UNIT_BASIS, 1)


def clean_text(text: Column) -> Column:
    """Without comments and chapter title lines, at most one blank line in a row, trimmed."""
    t = F.regexp_replace(F.regexp_replace(text, r"(?s)<!--.*?-->", ""), r"(?m)^제\d+장\s+.+$", "")
    return F.regexp_replace(F.regexp_replace(t, r"\n{3,}", "\n\n"), r"^\s+|\s+$", "")


def drop_contained(own: Column, others: Column) -> Column:
    """Notes that, without white space, neither contain a note of ``others`` nor are contained in one."""
    bare = lambda x: F.regexp_replace(x, r"\s+", "")
    return F.filter(own, lambda n: ~F.exists(F.coalesce(others, F.array().cast("array<string>")), lambda t: (bare(t) != "") & (bare(n).contains(bare(t)) | bare(t).contains(bare(n)))))


def token_count(text: Column) -> Column:
    """Deterministic size: characters / 2, rounded up; 0 for null."""
    return F.coalesce(F.ceil(F.length(text) / 2), F.lit(0)).cast("int")


def chunk_tokens(text: Column, tables: Column, own_notes: Column) -> Column:
    """Size of a chunk: its text, the cells of its tables, its notes."""
    cells = lambda t: F.flatten(F.transform(F.coalesce(t["rows"], F.array()), lambda r: F.transform(F.map_values(r), lambda c: c["s"])))
    add = lambda acc, x: acc + token_count(x)
    of_tables = F.coalesce(F.aggregate(F.flatten(F.transform(tables, cells)), F.lit(0), add), F.lit(0))
    return token_count(text) + of_tables + F.coalesce(F.aggregate(own_notes, F.lit(0), add), F.lit(0))


def paragraph_parts(text: Column, budget: Column | int = 1500) -> Column:
    """Paragraphs packed greedily under the budget; texts of one paragraph by lines; larger ones stay whole."""
    paras = F.filter(F.split(text, r"\n\s*\n"), lambda x: F.trim(x) != "")
    units = F.when(F.size(paras) > 1, paras).otherwise(F.filter(F.split(text, "\n"), lambda x: F.trim(x) != ""))
    join = lambda p: F.when(F.size(paras) > 1, F.array_join(p, "\n\n")).otherwise(F.array_join(p, "\n"))
    return F.transform(split_rows(units, budget=budget), join)


def picked_percentiles(df: DataFrame, value: str, shares: list[float], by: list[str] = ()) -> DataFrame:
    """Percentiles by index ``int(n * share)`` of the sorted values, from a histogram of the values.

    Values are counted first (map-side combined), so the window runs over different values, not rows.
    """
    by = list(by)
    h = df.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(*by).orderBy(value)
    h = h.withColumn("upto", F.sum("n").over(w)).withColumn("total", F.sum("n").over(Window.partitionBy(*by)))
    pick = lambda q: F.min(F.when(F.col("upto") > F.floor(F.col("total") * q), F.col(value)))
    return h.groupBy(*by).agg(F.max("total").alias("n"), F.min(value).alias("least"), F.max(value).alias("most"), *[pick(q).alias(f"p{round(q * 100)}") for q in shares])


def word_count(text: Column) -> Column:
    return F.size(F.filter(F.split(F.coalesce(text, F.lit("")), r"[ \t\n\r\f\v]+"), lambda x: x != ""))
