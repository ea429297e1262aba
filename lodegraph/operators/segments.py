"""Document segmentation: markers with offsets, contents lookups, fallbacks, line re-flow, page geometry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from lodegraph.operators.ordering import carry_forward

# The marker grammar.
SECTION = r"<!-- SECTION: (\S+) \| (.+?) \| 부문:(.+?) \| 장:(.+?) -->"
CONTEXT = r"<!-- CONTEXT: (\S+) \| (.+?) \| 부문:(.+?) \| 장:(.+?) -->"
PAGE = r"<!-- PAGE (\d+) \| (.+?) -->"
GRAMMAR = {
    "SECTION": (SECTION, ("section_id", "title", "department", "chapter")),
    "CONTEXT": (CONTEXT, ("section_id", "title", "department", "chapter")),
    "PAGE": (PAGE, ("page", "context")),
}


def strip(text: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def markers(df: DataFrame, kind: str, text: str = "text") -> DataFrame:
    """A row for each marker of a kind: marker_no, start_pos, end_pos (characters from 0) and its fields.

    Offsets come from the lengths of the parts between the matches; no text is copied.
    """
    pattern, names = GRAMMAR[kind]
    d = df.filter(F.col(text).rlike(pattern)).withColumn("__m", F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).withColumn("__p", F.split(text, pattern, -1))
    ends = F.aggregate(
        F.arrays_zip(F.slice("__p", 1, F.size("__m")).alias("p"), F.col("__m").alias("m")),
        F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<s:int,e:int,m:string>>").alias("out")),
        lambda acc, x: F.struct((acc["at"] + F.length(x["p"]) + F.length(x["m"])).alias("at"), F.concat(acc["out"], F.array(F.struct((acc["at"] + F.length(x["p"])).alias("s"), (acc["at"] + F.length(x["p"]) + F.length(x["m"])).alias("e"), x["m"].alias("m")))).alias("out")),
        lambda acc: acc["out"],
    )
    keep = [c for c in df.columns if c != text]
    got = d.select(*keep, F.posexplode(ends).alias("__i", "__x"))
    fields = [F.regexp_extract("__x.m", pattern, i + 1).alias(n) for i, n in enumerate(names)]
    if kind == "PAGE":
        fields[0] = F.regexp_extract("__x.m", pattern, 1).cast("int").alias("page")
    return got.select(*keep, (F.col("__i") + 1).alias("marker_no"), F.col("__x.s").alias("start_pos"), F.col("__x.e").alias("end_pos"), *fields)


def sections_of(df: DataFrame, file: str = "file", text: str = "text", joined_gap: int = 10) -> DataFrame:
    """(file, group, section_ids, raw_text): text behind each group of SECTION markers; markers with at most
    ``joined_gap`` characters between them are one group.

    A text is cut at its markers once, where it lies; nothing is shuffled and no text is copied a marker.
    """
    d = df.filter(F.col(text).rlike(SECTION)).select(file, F.regexp_extract_all(text, F.lit(SECTION), F.lit(1)).alias("__id"), F.split(text, SECTION, -1).alias("__p"))
    n = F.size("__id")
    items = F.arrays_zip(F.col("__id").alias("id"), F.slice("__p", 1, n).alias("before"), F.slice("__p", 2, n).alias("body"))
    groups = F.array().cast("array<struct<ids:array<string>,body:string>>")
    one = lambda ids, body: F.array(F.struct(ids.alias("ids"), body.alias("body")))

    def step(acc: Column, x: Column) -> Column:
        last, k = F.try_element_at(acc, F.lit(-1)), F.size(acc)
        joined = (k > 0) & (F.length(strip(x["before"])) <= joined_gap)
        return F.when(joined, F.concat(F.slice(acc, 1, F.greatest(k - 1, F.lit(0))), one(F.concat(last["ids"], F.array(x["id"])), x["body"]))).otherwise(F.concat(acc, one(F.array(x["id"]), x["body"])))

    g = d.select(file, F.posexplode(F.aggregate(items, groups, step)).alias("__i", "__g"))
    return g.select(file, (F.col("__i") + 1).alias("group"), F.col("__g.ids").alias("section_ids"), strip(F.col("__g.body")).alias("raw_text"))


def source_ranges(df: DataFrame, file: str = "file", text: str = "text") -> DataFrame:
    """(base_id, file, marker_no, text): what stands behind each SECTION or CONTEXT marker up to the next one, by base
    id. The ranges of an id are rows, not one text, so an id of any size is spread."""
    mark = r"<!-- (?:SECTION|CONTEXT): (\S+) \| .+? -->"
    d = df.filter(F.col(text).rlike(mark)).select(file, F.regexp_extract_all(text, F.lit(mark), F.lit(1)).alias("__id"), F.split(text, mark, -1).alias("__p"))
    z = d.select(file, F.posexplode(F.arrays_zip(F.col("__id").alias("id"), F.slice("__p", 2, F.size("__id")).alias("body"))).alias("__i", "__z"))
    return z.select(base_id(F.col("__z.id")).alias("base_id"), file, (F.col("__i") + 1).alias("marker_no"), strip(F.col("__z.body")).alias("text"))


def spread_text(groups: DataFrame, titles: DataFrame) -> DataFrame:
    """Divide a group's text among its sections: (file, group, section_id, part).

    A section starts at the first line that begins with its id, else where the first 8 characters of its title
    stand, moved to the line's start. Text before the first start goes to that section; without any start all
    text goes to the last section. ``titles`` has (section_id, title).
    """
    s = groups.select("*", F.posexplode("section_ids").alias("ord", "section_id")).join(titles, "section_id", "left")
    head = F.expr("locate(concat('\n', section_id, ' '), concat('\n', raw_text))")
    at_title = F.expr("locate(left(title, 8), raw_text)")
    line = F.expr("at_title - coalesce(nullif(locate('\n', reverse(left(raw_text, at_title - 1))), 0) - 1, at_title - 1)")
    s = s.withColumn("head", head).withColumn("at_title", F.when(F.length("title") >= 2, at_title).otherwise(0))
    s = s.withColumn("start", F.when(F.col("head") > 0, F.col("head")).when(F.col("at_title") > 0, line))
    w = Window.partitionBy("file", "group")
    o = w.orderBy(F.col("start").asc_nulls_last(), "ord")
    s = s.withColumn("next", F.lead("start").over(o)).withColumn("first", F.min("start").over(w)).withColumn("n", F.count("start").over(w)).withColumn("last", F.max("ord").over(w))
    begin = F.when(F.col("start") == F.col("first"), F.lit(1)).otherwise(F.col("start"))
    part = F.when(F.col("n") == 0, F.when(F.col("ord") == F.col("last"), F.col("raw_text")).otherwise("")).when(F.col("start").isNull(), "").otherwise(F.expr("substring(raw_text, 1, length(raw_text))"))
    s = s.withColumn("begin", begin).withColumn("part", part)
    cutout = strip(F.expr("substring(raw_text, begin, coalesce(next, length(raw_text) + 1) - begin)"))
    return s.withColumn("part", F.when((F.col("n") > 0) & F.col("start").isNotNull(), cutout).otherwise(F.col("part"))).select("file", "group", "section_id", "part")


def toc_lines(toc: DataFrame) -> DataFrame:
    """A table of contents as text lines of one book a division: (book, line_no, line)."""
    t = toc.withColumn("lines", F.array(F.concat(F.lit("@"), "chapter"), F.concat(F.lit("#"), "section"), F.concat_ws("\t", "key", "id", "title", F.coalesce(F.col("page").cast("string"), F.lit("")))))
    t = t.withColumn("rank", F.row_number().over(Window.partitionBy("chapter").orderBy("section", "key")))
    return t.select(F.col("chapter").alias("book"), "rank", F.posexplode("lines").alias("i", "line")).select("book", (F.col("rank") * 3 + F.col("i")).alias("line_no"), "line")


def parse_toc_lines(lines: DataFrame) -> DataFrame:
    """(key, id, chapter, section, title, page): division and chapter lines are carried to the entries below them."""
    d = lines.withColumn("chapter", F.when(F.col("line").startswith("@"), F.substring("line", 2, 10_000))).withColumn("section", F.when(F.col("line").startswith("#"), F.substring("line", 2, 10_000)))
    d = carry_forward(d, ["book"], ["line_no"], ["chapter", "section"]).filter(~F.col("line").rlike("^[@#]"))
    p = F.split("line", "\t", -1)
    return d.select(p[0].alias("key"), p[1].alias("id"), "chapter", "section", p[2].alias("title"), F.nullif(p[3], F.lit("")).cast("int").alias("page"))


def base_id(section: Column) -> Column:
    return F.trim(F.substring_index(section, "#", 1))


def valid_section(section: Column) -> tuple[Column, Column]:
    """(is valid, base id or 'unknown')."""
    ok = base_id(section).rlike(r"^\d{1,2}-\d{1,2}(-\d{1,3})?$")
    return ok, F.when(ok, base_id(section)).otherwise("unknown")


def with_toc_key(df: DataFrame, toc: DataFrame) -> DataFrame:
    """``df`` (section_id, chapter) with the contents key of its base id and chapter; of several the last wins."""
    r = toc.groupBy(F.col("id").alias("__id"), F.col("chapter").alias("__ch")).agg(F.max("key").alias("__key"))
    return df.join(r, (base_id(F.col("section_id")) == F.col("__id")) & (F.col("chapter") == F.col("__ch")), "left").withColumn("toc_key", F.coalesce("__key", "section_id")).drop("__id", "__ch", "__key")


def title_fallback(toc: DataFrame, chunks: DataFrame) -> DataFrame:
    """(key, found_in): contents entries no chunk has, with the first chunk of their chapter that has a line
    beginning with their id. Ids are taken out of the texts first, so this is an equi-join."""
    miss = toc.select("key", "id", "chapter").join(chunks.select(F.col("section_id").alias("key")).distinct(), "key", "left_anti")
    ids = F.regexp_extract_all("text", F.lit(r"(?m)^(\d{1,2}-\d{1,2}(?:-\d{1,3})?)[ \t]+"), F.lit(1))
    hits = chunks.select("chapter", "chunk_id", F.explode(F.array_distinct(ids)).alias("id"))
    return miss.join(hits, ["id", "chapter"], "left").groupBy("key").agg(F.min("chunk_id").alias("found_in"))


def disambiguate(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """unique_id: the key for its first row, ``key#2``, ``key#3`` for the others by order."""
    n = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return df.withColumn("__n", n).withColumn("unique_id", F.when(F.col("__n") == 1, F.col(key)).otherwise(F.concat(key, F.lit("#"), F.col("__n")))).drop("__n")


def repair_chapter(section: Column, chapter: Column) -> Column:
    """Give back the tens digit that a two-digit chapter lost."""
    first = F.split(section, "-")[0].try_cast("int")
    return F.when((chapter >= 10) & (first == chapter % 10), F.concat(F.floor(chapter / 10).cast("int").cast("string"), section)).otherwise(section)


def join_syllables(name: Column) -> Column:
    """Single Hangul syllables with spaces between them become one word; anything else stays."""
    return F.when(name.rlike(r"^[가-힣](\s+[가-힣])*$"), F.regexp_replace(name, r"\s+", "")).otherwise(name)


def ends_sentence(line: Column) -> Column:
    return line.rlike(r"(다|요|함|음|임|것|[.!?:;])[.)\]]?[ \t]*$")


def reflow(text: Column, width: int = 80) -> Column:
    """Join a line to the one before unless that ends a sentence, is long, or the line starts a list or is blank."""
    starts = lambda x: x.rlike(r"^\s*([-*·•○※①-⑳]|\(?\d{1,3}[.)]|[가-힣][.)]|[<|#\[]|$)")

    def step(acc: Column, x: Column) -> Column:
        last = F.substring_index(acc, "\n", -1)
        apart = ends_sentence(last) | (F.length(last) >= width) | starts(x) | (F.trim(last) == "")
        return F.when(acc.isNull(), x).when(apart, F.concat(acc, F.lit("\n"), x)).otherwise(F.concat(acc, F.lit(" "), x))

    joined = F.aggregate(F.split(text, "\n"), F.lit(None).cast("string"), step)
    return F.regexp_replace(F.regexp_replace(joined, r"\n{3,}", "\n\n"), r" {2,}", " ")


def inject_markers(text: Column) -> Column:
    """A section comment before every line that starts with a three-level id."""
    return F.regexp_replace(text, r"(?m)^(\d{1,2}-\d{1,2}-\d{1,3})([ \t]+)(\S[^\n]*)$", "<!-- SECTION: $1 | $3 -->\n$1$2$3")


def footer_fields(text: Column) -> list[Column]:
    """Division, chapter and page of a footer line."""
    return [F.nullif(F.regexp_extract(text, p, 1), F.lit("")).alias(n) for n, p in (("department", r"(\S+부문)"), ("chapter", r"(제\s*\d+\s*장[^\d|]*)"), ("page", r"(\d+)\s*$"))]


def repair_boxes(df: DataFrame, page: str, order: str, height: float, least: float = 10.0, gap: float = 5.0) -> DataFrame:
    """Boxes lower than ``least`` grow to ``gap`` above the next one, or to the foot of the page."""
    w = Window.partitionBy(page).orderBy("y0", order)
    foot = F.lit(min(0.85 * height, height - 30.0))
    grown = F.round(F.greatest(F.coalesce(F.lead("y0").over(w) - gap, foot), F.col("y1")), 3)
    return df.withColumn("y1", F.when(F.col("y1") - F.col("y0") < least, grown).otherwise(F.col("y1")))


def text_regions(df: DataFrame, page: str, order: str, height: float, gap: float = 5.0) -> DataFrame:
    """(page, top, bottom): what lies between the boxes of a page, above the first and below the last."""
    w = Window.partitionBy(page).orderBy("y0", order).rowsBetween(Window.unboundedPreceding, -1)
    above = df.select(page, F.coalesce(F.max("y1").over(w), F.lit(0.0)).alias("top"), F.col("y0").alias("bottom"))
    below = df.groupBy(page).agg(F.max("y1").alias("top")).withColumn("bottom", F.lit(height))
    return above.unionByName(below).filter(F.col("bottom") - F.col("top") >= gap)
