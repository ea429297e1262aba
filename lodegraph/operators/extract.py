"""Entities and facts out of parsed tables: header roles, row entities, matrix facts, carried names, targets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from lodegraph.operators import rules
from lodegraph.operators.tables import cell_quantity


def header_role(header: Column) -> Column:
    h = F.lower(F.regexp_replace(header, r"\s+", ""))
    role = rules.first_match(h, rules.HEADER_ROLES, "other")
    return F.when((role == "unit") & h.rlike("|".join(rules.NOT_UNIT)), "other").otherwise(role)


def entity_name(name: Column) -> Column:
    """Single spaces between Hangul go, a number joins its unit, other white space is squeezed."""
    t = F.trim(F.regexp_replace(name, r"(?U)\s+", " "))
    t = F.regexp_replace(t, r"(?<=[가-힣]) (?=[가-힣])", "")
    return F.regexp_replace(t, r"(\d) (mm|cm|m|kg|t|kW)(?![A-Za-z])", "$1$2")


def header_leaf(header: Column) -> Column:
    """Last part of a composite header; blank if any part is a total."""
    return F.when(F.lower(header).rlike("|".join(rules.TOTALS)), "").otherwise(F.element_at(F.split(header, "_"), -1))


def table_cells(chunks: DataFrame) -> DataFrame:
    """(chunk_id, table_id, row_no, col_no, header, role, s): cells in the order of the table's headers."""
    t = chunks.select("chunk_id", F.explode("tables").alias("t"))
    r = t.select("chunk_id", F.col("t.table_id").alias("table_id"), F.col("t.headers").alias("h"), F.posexplode("t.rows").alias("r", "row"))
    c = r.select("chunk_id", "table_id", (F.col("r") + 1).alias("row_no"), "row", F.posexplode("h").alias("c", "header"))
    return c.select("chunk_id", "table_id", "row_no", (F.col("c") + 1).alias("col_no"), "header", header_role(F.col("header")).alias("role"), F.element_at("row", F.col("header"))["s"].alias("s"))


def row_entities(chunks: DataFrame) -> DataFrame:
    """(chunk_id, table_id, row_no, name, spec, unit, quantity): one entity a row, by header roles; a blank name
    is that of the row above (ditto)."""
    c = table_cells(chunks)
    pick = lambda role: F.min_by(F.when(F.trim("s") != "", F.col("s")), F.when(F.col("role") == role, F.col("col_no")))
    r = c.groupBy("chunk_id", "table_id", "row_no").agg(*[pick(x).alias(x) for x in ("name", "spec", "unit")], cell_quantity(pick("quantity")).alias("quantity"))
    w = Window.partitionBy("chunk_id", "table_id").orderBy("row_no").rowsBetween(Window.unboundedPreceding, 0)
    return r.withColumn("name", F.last("name", ignorenulls=True).over(w)).filter("name is not null")


def matrix_facts(chunks: DataFrame) -> DataFrame:
    """(chunk_id, table_id, label, header, quantity): every number beside a row's label, without totals and zeros."""
    c = table_cells(chunks)
    label = c.filter("col_no = 1").select("chunk_id", "table_id", "row_no", F.col("s").alias("label"))
    facts = c.filter("col_no > 1").withColumn("quantity", cell_quantity(F.col("s"))).filter("quantity is not null and quantity <> 0")
    facts = facts.filter(header_leaf(F.col("header")) != "")
    return facts.join(label, ["chunk_id", "table_id", "row_no"]).filter("trim(label) <> ''").select("chunk_id", "table_id", "label", "header", "quantity")


def table_note(table: Column, most: int = 500) -> Column:
    """A scale table as one note: cells by bar, rows by semicolon."""
    return F.substring(F.array_join(F.transform(table["rows"], lambda r: F.array_join(F.transform(F.map_values(r), lambda c: F.coalesce(c["s"], F.lit(""))), " | ")), "; "), 1, most)


def type_of_name(name: Column) -> Column:
    return F.when(name.rlike("|".join(rules.HEADER_ROLES["labor"])), "Labor").when(name.rlike("|".join(rules.HEADER_ROLES["equipment"])), "Equipment").otherwise("Material")


def sub_title(text: Column) -> Column:
    return F.nullif(F.trim(F.regexp_extract(text, r"(?m)^\s*(\d{1,2}\.\s+\S[^\n]{0,60})$", 1)), F.lit(""))


def model_targets(chunks: DataFrame, entities: DataFrame, least_chars: int = 50) -> DataFrame:
    """(chunk_id, reason) of chunks worth a model's reading; the first reason that holds wins."""
    found = entities.filter("source_method = 'table_rule'").groupBy(F.col("source_chunk_id").alias("chunk_id")).agg(F.count(F.lit(1)).alias("n"))
    c = chunks.join(found, "chunk_id", "left")
    n, chars, tables = F.coalesce("n", F.lit(0)), F.coalesce(F.length(F.trim("text")), F.lit(0)), F.coalesce(F.size("tables"), F.lit(0))
    reason = F.when((tables == 0) & (chars >= least_chars), "text_only").when((tables > 0) & (n == 0), "tables_without_entities").when(chars >= 1000, "long_text").when((n > 0) & (n < tables), "few_entities")
    return c.select("chunk_id", reason.alias("reason")).filter("reason is not null")


def prompt(chunk: DataFrame) -> DataFrame:
    """(chunk_id, prompt): place, text and tables of a chunk for a model; the model itself is a plug-in."""
    from lodegraph.operators.tables import to_markdown

    head = F.concat_ws("\n", F.concat(F.lit("[section] "), "section_id"), F.concat(F.lit("[title] "), "title"), F.concat(F.lit("[department] "), "department"))
    md = F.array_join(F.transform(F.coalesce("tables", F.array()), to_markdown), "\n\n")
    return chunk.select("chunk_id", F.concat_ws("\n\n", head, F.nullif(F.trim("text"), F.lit("")), F.nullif(md, F.lit("")), F.nullif(F.array_join("notes", "\n"), F.lit(""))).alias("prompt"))


# Sections whose numeric column heads are pipe schedules, and title words that say the same.
SCHEDULE_SECTIONS = ("13-2-3", "13-1-1", "13-1-2", "13-2-1")
SCHEDULE_TITLES = ("강관용접", "배관설치", "관만곡", "강관절단")
# Trades in compound heads, and those that make the first row of a matrix its meta row.
COMPOUND_JOBS = ("용접공", "인부", "용접봉", "배관공", "철근공", "비계공", "기사", "기능사", "기능공", "기술자", "전공")
META_JOBS = ("용접공", "인부", "배관공", "용접봉", "기사", "기능사")


def column_label(header: Column, section: Column, title: Column) -> Column:
    """``SCH n`` for a numeric head where it is a schedule, else the head itself."""
    known = section.isin(*SCHEDULE_SECTIONS) | F.coalesce(F.replace(title, F.lit(" "), F.lit("")).rlike("|".join(SCHEDULE_TITLES)), F.lit(False))
    return F.when(F.trim(header).rlike(r"^\d+$") & known, F.concat(F.lit("SCH "), header)).otherwise(header)


def _compound(table: Column) -> Column:
    return F.size(F.filter(F.slice(table["headers"], 2, F.greatest(F.size(table["headers"]), F.lit(1))), lambda h: h.contains("_") & h.rlike("|".join(COMPOUND_JOBS))))


def is_matrix_table(table: Column) -> Column:
    """Two compound heads with a trade, or three numeric heads above trades in the first row or numbers in two of the
    next four; at least three heads and a row."""
    heads, rows = F.slice(table["headers"], 2, F.greatest(F.size(table["headers"]), F.lit(1))), table["rows"]
    value = lambda r, h: F.trim(F.coalesce(F.try_element_at(r, h)["s"], F.lit("")))
    first = F.array_join(F.transform(F.map_values(F.get(rows, F.lit(0))), lambda c: F.coalesce(c["s"], F.lit(""))), " ")
    filled = F.size(F.filter(F.slice(rows, 2, 4), lambda r: F.exists(heads, lambda h: value(r, h).rlike(r"^\d+\.?\d*$"))))
    numeric = F.size(F.filter(heads, lambda h: F.trim(h).rlike(r"^\d+$"))) >= 3
    return F.coalesce((F.size(table["headers"]) >= 3) & (F.size(rows) > 0) & ((_compound(table) >= 2) | numeric & (first.rlike("|".join(META_JOBS)) | (filled >= 2))), F.lit(False))


def matrix_kind(table: Column) -> Column:
    """D2 for tables with a compound head, else D1."""
    return F.when(_compound(table) > 0, "D2").otherwise("D1")
