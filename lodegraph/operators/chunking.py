"""Sections to chunks: greedy packing of paragraphs and tables under size budgets, all as array expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lodegraph.operators.ordering import global_row_number
from lodegraph.operators.texts import paragraph_parts, token_count

SOFT, HARD, LEAST_TEXT = 1500, 2000, 300


def pack_ranges(sizes: Column, budget: Column | int) -> Column:
    """array<struct<from int, n int>>: consecutive elements whose sizes fit the budget; a larger one stands alone."""
    budget = F.lit(budget) if isinstance(budget, int) else budget
    start = F.struct(F.array().cast("array<struct<from:int,n:int>>").alias("out"), F.lit(0).alias("at"), F.lit(0).alias("n"), F.lit(0).alias("sum"))

    def step(acc: Column, x: Column) -> Column:
        fits = (acc["n"] == 0) | (acc["sum"] + x <= budget)
        more = F.struct(acc["out"].alias("out"), acc["at"].alias("at"), (acc["n"] + 1).alias("n"), (acc["sum"] + x).alias("sum"))
        new = F.struct(F.concat(acc["out"], F.array(F.struct(acc["at"].alias("from"), acc["n"].alias("n")))).alias("out"), (acc["at"] + acc["n"]).alias("at"), F.lit(1).alias("n"), x.alias("sum"))
        return F.when(fits, more).otherwise(new)

    done = lambda acc: F.when(acc["n"] > 0, F.concat(acc["out"], F.array(F.struct(acc["at"].alias("from"), acc["n"].alias("n"))))).otherwise(acc["out"])
    return F.aggregate(sizes, start, step, done)


def row_size(row: Column) -> Column:
    return F.aggregate(F.map_values(row), F.lit(0), lambda a, c: a + token_count(c["s"]))


def table_size(table: Column) -> Column:
    return F.coalesce(F.aggregate(table["rows"], F.lit(0), lambda a, r: a + row_size(r)), F.lit(0))


def split_table(table: Column, budget: int) -> Column:
    """A table as pieces of rows, the header charged to each; a piece of a split table has its number in its id."""
    head = token_count(F.array_join(table["headers"], " "))
    cuts = pack_ranges(F.transform(table["rows"], row_size), F.greatest(F.lit(budget) - head, F.lit(1)))
    piece = lambda c, i: table.withField("rows", F.slice(table["rows"], c["from"] + 1, c["n"])).withField("table_id", F.concat(table["table_id"], F.lit("-"), (i + 1).cast("string")))
    return F.when((table_size(table) + head <= budget) | (F.size(table["rows"]) <= 1), F.array(table)).otherwise(F.transform(cuts, piece))


def table_groups(tables: Column, budget: int) -> Column:
    """Tables, large ones in pieces, packed greedily: array of arrays of tables."""
    pieces = F.flatten(F.transform(tables, lambda t: split_table(t, budget)))
    cuts = pack_ranges(F.transform(pieces, table_size), budget)
    return F.transform(cuts, lambda c: F.slice(pieces, c["from"] + 1, c["n"]))


PART = "struct<text:string,tables:{0},notes:array<string>>"


def _parts_size(text: Column, tables: Column, notes: Column) -> Column:
    add = lambda xs, f: F.coalesce(F.aggregate(xs, F.lit(0), lambda a, x: a + f(x)), F.lit(0))
    return token_count(text) + add(tables, table_size) + add(notes, token_count)


def _with_notes(df: DataFrame) -> DataFrame:
    return df if "notes" in df.columns else df.withColumn("notes", F.array().cast("array<string>"))


def _numbered(d: DataFrame, keep: list[str], parts: Column, no: str, n: str) -> DataFrame:
    d = d.withColumn("__p", parts)
    d = d.select(*keep, F.size("__p").alias(n), F.posexplode("__p").alias("__i", "__x"))
    return d.select(*keep, n, (F.col("__i") + 1).alias(no), "__x.text", "__x.tables", "__x.notes")


def section_parts(sections: DataFrame, soft: int = SOFT) -> DataFrame:
    """Sections (text, tables, and notes if there are any) as parts: part_no, n_parts, text, tables, notes.

    A section within the budget is one part. Of a larger one the notes stay with the first part, and
    - several tables are packed into groups, large ones in pieces; the first group goes with the text if that fits
      the budget, else with the first piece of the text cut at half the budget, whose other pieces follow;
    - a single table over the budget is cut into pieces behind the pieces of the text; a smaller one stays with the
      first piece of a text cut to what it leaves, ``LEAST_TEXT`` at least;
    - a text alone is cut by paragraphs.
    No text, note and table row is lost.
    """
    d = _with_notes(sections)
    kind = d.schema["tables"].dataType.simpleString()
    none_t, none_n = F.array().cast(kind), F.array().cast("array<string>")
    t, tb, notes = F.col("text"), F.coalesce(F.col("tables"), none_t), F.coalesce(F.col("notes"), none_n)
    one = F.get(tb, F.lit(0))
    d = d.withColumns({"__over": _parts_size(t, tb, notes) > soft, "__t": F.coalesce(table_size(one), F.lit(0)), "__n": F.size(tb)})
    large = F.col("__over") & (F.col("__n") == 1) & (F.col("__t") > soft)
    budget = F.when(F.col("__n") > 1, F.lit(soft // 2)).when((F.col("__n") == 1) & ~large, F.greatest(F.lit(soft) - F.col("__t"), F.lit(LEAST_TEXT))).otherwise(F.lit(soft))
    whole = ~F.col("__over") | (F.col("__n") > 1) & (token_count(t) <= soft)
    texts = F.when(F.coalesce(F.trim(t), F.lit("")) == "", none_n).when(whole, F.array(t)).otherwise(paragraph_parts(t, budget))
    groups = F.when(large, F.transform(split_table(one, soft), lambda x: F.array(x))).when(F.col("__over") & (F.col("__n") > 1), table_groups(tb, soft)).otherwise(F.array(tb))
    # the first piece of the text leads: with the notes, and with the first group of tables unless one large table is cut
    d = d.withColumns({"__lead": F.when(large, 0).otherwise(1), "__texts": texts, "__groups": groups})
    part = lambda text, tabs, ns: F.struct(text.cast("string").alias("text"), tabs.alias("tables"), ns.alias("notes"))
    behind = lambda xs, n: F.slice(xs, n + 1, F.greatest(F.size(xs), F.lit(1)))
    first = part(F.coalesce(F.get("__texts", F.lit(0)), F.when(F.col("__over"), "").otherwise(t)), F.when(F.col("__lead") == 1, F.coalesce(F.get("__groups", F.lit(0)), none_t)).otherwise(none_t), notes)
    led = F.when((F.col("__lead") == 1) | (F.size("__texts") > 0) | (F.size(notes) > 0), F.array(first)).otherwise(F.array().cast(f"array<{PART.format(kind)}>"))
    rest = F.concat(F.transform(behind(F.col("__texts"), F.lit(1)), lambda p: part(p, none_t, none_n)), F.transform(behind(F.col("__groups"), F.col("__lead")), lambda g: part(F.lit(""), g, none_n)))
    return _numbered(d, [c for c in sections.columns if c not in ("text", "tables", "notes")], F.concat(led, rest), "part_no", "n_parts")


def hard_parts(parts: DataFrame, soft: int = SOFT, hard: int = HARD) -> DataFrame:
    """``parts`` with those over ``hard`` cut again: sub_no, n_subs.

    Text and tables are parted: the text is cut to ``hard - 100`` (the soft budget if there are tables), each
    table is a piece of its own, one over ``hard - 100`` in pieces of rows. Notes go with the first piece. What
    cannot be cut (one paragraph, one row) stays as it is.
    """
    d = _with_notes(parts)
    kind = d.schema["tables"].dataType.simpleString()
    t, tb, notes = F.col("text"), F.coalesce(F.col("tables"), F.array().cast(kind)), F.coalesce(F.col("notes"), F.array().cast("array<string>"))
    part = lambda text, tabs, ns: F.struct(text.cast("string").alias("text"), tabs.alias("tables"), ns.alias("notes"))
    budget = F.when(F.size(tb) > 0, F.lit(min(hard - 100, soft))).otherwise(F.lit(hard - 100))
    texts = F.when(F.coalesce(F.trim(t), F.lit("")) == "", F.array().cast("array<string>")).otherwise(paragraph_parts(t, budget))
    none_t, none_n = F.array().cast(kind), F.array().cast("array<string>")
    tables = F.flatten(F.transform(tb, lambda x: F.transform(split_table(x, hard - 100), lambda y: part(F.lit(""), F.array(y), none_n))))
    some = F.concat(F.transform(texts, lambda p: part(p, none_t, none_n)), tables)
    led = F.transform(some, lambda x, i: x.withField("notes", F.when(i == 0, notes).otherwise(none_n)))
    whole = F.array(part(t, tb, notes))
    subs = F.when((_parts_size(t, tb, notes) <= hard) | (F.size(led) <= 1), whole).otherwise(led)
    return _numbered(d, [c for c in parts.columns if c not in ("text", "tables", "notes")], subs, "sub_no", "n_subs")


def number_chunks(parts: DataFrame, order: list[str], with_content: bool = True) -> DataFrame:
    """chunk_id ``C-0001`` by section in order, with -A, -B, … (then numbers) for the parts of a section and -a, -b,
    … for the pieces of a part (``hard_parts``).

    ``order`` is a total order of sections. Parts with neither text nor tables are left out.
    """
    if with_content:
        parts = parts.filter((F.coalesce(F.trim("text"), F.lit("")) != "") | (F.coalesce(F.size("tables"), F.lit(0)) > 0))
    ids = global_row_number(parts.select(*order).distinct(), order, "__n")
    letter = F.when(F.col("part_no") <= 26, F.char(F.lit(64) + F.col("part_no"))).otherwise(F.col("part_no").cast("string"))
    suffix = F.when(F.col("n_parts") > 1, F.concat(F.lit("-"), letter)).otherwise("")
    on = [F.col(f"p.{c}").eqNullSafe(F.col(f"i.{c}")) for c in order]
    cond = on[0]
    for c in on[1:]:
        cond = cond & c
    if "sub_no" in parts.columns:
        small = F.when(F.col("sub_no") <= 26, F.char(F.lit(96) + F.col("sub_no"))).otherwise(F.col("sub_no").cast("string"))
        suffix = F.concat(suffix, F.when(F.col("n_subs") > 1, F.concat(F.lit("-"), small)).otherwise(""))
    d = parts.alias("p").join(ids.alias("i"), cond).select("p.*", "i.__n")
    return d.withColumn("chunk_id", F.concat(F.format_string("C-%04d", F.col("__n")), suffix)).drop("__n")
