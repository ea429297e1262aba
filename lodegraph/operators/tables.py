"""HTML tables and parsed tables: regions, grids, headers, notes, numbers, typing, splitting, merging, rendering."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lodegraph.plans.session import ship_here

REGION = r"(?is)<table[^>]*>.*?</table>"

# Keyword lists of table types; a caller may pass others.
TYPE_A = ("수량", "단위", "인", "대", "수 량", "단 위")
TYPE_A_ROWS = ("인부", "철공", "용접공", "배관공", "기사", "기능공", "기능사", "조공", "내장공", "도장공", "미장공", "목공", "방수공", "보통인부", "특별인부", "잡역부")
TYPE_B = ("억", "m²", "규모", "직접노무비")
TYPE_C = ("구분", "내용", "구 분", "내 용")


def regions(text: Column) -> Column:
    """All table regions of a text, shortest matches; nested tables are not balanced."""
    return F.regexp_extract_all(text, F.lit(REGION), F.lit(0))


def without_tables(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, REGION, ""))


def cell_text(cell: Column) -> Column:
    """Text of a cell's markup: ^ and _ for raised and lowered text, tags dropped, common entities decoded."""
    t = F.regexp_replace(F.regexp_replace(cell, r"(?i)<sup[^>]*>", "^"), r"(?i)<sub[^>]*>", "_")
    t = F.regexp_replace(F.regexp_replace(t, r"(?i)<br\s*/?>", " "), r"<[^>]*>", "")
    for a, b in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        t = F.replace(t, F.lit(a), F.lit(b))
    return clean_cell(t)


def clean_cell(t: Column) -> Column:
    return F.trim(F.regexp_replace(t, r"[\s ]+", " "))


class _Grid(HTMLParser):
    """Rows of (text, rowspan, colspan); an unclosed cell ends where the next one begins."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.rows: list[list[list]] = []
        self.open = False

    def handle_starttag(self, tag, attrs):
        if tag == "tr":
            self.rows.append([])
            self.open = False
        elif tag in ("td", "th"):
            if not self.rows:
                self.rows.append([])
            a = dict(attrs)
            span = [int(x) if (x := (a.get(k) or "").strip()).isdigit() and 0 < int(x) < 1000 else 1 for k in ("rowspan", "colspan")]
            self.rows[-1].append(["", *span])
            self.open = True
        elif self.open:
            self.rows[-1][-1][0] += {"sup": "^", "sub": "_", "br": " "}.get(tag, "")

    def handle_endtag(self, tag):
        if tag in ("td", "th", "tr", "table"):
            self.open = False

    def handle_data(self, data):
        if self.open:
            self.rows[-1][-1][0] += data


def expand_grid(html: str) -> list[list[str]]:
    """Cells by row and column; a spanning cell fills every place it covers, places without a cell are ''.

    >>> expand_grid('<table><tr><td rowspan=2>a<td colspan=2>b<tr><td>c<td>d</table>')
    [['a', 'b', 'b'], ['a', 'c', 'd']]
    """
    p = _Grid()
    p.feed(html)
    p.close()
    placed: dict[tuple[int, int], str] = {}
    for r, row in enumerate(p.rows):
        c = 0
        for text, down, across in row:
            while (r, c) in placed:
                c += 1
            text = " ".join(text.replace("\xa0", " ").split())
            for i in range(r, min(r + down, len(p.rows))):
                for j in range(c, c + across):
                    placed.setdefault((i, j), text)
            c += across
    width = max((j for _, j in placed), default=-1) + 1
    return [[placed.get((i, j), "") for j in range(width)] for i in range(len(p.rows))]


def grids(df: DataFrame, key: str, text: str = "text") -> DataFrame:
    """(key, table_no, grid array<array<string>>): every table of a text, expanded, in Arrow batches."""
    ship_here()
    kind = dict(df.dtypes)[key]
    rows = df.select(key, F.posexplode(regions(F.col(text))).alias("i", "html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [expand_grid(h) for h in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([i + 1 for i in b.column(1).to_pylist()], pa.int32()), pa.array(got, pa.list_(pa.list_(pa.string())))], [key, "table_no", "grid"])

    return rows.mapInArrow(run, f"`{key}` {kind}, table_no int, grid array<array<string>>")


def header_like(row: Column) -> Column:
    """More than half of the cells are text that is no number."""
    return F.size(F.filter(row, lambda x: (F.length(x) > 0) & ~x.rlike(r"^[\d,.\-\s]*$"))) > F.size(row) * 0.5


def header_depth(grid: Column) -> Column:
    """1 to 3 header rows: more than one only if the first row repeats a value."""
    n, row = F.size(grid), lambda i: F.get(grid, F.lit(i))
    dup = F.size(F.array_distinct(row(0))) < F.size(row(0))
    three = dup & (n >= 4) & header_like(row(1)) & header_like(row(2)) & ~header_like(row(3))
    return F.when(three, 3).when(dup & (n >= 3) & header_like(row(1)), 2).otherwise(1)


def composite_headers(grid: Column, depth: Column) -> Column:
    """Distinct non-blank header parts of each column joined by ``_``."""
    width = F.size(F.get(grid, F.lit(0)))
    col = lambda c: F.transform(F.slice(grid, 1, depth), lambda r: F.trim(F.coalesce(F.get(r, c), F.lit(""))))
    return F.when(width > 0, F.transform(F.sequence(F.lit(0), width - 1), lambda c: F.array_join(F.array_distinct(F.filter(col(c), lambda x: x != "")), "_"))).otherwise(F.array().cast("array<string>"))


def is_note_row(row: Column) -> Column:
    """Note marks, circled numbers, a leading dash, remarks; a lone cell that is long, a code line or a section title."""
    # fixed values: the marks of notes, code lines and section titles
    text = F.trim(F.array_join(row, " "))
    cells = F.filter(row, lambda x: F.trim(x) != "")
    one = F.get(cells, F.lit(0))
    lone = (F.size(cells) == 1) & ((F.length(one) > 50) | one.rlike(r"^\(\d{4}\)\s*.+") | one.rlike(r"^\d+-\d+(?:-\d+)?\s+.{4,}"))
    return (text != "") & (text.rlike(r"\[주\]|〔주〕|【주】|^[①-⑮㉮-㉷]|^비\s*고") | text.startswith("- ") | text.startswith("– ") | lone)


def number_of(cell: Column) -> Column:
    """The number in a cell without its commas; decimals with a trailing zero stay text (null here)."""
    t = F.regexp_replace(F.trim(cell), ",", "")
    return F.when(t.rlike(r"^-?\d+$") | (t.rlike(r"^-?\d*\.\d+$") & ~t.rlike(r"0$")), t.try_cast("double"))


def cell_quantity(cell: Column) -> Column:
    """Quantity in a cell: ``(n)`` is n, commas go, blank, dash and text are null."""
    return F.regexp_replace(F.regexp_replace(F.trim(cell), r"^\((.*)\)$", "$1"), ",", "").try_cast("double")


def _count(keywords: tuple[str, ...], text: Column) -> Column:
    return sum((F.when(text.contains(k), 1).otherwise(0) for k in keywords), F.lit(0))


def table_type(headers: Column, first_cells: Column, a=TYPE_A, a_rows=TYPE_A_ROWS, b=TYPE_B, c=TYPE_C) -> Column:
    """A: two quantity or unit words in the header, or two rows that begin with a trade; B: a scale word; C: two
    headers, one a division word; else D."""
    text = F.lower(F.array_join(headers, " "))
    trade = "|".join(a_rows)
    rows = F.size(F.filter(first_cells, lambda x: F.replace(x, F.lit(" "), F.lit("")).rlike(trade)))
    is_a = (_count(a, text) >= 2) | ((F.size(first_cells) >= 2) & (rows >= 2))
    return F.when(is_a, "A").when(_count(b, text) > 0, "B").when((F.size(headers) == 2) & (_count(c, text) > 0), "C").otherwise("D")


def long_cells(df: DataFrame, keys: list[str], tables: str = "tables") -> DataFrame:
    """(keys, table_id, row_no, header, s, n): the long view of parsed tables."""
    t = df.select(*keys, F.explode(tables).alias("t")).select(*keys, F.col("t.table_id").alias("table_id"), F.posexplode("t.rows").alias("r", "row"))
    return t.select(*keys, "table_id", (F.col("r") + 1).alias("row_no"), F.explode("row").alias("header", "c")).select(*keys, "table_id", "row_no", "header", "c.s", "c.n")


def split_rows(rows: Column, size: Column | None = None, budget: Column | int = 1500, header_size: Column | int = 0) -> Column:
    """Greedy packing of an array of texts: arrays of consecutive elements whose sizes with the header's fit the
    budget; an element over the budget stands alone."""
    size_of = lambda x: F.ceil(F.length(x) / 2)
    head = F.lit(header_size) if isinstance(header_size, int) else header_size
    empty = F.array().cast("array<string>")
    start = F.struct(F.array().cast("array<array<string>>").alias("out"), empty.alias("cur"), F.lit(0).cast("bigint").alias("n"))

    def step(acc: Column, x: Column) -> Column:
        fits = (F.size(acc["cur"]) == 0) | (acc["n"] + size_of(x) + head <= budget)
        return F.when(fits, F.struct(acc["out"].alias("out"), F.concat(acc["cur"], F.array(x)).alias("cur"), (acc["n"] + size_of(x)).alias("n"))).otherwise(F.struct(F.concat(acc["out"], F.array(acc["cur"])).alias("out"), F.array(x).alias("cur"), size_of(x).alias("n")))

    return F.aggregate(rows, start, step, lambda acc: F.when(F.size(acc["cur"]) > 0, F.concat(acc["out"], F.array(acc["cur"]))).otherwise(acc["out"]))


def row_text(row: Column) -> Column:
    return F.array_join(F.transform(F.map_values(row), lambda c: F.coalesce(c["s"], F.lit(""))), " | ")


def to_markdown(table: Column, note_chars: int = 300) -> Column:
    """Header, rule and data lines of a table, then its first note."""
    head = F.array_join(table["headers"], " | ")
    rule = F.array_join(F.transform(table["headers"], lambda _: F.lit("---")), " | ")
    body = F.transform(table["rows"], lambda r: F.array_join(F.transform(table["headers"], lambda h: F.coalesce(F.element_at(r, h)["s"], F.lit(""))), " | "))
    note = F.when(F.size(table["notes_in_table"]) > 0, F.array(F.substring(F.get(table["notes_in_table"], F.lit(0)), 1, note_chars))).otherwise(F.array().cast("array<string>"))
    return F.array_join(F.concat(F.array(head, rule), body, note), "\n")


def flat_text(tables: Column) -> Column:
    """All header and cell texts of a chunk's tables in one string."""
    one = lambda t: F.concat(F.coalesce(t["headers"], F.array().cast("array<string>")), F.flatten(F.transform(F.coalesce(t["rows"], F.array()), lambda r: F.transform(F.map_values(r), lambda c: F.coalesce(c["s"], F.lit(""))))))
    return F.array_join(F.flatten(F.transform(tables, one)), " ")


def union_same_headers(df: DataFrame, scope: str, tables: str = "tables") -> DataFrame:
    """(scope, headers, n_tables, n_rows): tables of a scope with equal headers are one table."""
    t = df.select(scope, F.explode(tables).alias("t"))
    return t.groupBy(scope, F.array_join("t.headers", "|").alias("headers")).agg(F.count(F.lit(1)).alias("n_tables"), F.sum(F.size("t.rows")).alias("n_rows"))


def signature(table: Column) -> Column:
    """SHA-256 of headers and all rows, cells by header order of the map's sorted keys."""
    rows = F.transform(table["rows"], lambda r: F.array_join(F.array_sort(F.transform(F.map_entries(r), lambda e: F.concat(e["key"], F.lit("="), F.coalesce(e["value"]["s"], F.lit(""))))), "\u0002"))
    return F.sha2(F.concat(F.array_join(table["headers"], "\u0001"), F.lit("\u0003"), F.array_join(rows, "\u0003")), 256)


def is_matrix(headers: Column, least: int = 4) -> Column:
    """At least ``least`` headers of which half are numbers."""
    return (F.size(headers) >= least) & (F.size(F.filter(headers, lambda h: h.rlike(r"^\s*[\d,.]+\s*$"))) >= F.size(headers) * 0.5)


def has_ranges(rows: Column, first: int = 10) -> Column:
    """Two or more cells such as ``a~b`` or ``a-b`` in the first rows."""
    cells = F.flatten(F.transform(F.slice(rows, 1, first), lambda r: F.transform(F.map_values(r), lambda c: c["s"])))
    return F.size(F.filter(cells, lambda s: s.rlike(r"^\s*[\d.,]+\s*[~-]\s*[\d.,]+\s*$"))) >= 2


def material_name(name: Column) -> Column:
    """Spaces out; a standard's code behind the name goes into parentheses."""
    t = F.regexp_replace(name, r"\s+", "")
    return F.regexp_replace(t, r"^(.+?)((?:KSD?|SCH|STD)[-\w]*)$", "$1($2)")


def piecewise(df: DataFrame, x: str, knots: list[tuple[float, float]], out: str = "factor") -> DataFrame:
    """Linear interpolation between knots, constant beyond the ends; knots are a parameter, so this stays codegen."""
    k = sorted(knots)
    c = F.when(F.col(x) <= k[0][0], F.lit(k[0][1]))
    for (x0, y0), (x1, y1) in zip(k, k[1:]):
        c = c.when(F.col(x) <= x1, F.lit(y0) + (F.col(x) - x0) * ((y1 - y0) / (x1 - x0)))
    return df.withColumn(out, F.when(F.col(x).isNotNull(), c.otherwise(F.lit(k[-1][1]))))


def unpivot_wide(df: DataFrame, ids: list[str], measures: dict[str, tuple[str, ...]], dims: tuple[str, ...], value: str, digits: int = 3) -> DataFrame:
    """Wide to long: each measure column becomes rows with its dimension values; only values above 0 stay."""
    parts = F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(dims, vals)], F.round(F.col(c), digits).alias(value)) for c, vals in measures.items()])
    return df.select(*ids, F.explode(parts).alias("x")).select(*ids, "x.*").filter(F.col(value) > 0)


def zip_unpivot(df: DataFrame, keys: list[str], left: str, right: str, digits: int = 3) -> DataFrame:
    """(keys, row_no, side, header, quantity): two tables (arrays of rows) side by side by row number, in long form;
    quantities above 0 stay. The longer table's rows stand alone."""
    z = df.select(*keys, F.posexplode(F.arrays_zip(F.col(left).alias("left"), F.col(right).alias("right"))).alias("__i", "__z"))
    sides = F.array(*[F.struct(F.lit(s).alias("side"), F.col(f"__z.{s}").alias("row")) for s in ("left", "right")])
    x = z.select(*keys, (F.col("__i") + 1).alias("row_no"), F.explode(sides).alias("__s")).select(*keys, "row_no", "__s.side", F.explode("__s.row").alias("header", "__c"))
    return x.select(*keys, "row_no", "side", "header", F.round("__c.n", digits).alias("quantity")).filter("quantity > 0")


def simple_table(html: Column) -> Column:
    """struct(headers, rows): heads and cells as they come, spans not expanded; a row of one spanning cell is skipped."""
    text = lambda x: F.trim(F.regexp_replace(F.regexp_replace(x, r"<[^>]*>", " "), r"\s+", " "))
    behind = lambda x: F.slice(x, 2, F.greatest(F.size(x), F.lit(1)))
    rows = behind(F.split(F.regexp_replace(html, r"(?is)</table>", ""), r"(?i)<tr[^>]*>"))
    lone = lambda r: r.rlike(r"(?i)<td[^>]*colspan") & (F.size(F.split(r, r"(?i)<td[^>]*>")) == 2)
    cells = F.transform(F.filter(rows, lambda r: ~lone(r)), lambda r: F.transform(behind(F.split(r, r"(?i)<td[^>]*>")), text))
    heads = F.transform(behind(F.split(html, r"(?i)<th[^e>]*>")), lambda x: text(F.regexp_replace(x, r"(?is)</th>.*", "")))
    return F.struct(heads.alias("headers"), F.filter(cells, lambda r: F.size(r) > 0).alias("rows"))


def repair_targets(ids: DataFrame, chunks: DataFrame) -> DataFrame:
    """(id, chunk_id, n_tables): of the chunks whose section id begins with an id the one with the fewest tables, ties
    by chunk id. Every beginning of a section id is looked up, so this is an equi-join."""
    n = F.coalesce(F.size("tables"), F.lit(0))
    one = chunks.filter("section_id <> ''").groupBy("section_id").agg(F.min(F.struct(n.alias("n_tables"), "chunk_id")).alias("o"))
    heads = one.select(F.explode(F.transform(F.sequence(F.lit(1), F.length("section_id")), lambda i: F.substring("section_id", F.lit(1), i))).alias("id"), "o")
    return heads.groupBy("id").agg(F.min("o").alias("o")).join(ids, "id", "left_semi").select("id", "o.chunk_id", "o.n_tables")
