"""Queries of this package and the SQL that checks them where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from lodegraph.llm import canonical, markup, neighbours, packing, records, split, tokens, truncation
from lodegraph.plans.session import load

NAME_FIELDS = ["name", "normalized_name", "unit"]
RECORD_FIELDS = ["type", "normalized_name", "spec"]


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    got = markup.label_blocks(load(spark, d, "graph_chunks"), render=False)
    fields = F.array_compact(F.array(F.when(F.col("text_blocks") > 0, F.lit("text")), F.when(F.col("table_blocks") > 0, F.lit("tables"))))
    return got.select("chunk_id", F.explode(fields).alias("field")).distinct()


def p1_clean(spark: SparkSession, d: str) -> DataFrame:
    """Clean text and tables of every chunk row; a row of a table is its (header, s, n) entries in order."""
    return markup.clean_chunks(load(spark, d, "graph_chunks"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return canonical.odd_values(load(spark, d, "entities"), "row_id", NAME_FIELDS)


def p2_forms(spark: SparkSession, d: str) -> DataFrame:
    """Visual form and comparison key of each text field of entities."""
    e = canonical.with_folded(canonical.with_visual(load(spark, d, "entities").select("row_id", *NAME_FIELDS), NAME_FIELDS), NAME_FIELDS)
    return e.select("row_id", *[c for f in NAME_FIELDS for c in (F.col(f"{f}_visual"), canonical.key_of(F.col(f"{f}_folded")).alias(f"{f}_key"))])


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    pieces = split.split_pieces(load(spark, d, "graph_chunks").select("chunk_id", "text"))
    return pieces.filter("n_pieces > 1 and piece_no = 2").select("chunk_id").distinct()


def p3_pieces(spark: SparkSession, d: str) -> DataFrame:
    chunks = load(spark, d, "graph_chunks").select("chunk_id", "section_id", "created_at", "text")
    return split.split_pieces(chunks).filter("n_pieces > 1")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return records.copies(load(spark, d, "entities"), "row_id", RECORD_FIELDS, ["spec"])


def p4_records(spark: SparkSession, d: str) -> DataFrame:
    """One row for each record, with the number of its copies."""
    return records.record_groups(load(spark, d, "entities"), "row_id", RECORD_FIELDS, ["spec"])[1].select("keep_row_id", "n_copies")


def _vectors(spark: SparkSession, d: str) -> DataFrame:
    parts = [load(spark, d, t).select(F.lit(t).alias("table_name"), F.col(c).alias("id"), "embedding") for t, c in (("graph_entities", "id"), ("graph_chunks", "chunk_id"))]
    return parts[0].unionByName(parts[1])


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return neighbours.similar(_vectors(spark, d), k=0, floor=0.9).filter("cosine >= 0.9").select("table_name", "id_a", "id_b")


def p7_neighbours(spark: SparkSession, d: str) -> DataFrame:
    """The 5 most similar others of every row whose number is divisible by 100, against all rows."""
    v = _vectors(spark, d)
    asked = v.filter(F.regexp_extract("id", r"(\d+)$", 1).cast("long") % 100 == 0).select("table_name", "id").distinct()
    got = neighbours.nearest(v, 5, asked, probes=None, m=16, ef=64, search_ef=160, cell=8_000)
    return got.withColumn("cosine", F.round("cosine", 5))


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    return tokens.encode_ids(load(spark, d, "documents"))


def p9_containers(spark: SparkSession, d: str) -> DataFrame:
    sizes = tokens.encode_sizes(load(spark, d, "documents"), "doc_id", "text")
    return packing.pack(sizes)


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return truncation.cut_texts(load(spark, d, "documents")).filter("is_cut").select("doc_id")


def p10_sources(spark: SparkSession, d: str) -> DataFrame:
    """How often each source cuts its texts; blank texts are left out of the share."""
    got = truncation.cut_texts(load(spark, d, "documents"))
    n = got.groupBy("source").agg(F.count(F.lit(1)).alias("texts"), F.count_if("is_cut").alias("cut_texts"))
    return n.withColumn("cut_share", F.col("cut_texts") / F.col("texts"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (p1_found, p1_clean, p2_found, p2_forms, p3_found, p3_pieces, p4_found, p4_records, p7_found, p7_neighbours, p8_ids, p9_containers, p10_found, p10_sources)
}



# Written out here and not taken from the operator: what the test tables hold beside plain characters.
_LIKE = ("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧνο" "ЅІЈАВЕКМНОРСТХаеорсухі", "ABEZHIKMNOPTYXvo" "SIJABEKMHOPCTXaeopcyxi")
_WIDE = ("！＂＃＄％＆＇（）＊＋，－．／０１２３４５６７８９：；＜＝＞？＠ＡＢＣＤＥＦＧＨＩＪＫＬＭＮＯＰＱＲＳＴＵＶＷＸＹＺ［＼］＾＿｀ａｂｃｄｅｆｇｈｉｊｋｌｍｎｏｐｑｒｓｔｕｖｗｘｙｚ｛｜｝～", "!\"#$%&'()*+,-./0123456789:;<=>?@ABCDEFGHIJKLMNOPQRSTUVWXYZ[\\]^_`abcdefghijklmnopqrstuvwxyz{|}~")
_DASH_AND_SPACE = ("‐‑‒–−" "\u00a0\u2007\u2008\u2009\u200a\u202f\u205f\u3000", "-----" "        ")
_SEVERAL = {"ﬁ": "fi", "ﬂ": "fl", "Ⅱ": "II", "㎝": "cm", "㎜": "mm", "㎞": "km", "㎏": "kg", "㎡": "m²", "㎥": "m³", "㎠": "cm²", "㎾": "kW", "㎖": "ml"}


def _visual(c: str) -> str:
    """The visual form in SQL for what the test tables hold: widths, look-alikes, ligatures, unit signs, spaces."""
    a, b = ("".join(x[i] for x in (_LIKE, _WIDE, _DASH_AND_SPACE)).replace("'", "''") for i in (0, 1))
    t = f"translate(regexp_replace({c}, '[\\x{{AD}}\\x{{200B}}-\\x{{200F}}\\x{{2060}}\\x{{FEFF}}]', '', 'g'), '{a}', '{b}')"
    for x, y in _SEVERAL.items():
        t = f"replace({t}, '{x}', '{y}')"
    return f"nfc_normalize({t})"


def _canon(c: str) -> str:
    return f"replace(lower({_visual(c)}), 'ß', 'ss')"


# signs of markup by language, read from the statement of the problem and held against each line, header, cell and note
_HTML = ("<[A-Za-z/!][^ ]", "-->", "&(amp;)?(nbsp|lt|gt|amp|quot|middot|times|deg|#[0-9]+);?")
_MARKDOWN = (r"\*\*", "__", "~~", "`", "^#{2,6} ", "^# [^0-9]", r"\]\(", "^> ", "^={3,}$", r"^\|.*\|$")
_WIKI = ("''", r"\[\[", r"\]\]", r"\{\{", r"\}\}", r"^\{\|", r"^\|\}", r"^\|-", r"^\| .* \|\| ", "^! .* !! ", "^=+ ?[^=]+ ?=+$")
_LATEX = (r"\\[A-Za-z]{2,}", r"\\[%()\[\]&#$_{}]", r"\$\$", r"\$\\[a-z]", r"\$[A-Za-z0-9]([^$]*[^ $])?\$([^0-9]|$)")
_MARKUP = "|".join(_HTML + _MARKDOWN + _WIKI + _LATEX).replace("'", "''")


# points between digits and minus signs before a number become marks before all other signs go
_POINTS = lambda t: f"regexp_replace(regexp_replace({t}, '([0-9])\\.([0-9])', '\\1§\\2', 'g'), '([0-9])\\.([0-9])', '\\1§\\2', 'g')"
_PLAIN = lambda c: f"regexp_replace({_POINTS(_canon(f'coalesce({c}, chr(32))'))}, '[^\\p{{L}}\\p{{N}}\\p{{M}}§]', '', 'g')"
_LIST = f"""array_to_string(list_sort(list_filter(list_transform(regexp_split_to_array(regexp_replace({_POINTS(_canon("coalesce(spec, '')"))}, '\\s*[=:]\\s*', '=', 'g'), '[;,|/\\n\\t]+'), lambda x: regexp_replace(regexp_replace(regexp_replace(x, '=-([0-9])', '=¶\\1', 'g'), '^\\s*-([0-9])', '¶\\1'), '[^\\p{{L}}\\p{{N}}\\p{{M}}=§¶]', '', 'g')), lambda x: regexp_matches(x, '[\\p{{L}}\\p{{N}}]'))), ';')"""
_KEYS = f"k AS (SELECT row_id, {_PLAIN('type')} AS t, {_PLAIN('normalized_name')} AS n, {_LIST} AS s FROM entities)"

SQL: dict[str, str] = {
    # an independent reading of the size rule
    "p3_found": "SELECT DISTINCT chunk_id FROM graph_chunks WHERE ceil(length(text) / 2.0) > 2000",
    # canonical keys written independently in SQL
    "p4_found": f"WITH {_KEYS}, m AS (SELECT row_id, min(row_id) OVER (PARTITION BY t, n, s) AS keep FROM k) SELECT DISTINCT keep AS keep_row_id, row_id AS copy_row_id FROM m WHERE keep <> row_id",
    "p4_records": f"WITH {_KEYS} SELECT min(row_id) AS keep_row_id, count(*) AS n_copies FROM k GROUP BY t, n, s",
    "p1_found": f"""WITH l AS (SELECT chunk_id, 'text' AS field, unnest(string_split(text, chr(10))) AS x FROM graph_chunks WHERE text IS NOT NULL
        UNION ALL SELECT chunk_id, 'tables', unnest(flatten(list_transform(tables, lambda t: list_concat(coalesce(t.headers, []), coalesce(t.notes_in_table, []), flatten(list_transform(t.rows, lambda r: list_concat(map_keys(r), list_transform(map_values(r), lambda c: c.s)))))))) FROM graph_chunks)
        SELECT DISTINCT chunk_id, field FROM l WHERE regexp_matches(x, '(?m){_MARKUP}')""",
    "p2_found": " UNION ".join(f"SELECT row_id, '{f}' AS field FROM entities WHERE {_visual(f)} <> {f}" for f in NAME_FIELDS),
    "p2_forms": "SELECT row_id, " + ", ".join(f"{_visual(f)} AS {f}_visual, trim(regexp_replace({_canon(f)}, '\\s+', ' ', 'g')) AS {f}_key" for f in NAME_FIELDS) + " FROM entities",
    # all pairs, which the small tables allow
    "p7_found": """WITH v AS (SELECT DISTINCT 'graph_entities' AS table_name, id, CAST(embedding AS DOUBLE[]) AS e FROM graph_entities WHERE len(embedding) = 64 UNION SELECT 'graph_chunks', chunk_id, CAST(embedding AS DOUBLE[]) FROM graph_chunks WHERE len(embedding) = 64),
        ok AS (SELECT * FROM v WHERE len(list_filter(e, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND list_sum(list_transform(e, lambda x: x * x)) > 0)
        SELECT DISTINCT a.table_name, a.id AS id_a, b.id AS id_b FROM ok a JOIN ok b ON a.table_name = b.table_name AND a.id < b.id WHERE list_cosine_similarity(a.e, b.e) >= 0.9""",
    # every asked id against all rows
    "p7_neighbours": """WITH v AS (SELECT DISTINCT 'graph_entities' AS table_name, id, CAST(embedding AS DOUBLE[]) AS e FROM graph_entities WHERE len(embedding) = 64 UNION SELECT 'graph_chunks', chunk_id, CAST(embedding AS DOUBLE[]) FROM graph_chunks WHERE len(embedding) = 64),
        ok AS (SELECT * FROM v WHERE len(list_filter(e, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND list_sum(list_transform(e, lambda x: x * x)) > 0),
        p AS (SELECT a.table_name, a.id, b.id AS other, max(list_cosine_similarity(a.e, b.e)) AS c FROM ok a JOIN ok b ON a.table_name = b.table_name AND a.id <> b.id WHERE TRY_CAST(regexp_extract(a.id, '([0-9]+)$', 1) AS BIGINT) % 100 = 0 GROUP BY 1, 2, 3),
        r AS (SELECT *, row_number() OVER (PARTITION BY table_name, id ORDER BY round(c, 6) DESC, other) AS rank FROM p) SELECT table_name, id, CAST(rank AS INT) AS rank, other, round(c, 5) AS cosine FROM r WHERE rank <= 5""",
}
