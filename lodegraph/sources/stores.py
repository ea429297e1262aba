"""Reading marked documents and writing tables: scans, merges, numbered appends, positional updates, resume."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lodegraph.operators.ordering import global_row_number, latest


def read_marked_documents(spark: SparkSession, path: str, name_glob: str = "*.md") -> DataFrame:
    """(file, first_page, text): whole files; first_page is the number before a dash in the name, 0 if none."""
    raw = spark.read.option("pathGlobFilter", name_glob).text(path, wholetext=True)
    name = F.element_at(F.split(F.input_file_name(), "/"), -1)
    page = F.coalesce(F.regexp_extract(name, r"(\d+)-\d+", 1).try_cast("int") if hasattr(Column, "try_cast") else F.regexp_extract(name, r"(\d+)-\d+", 1).cast("int"), F.lit(0))
    return raw.select(name.alias("file"), page.alias("first_page"), F.col("value").alias("text"))


def read_toc(spark: SparkSession, path: str) -> DataFrame:
    """(key, id, chapter, section, title, page) from a JSON map of entries, bare or below ``section_map``."""
    entry = "struct<id:string,chapter:string,section:string,title:string,page:int>"
    raw = spark.read.text(path, wholetext=True)
    inner = F.coalesce(F.get_json_object("value", "$.section_map"), F.col("value"))
    return raw.select(F.explode(F.from_json(inner, f"map<string,{entry}>")).alias("key", "e")).select("key", "e.*")


def pages_of(df: DataFrame, spec: str, total: str) -> DataFrame:
    """Rows of ``df`` for each page (from 0) that a spec such as ``1,3,5-10``, ``20-``, ``-10`` or ``10`` names.

    A lone number means the first so many pages; pages out of range are left out, repeated ones come once.
    """
    item = F.trim(F.col("__item"))
    lone = ~F.col(spec).contains(",") & F.trim(F.col(spec)).rlike(r"^\d+$")
    lo = F.when(lone, F.lit(1)).when(item.rlike(r"^\d"), F.regexp_extract(item, r"^(\d+)", 1).cast("int")).otherwise(1)
    hi = F.when(lone | item.rlike(r"-\d+$"), F.regexp_extract(item, r"(\d+)$", 1).cast("int")).when(item.endswith("-"), F.col(total)).otherwise(lo)
    d = df.withColumn("__item", F.explode(F.split(spec, ",")))
    d = d.withColumn("__lo", F.greatest(lo, F.lit(1))).withColumn("__hi", F.least(hi, F.col(total))).filter("__lo <= __hi")
    return d.withColumn("page", F.explode(F.sequence(F.col("__lo") - 1, F.col("__hi") - 1))).drop("__item", "__lo", "__hi").distinct()


def section_marker(section_id: Column, title: Column, department: Column, chapter: Column) -> Column:
    return F.format_string("<!-- SECTION: %s | %s | 부문:%s | 장:%s -->", section_id, title, department, chapter)


def page_marker(page: Column, context: Column) -> Column:
    return F.format_string("<!-- PAGE %d | %s -->", page, context)


def upsert(target: DataFrame, updates: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Target rows without an update, and of the updates the first row of each key by ``order``."""
    new = latest(updates, keys, order)
    return target.join(new.select(*keys), keys, "left_anti").unionByName(new, allowMissingColumns=True)


def append_numbered(df: DataFrame, order: list[str], first: int = 1, name: str = "id") -> DataFrame:
    """Rows with surrogate numbers from ``first`` in the given order."""
    return global_row_number(df, order, "__n").withColumn(name, F.col("__n") + F.lit(first - 1)).drop("__n")


#: Tables whose vectors may be set by position.
UPDATABLE = ("graph_entities", "graph_chunks")


def offset_pages(df: DataFrame, order: list[str], size: int) -> DataFrame:
    """``df`` with page_no from 0: pages of ``size`` rows in a total order, numbered without one task seeing all."""
    return global_row_number(df, order, "__n").withColumn("page_no", F.floor((F.col("__n") - 1) / size)).drop("__n")


#: Rows of an array of a positional update, about.
UPDATE_ROWS = 1_000


def blocks_of(rows: int) -> int:
    """Arrays to send so many rows in, by hash of their key."""
    return max(1, -(-rows // UPDATE_ROWS))


def positional_update(df: DataFrame, table: str, key: str, column: str, ids: DataFrame) -> DataFrame:
    """``df`` with ``column`` replaced where ``ids`` (arrays ids and vals, by position) has a value for the key."""
    if table not in UPDATABLE:
        raise ValueError(f"{table} is not one of {UPDATABLE}")
    pairs = ids.select(F.explode(F.arrays_zip("ids", "vals")).alias("x")).select(F.col("x.ids").alias(key), F.col("x.vals").alias("__new"))
    return df.join(latest(pairs, [key], [F.col("__new").asc_nulls_last()]), key, "left").withColumn(column, F.coalesce("__new", F.col(column))).drop("__new")


def not_done(df: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Resume: rows whose key is not among those done."""
    return df.join(done.select(key).distinct(), key, "left_anti")


def property_row(core: dict[str, Column], props: Column) -> Column:
    """One properties map: the core fields that are not null, overridden by the row's own properties."""
    own = F.map_from_entries(F.filter(F.array(*[F.struct(F.lit(k).alias("key"), v.cast("string").alias("value")) for k, v in core.items()]), lambda e: e["value"].isNotNull()))
    props = F.coalesce(props, F.create_map().cast("map<string,string>"))
    kept = F.map_filter(own, lambda k, v: ~F.map_contains_key(props, k))
    return F.map_concat(kept, F.map_filter(props, lambda k, v: v.isNotNull()))


def write_staged(df: DataFrame, path: str, stats: dict[str, Column]) -> DataFrame:
    """Overwrite one stage's rows and, beside them, a one-row table of its metadata; returns the metadata."""
    df.write.mode("overwrite").parquet(f"{path}/rows")
    meta = df.sparkSession.read.parquet(f"{path}/rows").agg(*[c.alias(k) for k, c in stats.items()])
    meta.write.mode("overwrite").json(f"{path}/metadata")
    return meta


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True)


def rewrite_in_order(tables: list[tuple[DataFrame, str]]) -> None:
    """Replace tables one after another: list edges before the nodes they refer to."""
    for df, path in tables:
        df.write.mode("overwrite").parquet(path)
