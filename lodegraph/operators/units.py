"""Quantities in common units.

A unit string is segmented by dynamic programming over tries of numbers, prefixes, roots and exponents; the
best-scoring decomposition wins, where exact spelling scores above folded case and the prior of the field's
dimensions decides what is left. A decomposition must cover the whole string. Strings are parsed once for
each distinct value of a batch.

Defined results: null, blank and unparsable units have no dimension; a rate such as kg/m has none either; a
missing unit is looked for in the row's property texts, right after the row's own number.
"""

from __future__ import annotations

import math
import re
import unicodedata
from dataclasses import dataclass, field
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from lodegraph.plans.session import ship_here

# SI prefixes in use, by symbol and by name.
PREFIX_SYMBOLS = {"k": 1e3, "M": 1e6, "G": 1e9, "h": 1e2, "d": 1e-1, "c": 1e-2, "m": 1e-3, "µ": 1e-6, "μ": 1e-6, "u": 1e-6}
PREFIX_NAMES = {"kilo": 1e3, "mega": 1e6, "giga": 1e9, "hecto": 1e2, "deci": 1e-1, "centi": 1e-2, "milli": 1e-3, "micro": 1e-6, "킬로": 1e3, "메가": 1e6, "기가": 1e9, "헥토": 1e2, "데시": 1e-1, "센티": 1e-2, "밀리": 1e-3, "마이크로": 1e-6}
# Roots as (dimension, size in m, m², m³, kg, h, kW, pieces, persons, takes a prefix symbol, takes a prefix name).
ROOTS = {
    "m": ("length", 1.0, True, False), "meter": ("length", 1.0, False, True), "metre": ("length", 1.0, False, True), "meters": ("length", 1.0, False, True), "metres": ("length", 1.0, False, True), "미터": ("length", 1.0, False, True), "메터": ("length", 1.0, False, True),
    "in": ("length", 0.0254, False, False), "inch": ("length", 0.0254, False, False), "inches": ("length", 0.0254, False, False), "인치": ("length", 0.0254, False, False), "ft": ("length", 0.3048, False, False), "foot": ("length", 0.3048, False, False), "feet": ("length", 0.3048, False, False), "피트": ("length", 0.3048, False, False), "yd": ("length", 0.9144, False, False), "yard": ("length", 0.9144, False, False), "야드": ("length", 0.9144, False, False), "mile": ("length", 1609.344, False, False),
    "ha": ("area", 1e4, False, False), "hectare": ("area", 1e4, False, False), "헥타르": ("area", 1e4, False, False), "a": ("area", 100.0, False, False), "아르": ("area", 100.0, False, False), "평": ("area", 400 / 121, False, False),
    "l": ("volume", 1e-3, True, False), "L": ("volume", 1e-3, True, False), "ℓ": ("volume", 1e-3, True, False), "liter": ("volume", 1e-3, False, True), "litre": ("volume", 1e-3, False, True), "liters": ("volume", 1e-3, False, True), "litres": ("volume", 1e-3, False, True), "리터": ("volume", 1e-3, False, True), "cc": ("volume", 1e-6, False, False), "루베": ("volume", 1.0, False, False), "헤베": ("area", 1.0, False, False),
    "g": ("mass", 1e-3, True, False), "gram": ("mass", 1e-3, False, True), "grams": ("mass", 1e-3, False, True), "gramme": ("mass", 1e-3, False, True), "그램": ("mass", 1e-3, False, True), "그람": ("mass", 1e-3, False, True), "t": ("mass", 1e3, False, False), "ton": ("mass", 1e3, False, False), "tons": ("mass", 1e3, False, False), "tonne": ("mass", 1e3, False, False), "tonnes": ("mass", 1e3, False, False), "톤": ("mass", 1e3, False, False), "lb": ("mass", 0.45359237, False, False), "파운드": ("mass", 0.45359237, False, False),
    "s": ("time", 1 / 3600, True, False), "sec": ("time", 1 / 3600, False, False), "secs": ("time", 1 / 3600, False, False), "second": ("time", 1 / 3600, False, True), "seconds": ("time", 1 / 3600, False, True), "초": ("time", 1 / 3600, False, True), "min": ("time", 1 / 60, False, False), "mins": ("time", 1 / 60, False, False), "minute": ("time", 1 / 60, False, False), "minutes": ("time", 1 / 60, False, False), "분": ("time", 1 / 60, False, False), "h": ("time", 1.0, False, False), "hr": ("time", 1.0, False, False), "hrs": ("time", 1.0, False, False), "hour": ("time", 1.0, False, False), "hours": ("time", 1.0, False, False), "시간": ("time", 1.0, False, False),
    "W": ("power", 1e-3, True, False), "watt": ("power", 1e-3, False, True), "watts": ("power", 1e-3, False, True), "와트": ("power", 1e-3, False, True), "hp": ("power", 0.745699872, False, False), "ps": ("power", 0.73549875, False, False), "마력": ("power", 0.73549875, False, False),
    "개": ("count", 1.0, False, False), "ea": ("count", 1.0, False, False), "each": ("count", 1.0, False, False), "pc": ("count", 1.0, False, False), "pcs": ("count", 1.0, False, False), "piece": ("count", 1.0, False, False), "pieces": ("count", 1.0, False, False), "dozen": ("count", 12.0, False, False), "doz": ("count", 12.0, False, False), "다스": ("count", 12.0, False, False), "타스": ("count", 12.0, False, False),
    "인": ("labour", 1.0, False, False), "명": ("labour", 1.0, False, False), "사람": ("labour", 1.0, False, False), "person": ("labour", 1.0, False, False), "persons": ("labour", 1.0, False, False), "people": ("labour", 1.0, False, False), "man": ("labour", 1.0, False, False), "men": ("labour", 1.0, False, False), "worker": ("labour", 1.0, False, False), "workers": ("labour", 1.0, False, False),
}
# Powers, before and after the root; number words; marks of a basis.
POWERS_BEFORE = {"sq": 2, "sq.": 2, "square": 2, "제곱": 2, "평방": 2, "cu": 3, "cu.": 3, "cubic": 3, "세제곱": 3, "입방": 3}
POWERS_AFTER = {"2": 2, "3": 3, "^2": 2, "^3": 3, "**2": 2, "**3": 3}
NUMBER_WORDS = {"십": 10.0, "백": 100.0, "천": 1e3, "만": 1e4}
BASIS_BEFORE = ("per", "매", "/", "각")
BASIS_AFTER = ("당", "마다", "기준")
LOOKALIKE = dict(zip("асеорухіјѕһАВСЕНІЈКМОРЅТХУΑΒΕΖΗΙΚΜΝΟΡΤΥΧονρχ", "aceopyxijshABCEHIJKMOPSTXYABEZHIKMNOPTYXovpx"))

#: Log priors of the dimensions by field; they only order decompositions that are spelled equally well.
FIELD_PRIORS = {
    "unit": {"length": -1.0, "area": -1.4, "volume": -1.2, "mass": -1.2, "time": -1.6, "power": -2.0, "count": -1.2, "labour": -1.2},
    "per_unit": {"length": -0.9, "area": -1.1, "volume": -1.1, "mass": -1.2, "time": -3.0, "power": -4.0, "count": -1.2, "labour": -4.0},
}
#: How usual a prefix symbol is with a root; others are possible, at a price.
USUAL = {("k", "m"), ("c", "m"), ("m", "m"), ("d", "m"), ("µ", "m"), ("k", "g"), ("m", "g"), ("k", "W"), ("M", "W"), ("G", "W"), ("m", "L"), ("m", "l"), ("k", "L"), ("k", "l"), ("d", "L")}


@dataclass
class Trie:
    """Characters to nodes; a node holds the entries that end there."""

    kids: dict[str, "Trie"] = field(default_factory=dict)
    ends: list[tuple] = field(default_factory=list)

    def add(self, word: str, entry: tuple) -> None:
        node = self
        for ch in word:
            node = node.kids.setdefault(ch, Trie())
        node.ends.append(entry)

    def matches(self, text: str, at: int):
        node = self
        for i in range(at, len(text)):
            node = node.kids.get(text[i])
            if node is None:
                return
            for entry in node.ends:
                yield i + 1, entry


def _tries() -> dict[str, Trie]:
    out = {k: Trie() for k in ("prefix", "root", "before", "after", "number")}
    # every word goes in folded; the entry keeps its own spelling, against which the text is judged
    for s, x in PREFIX_SYMBOLS.items():
        out["prefix"].add(s.lower(), (s, x, "symbol"))
    for s, x in PREFIX_NAMES.items():
        out["prefix"].add(s, (s, x, "name"))
    for s, (dim, size, sym, name) in ROOTS.items():
        out["root"].add(s.lower(), (s, dim, size, sym, name))
    for s, n in POWERS_BEFORE.items():
        out["before"].add(s, (s, n))
    for s, n in POWERS_AFTER.items():
        out["after"].add(s, (s, n))
    for s, x in NUMBER_WORDS.items():
        out["number"].add(s, (s, x))
    return out


_TRIES = _tries()
_NUMBER = re.compile(r"\d{1,3}(?:,\d{3})+(?:\.\d+)?|\d+(?:\.\d+)?")


def plain(text: str) -> str:
    """Compatibility-composed, without invisible characters, look-alikes mapped, spaces squeezed."""
    if not text.isascii():
        # superscripts become digits here, which is what an exponent is
        text = "".join(LOOKALIKE.get(c, c) for c in unicodedata.normalize("NFKC", text))
        text = "".join(" " if unicodedata.category(c)[0] == "Z" else c for c in text if unicodedata.category(c) not in ("Cf", "Cc") or c in "\t\n\r")
        text = unicodedata.normalize("NFC", text)
    return re.sub(r"\s+", " ", text).strip()


def segment(text: str, priors: dict[str, float]) -> tuple[str, float] | None:
    """(dimension, size) of the best decomposition that covers ``text``, or None.

    Chart over (position, stage): 0 start or number, 1 power before, 2 prefix, 3 root, 4 power after.
    """
    low, n = text.lower(), len(text)
    if len(low) != n:
        return None
    # a cell maps what is known so far (dimension, size, power, prefix, prefix kind) to its best score
    chart: list[list[dict]] = [[{} for _ in range(5)] for _ in range(n + 1)]

    def put(i: int, stage: int, state: tuple, score: float) -> None:
        cell = chart[i][stage]
        if cell.get(state, -math.inf) < score:
            cell[state] = score

    spelled = lambda i, j, own: 0.0 if text[i:j] == own else -0.5 * sum(a != b for a, b in zip(text[i:j], own))
    put(0, 0, (None, 1.0, 1, None, None, 1.0), 0.0)
    for i in range(n):
        for stage in range(5):
            for (dim, mult, power, pre, kind, prefix), score in list(chart[i][stage].items()):
                if low[i] == " " or (stage == 0 and low[i] in "×x*" and (i == 0 or mult != 1.0)):
                    if stage != 2 or kind == "name":
                        put(i + 1, stage, (dim, mult, power, pre, kind, prefix), score - 0.01)
                if stage == 0:
                    if m := _NUMBER.match(low, i):
                        x = float(m[0].replace(",", ""))
                        if x > 0 and (i == 0 or not low[i - 1].isdigit()):
                            put(m.end(), 0, (dim, mult * x, power, pre, kind, prefix), score - 0.1)
                    for j, (_, x) in _TRIES["number"].matches(low, i):
                        put(j, 0, (dim, mult * x, power, pre, kind, prefix), score - 0.3)
                    for j, (own, p) in _TRIES["before"].matches(low, i):
                        put(j, 1, (dim, mult, p, pre, kind, prefix), score - 0.2)
                if stage <= 1:
                    for j, (own, x, k) in _TRIES["prefix"].matches(low, i):
                        put(j, 2, (dim, mult, power, own, k, x), score - 0.3 + spelled(i, j, own))
                if stage <= 2:
                    for j, (own, d, size, sym, name) in _TRIES["root"].matches(low, i):
                        if stage == 2 and not (sym if kind == "symbol" else name):
                            continue
                        cost = 0.0 if kind != "symbol" or (pre, own) in USUAL else -2.0
                        if power > 1 and d != "length":
                            continue
                        total = (prefix * size) ** power
                        put(j, 3, ({1: d, 2: "area", 3: "volume"}[power] if d == "length" else d, mult * total, power, own, None, prefix * size), score - 0.1 + cost + spelled(i, j, own))
                if stage == 3 and dim == "length":
                    for j, (_, p) in _TRIES["after"].matches(low, i):
                        if power == 1:
                            put(j, 4, ({2: "area", 3: "volume"}[p], mult / prefix * prefix**p, p, pre, None, prefix), score - 0.1)
    best = None
    for stage in (3, 4):
        for (dim, size, *_), score in chart[n][stage].items():
            score += 0.2 * priors.get(dim, -6.0)
            if best is None or score > best[0]:
                best = score, dim, size
    return best and best[1:]


def bare_basis(text: str) -> tuple[str, bool]:
    """The unit in a basis such as ``per 10 m``, ``m당`` or ``/kg``, and whether a mark of a basis was there."""
    t, marked = text.strip(), False
    if m := re.match(r"^\(([^()]*)\)$", t):
        t = m[1].strip()
    t = re.sub(r"^[^:：/]{1,8}[:：]\s*", "", t)
    for w in BASIS_BEFORE:
        if t.lower().startswith(w) and (not w.isalpha() or not w.isascii() or not t[len(w) : len(w) + 1].isalpha()):
            t, marked = t[len(w) :].strip(), True
            break
    for w in BASIS_AFTER:
        if t.endswith(w):
            t, marked = t[: -len(w)].strip(), True
            break
    return t, marked


@lru_cache(maxsize=100_000)
def parse_unit(text: str, field_name: str = "unit", basis: bool = False, need_mark: bool = False) -> tuple[str, float] | None:
    t = plain(text)
    if basis:
        t, marked = bare_basis(t)
        if need_mark and not marked:
            return None
    return segment(t, FIELD_PRIORS.get(field_name, {})) if t and len(t) <= 64 else None


def unit_in_text(text: str, quantity: float | None) -> str | None:
    """The text right after the row's own number; a frequency such as ``/ 1회`` behind it is left out."""
    t = plain(text)
    for m in _NUMBER.finditer(t):
        if quantity is not None and math.isclose(float(m[0].replace(",", "")), abs(quantity), rel_tol=1e-9):
            rest = re.sub(r"\s*/\s*\d*\s*회$", "", t[m.end() :].strip())
            if (p := re.match(r"^\(([^()]*)\)", rest)) or (p := re.match(r"^([^()]+)", rest)):
                if unit := re.sub(r"\s*/\s*\d*\s*회$", "", p[1]).strip(" ,;"):
                    return unit
    return None


SEP = "\u0001"
#: Rows a table of common units may have at most.
MOST_DIMENSIONS = 10_000


def units_udf(field_name: str, basis: bool):
    """(own string, property texts if it is blank, quantity) -> struct(dimension, factor to the SI-like base)."""

    @F.pandas_udf("dim string, factor double")
    def f(own: pd.Series, texts: pd.Series, quantity: pd.Series) -> pd.DataFrame:
        codes, values = pd.factorize(own, use_na_sentinel=True)
        known = [parse_unit(v, field_name, basis) if v.strip() else None for v in values]
        out = [known[c] if c >= 0 else None for c in codes]
        for i, (t, q) in enumerate(zip(texts, quantity)):
            if t:
                for part in t.split(SEP):
                    unit = part if basis else unit_in_text(part, q)
                    if unit and (got := parse_unit(unit, field_name, basis, basis)):
                        out[i] = got
                        break
        return pd.DataFrame({"dim": [x and x[0] for x in out], "factor": [x and x[1] for x in out]}, columns=["dim", "factor"])

    return f


def _texts(own: str, props: str) -> Column:
    blank = F.coalesce(F.trim(F.col(own)), F.lit("")) == ""
    return F.when(blank & F.col(props).isNotNull(), F.array_join(F.map_values(props), SEP))


def common_targets(common_units: DataFrame) -> dict[str, tuple[str, float]]:
    """dimension -> (common unit, its size). The table has one row a dimension.

    Units have a handful of dimensions; a table of more than MOST_DIMENSIONS rows is no table of common units and
    is refused, so no row of it is ever left out.
    """
    out = {}
    rows = common_units.select("dimension", "common_unit").distinct().limit(MOST_DIMENSIONS + 1).collect()
    if len(rows) > MOST_DIMENSIONS:
        raise ValueError(f"more than {MOST_DIMENSIONS} common units")
    for r in rows:
        if r.common_unit and (got := parse_unit(r.common_unit)) and r.dimension:
            out[r.dimension] = (r.common_unit, got[1])
    return out


def to_common(df: DataFrame, common_units: DataFrame, row_id: str, basis: str | None = None, unit: str = "unit", quantity: str = "quantity", props: str = "properties") -> DataFrame:
    """Rows with a quantity: (row_id, quantity, dimension, unit_factor, basis_dimension, basis_factor, common_quantity, common_unit, common_basis).

    A factor is the number of common units in one unit as recorded, null where there is no common unit.
    common_quantity is null unless the unit has one; a basis without a common unit leaves it per recorded basis.
    """
    ship_here()
    goal = common_targets(common_units)
    pick = lambda dim, i: F.element_at(F.create_map(*[F.lit(x) for d, v in goal.items() for x in (d, v[i])]), dim) if goal else F.lit(None)
    cols = [F.col(row_id).alias("row_id"), F.col(quantity).cast("double").alias("quantity")]
    cols += [F.col(unit).alias("u"), _texts(unit, props).alias("ut") if basis is None else F.lit(None).cast("string").alias("ut")]
    cols += [F.col(basis).alias("b"), _texts(basis, props).alias("bt")] if basis else [F.lit(None).cast("string").alias("b"), F.lit(None).cast("string").alias("bt")]
    d = df.filter(F.col(quantity).isNotNull()).select(*cols)
    d = d.withColumn("x", units_udf("unit", False)("u", "ut", "quantity"))
    d = d.withColumn("y", units_udf("per_unit", True)("b", "bt", "quantity")) if basis else d.withColumn("y", F.lit(None).cast("struct<dim:string,factor:double>"))
    near = lambda c: F.when(F.abs(c - 1) < 1e-9, F.lit(1.0)).otherwise(c)
    d = d.withColumn("uf", near(F.col("x.factor") / pick(F.col("x.dim"), 1))).withColumn("bf", near(F.col("y.factor") / pick(F.col("y.dim"), 1)))
    return d.select(
        "row_id", "quantity", F.col("x.dim").alias("dimension"), F.col("uf").alias("unit_factor"), F.col("y.dim").alias("basis_dimension"), F.col("bf").alias("basis_factor"),
        F.when(F.col("uf").isNotNull(), F.col("quantity") * F.col("uf") / F.coalesce("bf", F.lit(1.0))).alias("common_quantity"),
        F.when(F.col("uf").isNotNull(), pick(F.col("x.dim"), 0)).alias("common_unit"), F.when(F.col("bf").isNotNull(), pick(F.col("y.dim"), 0)).alias("common_basis"),
    )


def off_common(converted: DataFrame) -> DataFrame:
    """row_id of the rows of ``to_common`` whose unit or basis differs from the common one by a factor."""
    return converted.filter("unit_factor <> 1 or basis_factor <> 1").select("row_id").distinct()
