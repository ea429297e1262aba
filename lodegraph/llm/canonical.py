"""One consistent form for text that looks the same.

Two forms of a value: ``visual`` has the same look with the most ordinary characters (compatibility
composition, look-alike letters mapped, every space the plain one, no invisible characters), ``key`` is the
visual form fully case-folded with runs of white space squeezed, for comparisons. Work is done once for each
distinct value of a batch; values of plain characters never leave the JVM.

Defined results: null stays null, an empty text stays empty; tabs and line ends are ordinary; signs whose
replacement would change the look (superscripts, circled numbers, phi, alpha, degree, times, middle dot,
composed accents) stay; a word wholly in its own script (Cyrillic, Greek, Armenian), which holds a letter that no
Latin letter looks like and no Latin letter, stays as it is.
"""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from lodegraph.plans.session import ship_here

# Letters of other scripts that are drawn as the Latin letter beside them.
LOOKALIKE = {
    # Cyrillic
    "а": "a", "с": "c", "е": "e", "о": "o", "р": "p", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "һ": "h", "ԁ": "d", "ԛ": "q", "ԝ": "w", "ӏ": "l",
    "А": "A", "В": "B", "С": "C", "Е": "E", "Н": "H", "І": "I", "Ј": "J", "К": "K", "М": "M", "О": "O", "Р": "P", "Ѕ": "S", "Т": "T", "Х": "X", "У": "Y", "Ү": "Y", "Ԍ": "G", "Ԛ": "Q", "Ԝ": "W", "Ӏ": "I",
    # Greek
    "ο": "o", "ν": "v", "ι": "i", "κ": "k", "ρ": "p", "υ": "u", "χ": "x", "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "ϲ": "c", "Ϲ": "C", "ϳ": "j", "Ϳ": "J",
    # Armenian, Latin extensions
    "օ": "o", "ո": "n", "ս": "u", "հ": "h", "ɡ": "g", "ɑ": "a", "ı": "i",
}
# Hyphens and minus signs of other blocks; quotes and primes are left alone.
HYPHENS = "‐‑‒–−﹣－⁃˗"
# Default-ignorable code points (Unicode property Default_Ignorable_Code_Point), as ranges.
IGNORABLE = ((0xAD, 0xAD), (0x34F, 0x34F), (0x61C, 0x61C), (0x115F, 0x1160), (0x17B4, 0x17B5), (0x180B, 0x180F), (0x200B, 0x200F), (0x202A, 0x202E), (0x2060, 0x206F), (0x3164, 0x3164), (0xFE00, 0xFE0F), (0xFEFF, 0xFEFF), (0xFFA0, 0xFFA0), (0xFFF0, 0xFFF8), (0x1BCA0, 0x1BCA3), (0x1D173, 0x1D17A), (0xE0000, 0xE0FFF))
#: Compatibility mappings that keep the look. Superscripts, circles and fractions change it and stay.
SAME_LOOK = {"<wide>", "<narrow>", "<square>", "<compat>", "<noBreak>", "<font>", "<small>", "<vertical>", "<initial>", "<medial>", "<final>", "<isolated>"}

#: Characters of which a value consists that needs no work: plain ASCII, composed Hangul and Latin-1 letters, the legitimate signs.
PLAIN = r"^[\t\n\r -~가-힣À-ÖØ-öø-ÿ²³°×·φαㄱ-ㅎㅏ-ㅣ①-⑳※一-鿿]*$"

#: As PLAIN, of characters that folding changes no further than lower case does (so without sharp s).
PLAIN_FOLD = PLAIN.replace("ø-ÿ", "à-öø-ÿ").replace("Ø-ö", "Ø-Þ")

_SUPER = str.maketrans("23", "²³")


def _table() -> dict[int, str | None]:
    t: dict[int, str | None] = {ord(a): b for a, b in LOOKALIKE.items()}
    t |= {ord(c): "-" for c in HYPHENS}
    for cp in range(0x20):
        if cp not in (9, 10, 13):
            t[cp] = None
    for cp in range(0x7F, 0xA0):
        t[cp] = None
    t[0x85] = t[0x2028] = t[0x2029] = "\n"
    for lo, hi in IGNORABLE:
        for cp in range(lo, hi + 1):
            t[cp] = None
    return t


class _Lazy(dict):
    """A translate table that works out compatibility characters when it first meets them."""

    def __missing__(self, cp: int) -> str | int:
        ch, out = chr(cp), cp
        kind, _, rest = unicodedata.decomposition(ch).partition(" ")
        if unicodedata.category(ch) in ("Zs", "Zl", "Zp") and ch != " ":
            out = " "
        elif kind in SAME_LOOK and not 0x3131 <= cp <= 0x318E:
            full = unicodedata.normalize("NFKC", ch)
            if full.strip():
                full = full.translate(self)
                out = full[:-1] + full[-1].translate(_SUPER) if kind == "<square>" and full[-1] in "23" and full[:-1].isalpha() else full
        self[cp] = out
        return out


_MAP = _Lazy(_table())


_SCRIPT = re.compile("[\u0370-\u03ff\u0400-\u052f\u0531-\u058f]")
_WORD = re.compile(r"[^\W\d_]+")


def _own_script(word: str) -> bool:
    """A word of another script: it has a letter of it that looks like no Latin one, and no Latin letter."""
    return any(_SCRIPT.match(c) and c not in LOOKALIKE and c not in "φα" for c in word) and not any(c.isascii() for c in word)


def visual(value: str | None) -> str | None:
    """The same look in ordinary characters; idempotent."""
    if value is None or value.isascii() and value.isprintable():
        return value
    value = unicodedata.normalize("NFC", value)
    if not _SCRIPT.search(value):
        return unicodedata.normalize("NFC", value.translate(_MAP))
    out, at = [], 0
    # invisible characters go first, so that they do not part a word
    value = "".join(c for c in value if _MAP.get(ord(c), c) is not None)
    for m in _WORD.finditer(value):
        if _own_script(m[0]):
            out += [value[at : m.start()].translate(_MAP), m[0]]
            at = m.end()
    return unicodedata.normalize("NFC", "".join(out) + value[at:].translate(_MAP))


def folded(value: str | None) -> str | None:
    """Visual form, fully case-folded."""
    return None if value is None else unicodedata.normalize("NFC", visual(value).casefold())


def key(value: str | None) -> str | None:
    """Comparison form: folded, white space squeezed and trimmed."""
    return None if value is None else re.sub(r"\s+", " ", folded(value)).strip()


def _distinct(s: pd.Series, f) -> pd.Series:
    codes, values = pd.factorize(s, use_na_sentinel=True)
    out = [f(v) for v in values] + [None]
    return pd.Series([out[c] for c in codes], dtype=object)


def _python_columns(cols: tuple[str, ...], f, plain: str) -> list[Column]:
    """``f`` of several text columns in one Python pass, null where the value is plain."""
    ship_here()

    @F.pandas_udf(", ".join(f"c{i} string" for i in range(len(cols))))
    def run(*parts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame({f"c{i}": _distinct(p, f) for i, p in enumerate(parts)})

    got = run(*[F.when(~F.col(c).rlike(plain), F.col(c)) for c in cols])
    return [got[f"c{i}"] for i in range(len(cols))]


def visual_columns(*cols: str) -> list[Column]:
    """Visual forms of several text columns; plain values come back without leaving the JVM."""
    return [F.coalesce(v, F.col(c)) for c, v in zip(cols, _python_columns(cols, visual, PLAIN))]


def folded_columns(*cols: str) -> list[Column]:
    """Fully case-folded visual forms; values that lower case folds fully never leave the JVM."""
    return [F.coalesce(v, F.lower(F.col(c))) for c, v in zip(cols, _python_columns(cols, folded, PLAIN_FOLD))]


def _with(df: DataFrame, cols: list[str], suffix: str, columns) -> DataFrame:
    clash = {f"{c}{suffix}" for c in cols} & set(df.columns)
    if clash:
        raise ValueError(f"columns exist already: {sorted(clash)}")
    return df.withColumns({f"{c}{suffix}": v for c, v in zip(cols, columns(*cols))})


def with_visual(df: DataFrame, cols: list[str], suffix: str = "_visual") -> DataFrame:
    """``df`` with a column ``<name><suffix>`` for each named text column; a clashing name is refused."""
    return _with(df, cols, suffix, visual_columns)


def with_folded(df: DataFrame, cols: list[str], suffix: str = "_folded") -> DataFrame:
    """As ``with_visual``, with the folded forms."""
    return _with(df, cols, suffix, folded_columns)


def key_of(folded_col: Column) -> Column:
    """Comparison form from a folded form."""
    return F.trim(F.regexp_replace(F.lower(folded_col), r"\s+", " "))


def odd_values(df: DataFrame, row_id: str, fields: list[str]) -> DataFrame:
    """(row_id, field) of every value that differs from its visual form. Null is never odd."""
    cols = df.select(F.col(row_id).alias("row_id"), *[F.col(f).alias(f"v{i}") for i, f in enumerate(fields)])
    done = with_visual(cols, [f"v{i}" for i in range(len(fields))], "_n")
    hit = F.array_compact(F.array(*[F.when(F.col(f"v{i}_n") != F.col(f"v{i}"), F.lit(f)) for i, f in enumerate(fields)]))
    return done.select("row_id", F.explode(hit).alias("field")).distinct()
