"""Pieces of bounded size, cut at the strongest boundary in reach, with overlap.

One bounded-quantifier expression consumes a text from left to right: its alternatives are ordered by the
strength of the boundary they end on (blank line, line end, sentence end, comma or semicolon, white space)
and the last one takes the full limit of characters. Each match is new text; a piece is its match with the
characters before it looked back for, so consecutive pieces overlap. All of it runs in the JVM.

Defined results: null text has no piece; an empty text is one empty piece; a text within the limit is one
piece, unchanged. Every character is in a piece, and the new parts concatenated are the text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: A text's size is its characters / 2, rounded up.
CHARS_PER_UNIT = 2


def size_of(text: Column) -> Column:
    return F.ceil(F.length(text) / CHARS_PER_UNIT)


def boundary_pattern(most: int, least: int) -> str:
    """Alternatives by boundary strength; each takes between ``least`` and ``most`` characters, or the rest."""
    span = lambda tail, n: f".{{{least},{most - n}}}{tail}"
    ways = [
        f".{{1,{most}}}\\z",  # the rest fits
        span(r"\n[ \t]*\n", 12).replace(r"[ \t]*", r"[ \t]{0,10}"),  # blank line
        span(r"\n", 1),
        span(r"[.!?。！？][\"'”’)\]]{0,2}\s", 4),
        span(r"[,;:，；]\s", 2),
        span(r"\s", 1),
        f".{{1,{most}}}(?![\\p{{M}}\\u200d])",  # a character, but not before its accents
        f".{{1,{most}}}",
    ]
    return "(?s)(?:" + "|".join(ways) + ")"


def split_pieces(df: DataFrame, text: str = "text", limit: int = 2000, overlap: int = 100) -> DataFrame:
    """Rows of ``df`` for each piece, with piece_no (from 1), n_pieces, piece, piece_size, piece_start.

    ``limit`` and ``overlap`` are sizes (characters / 2). Columns of ``df`` other than the text stay; names
    that clash with the added ones are refused.
    """
    added = {"piece_no", "n_pieces", "piece", "piece_size", "piece_start"}
    if added & set(df.columns):
        raise ValueError(f"columns exist already: {sorted(added & set(df.columns))}")
    if not 0 <= overlap < limit:
        raise ValueError("overlap must be below limit")
    back, most = overlap * CHARS_PER_UNIT, (limit - overlap) * CHARS_PER_UNIT
    pattern = boundary_pattern(most, max(back, most // 2))
    t = F.col(text)
    over = size_of(t) > limit
    parts = F.when(over, F.regexp_extract_all(t, F.lit(pattern), F.lit(0))).otherwise(F.array(t))
    # offsets: the running sum of the lengths of the parts before
    starts = lambda a: F.aggregate(
        F.slice(a, 1, F.size(a) - 1), F.array(F.lit(0)), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + F.length(x)))
    )
    keep = [c for c in df.columns if c != text]
    cut = df.filter(t.isNotNull()).select(*[F.col(f"`{c}`") for c in keep], t.alias("__t"), parts.alias("__p"))
    rows = cut.select("*", F.size("__p").alias("n_pieces"), F.posexplode(F.arrays_zip(F.col("__p").alias("p"), starts(F.col("__p")).alias("s"))).alias("__i", "__x"))
    lead = F.when(F.col("__i") > 0, F.lit(back)).otherwise(F.lit(0))
    start = F.col("__x")["s"] - lead
    piece = F.when(F.col("n_pieces") == 1, F.col("__t")).otherwise(F.substring(F.col("__t"), start + 1, F.length(F.col("__x")["p"]) + lead))
    return rows.select(*[F.col(f"`{c}`") for c in keep], (F.col("__i") + 1).alias("piece_no"), "n_pieces", start.alias("piece_start"), piece.alias("piece")).withColumn("piece_size", size_of(F.col("piece")).cast("int"))
