"""Texts that stop before their own end.

A stack automaton reads each whole text: it opens and closes brackets, quotes and markup elements and looks
for what cannot end a text (half a multibyte character, half an escape or tag, a mark of omission). What is
left is judged by the way the last line ends. Strong terminators end a sentence. Other endings are held
against baselines counted over the whole corpus: endings of the lines inside texts, which nobody cut, and
last lines that many different texts share, over all sources or within the text's own source (closing
phrases). An ending without terminator that no baseline knows is a cut.

Defined results: null and blank texts are not cut; repeated texts count once in a baseline but each of them
is reported; white space at the end is ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from lodegraph.plans.session import cut, spread

#: An ending is known if it has this share of its baseline's rows, and at least LEAST of them. So a baseline
#: has at most 1/SHARE endings, which may be broadcast.
SHARE, LEAST = 0.001, 3
#: The same for the closing phrases of one source, by share of that source's texts.
SOURCE_SHARE = 0.02

OPEN = {"(": ")", "[": "]", "{": "}", "「": "」", "『": "』", "《": "》", "【": "】", "“": "”", "‘": "’"}
CLOSE = {b: a for a, b in OPEN.items()}
# Elements that HTML lets stand open or that have no end tag.
VOID = {"br", "hr", "img", "input", "meta", "link", "col", "wbr", "p", "li", "td", "th", "tr", "dt", "dd", "option"}
# Marks put behind a cut.
MARKS = re.compile(r"(?:…|\.{3,}|⋯|‥|\[(?:\.{3}|…|truncated|cut|more|계속|생략|중략|이하 ?생략)\]|\((?:계속|continued|truncated|중략)\)|(?:-{2,}|>{2,}|»))$", re.I)
HALF_TAG = re.compile(r"(?:</?[A-Za-z][^<>]*|<[/!]?)$")
HALF_ESCAPE = re.compile(r"&(?:#\d{0,6}|#x[0-9A-Fa-f]{0,6}|[A-Za-z]{2,8})$|\\(?:u[0-9A-Fa-f]{0,3}|x[0-9A-Fa-f]?)?$|(?<![0-9])%[0-9A-Fa-f]?$")
TAG = re.compile(r"<(/?)([A-Za-z][A-Za-z0-9]*)(?:\s[^<>]*)?(/?)>")
TOKEN = re.compile(r"<(/?)([A-Za-z][A-Za-z0-9]*)(?:\s[^<>]*)?(/?)>|[()\[\]{}「」『』《》【】“”‘’]|\n\s*\n")
CLOSERS = "\"'”’」』》】)]*_~`"
TERMINAL = ".!?。！？．"
DIGITS = re.compile(r"\d+")
CIRCLED = re.compile("[①-⑳]")
#: a list item or table row: a mark, or a short line of words that ends in a number with its unit
ITEM = re.compile(r"^\s*(?:[-*·•○●▪∙※]|\(?\d{1,3}[).]|[①-⑳]|[가-힣][.)]|[A-Za-z][.)])\s")


def ending(line: str) -> tuple[str, str]:
    """(kind, signature) of a line's end: 'stop' needs no baseline, the others do."""
    line = line.rstrip()
    bare = line.rstrip(CLOSERS).rstrip()
    if bare and bare[-1] in TERMINAL:
        if bare[-1] == "." and bare[-2:-1].isdigit():
            # a point behind a number ends a sentence only where sentences end on that word and a number
            last = bare.rsplit(None, 2)
            return "point", DIGITS.sub("0", last[-2] if len(last) > 1 else last[-1])
        return "stop", ""
    if line.endswith((":", "：")):
        return "colon", ":"
    if line.endswith(">") and TAG.search(line[line.rfind("<") :]):
        return "tag", re.sub(r"\s.*?(?=/?>)", "", line[line.rfind("<") :])
    if m := ITEM.match(line):
        # kinds of marks end their items in their own ways: bullets on quantities, circled numbers on sentences
        mark = CIRCLED.sub("①", DIGITS.sub("0", m[0].strip()))
        tail = re.search(r"(\d[\d.,]*)\s*([^\d\s,;]*)$", line)
        last = ("0" + (" " if re.search(r"\d\s+\S*$", line) else "") + tail[2]) if tail else line.split()[-1]
        return "item", f"{mark} {last}"
    return "line", re.sub(r"\d+(?:[.,]\d+)*", "0", line.strip())


def broken(text: str) -> str | None:
    """What the stack automaton finds at the end of a text that its own end does not allow."""
    t = text.rstrip()
    if t.endswith(("\ufffd",)) or t and 0xD800 <= ord(t[-1]) <= 0xDFFF:
        return "multibyte"
    if MARKS.search(t[-40:]):
        return "mark"
    # an element or a comment that the text ends inside of
    last = t.rfind("<")
    if last >= 0 and (HALF_TAG.match(t, last) or t.rfind("<!--") > t.rfind("-->")):
        return "tag"
    if HALF_ESCAPE.search(t[-12:]):
        return "escape"
    stack: list[str] = []
    for m in TOKEN.finditer(t):
        s = m[0]
        if m[2]:
            name = m[2].lower()
            if m[3] or name in VOID and not m[1]:
                continue
            if not m[1]:
                stack.append("<" + name)
            elif "<" + name in stack:
                while stack.pop() != "<" + name:
                    pass
        elif s in OPEN:
            stack.append(s)
        elif s in CLOSE:
            if CLOSE[s] in stack[-8:]:
                while stack.pop() != CLOSE[s]:
                    pass
        else:  # a blank line ends what brackets and quotes were left open by mistake
            stack = [x for x in stack if x[0] == "<"]
    if any(x[0] == "<" for x in stack):
        return "markup"
    if any(x in "([{「『《【" for x in stack):
        return "bracket"
    if any(x in "“‘" for x in stack):
        return "quote"
    last = t[t.rfind("\n\n") + 1 :]
    if last.count('"') % 2 and not re.search(r'\d"', last):
        return "quote"
    if t.count("```") % 2 or len(re.findall(r"\\begin\{", t)) > len(re.findall(r"\\end\{", t)):
        return "markup"
    return None


def _hash(*parts: str) -> int:
    return xxhash.xxh64_intdigest("\u0001".join(parts).encode("utf-8", "replace")) - (1 << 63)


_SCHEMA = pa.schema([("key", pa.int64()), ("source", pa.string()), ("found", pa.string()), ("kind", pa.string()), ("sig", pa.int64()), ("text_hash", pa.int64()), ("inner", pa.list_(pa.int64()))])
_SENTENCE_POINT = re.compile(r"\d[.]\s+(?=[A-Z가-힣(\"“])")


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = []
        for k, t, source in zip(*(b.column(i).to_pylist() for i in range(3))):
            if t is None or not t.strip():
                rows.append((k, source, "blank", None, None, None, []))
                continue
            text = t.rstrip()
            lines = text.split("\n")
            found, (kind, sig) = broken(t), ending(lines[-1])
            # endings inside the text, which were not cut: baseline for items and for points behind numbers
            inner = []
            for line in lines[:-1]:
                if line.strip():
                    x, s = ending(line)
                    if x in ("item", "point", "tag"):
                        inner.append(_hash(x, s))
            for m in _SENTENCE_POINT.finditer(text):
                # the word before the number; words longer than this are no baseline
                word = text[max(0, m.start() - 120) : m.start() + 1].rsplit(None, 2)
                if len(word) > 1:
                    inner.append(_hash("point", DIGITS.sub("0", word[-2])))
            rows.append((k, source, found, kind, _hash(kind, sig), _hash(text), inner))
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _SCHEMA)] if rows else [pa.array([], f.type) for f in _SCHEMA], schema=_SCHEMA)


def cut_texts(df: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """(key, source, is_cut, reason) for every row; reason tells what showed the cut."""
    rows = spread(df.select(F.col(key).cast("long").alias("key"), text, F.coalesce(F.col(source), F.lit("")).alias("source")))
    feats = cut(rows.mapInArrow(_features, "key bigint, source string, found string, kind string, sig bigint, text_hash bigint, inner array<bigint>"))
    # inner endings: share of all inner endings; one row an ending after map-side combining
    inner = feats.select(F.explode("inner").alias("sig")).groupBy("sig").agg(F.count(F.lit(1)).alias("n"))
    finals = feats.filter("kind <> 'stop'").select("sig", "source", "text_hash")
    texts = feats.filter("found is null or found <> 'blank'").groupBy("source").agg(F.count(F.lit(1)).alias("texts"))
    n_inner, n_texts = (x or 0 for x in inner.agg(F.sum("n")).crossJoin(texts.agg(F.sum("texts"))).first())  # one row each
    least = lambda n: max(LEAST, n * SHARE)
    # each text counts once for a closing phrase; a third of all rows may be one text
    by_source = finals.distinct().groupBy("sig", "source").agg(F.count(F.lit(1)).alias("n"))
    by_source = cut(by_source)
    everywhere = by_source.groupBy("sig").agg(F.sum("n").alias("n")).filter(F.col("n") >= F.lit(least(n_texts))).select("sig")
    known = inner.filter(F.col("n") >= F.lit(least(n_inner))).select("sig").union(everywhere).distinct().withColumn("known", F.lit(True))
    # a source's own phrases: at most 1/SOURCE_SHARE a source
    own = by_source.join(F.broadcast(texts) if _few(texts) else texts, "source").filter((F.col("n") >= 20) & (F.col("n") >= F.col("texts") * SOURCE_SHARE)).select("source", "sig").withColumn("own", F.lit(True))
    feats = feats.drop("inner")
    open_end = (F.col("found").isNull()) & ~F.col("kind").isin("stop", "tag")
    told = feats.filter(~open_end).withColumn("reason", F.when(F.col("found") != "blank", F.col("found")))
    # only rows whose ending no corpus-wide baseline knows reach the shuffle join: their endings are rare ones
    asked = feats.filter(open_end).join(F.broadcast(known), "sig", "left")
    fine = asked.filter("known").withColumn("reason", F.lit(None).cast("string"))
    rest = asked.filter("known is null").join(own, ["source", "sig"], "left").withColumn("reason", F.when(F.col("own").isNull(), "ending"))
    out = None
    for part in (told, fine, rest):
        part = part.select(F.col("key").alias(key), "source", F.col("reason").isNotNull().alias("is_cut"), "reason")
        out = part if out is None else out.unionByName(part)
    return out


def _few(df: DataFrame, most: int = 100_000) -> bool:
    return df.limit(most + 1).count() <= most
