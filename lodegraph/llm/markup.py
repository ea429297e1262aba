"""Markup left in text: find the blocks that carry it and turn them into clean text that keeps its structure.

A text is a sequence of leaf blocks (its lines; of tables every header, cell and note). Each block has a
tag path (what is open where it starts: elements, fences, environments, wiki tables), the signs of markup
languages it holds, and its words; all are hashed into a sparse vector. A bidirectional LSTM reads the whole
sequence and gives every block a class, so a block is judged with the document around it. The class alone
settles whether a block is reported and which renderer cleans it.

The labeller is trained on documents written by ``write_document``, whose labels are known by construction;
their number is the parameter ``TRAIN_DOCS``.

Defined results: null stays null, an empty text stays empty; plain blocks come out unchanged, byte for byte.
Clean text keeps headings as ``# ``, list items as ``- ``, code in fences, table rows as ``a | b`` and
formulas between ``$``.
"""

from __future__ import annotations

import html
import random
import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lodegraph.llm.lstm import WORD_DIM, BiLSTM
from lodegraph.plans.session import spread

CLASSES = ("plain", "heading", "list", "code", "table", "formula", "inline", "noise")
PLAIN, HEADING, LIST, CODE, TABLE, FORMULA, INLINE, NOISE = range(8)
#: Documents the labeller is trained on, epochs over them, and its width.
TRAIN_DOCS, EPOCHS, HIDDEN, BUCKETS, TOKEN_BUCKETS = 1500, 4, 12, 256, 512
#: A block is markup if the labeller gives markup at least this probability.
LEAST_P = 0.5

_TAG = r"</?[A-Za-z][A-Za-z0-9]*(?:\s[^<>\n]*)?/?>"
_ENTITY = r"&(?:amp;)*(?:#\d{1,6}|#[xX][0-9A-Fa-f]{1,5}|[A-Za-z][A-Za-z0-9]{1,30});|&(?:amp;)*(?:nbsp|amp|lt|gt|quot|apos|middot|times|deg|sup[123])\b;?"
# Signs of the markup languages by name; which of them a block holds is part of what the labeller reads.
SIGNS = {
    "tag": _TAG, "attribute": r"</?[A-Za-z][A-Za-z0-9]*\s+[A-Za-z:-]+\s*=", "end": r"</[A-Za-z]+", "comment": r"<!--|-->|<!\[CDATA", "entity": _ENTITY, "stars": r"\*\*", "lines": r"__(?=\S)|(?<=\S)__", "strike": "~~", "tick": "`", "quotes": "'''?", "link": r"\[\[|\]\]", "call": r"\{\{|\}\}",
    "label": r"!?\[[^\]\n]*\]\([^)\n]*\)", "command": r"\\[A-Za-z]+", "escape": r"\\[%()\[\]$&#_{}]", "display": r"\$\$", "math": r"\$[^$\s](?:[^$\n]{0,200}[^$\s])?\$(?!\d)",
}
# Signs that count where a line starts.
LINE_SIGNS = {
    "hashes": r"\s{0,3}#{2,6}\s", "hash": r"\s{0,3}#\s+(?!\d)", "underline": r"\s*={3,}\s*$", "equals": r"={1,6}\s?[^=].*[^=]\s?={1,6}\s*$", "quote": r"\s{0,3}>\s",
    "cells": r"\s*\|.*\|\|", "row": r"\s*\|.*\|\s*$", "open": r"\s*\{\|", "close": r"\s*\|\}", "rule": r"\s*\|-", "heads": r"\s*!.*!!",
}
_named = lambda t: re.compile("|".join(f"(?P<{k}>{v})" for k, v in t.items()), re.M)
_SIGN, _LINE_SIGN = _named(SIGNS), _named(LINE_SIGNS)
# where a sign, a sign of a line and a token can begin, for a quick scan of long blocks
_SIGN_AT, _LINE_SIGN_AT, _TOKEN_AT = re.compile(r"[<&*_~`'\[\]{}!\\$-]"), re.compile(r"^\s*[#=>|{!]", re.M), re.compile(r"[</>&\\*_~`'={|}!\[\]$#^※①-⑳·•-]")
_LEAD = re.compile(r"\s*[-\d(]+[.)]?")
_TOKEN = re.compile(r"</?[A-Za-z][A-Za-z0-9]*|/?>|<!--|-->|<|&(?:#?[A-Za-z0-9]+);?|\\[A-Za-z]+|\\.?|\*+|_+|~+|`+|'{2,}|=+|\{\{|\}\}|\{\||\|\}|\|-|\|\||\||!!|!\[|\[\[|\]\]|\]\(|\[|\]|\$+|#+|\{|\}|\^|[※①-⑳·•]")
_WORD = re.compile(r"[^\W\d_]+")
_HAS_TOKEN = re.compile(r"[<>&\\*_~`'={}|!\[\]$#^※①-⑳·•]|^\s*[-\d(]")


def _from(starts: re.Pattern, what: re.Pattern, text: str) -> Iterator[re.Match]:
    """Matches of ``what`` one behind another, tried only where ``starts`` matches."""
    end = 0
    for m in starts.finditer(text):
        if m.start() >= end and (got := what.match(text, m.start())):
            end = got.end()
            yield got


def signs(text: str) -> set[str]:
    """Names of the signs of markup languages in a block."""
    return {m.lastgroup for m in _from(_SIGN_AT, _SIGN, text)} | {m.lastgroup for m in _from(_LINE_SIGN_AT, _LINE_SIGN, text)}


_PATH = re.compile(r"<(/?)(table|ul|ol|pre|code|script|style|div|p|b|span|h[1-6]|blockquote)\b[^>]*?(/?)>|(```|\$\$|\{\||\|\}|<!--|-->)|\\(begin|end)\{(\w+)\}")


class _Hashed(dict):
    """Text to bucket, worked out when first met."""

    def __init__(self, first: int, buckets: int, most: int = 200_000):
        super().__init__()
        self.first, self.buckets, self.most = first, buckets, most

    def __missing__(self, t: str) -> int:
        if len(self) > self.most:
            self.clear()
        got = self[t] = self.first + zlib.crc32(t.lower().encode("utf-8", "replace")) % self.buckets
        return got


#: Numbers of the features: hashed tokens, whether a block has a sign, which signs, hashed paths.
NO_SIGN, SIGNED, PATHS = TOKEN_BUCKETS, TOKEN_BUCKETS + 1, 63
SIGN_IDS = {k: TOKEN_BUCKETS + 2 + i for i, k in enumerate(SIGNS | LINE_SIGNS)}
FIRST_PATH = TOKEN_BUCKETS + 2 + len(SIGN_IDS)
N_FEATURES = FIRST_PATH + PATHS
#: Fixed word vectors of the hash buckets.
WORD_VECTORS = np.random.default_rng(5).normal(0, 1, (BUCKETS, WORD_DIM)).astype("f4")


class Features:
    """Sparse features and word vectors of blocks."""

    def __init__(self) -> None:
        self.words, self.tokens, self.path_ids = _Hashed(0, BUCKETS), _Hashed(0, TOKEN_BUCKETS), _Hashed(FIRST_PATH, PATHS)

    def block(self, text: str) -> list[int]:
        """Sign and token features of a block alone, without its path; the last one says whether it has a sign."""
        if not _HAS_TOKEN.search(text):
            return [NO_SIGN]
        ids, hashed, n = {SIGN_IDS[k] for k in signs(text)}, self.tokens, len(text)
        signed, lead = bool(ids), _LEAD.match(text)
        for m in chain((lead,) if lead else (), _from(_TOKEN_AT, _TOKEN, text)):
            a, b = m.span()
            c = text[a - 1] if a else " "
            before = "^" if a < 3 and not text[:a].strip() else "w" if c.isalnum() else "s" if c.isspace() else "p"
            c = text[b] if b < n else ""
            after = "$" if not c else "d" if c.isdigit() else "w" if c.isalnum() else "s" if c.isspace() else "p"
            t = m[0][:9].strip()
            if not t.isalpha() and any(x.isdigit() for x in t):
                t = re.sub(r"\d+", "0", t)
            ids.add(hashed[t])
            ids.add(hashed[f"{t} {before}{after}"])
        return [*ids, SIGNED if signed else NO_SIGN]

    def embed(self, model: BiLSTM, texts: list[str]) -> np.ndarray:
        """Input rows of different blocks."""
        tokens = [self.block(t) for t in texts]
        return model.embed(np.fromiter((i for x in tokens for i in x), np.int32), np.fromiter(map(len, tokens), np.int64, len(tokens)), self.word_vectors(texts))

    def word_vectors(self, texts: list[str]) -> np.ndarray:
        """Sum of the words' vectors over the root of their number."""
        found = [_WORD.findall(t) for t in texts]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        out = np.zeros((len(texts), WORD_DIM), "f4")
        hashed = self.words
        ids = np.fromiter((hashed[w] for ws in found for w in ws), np.int32, int(sizes.sum()))
        full = np.nonzero(sizes)[0]
        if len(full):
            out[full] = np.add.reduceat(WORD_VECTORS[ids], (np.cumsum(sizes) - sizes)[full], axis=0) * (0.3 / np.sqrt(sizes[full]))[:, None]
        return out

    def paths(self, lines: list[str]) -> list[str]:
        """What is open where each line starts."""
        out, stack = [], []
        for line in lines:
            out.append("/".join(stack[-4:]))
            if "<" in line or "`" in line or "$" in line or "\\" in line or "|" in line or "-->" in line:
                for close, tag, void, mark, env, name in (m.groups() for m in _PATH.finditer(line)):
                    key = tag or (env and "env:" + name) or {"{|": "wt", "|}": "wt", "<!--": "c", "-->": "c"}.get(mark, mark)
                    if void == "/":
                        continue
                    ends = bool(close) or env == "end" or mark in ("|}", "-->") or (mark in ("```", "$$") and mark in stack)
                    if not ends:
                        stack.append(key)
                    elif key in stack:
                        while stack.pop() != key:
                            pass
        return out



def write_document(r: random.Random) -> tuple[list[str], list[int]]:
    """Lines and their classes; made-up words, plain signs that resemble markup, and markup of each kind."""
    ko = lambda: "".join(chr(r.randrange(0xAC00, 0xD7A4)) for _ in range(r.randint(1, 4)))
    en = lambda: "".join(r.choice("abcdefghijklmnoprstuvwy") for _ in range(r.randint(2, 9)))
    korean = r.random() < 0.7
    word = ko if korean else en
    num = lambda: str(r.choice([r.randint(1, 20), r.randint(1, 999), round(r.uniform(0, 40), r.randint(1, 2))]))
    words = lambda a, b: " ".join(num() + r.choice(["", "m", "kg", "%", "mm"]) if r.random() < 0.12 else word() for _ in range(r.randint(a, b)))
    stop = lambda: r.choice([".", ".", ".", "", ":", ")"])

    def confuse() -> str:
        w, n = word, num
        return r.choice([
            lambda: f"{w()} {n()} < {n()}m {w()} {w()} h > {n()}{w()} {w()}.", lambda: f"{w()} t < {n()}mm", lambda: f"{w()} {n()}*{n()} = {n()}{w()}.", lambda: f"{w()} {n()} * {n()} = {n()}", lambda: f"#{n()} {w()} #{n()} {w()}.", lambda: f"# {n()} {w()}",
            lambda: f"{w()} KX_{r.randint(1,99):02d}_B {w()} R&D {w()}.", lambda: f"{w()} A&B {en()}_{en()} {w()}", lambda: f"{w()} {n()} | {n()} | {n()} {w()} {w()}.", lambda: f"{w()} $ {w()} {w()}.", lambda: f"{w()} $ {n()} {w()}", lambda: f"{w()} {n()} ^ {n()} {w()} {n()}.", lambda: f"{w()} 1:{n()} ~ 1:{n()} {w()}.",
            lambda: f"※ {w()} {r.randint(1,9)}* {words(2, 5)}.", lambda: f"[{w()}] {words(2, 6)}.", lambda: f"[{w()}]", lambda: "* " + w(), lambda: "a < b", lambda: f"{n()}×{n()}", lambda: f"φ{n()}", lambda: f"{w()}({en()}) {n()}~{n()}", lambda: f"<{ko()}>", lambda: f"{w()} & {w()}", lambda: f"{n()} x {n()} = {n()}", lambda: "-", lambda: "#" + n(), lambda: f"{w()}; {w()} {w()}!", lambda: f"{w()} '{w()}' \"{w()}\"",
        ])()

    def plain() -> str:
        k = r.random()
        if k < 0.25:
            return r.choice(["- ", "· ", "(1) ", "2) ", "3. ", "① ", "③ ", "○ ", "가. ", "• "]) + words(1, 5)
        if k < 0.45:
            return confuse()
        if k < 0.5:
            return ""
        t = words(3, 14 if r.random() < 0.7 else 90) + stop()
        t = t + " " + confuse() if r.random() < 0.15 else t
        # a paragraph in one line
        return " ".join([t, *(plain() for _ in range(r.randint(2, 40)))]) if r.random() < 0.03 else t

    def inline(t: str) -> str:
        w, n = word, num
        return r.choice([
            lambda: f"**{t}**", lambda: f"__{t}__", lambda: f"~~{t}~~", lambda: f"`{t}`", lambda: f"'''{t}'''", lambda: f"''{t}''", lambda: f"<b>{t}</b>", lambda: f"<i>{t}</i>", lambda: f"<p class=\"{en()}\">{t}</p>", lambda: f"<p>{t}", lambda: f"\\textbf{{{t}}}", lambda: f"\\textit{{{t}}}", lambda: f"\\emph{{{t}}}",
            lambda: f"{t}<br>", lambda: f"{t}&nbsp", lambda: f"{t} {words(20, 90)}.&nbsp", lambda: f"{t}&nbsp{w()}", lambda: f"{t}<br/>", lambda: f"{t}<BR>{w()}", lambda: f"{t}&nbsp;", lambda: t.replace(" ", "&nbsp;") + "&nbsp;", lambda: f"{t} &amp;nbsp;", lambda: f"{t}&#{r.randint(9,999)};", lambda: f"&lt;{w()}&gt; {t}", lambda: f"{t} [{w()} {n()}](#{en()}-{n()})", lambda: f"{t} ![{w()}](img/{en()}.png)", lambda: f"{t} [[{n()}-{n()}|{w()}]]", lambda: f"[[{w()}]] {t}", lambda: f"{t}{{{{{w()}|{n()}}}}}", lambda: f"{t} <span style='color:{en()}'>{w()}", lambda: f"<span>{t}", lambda: f"{t}</td>", lambda: f"{t}</{r.choice(['p','b','li','span','td','div'])}>", lambda: f"{t} (m<sup>{r.randint(2,3)}</sup> {w()})", lambda: f"{t}<sup>{w()}{r.randint(1,9)})</sup>",
            lambda: f"{t}<ref name=\"{en()}\" />", lambda: f"{t} {n()}\\%", lambda: f"{t} $V = \\frac{{\\pi d^2}}{{4}} \\times L$", lambda: f"$\\{en()}$ {t}", lambda: f"{t} $\\times$ 2", lambda: f"{t} \\(Q = A {en()}\\)", lambda: f"{t} (\\mathrm{{m}}^{{{r.randint(2,3)}}})", lambda: f"`{t[: len(t) // 2]}` {t[len(t) // 2 :]}", lambda: f"**{t[: len(t) // 2]}** {t[len(t) // 2 :]}", lambda: f"'''{t[: len(t) // 2]}''' {t[len(t) // 2 :]}", lambda: f"<a href=\"{en()}\">{t}</a>", lambda: f"{t} &{r.choice(['lt','gt','quot','middot','times','deg'])};", lambda: f"<div class='{en()}'>{t}</div>", lambda: f"{t[: len(t) // 2]}~~{t[len(t) // 2 :]}~~", lambda: f"{t}**", lambda: f"**{t}", lambda: f"{t}]]", lambda: f"[[{t}",
        ])()

    def structure() -> list[tuple[str, int]]:
        w, n = word, num
        item = lambda: f"{w()} {n()}{r.choice(['kg', 'm', '개', ' pcs'])}"
        return r.choice([
            lambda: [("#" * r.randint(2, 5) + " " + r.choice(["", n() + ". "]) + words(1, 4), HEADING)], lambda: [("# " + words(1, 4), HEADING)], lambda: [("=" * (k := r.randint(1, 4)) + " " + words(1, 4) + " " + "=" * k, HEADING)], *[lambda: [(words(1, 4), HEADING), ("=" * r.randint(3, 14), HEADING)]] * 3, lambda: [(f"<h{(k := r.randint(1, 6))}>{words(1, 4)}</h{k}>", HEADING)], lambda: [(f"\\{r.choice(['section', 'subsection', 'chapter'])}{{{words(1, 4)}}}", HEADING)],
            lambda: [("<ul>" + "".join(f"<li>{item()}" + r.choice(["</li>", ""]) for _ in range(r.randint(1, 4))) + "</ul>", LIST)], lambda: [("\\begin{itemize}", LIST)] + [("\\item " + item(), LIST) for _ in range(r.randint(1, 4))] + [("\\end{itemize}", LIST)], lambda: [(f"* **{w()}**: {item()}", LIST) for _ in range(r.randint(1, 3))], lambda: [(f"* __{w()}__", LIST)], lambda: [("> " + words(2, 9) + ".", LIST)],
            lambda: [("```", CODE)] + [(f"{en()} = {n()} * {n()}", CODE) for _ in range(r.randint(1, 3))] + [("```", CODE)], lambda: [(f"<pre><code>{en()}({n()})</code></pre>", CODE)],
            lambda: [(f"| {w()} | {w()} |", TABLE), ("|---|---:|", TABLE)] + [(f"| {w()} | {n()} |", TABLE) for _ in range(r.randint(1, 3))], lambda: [('{| class="wikitable"', TABLE), (f"! {w()} !! {w()}", TABLE)] + [x for _ in range(r.randint(1, 3)) for x in (("|-", TABLE), (f"| {w()} || {n()}", TABLE))] + [("|}", TABLE)], lambda: [(f"<table><tr><td rowspan={r.randint(1,3)}>{w()}</td><td>{n()}</tr></table>", TABLE)], lambda: [("<table>", TABLE), (f"<tr><td>{w()}</td><td>{n()}</td></tr>", TABLE), ("</table>", TABLE)],
            lambda: [("$$", FORMULA), (f"A = \\sum_{{i=1}}^{{n}} b_i h_i + {n()}", FORMULA), ("$$", FORMULA)], lambda: [(f"\\begin{{equation}} P = \\rho {en()} h \\end{{equation}}", FORMULA)], lambda: [("\\begin{equation}", FORMULA), (f"P = \\rho g {en()}", FORMULA), ("\\end{equation}", FORMULA)],
            lambda: [(f"<!-- PAGE {n()} | {words(1, 3)} -->", NOISE)], lambda: [(f"<!-- SECTION: {n()}-{n()} | {words(1, 3)} | {w()}:{w()} -->", NOISE)], lambda: [(f"<script>/* {n()} */</script>", NOISE)], lambda: [(f"<style>{en()}</style>", NOISE)], lambda: [(f"[[{w()}:{w()}.png|{w()}|{w()}]]", NOISE)],
        ])()

    lines: list[tuple[str, int]] = []
    cells = r.random() < 0.35  # the strings of tables: short blocks
    dirty = r.choice([0.0, 0.04, 0.12, 0.35])
    for _ in range(r.randint(2, 30)):
        k = r.random()
        if k < dirty * 0.5 and not cells:
            part = structure()
            if r.random() < 0.06:
                j = r.randrange(len(part))
                part[j] = (inline(part[j][0]), part[j][1])
            lines += part
        elif k < dirty:
            t = words(1, 2) if cells and r.random() < 0.8 else plain() or word()
            t = inline(t)
            lines.append((inline(t) if r.random() < 0.12 else t, INLINE))
        else:
            lines.append((r.choice([word(), num(), words(1, 2), confuse(), "주 1) " + words(2, 9) + "."]) if cells else plain(), PLAIN))
    return [a for a, _ in lines], [b for _, b in lines]


_MODEL: dict = {}


def labeller(train_docs: int = TRAIN_DOCS, epochs: int = EPOCHS, seed: int = 11) -> BiLSTM:
    """Trained on ``train_docs`` written documents; the same for the same parameters."""
    if (key := (train_docs, epochs, seed)) not in _MODEL:
        r, f = random.Random(seed), Features()
        docs = []
        for _ in range(train_docs):
            lines, y = write_document(r)
            ids = [[*f.block(x), f.path_ids[p]] for x, p in zip(lines, f.paths(lines))]
            docs.append((ids, f.word_vectors(lines), np.array(y)))
        _MODEL[key] = BiLSTM(N_FEATURES, HIDDEN, len(CLASSES), seed).fit(docs, epochs)
    return _MODEL[key]


def classify(model: BiLSTM, f: Features, docs: list[list[str]], least_p: float = LEAST_P) -> list[np.ndarray]:
    """Classes of the blocks of each document; plain, or the likeliest markup class from ``least_p`` on."""
    lengths = np.array([len(x) for x in docs])
    if not lengths.sum():
        return [np.zeros(0, int) for _ in docs]
    place: dict[str, int] = {}
    at = np.fromiter((place.setdefault(line, len(place)) for lines in docs for line in lines), np.int64)
    paths = np.fromiter((f.path_ids[p] for lines in docs for p in f.paths(lines)), np.int32)
    s = model.scores(f.embed(model, list(place))[at] + model.p["W"][paths], lengths)
    s = np.exp(s - s.max(1, keepdims=True))
    s /= s.sum(1, keepdims=True)
    y = np.where(1 - s[:, 0] >= least_p, 1 + s[:, 1:].argmax(1), 0)
    return np.split(y, np.cumsum(lengths)[:-1])


# ---- rendering ----

_SUP = str.maketrans("0123456789+-n", "⁰¹²³⁴⁵⁶⁷⁸⁹⁺⁻ⁿ")


def _decode(t: str) -> str:
    for _ in range(3):
        new = re.sub(_ENTITY, lambda m: html.unescape(m[0] if m[0].endswith(";") else m[0] + ";"), t)
        if new == t:
            break
        t = new
    return t.replace("\xa0", " ").replace("\r", "")


def _inline(t: str) -> str:
    """Inline markup of one block to plain text; formulas stay between dollar signs."""
    kept: list[str] = []

    def keep(m: re.Match) -> str:
        kept.append("$" + re.sub(r"^(?:\$+|\\\(|\\\[)|(?:\$+|\\\)|\\\])$", "", m[0]).strip() + "$")
        return f"\x00{len(kept) - 1}\x00"

    t = re.sub(r"\$\$.+?\$\$|\$[^$\s](?:[^$\n]{0,200}[^$\s])?\$(?!\d)|\\\(.+?\\\)|\\\[.+?\\\]", keep, t)
    t = re.sub(r"<!--.*?-->|<(script|style)\b.*?</\1>|<ref\b[^>]*/>|<ref\b[^>]*>.*?</ref>", "", t, flags=re.S | re.I)
    t = re.sub(r"<sup>\s*([0-9n+-]+)\s*</sup>", lambda m: m[1].translate(_SUP), t, flags=re.I)
    t = re.sub(r"<sup>(.*?)</sup>", r" \1", t, flags=re.I)
    t = re.sub(r"<br\s*/?>", "\n", t, flags=re.I)
    t = re.sub(rf"{_TAG}|</?[A-Za-z][A-Za-z0-9]*\s+[A-Za-z:-]+\s*=\S*|</[A-Za-z]+|<!--|-->", "", t)
    t = re.sub(r"\{\{[^{}|]*\|?([^{}]*)\}\}", "", t)
    t = re.sub(r"!?\[([^\]\n]*)\]\([^)\n]*\)", r"\1", t)
    t = re.sub(r"\[\[(?:[^\[\]|]*\|)*([^\[\]|]*)\]\]", r"\1", t)
    t = re.sub(r"\[\[|\]\]|\{\{|\}\}", "", t)
    for _ in range(3):
        t = re.sub(r"\\(?:textbf|textit|emph|text|underline|texttt|mathrm|mathbf)\{([^{}]*)\}", r"\1", t)
    t = re.sub(r"\^\{([0-9n+-]+)\}", lambda m: m[1].translate(_SUP), t)
    t = re.sub(r"\\([%$&#_{}])", r"\1", t)
    t = re.sub(r"\*\*|__(?=\S)|(?<=\S)__|~~|`|'''?", "", t)
    t = re.sub(r"\\[()\[\]]", "", t)
    t = _decode(t)
    return re.sub(r"\x00(\d+)\x00", lambda m: kept[int(m[1])], t)


def _bar(cells: list[str]) -> str:
    return " | ".join(_inline(x).strip() for x in cells)


def _heading(s: str) -> str | None:
    if re.fullmatch(r"={3,}", s):
        return None
    if m := re.match(r"(#{1,6})\s+(.*)", s):
        return f"{m[1]} {_inline(m[2]).strip()}"
    if m := re.match(r"(={1,6})\s?([^=].*?[^=])\s?={1,6}$", s):
        return f"{'#' * len(m[1])} {_inline(m[2]).strip()}"
    if m := re.match(r"<h([1-6])[^>]*>(.*?)(?:</h\1>)?(.*)$", s, re.I):
        return f"{'#' * int(m[1])} {_inline(m[2] or m[3]).strip()}"
    if m := re.match(r"\\(section|subsection|subsubsection|chapter)\*?\{([^{}]*)\}(.*)", s):
        return f"{'#' * ({'chapter': 1, 'section': 2, 'subsection': 3}.get(m[1], 4))} {_inline(m[2] + m[3]).strip()}"
    return _inline(s).strip("\n")


def _list(s: str) -> str | None:
    if re.fullmatch(r"\\(?:begin|end)\{(?:itemize|enumerate)\}|</?(?:ul|ol)[^>]*>", s):
        return None
    if re.search(r"<li\b", s, re.I):
        return "\n".join("- " + x for p in re.split(r"<li[^>]*>", s, flags=re.I)[1:] if (x := _inline(p).strip()))
    if m := re.match(r"\\item\s*(.*)", s):
        return "- " + _inline(m[1]).strip()
    if m := re.match(r"[*>]\s+(.*)", s):
        return ("- " if s[0] == "*" else "") + _inline(m[1]).strip()
    return _inline(s).strip("\n")


def _code(s: str) -> str | None:
    if m := re.search(r"<pre>(?:<code>)?(.*?)(?:</code>)?</pre>", s, re.S | re.I):
        around = [_inline(x).strip() for x in (s[: m.start()], s[m.end() :])]
        return "\n".join(x for x in (around[0], "```\n" + _decode(m[1]) + "\n```", around[1]) if x)
    return "```" if re.fullmatch(r"</?(?:pre|code)>", s, re.I) else s if s.startswith("```") else None


def _table(s: str) -> str | None:
    if re.fullmatch(r"\|?[-:| ]{3,}\|?|\{\|.*|\|\}|\|-.*|\\(?:begin|end)\{tabular\}.*|</?(?:table|tbody|thead|tr)[^>]*>", s):
        return None
    if re.search(r"<t[drh]\b", s, re.I):
        rows = [[_inline(c).strip() for c in re.split(r"<t[dh][^>]*>", r, flags=re.I)[1:]] for r in re.split(r"<tr[^>]*>", s, flags=re.I)]
        return "\n".join(" | ".join(r) for r in rows if r)
    if m := re.match(r"!\s*(.*)", s):
        return _bar(m[1].split("!!"))
    if m := re.match(r"\|\s*(.*\|\|.*)", s):
        return _bar(m[1].split("||"))
    if m := re.fullmatch(r"\|(.*)\|", s):
        return _bar(m[1].split("|"))
    return _inline(s).strip("\n")


def _formula(s: str) -> str | None:
    if m := re.match(r"\\begin\{(?:equation|align)\*?\}(.+?)\\end\{(?:equation|align)\*?\}(.*)", s):
        return f"$ {_decode(m[1]).strip()} ${_inline(m[2])}"
    if re.fullmatch(r"\\(?:begin|end)\{(?:equation|align)\*?\}|\$\$", s):
        return "$$"
    return None


def _noise(s: str) -> str | None:
    left = re.sub(r"<!--.*?-->|<(script|style)\b.*?</\1>", "", s, flags=re.S | re.I)
    return _inline(left).strip("\n") if left.strip() else None


def _plain_text(s: str) -> str | None:
    """Inline marks off; what they held may be a heading or an item of its own."""
    t = _inline(s).strip("\n")
    if t.lstrip().startswith("\\begin{equation}"):
        return _formula(t.strip()) or t
    if re.match(r"\s*(?:={1,6}\s?[^=]|\\(?:sub)*(?:section|chapter)\b)", t):
        return _heading(t.strip())
    return _list(t.strip()) if re.match(r"\s*\\item\b", t) else t


#: Renderer of each class; code and formula return None for a line that stays as it is.
RENDER = {HEADING: _heading, LIST: _list, CODE: _code, TABLE: _table, FORMULA: _formula, INLINE: _plain_text, NOISE: _noise}


def render_block(t: str, y: int) -> str | None:
    """Clean text of a block of class y; None drops it. Lines of code and formulas stay byte for byte."""
    if y == PLAIN:
        return t
    got = RENDER[y](t if y == INLINE else t.strip())
    return t if got is None and y in (CODE, FORMULA) else got


def clean_lines(lines: list[str], classes: np.ndarray) -> tuple[str, int]:
    """(clean text, number of blocks with markup). A heading without a mark of its own is one by the rule below it."""
    out, n = [], 0
    for i, (line, y) in enumerate(zip(lines, classes)):
        n += y != PLAIN
        got = render_block(line, int(y))
        if y == HEADING and got is not None and got == line and i + 1 < len(lines) and re.fullmatch(r"\s*={3,}\s*", lines[i + 1]):
            got = "# " + line.strip()
        if got is not None:
            out.append(got)
    return "\n".join(out), n


# ---- Spark ----


def table_strings(tables: Column) -> Column:
    """All different headers, cells and notes of a chunk's tables, as one array of strings."""
    cells = lambda t: F.flatten(F.transform(F.coalesce(t["rows"], F.array()), lambda r: F.concat(F.map_keys(r), F.transform(F.map_values(r), lambda c: c["s"]))))
    leaves = F.flatten(F.transform(tables, lambda t: F.concat(F.coalesce(t["headers"], F.array()), cells(t), F.coalesce(t["notes_in_table"], F.array()))))
    return F.array_distinct(F.array_compact(leaves))


def clean_chunks(df: DataFrame, key: str = "chunk_id", text: str = "text", tables: str = "tables") -> DataFrame:
    """(key, text, tables, text_blocks, table_blocks) with clean text and tables; other columns are left out.

    The work on nested tables is done in the JVM from a map of the strings that change. Two headers may
    become equal when clean, so a row of a table is an array of entries instead of a map.
    """
    got = label_blocks(df, key, text, tables, keep_tables=True)
    fix = lambda x: F.coalesce(F.element_at(F.col("fixes"), x), x)
    row = lambda r: F.transform(F.map_entries(r), lambda e: F.struct(fix(e["key"]).alias("header"), fix(e["value"]["s"]).alias("s"), e["value"]["n"].alias("n")))
    table = lambda t: t.withField("headers", F.transform(t["headers"], fix)).withField("notes_in_table", F.transform(t["notes_in_table"], fix)).withField("rows", F.transform(t["rows"], row))
    return got.select(key, F.col("clean_text").alias(text), F.when(F.size("fixes") >= 0, F.transform(tables, table)).alias(tables), "text_blocks", "table_blocks")


def label_blocks(df: DataFrame, key: str = "chunk_id", text: str = "text", tables: str = "tables", render: bool = True, keep_tables: bool = False) -> DataFrame:
    """(key, text_blocks, table_blocks, clean_text, fixes): numbers of blocks with markup, the clean text, and
    a map from each table string with markup to its clean form. Without ``render`` the last two are left out;
    ``keep_tables`` carries the tables along."""
    rows = df.select(F.col(key).cast("string").alias("k"), F.col(text).alias("t"), F.coalesce(table_strings(F.col(tables)), F.array()).alias("s"), *([F.col(tables).alias("tb")] if keep_tables else []))
    shared = df.sparkSession.sparkContext.broadcast(labeller().p)  # fixed size, some 200 KB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, f = BiLSTM(1, HIDDEN, len(CLASSES)), Features()
        model.p = shared.value
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                b = whole.slice(at, 1000)
                texts, strings = b.column(1).to_pylist(), b.column(2).to_pylist()
                lines = [t.split("\n") if t else [] for t in texts]
                a = classify(model, f, lines)
                # line breaks inside a cell are part of its block
                c = classify(model, f, strings)
                nt, ns, clean, fixes = [], [], [], []
                for t, ls, ya, ss, yc in zip(texts, lines, a, strings, c):
                    if render:
                        got, n = clean_lines(ls, ya)
                        clean.append(got if t else t)
                    else:
                        n = int((ya > 0).sum())
                    hits = np.nonzero(yc)[0]
                    nt.append(n)
                    ns.append(len(hits))
                    if render:
                        fixes.append([(ss[i], render_block(ss[i], int(yc[i])) or "") for i in hits])
                cols = [b.column(0), pa.array(nt, pa.int32()), pa.array(ns, pa.int32())]
                names = ["k", "text_blocks", "table_blocks"]
                if render:
                    cols += [pa.array(clean, pa.string()), pa.array(fixes, pa.map_(pa.string(), pa.string()))]
                    names += ["clean_text", "fixes"]
                if keep_tables:
                    cols.append(b.column(3))
                    names.append(tables)
                yield pa.RecordBatch.from_arrays(cols, names)

    out = "k string, text_blocks int, table_blocks int" + (", clean_text string, fixes map<string,string>" if render else "")
    if keep_tables:
        out += f", `{tables}` " + rows.schema["tb"].dataType.simpleString()
    return spread(rows).mapInArrow(run, out).withColumnRenamed("k", key)
