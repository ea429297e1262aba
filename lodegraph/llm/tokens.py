"""Exact encoding of a corpus with a public byte-level BPE vocabulary.

The frequent words of the corpus (counted over all documents) are compiled, with their id sequences, into a
minimal acyclic transducer: a shared-suffix automaton over bytes whose arcs add up to the word's number, laid
out as flat sorted arrays that every worker memory-maps. Words it does not know are merged exactly from the
vocabulary's ranks, so the result never depends on the lexicon.

Defined results: an empty and a null text have no ids (an empty list); strings of special tokens in a text
are ordinary text.
"""

from __future__ import annotations

import base64
import heapq
import io
import os
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession, functions as F

from lodegraph.plans.session import scratch, spread, write_bytes

#: Where the public vocabulary files lie, on the driver and on every executor.
TOKENIZERS = os.environ.get("LODEGRAPH_TOKENIZERS", "/opt/tokenizers")
VOCABULARY = "byte_bpe_50k.tiktoken"
# Fixed value: the vocabulary's published rule for cutting a text into words.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Words in the lexicon at most; a speed parameter without influence on results.
LEXICON_WORDS = 40_000
#: Pieces of text a worker remembers before it starts anew; bounds its memory.
MEMO_WORDS = 300_000

_STATE: dict = {}


def splitter():
    if "split" not in _STATE:
        import regex

        _STATE["split"] = regex.compile(PATTERN).findall
    return _STATE["split"]


def ranks(path: str) -> dict[bytes, int]:
    if ("ranks", path) not in _STATE:
        with open(path, "rb") as f:
            _STATE["ranks", path] = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f) if a}
    return _STATE["ranks", path]


def merge(word: bytes, rank: dict[bytes, int]) -> list[int]:
    """Byte-pair merges of one word, lowest rank first, leftmost among equals."""
    if (whole := rank.get(word)) is not None:
        return [whole]
    n = len(word)
    end = list(range(1, n + 1))  # end of the part that starts at i
    prev = list(range(-1, n - 1))
    dead = bytearray(n)
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := rank.get(word[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        j = end[i] if not dead[i] else n
        if dead[i] or j >= n or end[j] != stop:
            continue  # one of the two parts has changed since
        dead[j], end[i] = 1, stop
        if stop < n:
            prev[stop] = i
            if (r := rank.get(word[i : end[stop]])) is not None:
                heapq.heappush(heap, (r, i, end[stop]))
        if (p := prev[i]) >= 0 and (r := rank.get(word[p:stop])) is not None:
            heapq.heappush(heap, (r, p, stop))
    out, i = [], 0
    while i < n:
        out.append(rank[word[i : end[i]]])
        i = end[i]
    return out


def compile_lexicon(words: dict[bytes, list[int]]) -> bytes:
    """The minimal automaton of ``words`` as one npz: arcs (sorted keys state*256+byte, target, add), final, ids.

    Words are added in byte order; when a word leaves a branch, the branch is final and each of its states is
    replaced by an equal one met before. ``add`` of an arc is the number of words on the arcs before it, so a
    path's sum is the word's place in order.
    """
    order = sorted(w for w in words if w)
    register: dict[tuple, int] = {}
    frozen: list[tuple[bool, tuple[tuple[int, int], ...]]] = []

    def freeze(node: list) -> int:
        sig = (node[0], tuple(node[1]))
        if sig not in register:
            register[sig] = len(frozen)
            frozen.append(sig)
        return register[sig]

    path: list[list] = [[False, []]]  # open states from the root: [final, arcs (byte, state)]
    last = b""
    for w in [*order, None]:
        same = 0
        if w is not None:
            while same < min(len(w), len(last)) and w[same] == last[same]:
                same += 1
        while len(path) - 1 > same:
            node = path.pop()
            path[-1][1].append((last[len(path) - 1], freeze(node)))
        if w is not None:
            path += [[False, []] for _ in range(len(w) - same)]
            path[-1][0] = True
            last = w
    root = freeze(path[0])
    below = np.zeros(len(frozen), np.int64)
    keys, target, add = [], [], []
    for s, (final, arcs) in enumerate(frozen):  # targets come before their sources
        n = int(final)
        for byte, t in arcs:
            keys.append(s * 256 + byte)
            target.append(t)
            add.append(n)
            n += below[t]
        below[s] = n
    k = np.asarray(keys, np.int64)
    o = np.argsort(k)
    lists = [words[w] for w in order]
    head = np.array([root, len(o), len(frozen), len(lists)], np.int64)
    start = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int64) if lists else np.zeros(1, np.int64)
    flat = np.array([i for x in lists for i in x], np.int64)
    parts = [head, k[o], np.asarray(target, np.int64)[o], np.asarray(add, np.int64)[o], np.array([f for f, _ in frozen], np.int64), start, flat]
    buf = io.BytesIO()
    np.save(buf, np.concatenate(parts).astype(np.int64))
    return buf.getvalue()


class Lexicon:
    """A compiled lexicon over a memory-mapped file."""

    def __init__(self, path: str):
        a = np.load(path, mmap_mode="r")
        self.root, arcs, states, words = (int(x) for x in a[:4])
        cuts = np.cumsum([4, arcs, arcs, arcs, states, words + 1])
        self.keys, self.target, self.add, self.final, self.start = (a[i:j] for i, j in zip(cuts[:-1], cuts[1:]))
        self.ids = a[cuts[-1] :]

    def find(self, words: list[bytes]) -> list[list[int] | None]:
        """All words walk the automaton in step, a byte at a time."""
        out: list[list[int] | None] = [None] * len(words)
        if not words or not len(self.keys):
            return out
        flat = np.frombuffer(b"".join(words), np.uint8)
        size = np.array([len(w) for w in words])
        first = np.cumsum(size) - size
        live = np.nonzero(size)[0]
        state, number, pos = np.full(len(live), self.root), np.zeros(len(live), np.int64), 0
        while len(live):
            key = state * 256 + flat[first[live] + pos]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            ok = self.keys[at] == key
            live, at = live[ok], at[ok]
            state, number, pos = self.target[at], number[ok] + self.add[at], pos + 1
            done = size[live] == pos
            for w, s, x in zip(live[done], state[done], number[done]):
                if self.final[s]:
                    out[w] = self.ids[self.start[x] : self.start[x + 1]].tolist()
            live, state, number = live[~done], state[~done], number[~done]
        return out


#: White space beside a blank: such a text is cut by the word rule itself.
_UNSAFE = re.compile(r" \s|\s ")


class _Places(dict):
    """Unit to number; a unit met for the first time gets the next one and waits to be learnt."""

    def __init__(self, lead: str, waiting: list[str], first: list[int]):
        super().__init__()
        self.lead, self.waiting, self.next = lead, waiting, first

    def __missing__(self, unit: str) -> int:
        n = self[unit] = self.next[0]
        self.next[0] += 1
        self.waiting.append(self.lead + unit)
        return n


class Encoder:
    """Texts to ids; what it learnt stays in the worker as flat arrays of ids.

    No word reaches over a blank between two other characters, and a word that follows one starts with it. So
    a text without white space beside a blank is cut at its blanks, and each piece is encoded by itself, once.
    """

    def __init__(self, vocabulary: str, lexicon: str | None):
        self.rank, self.lex, self.split = ranks(vocabulary), Lexicon(lexicon) if lexicon else None, splitter()
        self._forget()

    def _forget(self) -> None:
        self.waiting: list[str] = []
        self.next = [0]
        self.bare, self.after = _Places("", self.waiting, self.next), _Places(" ", self.waiting, self.next)
        self.start, self.size, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)

    def _learn(self) -> None:
        cut = [self.split(u) for u in self.waiting]
        words = list({w for ws in cut for w in ws})
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        known = self.lex.find(raw) if self.lex else [None] * len(raw)
        ids = {w: merge(b, self.rank) if i is None else i for w, b, i in zip(words, raw, known)}
        new = [[i for w in ws for i in ids[w]] for ws in cut]
        size = np.fromiter(map(len, new), np.int64, len(new))
        self.start = np.concatenate([self.start, len(self.ids) + np.cumsum(size) - size])
        self.size = np.concatenate([self.size, size])
        self.ids = np.concatenate([self.ids, np.fromiter((i for x in new for i in x), np.int32, int(size.sum()))])
        self.waiting.clear()

    def _words(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(number of every unit, units of each text)."""
        if self.next[0] > MEMO_WORDS:
            self._forget()
        bare, after = self.bare.__getitem__, self.after.__getitem__
        out: list[int] = []
        counts = np.zeros(len(texts), np.int64)
        for i, t in enumerate(texts):
            if not t:
                continue
            n = len(out)
            if _UNSAFE.search(t):
                out.extend(map(bare, self.split(t)))
            else:
                parts = t.split(" ")
                out.append(bare(parts[0]))
                out.extend(map(after, parts[1:]))
            counts[i] = len(out) - n
        if self.waiting:
            self._learn()
        return np.array(out, np.int64), counts

    def encode(self, texts: list[str | None]) -> pa.ListArray:
        words, counts = self._words(texts)
        size = self.size[words]
        ends = np.concatenate([[0], np.cumsum(size)])
        # place of every id: its word's first id plus its place within the word
        flat = self.ids[np.arange(ends[-1]) + np.repeat(self.start[words] - ends[:-1], size)]
        offsets = ends[np.concatenate([[0], np.cumsum(counts)])]
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int32()))

    def sizes(self, texts: list[str | None]) -> pa.Array:
        words, counts = self._words(texts)
        ends = np.concatenate([[0], np.cumsum(self.size[words])])
        at = np.concatenate([[0], np.cumsum(counts)])
        return pa.array(ends[at[1:]] - ends[at[:-1]], pa.int32())


def encoder(vocabulary: str, lexicon: str | None) -> Encoder:
    """The worker's encoder."""
    if (vocabulary, lexicon) not in _STATE:
        _STATE[vocabulary, lexicon] = Encoder(vocabulary, lexicon)
    return _STATE[vocabulary, lexicon]


#: Texts encoded at a time; bounds a worker's memory.
TEXTS = 1000


def word_counts(df: DataFrame, text: str) -> DataFrame:
    """(word, n) over all texts; each task counts for itself first, in bounded memory. White space between words
    is not counted, which only matters for what the lexicon holds."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, pieces = splitter(), Counter()

        def flush():
            c = Counter()
            for p, n in pieces.items():
                for w in split(" " + p):
                    c[w] += n
            pieces.clear()
            return pa.RecordBatch.from_pydict({"word": pa.array([w.encode("utf-8", "surrogatepass") for w in c], pa.binary()), "n": pa.array(list(c.values()), pa.int64())})

        for b in batches:
            for t in b.column(0).to_pylist():
                # pieces between blanks are counted first and cut into words once each
                pieces.update(t.split(" "))
            if len(pieces) > MEMO_WORDS:
                yield flush()
        if pieces:
            yield flush()

    return df.select(text).filter(F.length(text) > 0).mapInArrow(count, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def build_lexicon(df: DataFrame, text: str, vocabulary: str, words: int = LEXICON_WORDS) -> str:
    """Count words, take the most frequent, compile them, hand the file to all executors; its name."""
    spark = df.sparkSession
    top = word_counts(df, text).filter("n > 1 and length(word) <= 64").orderBy(F.desc("n"), "word").limit(words).select("word").collect()
    rank = ranks(vocabulary)
    data = compile_lexicon({bytes(r.word): merge(bytes(r.word), rank) for r in top})
    path = write_bytes(spark, scratch(spark, "lexicon") + ".npy", data)
    spark.sparkContext.addFile(path)
    return path.rsplit("/", 1)[1]


def vocabulary_path(folder: str | None = None, name: str = VOCABULARY) -> str:
    return os.path.join(folder or TOKENIZERS, name)


def encode_ids(df: DataFrame, key: str = "doc_id", text: str = "text", folder: str | None = None, words: int = LEXICON_WORDS) -> DataFrame:
    """(key, ids array<int>) for every row."""
    vocab = vocabulary_path(folder)
    name = build_lexicon(df, text, vocab, words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(vocab, SparkFiles.get(name))
        for whole in batches:
            for b in (whole.slice(i, TEXTS) for i in range(0, whole.num_rows, TEXTS)):
                yield pa.RecordBatch.from_arrays([b.column(0), e.encode(b.column(1).to_pylist())], [key, "ids"])

    rows = spread(df.select(key, text))
    return rows.mapInArrow(run, f"`{key}` {dict(rows.dtypes)[key]}, ids array<int>")


def encode_sizes(df: DataFrame, key: str, text: str, folder: str | None = None, words: int = LEXICON_WORDS) -> DataFrame:
    """(key, n_tokens int); a null or empty text has 0."""
    vocab = vocabulary_path(folder)
    name = build_lexicon(df, text, vocab, words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(vocab, SparkFiles.get(name))
        for whole in batches:
            for b in (whole.slice(i, TEXTS) for i in range(0, whole.num_rows, TEXTS)):
                yield pa.RecordBatch.from_arrays([b.column(0), e.sizes(b.column(1).to_pylist())], [key, "n_tokens"])

    rows = spread(df.select(key, text))
    return rows.mapInArrow(run, f"`{key}` {dict(rows.dtypes)[key]}, n_tokens int")
