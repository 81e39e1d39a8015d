"""Encoding of a corpus with a public byte-level BPE through a minimal acyclic transducer.

A word is what the tokenizer's own pattern splits off.  Frequent words are compiled with their
ids into a minimal acyclic automaton with shared suffixes; a word's number is the sum of the
offsets on its path (so equal suffixes share states although their outputs differ), and the
number points to its ids.  The automaton is one flat file which the workers memory-map.
Words that are not in it are merged exactly, pair by pair, in order of rank.
"""

from __future__ import annotations

import base64
import heapq
import io
import json
import mmap
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stenoloom.operators.order import spread
from stenoloom.plans.durable import shared_file

# Fixed value: how byte_bpe_50k splits a text into words (public byte-level BPE pattern).
SPLIT = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@lru_cache(maxsize=1)
def _pattern():
    import regex

    return regex.compile(SPLIT)


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and rank, which is the id, of a ranks file."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def merge(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one word by exact byte-pair merging: the lowest rank first, of equals the leftmost.

    A heap over the pairs keeps it O(n log n), so a text without any word boundary does no harm.
    """
    if (whole := ranks.get(word)) is not None:
        return [whole]
    n = len(word)
    end = list(range(1, n + 1))  # of the piece that starts here
    before = list(range(-1, n - 1))
    alive = [True] * n
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(word[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        if not alive[i] or (j := end[i]) >= n or end[j] != stop:
            continue
        alive[j] = False
        end[i] = stop
        if stop < n:
            before[stop] = i
            if (r := ranks.get(word[i : end[stop]])) is not None:
                heapq.heappush(heap, (r, i, end[stop]))
        if (p := before[i]) >= 0 and (r := ranks.get(word[p:stop])) is not None:
            heapq.heappush(heap, (r, p, stop))
    return [ranks[word[i : end[i]]] for i in range(n) if alive[i]]


class Transducer:
    """Minimal acyclic automaton over byte strings, numbering them in byte order."""

    FIELDS = ("first", "count", "final", "label", "target", "offset", "start", "ids")

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.__dict__.update(arrays)
        #: (state, byte) of every edge as one sorted key
        n = np.repeat(np.arange(len(self.count), dtype=np.int64), self.count)
        self.key = n * 256 + self.label

    @classmethod
    def compile(cls, words: list[bytes], ids: list[list[int]]) -> Transducer:
        """``words`` distinct and sorted; states with equal futures are shared as words are added."""
        register: dict[tuple, int] = {}
        finals: list[bool] = []
        edges: list[tuple] = []
        size: list[int] = []
        path: list[tuple[list, list]] = [([], [False])]  # unfinished states: (edges, [final])

        def close(depth: int) -> None:
            while len(path) > depth + 1:
                out, (final,) = path.pop()
                sig = (final, tuple(out))
                if (s := register.get(sig)) is None:
                    s = register[sig] = len(finals)
                    finals.append(final)
                    edges.append(sig[1])
                    size.append(final + sum(size[t] for _, t in sig[1]))
                path[-1][0][-1] = (path[-1][0][-1][0], s)

        last = b""
        for w in words:
            k = 0
            while k < min(len(w), len(last)) and w[k] == last[k]:
                k += 1
            close(k)
            for b in w[k:]:
                path[-1][0].append((b, -1))
                path.append(([], [False]))
            path[-1][1][0] = True
            last = w
        close(0)
        out, (final,) = path[0]
        finals.append(final)
        edges.append(tuple(out))
        first, count, label, target, offset = [], [], [], [], []
        for final, es in zip(finals, edges):
            first.append(len(label))
            count.append(len(es))
            at = int(final)
            for b, t in es:
                label.append(b)
                target.append(t)
                offset.append(at)
                at += size[t]
        flat = np.array([x for i in ids for x in i], np.int32)
        arrays = dict(
            first=np.array(first, np.int64), count=np.array(count, np.int64), final=np.array(finals, bool),
            label=np.array(label, np.int64), target=np.array(target, np.int64), offset=np.array(offset, np.int64),
            start=np.concatenate([[0], np.cumsum([len(i) for i in ids])]).astype(np.int64), ids=flat)
        return cls(arrays)

    def dump(self) -> bytes:
        """One flat file: a length-prefixed JSON header, then the arrays on 64-byte bounds."""
        body, head = io.BytesIO(), {}
        for f in self.FIELDS:
            a = getattr(self, f)
            body.write(b"\0" * (-body.tell() % 64))
            head[f] = (a.dtype.str, len(a), body.tell())
            body.write(a.tobytes())
        h = json.dumps(head).encode()
        h += b" " * (-(len(h) + 8) % 64)
        return len(h).to_bytes(8, "little") + h + body.getvalue()

    @classmethod
    def map(cls, path: str) -> Transducer:
        """Memory-map a dumped transducer; nothing but the edge keys is copied."""
        with open(path, "rb") as f:
            m = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        n = int.from_bytes(m[:8], "little")
        head = json.loads(m[8 : 8 + n])
        return cls({k: np.frombuffer(m, np.dtype(t), c, 8 + n + at) for k, (t, c, at) in head.items()})

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """The number of each word, -1 for words outside; all words walk one byte at a time together."""
        lengths = np.array([len(w) for w in words], np.int64)
        number = np.zeros(len(words), np.int64)
        if not len(words) or not len(self.key):
            return number - 1
        data = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
        begin = np.cumsum(lengths) - lengths
        state = np.full(len(words), len(self.final) - 1, np.int64)
        live = np.arange(len(words))
        at = 0
        while True:
            done = live[lengths[live] == at]
            number[done[~self.final[state[done]]]] = -1
            live = live[lengths[live] > at]
            if not len(live):
                return number
            want = state[live] * 256 + data[begin[live] + at]
            edge = np.minimum(np.searchsorted(self.key, want), len(self.key) - 1)
            hit = self.key[edge] == want
            number[live[~hit]] = -1
            live, edge = live[hit], edge[hit]
            number[live] += self.offset[edge]
            state[live] = self.target[edge]
            at += 1


def word_counts(docs: DataFrame, text: str) -> DataFrame:
    """(word BINARY, n) of the whole collection; each Arrow batch is counted before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from collections import Counter

        find = _pattern().findall
        for b in batches:
            c = Counter()
            for t in b.column(0).to_pylist():
                if t:
                    c.update(find(t))
            yield pa.RecordBatch.from_arrays([pa.array([w.encode() for w in c], pa.binary()), pa.array(list(c.values()), pa.int64())], ["word", "n"])

    return spread(docs.select(text)).mapInArrow(count, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def build_lexicon(docs: DataFrame, text: str, ranks: dict[bytes, int], size: int = 60_000, longest: int = 40) -> Transducer:
    """Compile the ``size`` most frequent words of all of ``docs`` (of equals the smaller bytes).

    The lexicon only decides which words take the quick way; ids do not depend on it.  Its size
    is bounded by the two parameters, so it can be compiled on the driver.
    """
    top = word_counts(docs, text).where(F.length("word") <= longest).orderBy(F.desc("n"), "word").limit(size).select("word")
    words = sorted(bytes(r[0]) for r in top.collect())
    return Transducer.compile(words, [merge(w, ranks) for w in words])


_worker: dict = {}


def encode(docs: DataFrame, key: str, text: str, vocabulary: str, lexicon_size: int = 60_000) -> DataFrame:
    """(key, ids ARRAY<INT>) of every row of ``docs``, by the ranks file at path ``vocabulary``.

    No special tokens are added and their strings in a text are ordinary text.  Null and empty
    texts have no ids, that is an empty list.  Every row gives one row, repeated ones too; a
    null key stays null; other columns are not read.  ``vocabulary`` is read on the driver and
    handed to the workers as a file, as is the transducer.
    """
    spark = docs.sparkSession
    with open(vocabulary, "rb") as f:
        raw = f.read()
    ranks = read_ranks(vocabulary)
    ranks_file = shared_file(spark, raw, "ranks")
    lexicon_file = shared_file(spark, build_lexicon(docs, text, ranks, lexicon_size).dump(), "lexicon")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if lexicon_file not in _worker:
            _worker.clear()
            _worker[lexicon_file] = Transducer.map(SparkFiles.get(lexicon_file)), {}
        lexicon, rare = _worker[lexicon_file]
        find = _pattern().findall
        for b in batches:
            number: dict[str, int] = {}
            sequence, per_doc = [], []
            for t in b.column(1).to_pylist():
                words = find(t) if t else []
                per_doc.append(len(words))
                for w in words:
                    sequence.append(number.setdefault(w, len(number)))
            words = [w.encode() for w in number]
            found = lexicon.numbers(words)
            unseen = np.flatnonzero(found < 0)
            extra, merged = {}, []
            for i in unseen:
                if not rare:
                    rare["ranks"] = read_ranks(SparkFiles.get(ranks_file))
                extra[i] = merge(words[i], rare["ranks"])
            # ids of the distinct words of this batch, then of their sequence, by offsets
            lens = np.where(found < 0, 0, lexicon.start[found + 1] - lexicon.start[np.maximum(found, 0)])
            for i, ids in extra.items():
                lens[i] = len(ids)
                merged += ids
            begin = lexicon.start[np.maximum(found, 0)].copy()
            if len(unseen):
                begin[unseen] = len(lexicon.ids) + np.cumsum(lens[unseen]) - lens[unseen]
            pool = np.concatenate([lexicon.ids, np.array(merged, np.int32)])
            seq = np.array(sequence, np.int64)
            n, at = lens[seq], begin[seq]
            ends = np.cumsum(n)
            take = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - n, n) + np.repeat(at, n)
            doc_end = np.concatenate([[0], ends])[np.cumsum([0, *per_doc])]
            ids = pa.ListArray.from_arrays(pa.array(doc_end, pa.int32()), pa.array(pool[take], pa.int32()))
            yield pa.RecordBatch.from_arrays([b.column(0), ids], names=[key, "ids"])

    of_key = docs.select(key).schema[0].dataType.simpleString()
    return spread(docs.select(key, text)).mapInArrow(run, f"`{key}` {of_key}, ids array<int>")
