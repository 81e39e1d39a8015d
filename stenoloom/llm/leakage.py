"""Evaluation texts leaking into training text: a prefix-filtered set join with exact windows."""

from __future__ import annotations

import io
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stenoloom.llm.words import combined, word_hashes, words
from stenoloom.operators.order import spread
from stenoloom.plans.durable import shared_file

#: Places of the words of a seed.  Texts and items have both kinds under one hash, so a seed
#: also meets across a word put in or left out.
SEEDS = ((0, 1, 2), (0, 1, 3))
#: Items below so many words have to stand in the text whole and unchanged.
WHOLE = 5
#: Words between two seeds of one passage, at most: two lone words, each between differing ones.
REACH = 8
_worker: dict = {}

#: What speech records insert into a text: short notes in brackets or stars, times, hesitation sounds.
_INSERTED = regex.compile(
    r"\[[^\[\]\n]{0,40}\]|\([^()\n]{0,40}\)|\{[^{}\n]{0,40}\}|<[^<>\n]{0,40}>|\*[^*\n]{1,40}\*"
    r"|\b\d{1,3}[:.]\d\d(?:[:.]\d\d)?(?:[.,]\d{1,3})?(?!\w)(?:\s*-->)?(?:\s*[ap]\.?m\b\.?)?|\b(?:uh+|um+|uhm+|er+|erm+|err+|ah+|hm+|mm+)\b", regex.I)
_INVISIBLE = regex.compile(r"[­​⁠﻿]")


def passage_words(text: str) -> list[str]:
    """Words of ``text`` without inserted marks; of a text that is nothing but marks, all its words."""
    text = _INVISIBLE.sub("", text)
    return words(_INSERTED.sub(" ", text)) or words(text)


def seed_hashes(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, places) of the seeds of a text whose words hash to ``h``, in order of place."""
    keys, at = [], []
    for shape in SEEDS:
        n = len(h) - shape[-1]
        if n > 0:
            keys.append(combined([h[k : k + n] for k in shape]))
            at.append(np.arange(n))
    if not keys:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    key, place = np.concatenate(keys), np.concatenate(at)
    order = np.argsort(place, kind="stable")
    return key[order], place[order]


def least_seeds(m: np.ndarray, share: float) -> np.ndarray:
    """Seeds that every passage of ``share`` of ``m`` words keeps when every third word differs."""
    return np.maximum(1, (np.ceil(share * m).astype(np.int64) - 1) // 3)


class ItemIndex:
    """Seeds of items with their places, and of each item its necessary prefix once seeds are ranked."""

    FIELDS = ("tokens", "offset", "keys", "start", "item", "pos", "prefix", "short", "short_item")

    def __init__(self, share: float, **arrays: np.ndarray):
        self.share = share
        for name in self.FIELDS:
            setattr(self, name, arrays[name])
        self.lengths = np.diff(self.offset)
        self.need = least_seeds(self.lengths, share)
        self.sizes = sorted(set(self.lengths[self.short_item].tolist()))

    @classmethod
    def build(cls, texts: list[str], share: float) -> ItemIndex:
        hashed = [word_hashes(passage_words(t)) for t in texts]
        offset = np.append(0, np.cumsum([len(h) for h in hashed])).astype(np.int64)
        short = [(int(combined(list(h.reshape(-1, 1)))[0]), k) for k, h in enumerate(hashed) if 0 < len(h) < WHOLE]
        seeds = [seed_hashes(h) if len(h) >= WHOLE else seed_hashes(h[:0]) for h in hashed]
        join = lambda parts, kind: np.concatenate(parts).astype(kind) if parts else np.zeros(0, kind)
        flat, pos = join([s[0] for s in seeds], np.uint64), join([s[1] for s in seeds], np.int32)
        item = np.repeat(np.arange(len(seeds), dtype=np.int32), [len(s[0]) for s in seeds])
        order = np.argsort(flat, kind="stable")
        keys, first = np.unique(flat[order], return_index=True)
        return cls(share, tokens=join(hashed, np.uint64), offset=offset, keys=keys, start=np.append(first, len(flat)).astype(np.int64), item=item[order], pos=pos[order],
                   prefix=np.ones(len(flat), bool), short=np.array([s for s, _ in short], np.uint64), short_item=np.array([k for _, k in short], np.int64))

    def rank(self, freq: np.ndarray) -> None:
        """Mark of each item its rarest seeds but need - 1, by the corpus frequency of each key.

        A text with ``need`` seeds of an item holds at least one of them.
        """
        of = np.repeat(freq, np.diff(self.start))
        order = np.lexsort((self.pos, of, self.item))
        n = np.bincount(self.item, minlength=len(self.lengths))
        at = np.arange(len(of)) - (np.cumsum(n) - n)[self.item[order]]
        self.prefix = np.zeros(len(of), bool)
        self.prefix[order[at < (n - self.need + 1)[self.item[order]]]] = True

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, share=self.share, **{k: getattr(self, k) for k in self.FIELDS})
        return out.getvalue()

    @classmethod
    def load(cls, path: str) -> ItemIndex:
        with np.load(path) as z:
            return cls(float(z["share"]), **{k: z[k] for k in cls.FIELDS})

    def hits(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in ``keys``, number of the key) of those any item has."""
        if not len(self.keys) or not len(keys):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        k = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        at = np.flatnonzero(self.keys[k] == keys)
        return at, k[at]

    def _postings(self, k: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(postings of the keys ``k`` one after the other, how many each has)."""
        n = self.start[k + 1] - self.start[k]
        ends = np.cumsum(n)
        return np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.start[k] - ends + n, n), n

    def leaked(self, h: np.ndarray, keys: np.ndarray, places: np.ndarray) -> list[int]:
        """Numbers of the items of which the text of words ``h`` holds a large enough passage."""
        out = [int(x) for size in self.sizes if size <= len(h) for x in self._whole(h, size)]
        at, k = self.hits(keys)
        if not len(at):
            return out
        post, n = self._postings(k)
        item = self.item[post]
        # prefix filter, then the bounds on shared seeds and on length
        candidate = np.zeros(len(self.lengths), bool)
        candidate[item[self.prefix[post]]] = True
        candidate &= np.bincount(item, minlength=len(self.lengths)) >= self.need
        candidate &= np.ceil(self.lengths * self.share) * 2 <= 3 * len(h)
        keep = candidate[item]
        item, pos, place = item[keep], self.pos[post[keep]], np.repeat(places[at], n)[keep]
        if not len(item):
            return out
        # positional bound: seeds near each other in the text, far enough apart in all
        order = np.argsort(item, kind="stable")
        item, pos, place = item[order], pos[order], place[order]
        begins = np.flatnonzero((np.diff(item, prepend=-1) != 0) | (np.diff(place, prepend=place[0]) > REACH + 3))
        ends = np.append(begins[1:], len(item))
        least = self.share * self.lengths[item[begins]]
        far = place[ends - 1] + 4 - place[begins] >= least * 2 / 3
        far &= np.maximum.reduceat(pos, begins) + 4 - np.minimum.reduceat(pos, begins) >= least * 2 / 3
        far &= ends - begins >= self.need[item[begins]]
        found: set[int] = set()
        for a, z in zip(begins[far].tolist(), ends[far].tolist()):
            x = int(item[a])
            if x not in found and len(np.unique(pos[a:z])) >= self.need[x]:
                own = self.tokens[self.offset[x] : self.offset[x + 1]].tolist()
                near = h[max(0, place[a] - REACH) : place[z - 1] + 4 + REACH].tolist()
                # words in common, in whatever order, bound those of a passage
                if (Counter(own) & Counter(near)).total() >= self.share * len(own) and longest_passage(own, near) >= self.share * len(own):
                    found.add(x)
        return out + sorted(found)

    def _whole(self, h: np.ndarray, size: int) -> np.ndarray:
        of_size = self.lengths[self.short_item] == size
        n = len(h) - size + 1
        return self.short_item[of_size][np.isin(self.short[of_size], combined([h[k : k + n] for k in range(size)]))]


def longest_passage(item: list[int], text: list[int]) -> int:
    """Words of ``item`` that its longest passage in ``text`` holds, those that differ not counted.

    A passage goes through equal words in the order of both.  Between two of them one word may
    differ, be put in or be left out; two may between runs of three equal words.  Passages of
    which fewer than two thirds of the item's words are equal don't count.
    """
    where: dict[int, list[int]] = defaultdict(list)
    for j, w in enumerate(text):
        where[w].append(j)
    run: dict[tuple[int, int], int] = {}  # equal words in a row up to here
    for i, w in enumerate(item):
        for j in where.get(w, ()):
            run[i, j] = run.get((i - 1, j - 1), 0) + 1
    best: dict[tuple[int, int], tuple[int, int]] = {}  # (equal words, first place)
    longest = 0
    for i, j in run:
        top = (0, i)
        begins = (i + 1, j + 1) in run and (i + 2, j + 2) in run
        for di in (1, 2, 3):
            for dj in (1, 2, 3):
                before = best.get((i - di, j - dj))
                if before and before > top and (max(di, dj) < 3 or begins and run[i - di, j - dj] >= 3):
                    top = before
        top = (top[0] + 1, top[1])
        best[i, j] = top
        if top[0] > longest and 3 * top[0] >= 2 * (i - top[1] + 1):
            longest = top[0]
    return longest


def leaks(docs: DataFrame, doc_key: str, doc_text: str, items: DataFrame, item_key: str, item_text: str, share: float = 0.5, block: int = 2_000_000) -> DataFrame:
    """(doc_key, item_key): documents that hold an item's text or a connected passage of at
    least ``share`` of its words.

    Case, punctuation, spacing, line breaks and inserted marks (short notes in brackets, times,
    hesitation sounds) don't matter.  A passage is connected in the item and in the document:
    single words may differ, be put in or be left out, and two together between runs of three
    equal words; foreign text between two pieces parts them.  Words that differ don't count for
    ``share``: the turns of phrase two texts have in common would else make a passage.

    Seeds are of three words, with a word left out or not (the general shingles of five would
    lose passages in which every third word differs).  A first scan of the documents counts in
    how many each seed occurs; every item's seeds are ordered by rarity and all but the
    necessary prefix are left out of candidate search; a second scan joins in the scan itself
    by an index, applies the bounds on shared seeds, length and place, and verifies windows.
    However many items there are, documents are read twice and never shuffled: the items' index
    is in blocks of about ``block`` words, and a worker opens all of them.

    Null and wordless texts hold nothing; items of fewer than five words have to stand whole;
    repeated rows give one row each pair; rows with a null key are left out; other columns are
    not read.
    """
    spark = docs.sparkSession
    chosen = items.select(F.col(item_key).alias("k"), F.col(item_text).alias("t")).where("k is not null and t is not null").distinct()
    schema = T.StructType([T.StructField(doc_key, docs.schema[doc_key].dataType), T.StructField("_item", T.LongType())])
    parts, names, keys, size = [], [], [], 0

    def close() -> None:
        if parts:
            index = ItemIndex.build([t for _, t in parts], share)
            names.append((shared_file(spark, index.dump(), "items"), len(keys), index))
            keys.extend(k for k, _ in parts)
            parts.clear()

    for r in chosen.orderBy("k", "t").toLocalIterator():
        parts.append((r["k"], r["t"]))
        size += len(r["t"]) // 5 + 1
        if size >= block:
            close()
            size = 0
    close()
    plain = [n for n, _, _ in names]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = [_load(n) for n in plain]
        for batch in batches:
            seen: list[list[np.ndarray]] = [[] for _ in blocks]
            for t in batch.column(0).to_pylist():
                if t:
                    h = np.unique(seed_hashes(word_hashes(passage_words(t)))[0])
                    for of, own in zip(seen, blocks):
                        of.append(own.hits(h)[1])
            for b, of in enumerate(seen):
                k, n = np.unique(np.concatenate(of), return_counts=True) if of else (np.zeros(0, np.int64), np.zeros(0, np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(k), b, np.int32)), pa.array(k.astype(np.int64)), pa.array(n.astype(np.int64))], ["b", "k", "n"])

    df = spread(docs.select(doc_text)).mapInArrow(count, "b int, k bigint, n bigint").groupBy("b", "k").agg(F.sum("n").alias("n"))
    freq = [np.zeros(len(index.keys), np.int64) for _, _, index in names]
    for r in df.toLocalIterator():  # one number for each seed of the items
        freq[r["b"]][r["k"]] = r["n"]
    ranked = []
    for (_, base, index), of in zip(names, freq):
        index.rank(of)
        ranked.append((shared_file(spark, index.dump(), "items"), base))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = [(_load(n), base) for n, base in ranked]
        for batch in batches:
            doc, item = [], []
            for i, t in enumerate(batch.column(1).to_pylist()):
                if t:
                    h = word_hashes(passage_words(t))
                    key, place = seed_hashes(h)
                    for own, base in blocks:
                        for x in own.leaked(h, key, place):
                            doc.append(i)
                            item.append(base + x)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(doc, pa.int64())), pa.array(item, pa.int64())], [doc_key, "_item"])

    found = spread(docs.where(F.col(doc_key).isNotNull()).select(doc_key, doc_text)).mapInArrow(find, schema)
    named = spark.createDataFrame(list(enumerate(keys)), T.StructType([T.StructField("_item", T.LongType()), T.StructField("_key", items.schema[item_key].dataType)]))
    return found.join(named, "_item").select(doc_key, F.col("_key").alias(item_key)).distinct()


def _load(name: str) -> ItemIndex:
    if name not in _worker:
        _worker[name] = ItemIndex.load(SparkFiles.get(name))
    return _worker[name]
