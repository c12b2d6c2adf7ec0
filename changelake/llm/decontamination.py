"""Benchmark decontamination by fingerprints of item-sized windows.

Benchmark items and documents are words (lower-cased runs of letters and digits), cut into
shingles of five words.  A window of a document has as many words as an item.  Its SimHash
(64 bits over the shingles' hashes, weighted by how often they occur) is looked up in a
multi-index: fingerprints are cut into ``radius + 1`` blocks, and two fingerprints that
differ in at most ``radius`` bits agree in a block, so the blocks that agree give every item
within the radius.  An item within the radius is then compared exactly, by weighted Jaccard
similarity of the shingles (sum of smaller over sum of larger counts).

Every start of a window and every item length is looked at, but for windows that cannot
reach the similarity with any item: it needs s / (1 + s) of both shingle counts' sum in
common, and running sums over the places that hold some item's shingle tell where a window
has that many.  Which item a window may match is found by the fingerprints alone.

The benchmark is the stated set of queries: it goes to the tasks in blocks of at most
``block_bytes`` of text, and a larger benchmark takes several passes over the documents,
whose hits are united.  Documents are never shuffled by text.

Defined results: null texts are empty and never hit; an item of fewer than five words is
one shingle of all its words; items without words are never hit; equal items are hit
together; rows that repeat an id are judged one by one; an empty benchmark hits nothing.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_slices, mix64, pick

WORD = re.compile(r"[^\W_]+")
_STEP = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class LeakParams:
    shingle: int = 5          # words
    similarity: float = 0.8   # weighted Jaccard of an item and a window
    radius: int = 20          # bits in which fingerprints may differ; pairs at 0.8 to 1 had 18 at most of 6,000
    block_bytes: int = 8 << 20  # benchmark text that is broadcast at once


def shingles_of(words: list, n: int) -> list[tuple]:
    return [tuple(words[i:i + n]) for i in range(max(len(words) - n, 0) + 1)] if words else []


def weighted_jaccard(a: Counter, b: Counter) -> float:
    low = sum(min(n, b[s]) for s, n in a.items() if s in b)
    return low / (sum(a.values()) + sum(b.values()) - low) if a or b else 0.0


def shingle_hashes(codes: np.ndarray, n: int) -> np.ndarray:
    """64-bit hashes of the runs of ``n`` word codes (of all codes, where there are fewer)."""
    n = min(n, len(codes))
    if not n:
        return np.empty(0, np.uint64)
    x = np.full(len(codes) - n + 1, np.uint64(n), np.uint64)
    for i in range(n):
        x = mix64(x * _STEP + codes[i:len(codes) - n + 1 + i])
    return x


def simhashes(hashes: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """64-bit SimHash of the windows of ``size`` shingles at ``starts``, by running sums of the bits."""
    bits = np.unpackbits(mix64(hashes * _STEP).view(np.uint8).reshape(-1, 8), axis=1)
    sums = np.zeros((len(hashes) + 1, 64), np.int32)
    np.cumsum(bits, axis=0, dtype=np.int32, out=sums[1:])
    votes = 2 * (sums[starts + size] - sums[starts]) > size
    return np.packbits(votes, axis=1).view(np.uint64).ravel()


class HammingIndex:
    """Items by blocks of their fingerprints' bits, each item within its group."""

    def __init__(self, prints: list[int], radius: int, groups: list[int] | None = None):
        self.prints, self.radius = np.array(prints, np.uint64), radius
        edges = np.linspace(0, 64, min(radius + 1, 64) + 1).astype(np.uint64)
        self.shift = edges[:-1]
        self.mask = (np.uint64(1) << (edges[1:] - edges[:-1])) - np.uint64(1) if radius else np.array([~np.uint64(0)])
        keys = self._keys(self.prints, np.array(groups if groups is not None else [0] * len(prints), np.uint64))
        order = np.argsort(keys, axis=None, kind="stable")
        self.keys, self.first = np.unique(keys.ravel()[order], return_index=True)
        self.last = np.append(self.first[1:], keys.size)
        self.postings = order // max(len(self.shift), 1)

    def _keys(self, prints: np.ndarray, groups: np.ndarray) -> np.ndarray:
        """One number for (group, block, value of the block)."""
        value = (prints[:, None] >> self.shift) & self.mask
        block = groups[:, None] * np.uint64(len(self.shift)) + np.arange(len(self.shift), dtype=np.uint64)
        return mix64(mix64(block + np.uint64(1)) * _STEP + value)

    def near_all(self, prints: np.ndarray, groups: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All distinct (print, item) of one group that differ in at most ``radius`` bits, as two arrays of numbers."""
        if not len(self.keys) or not len(prints):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        keys = self._keys(prints, groups).ravel()
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        hit = np.flatnonzero(self.keys[at] == keys)
        first, count = self.first[at[hit]], (self.last - self.first)[at[hit]]
        of = np.repeat(hit // len(self.shift), count)
        item = self.postings[np.repeat(first - np.cumsum(count) + count, count) + np.arange(count.sum())]
        ok = np.bitwise_count(prints[of] ^ self.prints[item]) <= self.radius
        pairs = np.unique(of[ok] * np.int64(len(self.prints)) + item[ok])
        return pairs // len(self.prints), pairs % len(self.prints)

    def near(self, f: int, group: int = 0) -> list[int]:
        """Items of the group whose fingerprint differs from ``f`` in at most ``radius`` bits."""
        return self.near_all(np.array([f], np.uint64), np.array([group], np.uint64))[1].tolist()


class LeakFinder:
    """Finds a block of benchmark items in texts."""

    STRETCH = 1 << 13  # window starts whose fingerprints are taken at once

    def __init__(self, items: list[tuple[int, str]], p: LeakParams):
        self.p = p
        words = [(i, WORD.findall((t or "").lower())) for i, t in items]
        self.items = [(i, w) for i, w in words if w]
        self.codes: dict[str, int] = {}  # of the items' words
        self.counts, prints = [], []
        self.lengths = np.array([len(w) for _, w in self.items], np.int64)
        self.sizes = sorted(set(self.lengths.tolist()))
        known = defaultdict(list)  # hashes of the items' shingles, by their words
        for _, w in self.items:
            self.counts.append(Counter(shingles_of(w, p.shingle)))
            code = np.array([self.codes.setdefault(x, xxhash.xxh64_intdigest(x)) for x in w], np.uint64)
            h = shingle_hashes(code, p.shingle)
            known[min(p.shingle, len(w))].append(h)
            prints.append(int(simhashes(h, np.zeros(1, np.int64), len(h))[0]))
        self.known = {k: np.unique(np.concatenate(h)) for k, h in known.items()}
        self.index = HammingIndex(prints, p.radius, self.lengths.tolist())

    def _windows(self, n_words: int, known: dict[int, np.ndarray]) -> Iterator[tuple[int, int, np.ndarray]]:
        """(item length, window's words, starts) of the windows that hold enough of the items' shingles.

        A similarity of s needs shared shingles of s / (1 + s) of both counts' sum; a window
        with fewer shingles of any item cannot reach it with one, and is left out.
        """
        share = self.p.similarity / (1 + self.p.similarity)
        for n in self.sizes:
            size, k = min(n, n_words), min(n, self.p.shingle)
            if size < k:
                continue  # other shingles than the items'
            mine = size - k + 1
            need = np.ceil(share * (n - k + 1 + mine) - 1e-9)
            sums = known[k]
            if sums[-1] < need:
                continue
            starts = np.flatnonzero(sums[mine:] - sums[:-mine] >= need)
            if len(starts):
                yield n, size, starts

    def find(self, text: str | None) -> list[tuple[int, float, int, int]]:
        """(item id, best similarity, first word, words) of every item found in the text."""
        words = WORD.findall((text or "").lower())
        get = self.codes.get
        code = np.fromiter((get(w, 0) for w in words), np.uint64, len(words))
        sums = {}
        for k, hashes in self.known.items():
            h = shingle_hashes(code, k)
            at = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
            sums[k] = np.concatenate([[0], np.cumsum(hashes[at] == h)])
        best: dict[int, tuple[float, int, int]] = {}
        by_stretch = defaultdict(list)
        for n, size, starts in self._windows(len(words), sums):
            cuts = np.flatnonzero(np.diff(starts // self.STRETCH)) + 1
            for part in np.split(starts, cuts):
                by_stretch[int(part[0]) // self.STRETCH].append((n, size, part))
        for stretch, windows in sorted(by_stretch.items()):
            self._compare(words, stretch * self.STRETCH, windows, best)
        return [(self.items[i][0], *v) for i, v in sorted(best.items())]

    def _compare(self, words: list[str], base: int, windows: list, best: dict) -> None:
        """Fingerprints of the windows, the items that the index gives for them, and their exact similarity."""
        here = words[base:base + self.STRETCH + max(size for _, size, _ in windows)]
        code = np.array([self.codes.get(w) or xxhash.xxh64_intdigest(w) for w in here], np.uint64)
        hashes = {}
        prints, groups, places = [], [], []
        for n, size, starts in windows:
            k = min(n, self.p.shingle)
            if k not in hashes:
                hashes[k] = shingle_hashes(code, k)
            prints.append(simhashes(hashes[k], starts - base, size - k + 1))
            groups.append(np.full(len(starts), n, np.uint64))
            places += [(int(s), size) for s in starts]
        of, item = self.index.near_all(np.concatenate(prints), np.concatenate(groups))
        for w, i in zip(of.tolist(), item.tolist()):
            start, size = places[w]
            j = weighted_jaccard(self.counts[i], Counter(shingles_of(words[start:start + size], self.p.shingle)))
            if j >= self.p.similarity and j > best.get(i, (0.0,))[0]:
                best[i] = (j, start, size)


def item_blocks(benchmark: DataFrame, p: LeakParams) -> Iterator[list[tuple[int, str]]]:
    """The benchmark in blocks of bounded size, one after the other."""
    items = pick(benchmark, "item_id", "text").filter("text IS NOT NULL")
    size = int(items.agg(F.sum(F.octet_length("text").cast("long")).alias("n")).first()["n"] or 0)
    parts = -(-size // p.block_bytes)
    for k in range(parts):
        part = items if parts == 1 else items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == k)
        yield [(r["item_id"], r["text"]) for r in part.orderBy("item_id", "text").collect()]


def find_leaks(docs: DataFrame, benchmark: DataFrame, params: LeakParams = LeakParams()) -> DataFrame:
    """Add ``hits`` (item_id, similarity, first_word, n_words) to the rows of ``docs``."""
    hit = "array<struct<item_id:bigint,similarity:double,first_word:int,n_words:int>>"
    kind = pa.list_(pa.struct([("item_id", pa.int64()), ("similarity", pa.float64()), ("first_word", pa.int32()), ("n_words", pa.int32())]))
    docs = docs.drop("hits")
    out = docs.withColumn("hits", F.array().cast(hit))
    names = out.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in out.schema)
    for items in item_blocks(benchmark, params):
        shared = docs.sparkSession.sparkContext.broadcast(items)  # at most block_bytes of text

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            finder = LeakFinder(shared.value, params)
            for b in in_slices(batches):
                found = []
                for text, before in zip(b.column("text"), b.column("hits").to_pylist()):
                    new = [dict(zip(("item_id", "similarity", "first_word", "n_words"), h)) for h in finder.find(text.as_py())]
                    found.append(before + new)
                yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(found, kind)], names=names)

        out = out.mapInArrow(run, schema)
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, params: LeakParams = LeakParams()) -> DataFrame:
    """doc_id, contaminated, n_items, items (ids, ascending) and hits of every document."""
    found = find_leaks(pick(docs, "doc_id", "text"), benchmark, params)
    items = F.array_sort(F.array_distinct(F.transform("hits", lambda h: h["item_id"])))
    return found.select("doc_id", (F.size("hits") > 0).alias("contaminated"), F.size(items).alias("n_items"), items.alias("items"), "hits")
