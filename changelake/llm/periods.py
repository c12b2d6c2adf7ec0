"""Periodic runs of words: stretches that repeat with a period, found by seed and extend.

A run is a stretch of consecutive words with smallest period q (words q apart are equal), at
least ``min_length`` words and twice the period long, that no neighbouring word extends.

On the diagonal of lag q a run is a stretch of matches (word i equals word i + q) of at least
max(q, min_length - q) words.  So lags are divided into bands [K, 2K), and every run of a band
holds an equal pair of K-grams at its lag; the first K is half of ``min_length``, which also
serves all smaller lags.

1. *Index.* Names of K-grams, exact and by document: those of the first K from the words, those
   of 2K from pairs of names.  Only K-grams that occur again are kept, so later bands see
   little of an ordinary text.
2. *Pairs.* Occurrences of a K-gram that are at most K/2 apart form a chain (the gram itself is
   periodic there).  An occurrence is paired with the first members of the next chains only, at
   most three of which are less than 2K away.  That finds every run: if some K-gram of its match
   is not periodic, all its chains have one member; if all are, the match lies in one stretch of
   a smaller period, its copy in the next one, and the copy starts less than that period after
   the start of the next one, which is where chains begin.  So pairs grow with the words, also
   where one word is repeated throughout.
3. *Extension.* Pairs go by lag and position; a table of the furthest covered position of each
   lag drops pairs that lie in a stretch extended before.  Extension leaps by the names of all
   bands, from the longest grams to single words.
4. Of equal stretches the smallest lag is the period: a stretch with two periods, twice as long
   as the larger, has their common divisor as a period too.

Documents are independent, so nothing is shuffled; a task holds ``pool`` words at a time, or one
longer text.

Defined results: a null or blank text has no words and no runs; repeated rows are returned as
often as they occur; a null doc_id stays null; an empty table gives an empty result.  Words are
compared byte by byte (case matters).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD_SPACE, in_slices, mix64, pick

Run = tuple[int, int, int]  # start, length, period


@dataclass(frozen=True)
class RunParams:
    min_length: int = 12     # words of a run
    pool: int = 400_000      # words that a task looks at together


class RunFinder:
    """All runs of a pool of documents' words, given as numbers (equal words, equal numbers)."""

    def __init__(self, docs: list[list[int]], p: RunParams):
        self.p = p
        self.docs = docs
        sizes = np.array([len(d) for d in docs], np.int64)
        # every document ends with a word of its own, so nothing matches across documents
        kinds = max((max(d) for d in docs if d), default=-1) + 1
        self.starts = np.concatenate([[0], np.cumsum(sizes + 1)])
        flat = np.empty(self.starts[-1], np.int64)
        for k, d in enumerate(docs):
            flat[self.starts[k]:self.starts[k] + len(d)] = d
            flat[self.starts[k + 1] - 1] = kinds + k
        self.kinds = kinds + len(docs)
        self.flat = flat
        self.names: dict[int, np.ndarray] = {}  # K -> name of the K-gram at each position, -1 if it occurs once

    def _first_grams(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions of the k-grams that occur twice in their document, and their names."""
        n = len(self.flat) - k + 1
        if n <= 0:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        doc = np.repeat(np.arange(len(self.docs)), np.diff(self.starts))
        # hashes only preselect; names are exact
        x = mix64(self.flat.astype(np.uint64) + np.uint64(1))
        g = mix64(doc[:n].astype(np.uint64) + np.uint64(1 << 40))
        for j in range(k):
            g = mix64(g + x[j:j + n])
        ordered = np.sort(g)
        twice = ordered[1:][ordered[1:] == ordered[:-1]]
        if not len(twice):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        i = np.searchsorted(twice, g)
        i[i == len(twice)] = 0
        pos = np.flatnonzero(twice[i] == g)
        name = doc[pos]
        for j in range(k):
            name = np.unique(name * self.kinds + self.flat[pos + j], return_inverse=True)[1]
        return self._repeated(pos, name)

    @staticmethod
    def _repeated(pos: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        _, name, count = np.unique(key, return_inverse=True, return_counts=True)
        keep = count[name] > 1
        return pos[keep], name[keep]

    def _seeds(self) -> tuple[np.ndarray, np.ndarray]:
        """(lag, position) of the pairs to extend, ascending; neighbours on a diagonal once."""
        k = max(self.p.min_length // 2, 1)
        first = k
        pos, name = self._first_grams(k)
        lags, ats = [], []
        while len(pos):
            dense = np.full(len(self.flat), -1, np.int32)
            dense[pos] = name
            self.names[k] = dense
            order = np.argsort(name, kind="stable")
            p, m = pos[order], name[order]
            gap = np.where(m[1:] == m[:-1], p[1:] - p[:-1], np.iinfo(np.int64).max)
            if k == first:
                # a period below k: the k-gram is longer than it and comes again exactly a period later
                near = np.flatnonzero(gap < k)
                lags.append(gap[near])
                ats.append(p[near])
            heads = np.flatnonzero(np.concatenate([[True], gap > k // 2]))
            after = np.searchsorted(heads, np.arange(len(p)), side="right")
            for r in range(4):
                t = np.flatnonzero(after + r < len(heads))
                h = heads[after[t] + r]
                lag = p[h] - p[t]
                hit = (m[h] == m[t]) & (lag >= k) & (lag < 2 * k)
                lags.append(lag[hit])
                ats.append(p[t[hit]])
            inside = pos + k < len(dense)
            second = np.full(len(pos), -1, np.int64)
            second[inside] = dense[pos[inside] + k]
            both = second >= 0
            pos, name = self._repeated(pos[both], name[both] * (len(self.flat) + 1) + second[both])
            k *= 2
        if not lags:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        lag, at = np.concatenate(lags), np.concatenate(ats)
        order = np.lexsort((at, lag))
        lag, at = lag[order], at[order]
        fresh = np.ones(len(lag), bool)
        fresh[1:] = (lag[1:] != lag[:-1]) | (at[1:] > at[:-1] + 1)
        return lag[fresh], at[fresh]

    def _ahead(self, i: int, j: int) -> int:
        """How many words from i and j on are equal."""
        x = 0
        for k, name in self.leaps:
            while name[i + x] >= 0 and name[i + x] == name[j + x]:
                x += k
        while self.flat[i + x] == self.flat[j + x]:
            x += 1
        return x

    def _behind(self, i: int, j: int) -> int:
        """How many words before i and j are equal."""
        x = 0
        for k, name in self.leaps:
            while i - x >= k and name[i - x - k] >= 0 and name[i - x - k] == name[j - x - k]:
                x += k
        while i > x and self.flat[i - x - 1] == self.flat[j - x - 1]:
            x += 1
        return x

    def runs(self) -> list[list[Run]]:
        """Every document's runs by start, then period."""
        out: list[list[Run]] = [[] for _ in self.docs]
        lag, at = self._seeds()
        self.leaps = sorted(self.names.items(), reverse=True)
        covered: dict[int, int] = {}
        period: dict[tuple[int, int], int] = {}
        for q, i in zip(lag.tolist(), at.tolist()):
            if i < covered.get(q, 0):
                continue
            end = covered[q] = i + self._ahead(i, i + q)
            start = i - self._behind(i, i + q)
            if end - start >= max(q, self.p.min_length - q):
                # lags ascend, so the first is the smallest
                period.setdefault((start, end + q), q)
        if period:
            found = sorted((s, q, e) for (s, e), q in period.items())
            docs = np.searchsorted(self.starts, [s for s, _, _ in found], side="right") - 1
            for d, (s, q, e) in zip(docs.tolist(), found):
                out[d].append((s - int(self.starts[d]), e - s, q))
        return out


def collapse(words: list[bytes], runs: list[Run]) -> bytes:
    """The words that no run holds after its first period, joined by one space."""
    if runs:
        edge = np.zeros(len(words) + 1, np.int64)
        for start, length, q in runs:
            edge[start + q] += 1
            edge[start + length] -= 1
        words = [words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0)]
    return b" ".join(words)


def periodic_runs(docs: DataFrame, p: RunParams = RunParams()) -> DataFrame:
    """doc_id, n_words, runs (start, length, period; by start, then period) and the collapsed text of every row."""
    run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def pooled(ids: list, texts: list[list[bytes]]) -> Iterator[pa.RecordBatch]:
        number: dict[bytes, int] = {}
        runs = RunFinder([[number.setdefault(w, len(number)) for w in t] for t in texts], p).runs()
        rows = [[{"start": s, "length": n, "period": q} for s, n, q in r] for r in runs]
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array([len(t) for t in texts], pa.int64()), pa.array(rows, run_type),
             pa.array([collapse(t, r) for t, r in zip(texts, runs)], pa.binary()).cast(pa.string())],
            names=["doc_id", "n_words", "runs", "collapsed"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list = []
        texts: list[list[bytes]] = []
        held = 0
        for b in in_slices(batches):
            for i, t in zip(b.column("doc_id"), b.column("text").cast(pa.binary())):
                ids.append(i.as_py())
                texts.append((t.as_py() or b"").split())
                held += len(texts[-1])
                if held >= p.pool:
                    yield from pooled(ids, texts)
                    ids, texts, held = [], [], 0
        if ids:
            yield from pooled(ids, texts)

    return pick(docs, "doc_id", "text").select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id bigint, n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string")


def plant_runs(docs: DataFrame) -> DataFrame:
    """The rows (doc_id, text) with a run planted into every tenth document, as the query's contract has it.

    With h the unsigned crc32 of the id as decimal text and g = floor(h / 10): if h is divisible
    by 10, each word i from a = g % n on becomes word a + (i - a) % p, p = 1 + floor((n - a) / (3 + g % 8)).
    """
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    df = pick(docs, "doc_id", "text").withColumns({
        "_g": F.floor(h / 10), "_w": F.when(h % 10 == 0, F.filter(F.split("text", WORD_SPACE), lambda w: w != ""))})
    n = F.size("_w")
    df = df.withColumn("_a", F.when(n > 0, (F.col("_g") % n).cast("int")))
    df = df.withColumn("_p", (1 + F.floor((n - F.col("_a")) / (3 + F.col("_g") % 8))).cast("int"))
    rest = n - F.col("_a")
    copies = F.flatten(F.array_repeat(F.slice("_w", F.col("_a") + 1, F.col("_p")), F.ceil(rest / F.col("_p")).cast("int")))
    planted = F.array_join(F.concat(F.slice("_w", F.lit(1), F.col("_a")), F.slice(copies, F.lit(1), rest)), " ")
    return df.select("doc_id", F.when(F.col("_a").isNotNull(), planted).otherwise(F.col("text")).alias("text"))


def run_digest(found: DataFrame) -> DataFrame:
    """The longest run of each row (ties: smallest start, then period), and digests of all runs and of the collapsed text."""
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("q"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(
        r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))), "")
    df = found.withColumn("_best", best)
    return df.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("_best.s")).alias("start"), F.col("_best.length").alias("length"),
        (-F.col("_best.q")).alias("period"), F.floor(1000 * F.col("_best.length") / -F.col("_best.q")).cast("long").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
