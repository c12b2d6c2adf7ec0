"""Removal of long repeated passages by distributed prefix doubling.

A byte is removed if a string of ``length`` bytes that covers it starts anywhere else too.
A suffix array over every byte of a corpus would need many times the corpus in shuffles, so
the positions that can matter are narrowed down first, exactly:

1. *Anchors.* In every window of ``length`` bytes the smallest hash of its ``seed``-byte
   strings is the window's anchor (the leftmost one among equals).  Equal windows have equal
   anchors at the same place, and neighbouring windows mostly share theirs, so a run of
   starts is one row.  Runs whose anchor occurs once in the corpus have no repeat.
2. *Runs and pieces.* Runs with the same anchor and the same bytes are repeated as a whole.
   What is left (runs with an anchor in common that differ somewhere) is cut into pieces of
   ``piece`` starts, at places counted from the anchor; pieces with equal bytes are
   repeated, pieces whose inner bytes (common to all their starts) occur once are not.
3. *Prefix doubling* decides the remaining starts: a position's rank for a quarter of the
   length is paired with the rank a quarter further on, Spark sorts the pairs by range, and
   the place in that order is the new rank for twice the length.  Positions with a unique
   pair leave; after the threshold's length the ranks left over are repeated strings.

Copies of a text share their rows' results: rows are keyed by a hash of the text and its
length.  Long texts are cut into slices of starts, which changes no result.  Equality of
strings is equality of at least 128 bits of hash.

Defined results: a null text is empty; texts shorter than ``length`` lose nothing; matches
never cross texts; equal texts are repeats of each other; overlaps and repeats within a text
count; every row is returned, repeated ids too.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_slices, materialize, per_worker, pick, scratch_block

_BASE = 0x9E3779B97F4A7C15


@dataclass(frozen=True)
class RepeatParams:
    length: int = 400   # bytes of a repeated string
    seed: int = 128     # bytes hashed for anchors
    words: int = 0      # if set, strings of so many words repeat too where they are shorter than ``length``
    piece: int = 16     # starts in a piece
    slice: int = 1 << 20  # starts of a text that are handled at once


def h64(data: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little", signed=True)


class AnchorFinder:
    """Runs of window starts with the same anchor."""

    def __init__(self, p: RepeatParams):
        self.p = p
        n = p.slice + p.length
        self.power = np.full(n, _BASE, np.uint64)
        self.power[0] = 1
        np.multiply.accumulate(self.power, out=self.power)
        self.inverse = np.full(n, pow(_BASE, -1, 1 << 64), np.uint64)
        self.inverse[0] = 1
        np.multiply.accumulate(self.inverse, out=self.inverse)

    def seeds(self, a: np.ndarray) -> np.ndarray:
        """A hash of each string of ``seed`` bytes, equal for equal strings."""
        k = self.p.seed
        sums = np.zeros(len(a) + 1, np.uint64)
        np.cumsum((a.astype(np.uint64) + np.uint64(1)) * self.power[:len(a)], out=sums[1:])
        x = (sums[k:] - sums[:-k]) * self.inverse[:len(a) - k + 1]
        x ^= x >> np.uint64(32)
        x *= np.uint64(0xD6E8FEB86659FD93)
        x ^= x >> np.uint64(29)
        return x

    def runs(self, data: bytes) -> Iterator[tuple[int, int, int, int]]:
        """(anchor hash, first start, last start, anchor position), by ascending start."""
        p, total = self.p, len(data) - self.p.length + 1
        for base in range(0, max(total, 0), p.slice):
            starts = min(p.slice, total - base)
            x = self.seeds(np.frombuffer(data, np.uint8, starts + p.length - 1, base))
            w = p.length - p.seed + 1
            # the position in the low bits makes the leftmost of equal hashes the smallest
            y = (x >> np.uint64(24) << np.uint64(24)) | np.arange(len(x), dtype=np.uint64)
            low = np.full(-(-len(y) // w) * w, np.iinfo(np.uint64).max, np.uint64)
            low[:len(y)] = y
            block = low.reshape(-1, w)
            left = np.minimum.accumulate(block, 1).ravel()
            right = np.minimum.accumulate(block[:, ::-1], 1)[:, ::-1].ravel()
            at = (np.minimum(right[:starts], left[w - 1:w - 1 + starts]) & np.uint64((1 << 24) - 1)).astype(np.int64)
            first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
            last = np.concatenate([first[1:], [starts]]) - 1
            pos = at[first]
            yield from zip(x[pos].view(np.int64).tolist(), (first + base).tolist(), (last + base).tolist(), (pos + base).tolist())


def keyed(docs: DataFrame) -> DataFrame:
    """The row, the text, and the key of the text: tid (hash) and size (bytes)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("row")
    return docs.select(row, text.alias("text"), F.xxhash64(text).alias("tid"), F.octet_length(text).alias("size"))


def _batch(names: str, kinds: list[pa.DataType], rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [[]] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=names.split())


L, I, S, Y = pa.int64(), pa.int32(), pa.bool_(), pa.binary()  # noqa: E741


def anchor_runs(texts: DataFrame, p: RepeatParams) -> DataFrame:
    """One row per run: anchor, whole (hash of all its bytes), key of the text, lo, hi, at."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = per_worker(("anchors", p), lambda: AnchorFinder(p))
        for b in in_slices(batches, 250):
            rows = []
            for text, tid, size in zip(b.column("text"), b.column("tid").to_pylist(), b.column("size").to_pylist()):
                data = text.as_py().encode()
                rows += [(a, h64(data[lo:hi + p.length]), tid, size, lo, hi, at) for a, lo, hi, at in finder.runs(data)]
                if len(rows) > 50_000:
                    yield _batch("anchor whole tid size lo hi at", [L, L, L, I, I, I, I], rows)
                    rows = []
            yield _batch("anchor whole tid size lo hi at", [L, L, L, I, I, I, I], rows)

    return texts.filter(F.col("size") >= p.length).select("text", "tid", "size").mapInArrow(
        run, "anchor bigint, whole bigint, tid bigint, size int, lo int, hi int, at int")


def contexts(texts: DataFrame, wanted: DataFrame, p: RepeatParams) -> DataFrame:
    """The bytes of the wanted runs, once each."""
    per_text = wanted.groupBy("tid", "size").agg(F.collect_list(F.struct("anchor", "whole", "settled", "lo", "hi", "at")).alias("runs"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in in_slices(batches, 250):
            for text, tid, size, runs in zip(b.column("text"), b.column("tid").to_pylist(), b.column("size").to_pylist(), b.column("runs").to_pylist()):
                data = text.as_py().encode()
                for i in range(0, len(runs), 20_000):
                    yield _batch("anchor whole settled tid size lo hi at bytes", [L, L, S, L, I, I, I, I, Y], [
                        (r["anchor"], r["whole"], r["settled"], tid, size, r["lo"], r["hi"], r["at"], data[r["lo"]:r["hi"] + p.length])
                        for r in runs[i:i + 20_000]])

    found = texts.join(per_text, ["tid", "size"]).select("text", "tid", "size", "runs").mapInArrow(
        run, "anchor bigint, whole bigint, settled boolean, tid bigint, size int, lo int, hi int, at int, bytes binary")
    return found.dropDuplicates(["anchor", "whole"])  # copies of a text hold the same run


def pieces(ctx: DataFrame, p: RepeatParams) -> DataFrame:
    """Pieces of runs: k (place from the anchor), inner and outer hash, starts a to b."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = p.piece
        for b in in_slices(batches, 250):
            rows = []
            for r in b.to_pylist():
                data, lo, at = r["bytes"], r["lo"], r["at"]
                for k in range((at - r["hi"]) // n, (at - lo) // n + 1):
                    # starts whose distance to the anchor is in [k * n, k * n + n)
                    a, z = max(lo, at - k * n - n + 1), min(r["hi"], at - k * n)
                    inner = data[max(at - k * n - lo, 0):at - k * n - n + 1 + p.length - lo]
                    outer = (at - a).to_bytes(4, "little") + data[a - lo:z - lo + p.length]
                    rows.append((r["anchor"], r["whole"], k, h64(inner), h64(outer), r["settled"], r["tid"], r["size"], a, z))
            yield _batch("anchor whole k inner outer settled tid size a b", [L, L, I, L, L, S, L, I, I, I], rows)

    return ctx.select("anchor", "whole", "settled", "tid", "size", "lo", "hi", "at", "bytes").mapInArrow(
        run, "anchor bigint, whole bigint, k int, inner bigint, outer bigint, settled boolean, tid bigint, size int, a int, b int")


def start_names(ctx: DataFrame, open_pieces: DataFrame, p: RepeatParams) -> DataFrame:
    """Per open start two rows (half 0 and 1): the hashes of the two quarters of that half."""
    quarter = -(-p.length // 4)
    # the last quarters overlap their neighbours if the length is not a multiple of four
    half = p.length - 2 * quarter
    joined = open_pieces.join(ctx.select("anchor", "whole", "lo", "bytes"), ["anchor", "whole"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, 250):
            rows = []
            for r in batch.to_pylist():
                data, lo = r["bytes"], r["lo"]
                names: dict[int, int] = {}
                for s in range(r["a"] - lo, r["b"] - lo + 1):
                    for x in (0, half):
                        pair = []
                        for i in (s + x, s + x + quarter):
                            if i not in names:
                                names[i] = h64(data[i:i + quarter])
                            pair.append(names[i])
                        rows.append((r["tid"], r["size"], lo + s, int(x > 0), *pair))
            yield _batch("tid size start half r1 r2", [L, I, I, I, L, L], rows)

    return joined.select("tid", "size", "a", "b", "lo", "bytes").mapInArrow(
        run, "tid bigint, size int, start int, half int, r1 bigint, r2 bigint")


def rerank(pairs: DataFrame) -> DataFrame:
    """Replace the rank pair (r1, r2) by its place among the sorted distinct pairs; unique pairs leave."""
    repeated = pairs.groupBy("r1", "r2").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("r1", "r2")
    order = repeated.repartitionByRange("r1", "r2").sortWithinPartitions("r1", "r2").withColumn(
        "rank", F.monotonically_increasing_id())
    return pairs.join(materialize(order, "ranks"), ["r1", "r2"]).drop("r1", "r2")


def repeated_starts(texts: DataFrame, p: RepeatParams) -> DataFrame:
    """(tid, size, a, b): ranges of starts whose string of ``length`` bytes starts elsewhere too."""
    runs = anchor_runs(texts, p)
    # counted apart and written: a join of two plain tables lets Spark split a hot anchor
    shared = runs.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("anchor")
    shared = materialize(shared, "anchors")
    runs = materialize(runs.join(shared, "anchor"), "runs")
    kinds = runs.groupBy("anchor", "whole").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("tid", "size", "lo", "hi", "at")).alias("one"))
    kinds = materialize(kinds, "run-kinds")
    whole = runs.join(kinds.filter("n > 1").select("anchor", "whole"), ["anchor", "whole"], "left_semi").select(
        "tid", "size", F.col("lo").alias("a"), F.col("hi").alias("b"))
    # anchors with several kinds of runs need a closer look, with one run of each kind
    mixed = kinds.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds")).filter("kinds > 1").select("anchor")
    wanted = kinds.join(materialize(mixed, "mixed-anchors"), "anchor").select("anchor", "whole", (F.col("n") > 1).alias("settled"), "one.*")
    ctx = materialize(contexts(texts, wanted, p), "run-bytes")
    parts = materialize(pieces(ctx, p), "pieces")
    part_kinds = materialize(parts.groupBy("anchor", "k", "inner", "outer").agg(
        F.count(F.lit(1)).alias("n"), F.max("settled").alias("settled"),
        F.min(F.struct("whole", "tid", "size", "a", "b")).alias("one")), "piece-kinds")
    equal = parts.filter("NOT settled").join(part_kinds.filter("n > 1").select("anchor", "k", "inner", "outer"),
                                             ["anchor", "k", "inner", "outer"], "left_semi").select("tid", "size", "a", "b")
    mixed = part_kinds.groupBy("anchor", "k", "inner").agg(
        F.count(F.lit(1)).alias("kinds"), F.min(F.col("settled") | (F.col("n") > 1)).alias("done")).filter("kinds > 1 AND NOT done")
    mixed = materialize(mixed.select("anchor", "k", "inner"), "mixed-pieces")
    open_pieces = part_kinds.join(mixed, ["anchor", "k", "inner"]).select("anchor", "one.*")
    # doubling: quarters to halves, halves to the whole length
    halves = rerank(materialize(start_names(ctx, open_pieces, p), "quarter-ranks"))
    pairs = halves.groupBy("tid", "size", "start").agg(
        F.max(F.when(F.col("half") == 0, F.col("rank"))).alias("r1"), F.max(F.when(F.col("half") == 1, F.col("rank"))).alias("r2"))
    ends = rerank(materialize(pairs.filter("r1 IS NOT NULL AND r2 IS NOT NULL"), "half-ranks"))
    single = ends.select("tid", "size", F.col("start").alias("a"), F.col("start").alias("b"))
    return whole.distinct().union(equal).union(single)


def short_word_repeats(texts: DataFrame, p: RepeatParams) -> DataFrame:
    """Repeated strings of ``words`` words in under ``length`` bytes, as (tid, size, a, b) like the others.

    Longer ones hold a string of ``length`` bytes.  A string goes from a word's first byte to
    another's last one and must be equal byte by byte.
    """
    space = np.zeros(256, bool)
    space[[32, *range(9, 14)]] = True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in in_slices(batches, 250):
            rows = []
            for text, tid, size in zip(b.column("text"), b.column("tid").to_pylist(), b.column("size").to_pylist()):
                data = text.as_py().encode()
                inside = np.zeros(len(data) + 2, np.int8)
                inside[1:-1] = ~space[np.frombuffer(data, np.uint8)]
                edge = np.flatnonzero(inside[1:] != inside[:-1])
                first, last = edge[::2][:max(len(edge) // 2 - p.words + 1, 0)], edge[1::2][p.words - 1:]
                short = last - first < p.length
                rows += [(hashlib.blake2b(data[lo:hi], digest_size=16).digest(), tid, size, lo, hi - p.length)
                         for lo, hi in zip(first[short].tolist(), last[short].tolist())]
                if len(rows) > 50_000:
                    yield _batch("name tid size a b", [Y, L, I, I, I], rows)
                    rows = []
            yield _batch("name tid size a b", [Y, L, I, I, I], rows)

    found = materialize(texts.select("text", "tid", "size").mapInArrow(run, "name binary, tid bigint, size int, a int, b int"), "word-strings")
    again = materialize(found.groupBy("name").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("name"), "word-repeats")
    return found.join(again, "name", "left_semi").select("tid", "size", "a", "b").distinct()


def remove_repeats(docs: DataFrame, params: RepeatParams = RepeatParams()) -> DataFrame:
    """``row`` (a struct of the columns but ``text``), the remaining bytes (kept), n_bytes, n_removed, n_spans."""
    p = params
    texts = keyed(docs)
    with scratch_block(docs.sparkSession, "substrings") as keep:
        starts = repeated_starts(texts, p)
        if p.words:
            starts = starts.union(short_word_repeats(texts, p))
        starts = keep(starts, "repeats")
    per_text = starts.groupBy("tid", "size").agg(F.collect_list(F.struct("a", "b")).alias("starts"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in in_slices(batches, 250):
            rows, held, at_row = [], 0, 0
            for text, starts in zip(b.column("text"), b.column("starts").to_pylist()):
                data = text.as_py().encode()
                keep, at, removed, spans, end = [], 0, 0, 0, 0
                for s in sorted((s["a"], s["b"]) for s in starts or ()):
                    lo, hi = s[0], s[1] + p.length
                    if lo > end or not spans:
                        keep.append(data[at:lo])
                        spans += 1
                        removed += hi - lo
                        end = hi
                    elif hi > end:
                        removed += hi - end
                        end = hi
                    at = end
                keep.append(data[at:])
                rows.append((b"".join(keep), len(data), removed, spans))
                held += len(data)
                if held > 8 << 20:
                    yield with_rows(b, at_row, rows)
                    rows, held, at_row = [], 0, at_row + len(rows)
            yield with_rows(b, at_row, rows)

    def with_rows(b: pa.RecordBatch, at: int, rows: list[tuple]) -> pa.RecordBatch:
        done = _batch("kept n_bytes n_removed n_spans", [Y, L, L, L], rows)
        return pa.RecordBatch.from_arrays([b.column("row").slice(at, len(rows)), *done.columns], names=["row", *done.schema.names])

    joined = texts.join(per_text, ["tid", "size"], "left").select("row", "text", "starts")
    kind = joined.schema["row"].dataType.simpleString()
    return joined.mapInArrow(run, f"row {kind}, kept binary, n_bytes bigint, n_removed bigint, n_spans bigint")


def drop_repeats(docs: DataFrame, params: RepeatParams = RepeatParams()) -> DataFrame:
    """The rows of ``docs`` with the repeated passages cut out of ``text``, columns as before.

    A cut may fall inside a character, whose remaining bytes are dropped; a null text
    becomes empty.
    """
    done = remove_repeats(docs, params)
    # invalid bytes become the replacement character, which is taken out unless the text had it
    text = F.col("kept").cast("string")
    text = F.when(F.is_valid_utf8(text), text).otherwise(F.replace(F.make_valid_utf8(text), F.lit("\ufffd"), F.lit("")))
    return done.select("row.*", text.alias("text")).select(*docs.columns)


def removal_digest(docs: DataFrame, params: RepeatParams = RepeatParams()) -> DataFrame:
    return remove_repeats(pick(docs, "doc_id", "text"), params).select(
        "row.doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
