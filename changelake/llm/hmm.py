"""Language-model scoring with a hidden Markov model.

Words are symbols by a hash (``symbols`` of them, a fixed number), the model's states emit
symbols, and within a symbol a word has the add-one share of its count.  So the states see a
vocabulary of fixed size, while the word counts grow with the corpus and stay a distributed
table.  Baum-Welch: every partition runs the scaled forward and backward recursion over
its whole training texts and returns expected counts and the likelihood, which Spark sums;
rounds train start, transition and emission probabilities until the likelihood of a training
token gains less than ``least_gain``, at most ``rounds`` of them.  Long texts are walked in
segments: forward states are kept at the borders only, and the backward recursion carries its
state from each segment to the one before.  Scoring runs the scaled forward recursion over
each whole text: the sum of the logarithms of the scales is the exact likelihood.

Word counts are joined in two ways: words that make up more than one in ``frequent`` tokens
(there are at most ``frequent`` of them) travel to the tasks, the others are joined by their
hash, one row per occurrence; no hot word is left for that join.

Defined results: a null text is empty and has the end token only; upper-case ASCII letters
are lowered, words end at ASCII white space; without training texts all counts are 0 and the
model is uniform; repeated rows are counted and returned as often as they occur.
Words are identified by 64 bits of hash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WordHashes, fold, in_slices, materialize, mix64, pick

END = mix64(np.zeros(1, np.uint64) + np.uint64(1 << 63))[0]  # hash of the end token


@dataclass(frozen=True)
class HmmParams:
    states: int = 6
    symbols: int = 1024       # hash classes of words that the states emit
    rounds: int = 20          # Baum-Welch rounds over all training texts at most
    least_gain: float = 5e-4  # log10 likelihood of a training token that a round must bring (0.1 % of perplexity)
    segment: int = 128        # tokens of a text whose states are held at once
    width: int = 1024         # texts that a task advances at once
    kept: int = 1_500_000     # steps of texts whose forward states a task keeps
    pool: int = 4_000_000     # tokens of texts that a task sorts by length
    frequent: int = 1_000_000  # bound of the words whose counts travel to the tasks (16 bytes each)
    folds: int = 7
    held_out: int = 2
    smooth: float = 0.1       # added to expected counts


class Words(WordHashes):
    """Hashes of a text's tokens: its words and the end."""

    def __call__(self, text: str | None) -> np.ndarray:
        return np.append(super().__call__(text), END)


def symbol_of(hashes: np.ndarray, p: HmmParams) -> np.ndarray:
    return (hashes % np.uint64(p.symbols)).astype(np.int32)


@dataclass
class Hmm:
    start: np.ndarray  # states
    move: np.ndarray   # states x states
    emit: np.ndarray   # symbols x states

    @staticmethod
    def first(p: HmmParams) -> Hmm:
        """A start near the uniform model; the seed makes it the same everywhere."""
        rng = np.random.default_rng(7)
        s = p.states
        emit = 1.0 + rng.random((p.symbols, s))
        move = np.full((s, s), 0.1 / max(s - 1, 1)) if s > 1 else np.ones((1, 1))
        if s > 1:
            np.fill_diagonal(move, 0.9)
        return Hmm(np.full(s, 1 / s), move, emit / emit.sum(0))

    def log10(self, texts: list[np.ndarray]) -> np.ndarray:
        """log10 likelihood of each symbol sequence, by the scaled forward recursion."""
        out = np.zeros(len(texts))
        order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
        lengths = np.array([len(texts[i]) for i in order])
        grid_end = np.cumsum(lengths)
        flat = np.concatenate([texts[i] for i in order]) if len(order) else np.empty(0, np.int32)
        begin = grid_end - lengths
        alpha, total = None, np.zeros(len(order))
        active = len(order)
        for t in range(int(lengths[0]) if len(order) else 0):
            while lengths[active - 1] <= t:  # the shortest come last
                active -= 1
            e = self.emit[flat[begin[:active] + t]]
            alpha = (self.start * e) if alpha is None else (alpha[:active] @ self.move) * e
            scale = alpha.sum(1)
            alpha /= scale[:, None]
            total[:active] += np.log10(scale)
        out[order] = total
        return out

    def _emissions(self, seq: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols (steps x texts) and what each state emits them with (states x steps x texts).

        Padding is a symbol of its own that every state emits alike, so it carries no evidence.
        """
        sym = np.ascontiguousarray(np.where(seq < 0, len(self.emit), seq).T)
        return sym, np.take(np.append(self.emit.T, np.ones((len(self.start), 1), self.emit.dtype), 1), sym, axis=1)

    def _forward(self, e: np.ndarray, first: np.ndarray, before: np.ndarray | None, alpha: list, scale: list | None) -> np.ndarray:
        """The last scaled forward state; ``alpha`` and ``scale`` take those of all steps.

        Every other step is scaled (its scale is None else), and the last one: two steps without
        are far from the smallest single-precision number, as probabilities are smoothed.
        """
        a = None
        turn = np.ascontiguousarray(self.move.T)
        last = e.shape[1] - 1
        for t in range(last + 1):
            if t:
                a = turn @ a
            else:
                a = np.repeat(self.start[:, None], e.shape[2], 1)
                if before is not None:
                    a = np.where(first, a, turn @ before)
            a *= e[:, t]
            c = None
            if t % 2 or t == last:
                c = a.sum(0)
                a /= c
            if scale is not None:
                alpha.append(a)
                scale.append(c)
        return a

    def expected(self, seq: np.ndarray, first: np.ndarray, before: np.ndarray | None = None, after: np.ndarray | None = None,
                 walked: tuple | None = None):
        """Expected starts, moves and emissions of sequences (rows of ``seq``), the log10 likelihood, and the backward state.

        Symbols below 0 are padding after a sequence's end.  ``first`` marks rows that begin a
        text; the others go on from the forward states ``before`` (states x rows).  ``after`` is
        the backward state of what follows; the one returned is that of the step before the rows.
        ``walked`` is what :meth:`_walk` gave for the rows, if they have been walked forward before.
        """
        (n, length), s = seq.shape, len(self.start)
        sym, e, alpha, scale = walked or self._walk(seq, first, before)
        live = sym < len(self.emit)
        # padding has no evidence: its scales are 1, or what an unscaled last step left to scale
        total = float(np.log10(np.stack([c for c in scale if c is not None])).sum(dtype=np.float64))
        beta = np.ones((s, n), e.dtype) if after is None else after
        gamma = np.empty((s, length, n), e.dtype)
        moves = np.zeros((s, s))
        for t in range(length - 1, -1, -1):
            np.multiply(alpha[t], beta, out=gamma[:, t])
            back = e[:, t]
            back *= beta
            if scale[t] is not None:
                back /= scale[t]
            if t:
                was = alpha[t - 1]
            elif before is not None:
                was = np.where(first, 0.0, before)
            else:
                break
            moves += (was if live[t].all() else was * live[t]) @ back.T
            beta = self.move @ back
        moves *= self.move
        flat = sym.ravel()
        emits = np.stack([np.bincount(flat, g.ravel(), len(self.emit) + 1)[:-1] for g in gamma], 1)
        return gamma[:, 0, first].sum(1, dtype=np.float64), moves, emits, total, beta

    def _walk(self, seq: np.ndarray, first: np.ndarray, before: np.ndarray | None) -> tuple:
        """The forward recursion: symbols, emissions, scaled states and scales of all steps."""
        sym, e = self._emissions(seq)
        alpha: list[np.ndarray] = []
        scale: list[np.ndarray] = []
        self._forward(e, first, before, alpha, scale)
        return sym, e, alpha, scale

    def expected_of_texts(self, texts: list[np.ndarray], p: HmmParams) -> list:
        """Expected starts, moves and emissions of whole texts, and their log10 likelihood.

        The recursions run in single precision (states are scaled at every step), all sums in double.
        """
        s = len(self.start)
        single = Hmm(*(x.astype(np.float32) for x in (self.start, self.move, self.emit)))
        out = [np.zeros(s), np.zeros((s, s)), np.zeros((len(self.emit), s)), 0.0]
        texts = sorted(texts, key=len, reverse=True)
        for g in range(0, len(texts), p.width):
            group = texts[g:g + p.width]
            lengths = np.array([len(t) for t in group])
            parts = []
            for lo in range(0, int(lengths[0]), p.segment):
                rows = int((lengths > lo).sum())  # the longest come first
                seq = np.full((rows, min(p.segment, int(lengths[0]) - lo)), -1, np.int32)
                for row, t in zip(seq, group):
                    cut = t[lo:lo + p.segment]
                    row[:len(cut)] = cut
                parts.append(seq)
            # forward states at the borders, then the segments from the last to the first; the states
            # of all steps are kept where they are few, else each segment is walked a second time
            keep = sum(map(np.size, parts)) <= p.kept
            border: list = [None]
            walked: list = [None] * len(parts)
            for k, seq in enumerate(parts[:-1]):
                begins = np.full(len(seq), k == 0)
                if keep:
                    walked[k] = single._walk(seq, begins, border[k])
                    a = walked[k][2][-1]
                else:
                    a = single._forward(single._emissions(seq)[1], begins, border[k], [], None)
                border.append(a[:, :len(parts[k + 1])])
            after = None
            for k in range(len(parts) - 1, -1, -1):
                beta = np.ones((s, len(parts[k])), np.float32)
                if after is not None:
                    beta[:, :after.shape[1]] = after
                *sums, after = single.expected(parts[k], np.full(len(parts[k]), k == 0), border[k], beta, walked[k])
                walked[k] = None
                out = [x + y for x, y in zip(out, sums)]
        return out


def train_flag(p: HmmParams):
    return fold(F.col("doc_id"), p.folds) != p.held_out


def count_words(train: DataFrame) -> DataFrame:
    """(word, n): occurrences of every token's hash in the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        seen: list[np.ndarray] = []
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        held = distinct = 0

        def gather():
            parts.append(np.unique(np.concatenate(seen), return_counts=True))

        def flush():
            w, at = np.unique(np.concatenate([x for x, _ in parts]), return_inverse=True)
            n = np.bincount(at, np.concatenate([x for _, x in parts])).astype(np.int64)
            for i in range(0, len(w), 200_000):
                yield pa.RecordBatch.from_arrays([pa.array(w[i:i + 200_000].view(np.int64)), pa.array(n[i:i + 200_000])], names=["word", "n"])

        for b in in_slices(batches):
            for t in b.column("text"):
                seen.append(words(t.as_py()))
                held += len(seen[-1])
                if held > 200_000:  # small parts sort faster
                    gather()
                    distinct += len(parts[-1][0])
                    seen, held = [], 0
                    if distinct > 2_000_000:
                        yield from flush()
                        parts, distinct = [], 0
        if seen:
            gather()
        if parts:
            yield from flush()

    return train.select("text").mapInArrow(run, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def symbol_bytes(p: HmmParams) -> str:
    return "<u2" if p.symbols <= 1 << 16 else "<u4"


def train_symbols(train: DataFrame, p: HmmParams) -> DataFrame:
    """The symbols of every training text, as the bytes of small integers (a list of numbers costs the JVM more than a round)."""
    kind = symbol_bytes(p)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for b in in_slices(batches):
            yield pa.RecordBatch.from_arrays(
                [pa.array([symbol_of(words(t.as_py()), p).astype(kind).tobytes() for t in b.column("text")], pa.binary())], names=["symbols"])

    return train.select("text").mapInArrow(run, "symbols binary")


def train_hmm(train: DataFrame, p: HmmParams) -> Hmm:
    """Baum-Welch: expected counts per partition, summed by Spark; the model has a fixed size."""
    model = Hmm.first(p)
    s, m = p.states, p.symbols
    symbols = materialize(train_symbols(train, p), "symbols")
    kind = symbol_bytes(p)
    last = None
    for _ in range(p.rounds):
        shared = train.sparkSession.sparkContext.broadcast(model)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            now = shared.value
            sums = np.zeros(s + s * s + m * s + 2)  # and the likelihood, and the tokens
            texts: list[np.ndarray] = []
            held = 0

            def learn():
                start, moves, emits, total = now.expected_of_texts(texts, p)
                np.add(sums, np.concatenate([start, moves.ravel(), emits.ravel(), [total, held]]), out=sums)

            for b in in_slices(batches):
                for t in b.column("symbols"):
                    texts.append(np.frombuffer(t.as_buffer(), kind).astype(np.int32))
                    held += len(texts[-1])
                    if held >= p.pool:
                        learn()
                        texts, held = [], 0
            if texts:
                learn()
            hit = np.flatnonzero(sums)
            yield pa.RecordBatch.from_arrays([pa.array(hit, pa.int32()), pa.array(sums[hit], pa.float64())], names=["i", "x"])

        sums = symbols.mapInArrow(run, "i int, x double").groupBy("i").agg(F.sum("x").alias("x")).collect()
        flat = np.zeros(s + s * s + m * s + 2)
        for r in sums:
            flat[r["i"]] = r["x"]
        start, moves, emits = flat[:s] + p.smooth, flat[s:s + s * s].reshape(s, s) + p.smooth, flat[s + s * s:-2].reshape(m, s) + p.smooth
        model = Hmm(start / start.sum(), moves / moves.sum(1, keepdims=True), emits / emits.sum(0))
        likelihood = flat[-2] / max(flat[-1], 1)  # of the model before this round
        if last is not None and likelihood - last < p.least_gain:
            break
        last = likelihood
    return model


def score_texts(docs: DataFrame, p: HmmParams = HmmParams()) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row of (doc_id, text)."""
    spark = docs.sparkSession
    docs = pick(docs, "doc_id", "text")
    train = docs.filter(train_flag(p))
    counts = materialize(count_words(train), "word-counts")
    sym = F.pmod(F.col("word"), F.lit(p.symbols))
    # pmod of the signed hash is the unsigned remainder as long as symbols divides 2 ** 64
    per_symbol = counts.groupBy(sym.cast("int").alias("s")).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).collect()
    in_symbol, kinds = np.zeros(p.symbols), np.zeros(p.symbols)
    for r in per_symbol:
        in_symbol[r["s"]], kinds[r["s"]] = r["n"], r["v"]
    tokens, vocab = int(in_symbol.sum()), int(kinds.sum())
    # at most ``frequent`` words can reach this count
    floor = -(-max(tokens, 1) // p.frequent)
    top = counts.filter(F.col("n") >= floor).toArrow()
    top_words, top_counts = top.column("word").to_numpy(), top.column("n").to_numpy().astype(np.float64)
    order = np.argsort(top_words)
    model = train_hmm(train, p)
    shared = spark.sparkContext.broadcast((top_words[order], np.append(top_counts[order], 0.0), in_symbol + kinds + 1, model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, known_n, symbol_total, m = shared.value
        words = Words()
        top_log, total_log = np.log10(known_n + 1), np.log10(symbol_total)
        for b in in_slices(batches, 4000):
            syms, n, n_top, logs, rare = [], [], [], [], []
            within = []
            for part in in_slices([b], 200):
                # words of some texts are looked up once each
                hashes = [words(t.as_py()) for t in part.column("text")]
                size = np.array([len(h) for h in hashes])
                begin = np.cumsum(size) - size  # no text is without the end token
                flat = np.concatenate(hashes)
                kinds, which = np.unique(flat, return_inverse=True)
                signed = kinds.view(np.int64)
                i = np.searchsorted(known, signed)
                i[i == len(known)] = 0
                hit = known[i] == signed if len(known) else np.zeros(len(kinds), bool)
                y = symbol_of(flat, p)
                syms += np.split(y, begin[1:])
                n.append(size)
                hits = hit[which]
                n_top.append(np.add.reduceat(hits.astype(np.int64), begin))
                logs.append(np.add.reduceat(np.where(hit, top_log[i], 0.0)[which], begin))
                within.append(np.add.reduceat(total_log[y], begin))
                rare.append((flat[~hits].view(np.int64), size - n_top[-1]))
            offsets = pa.array(np.concatenate([[0], *[x for _, x in rare]]).cumsum().astype(np.int32))
            lists = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([x for x, _ in rare])))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), *[pa.array(np.concatenate(x)) for x in (n, n_top, logs)],
                 pa.array(m.log10(syms) - np.concatenate(within)), lists],
                names=["doc_id", "n_tokens", "n_top", "top_log", "rest_log", "rare"])

    texts = docs.mapInArrow(run, "doc_id bigint, n_tokens bigint, n_top bigint, top_log double, rest_log double, rare array<bigint>")
    # a number of its own for each row, so that repeated ids stay apart; fixed by the write
    texts = materialize(texts.withColumn("row", F.monotonically_increasing_id()), "scored")
    rare = texts.select("row", F.explode("rare").alias("word"))
    rare = rare.join(counts, "word").groupBy("row").agg(F.count(F.lit(1)).alias("n_rare"), F.sum(F.log10(F.col("n") + 1)).alias("rare_log"))
    joined = texts.drop("rare").join(rare, "row", "left")
    logs = F.col("top_log") + F.coalesce("rare_log", F.lit(0.0))
    return joined.select(
        "doc_id", (~train_flag(p)).alias("held_out"), "n_tokens",
        (F.col("n_top") + F.coalesce("n_rare", F.lit(0))).cast("long").alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (logs - F.col("n_tokens") * F.lit(float(np.log10(tokens + vocab + 1)))).alias("base_score"),
        (logs + F.col("rest_log")).alias("score"))
