"""Language of documents and of their spans: scripts narrow the candidates, Viterbi labels the words.

*Model.* Letter n-grams of every training text are counted by language into hash buckets
(partial counts per task, summed by Spark), and so are the scripts of the letters.  The model is
a table of log probabilities of at most ``cells`` numbers, whatever the corpus; languages are the
distinct values of the training rows.

*Words.* A word is a run of letters (and marks).  Its candidates are the languages that use all
its scripts (a script makes up ``min_share`` of a language's letters or more), else those that
use one of them, else all.  Its score for a language is the mean over n-gram orders of the
n-grams' log probabilities.

*Spans.* A path gives each word a language; it gains the words' scores and pays ``switch`` for
every change.  The best path is found by Viterbi over all of a task's texts at once.  A text
whose best single language cannot be beaten (no stretch gains more than one change costs
elsewhere) needs no such walk; the path is the same.

The document's language is the one with the most letters (ties: higher score of the text, then
the smaller name).  Its score is the share of those letters times the language's probability
from the scores of its spans' words.

Defined results: a null text, or one without a letter, is `und` with score 0 and no spans; so is
every text if there are no training rows.  Training rows with a null language or text teach
nothing; repeated rows count as often as they occur and are returned as often.  Runs of letters
longer than ``pool`` are words of that length.  More than ``max_languages`` languages are an error.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold, in_slices, pick

UNDETERMINED = "und"

# Code point ranges of scripts (first, last), by the Unicode blocks; what is in none is script 0.
SCRIPTS = [
    ("latin", [(0x41, 0x24F), (0x250, 0x2AF), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA720, 0xA7FF), (0xAB30, 0xAB6F), (0xFB00, 0xFB06), (0xFF21, 0xFF5A)]),
    ("greek", [(0x370, 0x3FF), (0x1F00, 0x1FFF)]),
    ("cyrillic", [(0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)]),
    ("armenian", [(0x530, 0x58F), (0xFB13, 0xFB17)]),
    ("hebrew", [(0x590, 0x5FF), (0xFB1D, 0xFB4F)]),
    ("arabic", [(0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)]),
    ("syriac", [(0x700, 0x74F)]),
    ("thaana", [(0x780, 0x7BF)]),
    ("nko", [(0x7C0, 0x7FF)]),
    ("devanagari", [(0x900, 0x97F), (0xA8E0, 0xA8FF)]),
    ("bengali", [(0x980, 0x9FF)]),
    ("gurmukhi", [(0xA00, 0xA7F)]),
    ("gujarati", [(0xA80, 0xAFF)]),
    ("oriya", [(0xB00, 0xB7F)]),
    ("tamil", [(0xB80, 0xBFF)]),
    ("telugu", [(0xC00, 0xC7F)]),
    ("kannada", [(0xC80, 0xCFF)]),
    ("malayalam", [(0xD00, 0xD7F)]),
    ("sinhala", [(0xD80, 0xDFF)]),
    ("thai", [(0xE00, 0xE7F)]),
    ("lao", [(0xE80, 0xEFF)]),
    ("tibetan", [(0xF00, 0xFFF)]),
    ("myanmar", [(0x1000, 0x109F), (0xA9E0, 0xA9FF), (0xAA60, 0xAA7F)]),
    ("georgian", [(0x10A0, 0x10FF), (0x1C90, 0x1CBF), (0x2D00, 0x2D2F)]),
    ("hangul", [(0x1100, 0x11FF), (0x3130, 0x318F), (0xA960, 0xA97F), (0xAC00, 0xD7FF)]),
    ("ethiopic", [(0x1200, 0x139F), (0x2D80, 0x2DDF), (0xAB00, 0xAB2F)]),
    ("cherokee", [(0x13A0, 0x13FF), (0xAB70, 0xABBF)]),
    ("khmer", [(0x1780, 0x17FF)]),
    ("mongolian", [(0x1800, 0x18AF)]),
    ("kana", [(0x3040, 0x30FF), (0x31F0, 0x31FF), (0xFF66, 0xFF9F)]),
    ("bopomofo", [(0x3100, 0x312F), (0x31A0, 0x31BF)]),
    ("han", [(0x2E80, 0x2FDF), (0x3005, 0x3007), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x323AF)]),
]
N_SCRIPTS = len(SCRIPTS) + 1
LETTER, MARK = 1, 2


@dataclass(frozen=True)
class LangParams:
    orders: int = 4             # n-grams of 1 to so many letters, word borders included
    buckets: int = 1 << 16      # hash buckets of n-grams, a power of two, halved while the model passes ``cells``
    cells: int = 1 << 22        # bound of buckets times languages
    max_languages: int = 4096
    smooth: float = 0.5         # added to every count
    min_share: float = 0.01     # of a language's letters that make a script one of its own
    switch: float = 12.0        # cost of a change of language, in natural log units
    pool: int = 1_000_000       # characters that a task looks at together
    folds: int = 3
    held_out: int = 1


@lru_cache(maxsize=1)
def alphabet() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of every code point: letter, mark or neither; its lower-case form; its script."""
    points = range(0x110000)
    kind = np.array([{"L": LETTER, "M": MARK}.get(unicodedata.category(chr(i))[0], 0) for i in points], np.uint8)
    lower = np.arange(0x110000, dtype=np.uint32)
    for i in np.flatnonzero(kind).tolist():
        low = chr(i).lower()
        if len(low) == 1:
            lower[i] = ord(low)
    script = np.zeros(0x110000, np.uint8)
    for k, (_, ranges) in enumerate(SCRIPTS, 1):
        for first, last in ranges:
            script[first:last + 1] = k
    return kind, lower, script


@dataclass
class Words:
    """The words of a list of texts: text numbers, places in the text, letters, script sets and n-gram buckets."""

    text: np.ndarray      # of each word
    start: np.ndarray     # in its text, in characters
    end: np.ndarray
    letters: np.ndarray
    scripts: np.ndarray   # bit set
    at: np.ndarray        # where each word's n-grams begin
    grams: list[np.ndarray]  # per order, a bucket for each place, or ``buckets`` for none


def read_words(texts: list[str], orders: int, buckets: int) -> Words:
    kind, lower, script = alphabet()
    sizes = np.array([len(t) + 1 for t in texts], np.int64)
    begin = np.cumsum(sizes) - sizes + orders
    # line ends before the first and after each text keep words apart
    raw = np.frombuffer(("\n" * orders + "".join(t + "\n" for t in texts)).encode("utf-32-le", "surrogatepass"), np.uint32)
    kinds = kind[raw]
    inside = kinds > 0
    c = np.where(inside, lower[raw], 0).astype(np.uint32)
    edge = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    starts, ends = edge[::2], edge[1::2]
    text = np.searchsorted(begin, starts, side="right") - 1
    grams = []
    shift = np.uint32(32 - (buckets.bit_length() - 1))
    n = len(c)
    before = np.concatenate([[0], np.cumsum(inside)])
    h = np.zeros(n, np.uint32)
    for k in range(1, orders + 1):
        # h of the k characters up to each place; the borders of a word are character 0
        if k > 1:
            h[1:] = h[:-1]
            h[:1] = 0
        h = h * np.uint32(0x01000193) + c + np.uint32(k)
        mixed = h ^ (h >> np.uint32(15))
        mixed = (mixed * np.uint32(0x9E3779B1)) >> shift if buckets > 1 else np.zeros(n, np.uint32)
        if k == 1:
            valid = inside
        else:
            # a word's characters, but that the first and the last may be its borders
            valid = np.zeros(n, bool)
            valid[k - 1:] = (before[k - 1:n] - before[1:n - k + 2] == k - 2) & ((k > 2) | inside[:n - k + 1] | inside[k - 1:])
        grams.append(np.where(valid, mixed, np.uint32(buckets)).astype(np.int64))
    if len(starts):
        bits = np.where(kinds == LETTER, np.left_shift(np.uint64(1), script[raw].astype(np.uint64)), np.uint64(0))
        scripts = np.bitwise_or.reduceat(bits, starts)
        letters = np.add.reduceat((kinds == LETTER).astype(np.int64), starts)
    else:
        scripts, letters = np.empty(0, np.uint64), np.empty(0, np.int64)
    return Words(text, starts - begin[text], ends - begin[text], letters, scripts, starts, grams)


def pieces(text: str, size: int) -> Iterator[tuple[int, str]]:
    """The text in parts of at most ``size`` characters, cut at white space where there is some."""
    at = 0
    while len(text) - at > size:
        cut = max(text.rfind(c, at, at + size) for c in (" ", "\n"))
        cut = cut + 1 if cut >= at else at + size
        yield at, text[at:cut]
        at = cut
    yield at, text[at:]


@dataclass
class LangModel:
    names: list[str]          # ascending by UTF-8 bytes
    table: np.ndarray         # buckets + 1 rows (the last is zero), a column for each language
    scripts: np.ndarray       # of each language, a bit set
    p: LangParams

    def word_scores(self, w: Words) -> np.ndarray:
        """Scores (words x languages); what is no candidate has -1e6."""
        if not len(w.at):
            return np.empty((0, len(self.names)))
        total = self.table[w.grams[0]]
        for g in w.grams[1:]:
            total += self.table[g]
        scores = np.add.reduceat(total, w.at, axis=0).astype(np.float64) / len(w.grams)
        kinds, which = np.unique(w.scripts, return_inverse=True)
        allowed = np.empty((len(kinds), len(self.names)), bool)
        for i, s in enumerate(kinds):
            whole = (self.scripts & s) == s
            allowed[i] = whole if whole.any() else (self.scripts & s) != 0
            if not allowed[i].any():
                allowed[i] = True
        return np.where(allowed[which], scores, -1e6)

    def paths(self, scores: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The best language of each word; ``sizes`` are the texts' word counts."""
        out = np.zeros(len(scores), np.int64)
        begin = np.cumsum(sizes) - sizes
        mixed = []
        for k in np.flatnonzero(sizes):
            s = scores[begin[k]:begin[k] + sizes[k]]
            best = int(s.sum(0).argmax())
            out[begin[k]:begin[k] + sizes[k]] = best
            if s.shape[1] > 1:
                gain = s - s[:, best:best + 1]
                gain[:, best] = -np.inf
                run = np.concatenate([[0.0], np.cumsum(gain.max(1))])
                if (run - np.minimum.accumulate(run)).max() > self.p.switch:
                    mixed.append(k)
        if mixed:
            self._viterbi(scores, begin, sizes, np.array(mixed), out)
        return out

    def _viterbi(self, scores: np.ndarray, begin: np.ndarray, sizes: np.ndarray, which: np.ndarray, out: np.ndarray) -> None:
        which = which[np.argsort(-sizes[which], kind="stable")]
        lengths, first = sizes[which], begin[which]
        # texts that still go on at each step; the longest come first
        active = np.searchsorted(-lengths, -np.arange(lengths[0]), side="left")
        stays, tops = [], []
        value = None
        for t in range(int(lengths[0])):
            here = scores[first[:active[t]] + t]
            if value is None:
                value = here
                ends = np.zeros((len(which), here.shape[1]))
            else:
                value = value[:active[t]]
                top = value.argmax(1)
                other = value[np.arange(len(value)), top][:, None] - self.p.switch
                stay = value >= other
                stays.append(stay)
                tops.append(top)
                value = np.where(stay, value, other) + here
            ends[:active[t]] = value
        state = ends.argmax(1)
        for t in range(int(lengths[0]) - 1, -1, -1):
            n = active[t]
            out[first[:n] + t] = state[:n]
            if t:
                stay = stays[t - 1][np.arange(n), state[:n]]
                state[:n] = np.where(stay, state[:n], tops[t - 1])

    def label(self, texts: list[str]) -> list[tuple[str, float, list[dict]]]:
        """Language, score and spans of each text."""
        parts = [(k, at, piece) for k, t in enumerate(texts) for at, piece in pieces(t, self.p.pool)]
        cols: list[list[np.ndarray]] = [[], [], [], [], []]
        group: list[tuple[int, int, str]] = []

        def take():
            w = read_words([g[2] for g in group], len_orders, buckets)
            text = np.array([g[0] for g in group])
            shift = np.array([g[1] for g in group])
            for c, x in zip(cols, (text[w.text], w.start + shift[w.text], w.end + shift[w.text], w.letters, self.word_scores(w))):
                c.append(x)

        len_orders, buckets, held = self.p.orders, len(self.table) - 1, 0
        for part in parts:
            group.append(part)
            held += len(part[2])
            if held >= self.p.pool:
                take()
                group, held = [], 0
        if group:
            take()
        if not cols[0]:
            return []
        text, start, end, letters, scores = (np.concatenate(c) for c in cols)
        sizes = np.bincount(text, minlength=len(texts))
        path = self.paths(scores, sizes)
        begin = np.cumsum(sizes) - sizes
        return [self._verdict(*(x[b:b + n] for x in (start, end, letters, scores, path))) for b, n in zip(begin.tolist(), sizes.tolist())]

    def _verdict(self, start, end, letters, scores, path) -> tuple[str, float, list[dict]]:
        if not letters.sum():
            return UNDETERMINED, 0.0, []
        per = np.bincount(path, letters, len(self.names))
        whole = scores.sum(0)
        best = max(np.flatnonzero(per == per.max()).tolist(), key=lambda k: (whole[k], -k))
        mine = scores[path == best].sum(0)
        odds = np.exp(mine - mine.max())
        at = np.flatnonzero(np.diff(path, prepend=-1))
        spans = [{"start": s, "end": e, "lang": self.names[k]} for s, e, k in
                 zip(start[at].tolist(), end[np.append(at[1:], len(path)) - 1].tolist(), path[at].tolist())]
        return self.names[best], float(min(1.0, odds[best] / odds.sum() * per[best] / per.sum())), spans


def train_flag(p: LangParams):
    return fold(F.col("doc_id"), p.folds) != p.held_out


def fit(train: DataFrame, p: LangParams = LangParams()) -> LangModel:
    """The model of the rows (text, lang): n-gram and script counts of all of them."""
    train = pick(train, "text", "lang").select(F.col("text").cast("string"), F.col("lang").cast("string")).filter("text is not null and lang is not null")
    names = [r[0] for r in train.select("lang").distinct().limit(p.max_languages + 1).collect()]
    if len(names) > p.max_languages:
        raise ValueError(f"more than {p.max_languages} languages")
    names.sort(key=lambda x: x.encode())
    n_lang, buckets = len(names), p.buckets
    while buckets > 2 and buckets * n_lang > p.cells:
        buckets //= 2
    place = {x: i for i, x in enumerate(names)}
    width = buckets + 1 + N_SCRIPTS  # per language: n-grams, no n-gram, scripts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((n_lang, width), np.int64)
        _, _, script = alphabet()

        def learn(parts: list[str], k: int):
            w = read_words(parts, p.orders, buckets)
            for g in w.grams:
                sums[k, :buckets + 1] += np.bincount(g, minlength=buckets + 1)
            raw = np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), np.uint32)
            sums[k, buckets + 1:] += np.bincount(script[raw[alphabet()[0][raw] == LETTER]], minlength=N_SCRIPTS)

        pools: dict[int, list[str]] = {}
        held: dict[int, int] = {}
        for b in in_slices(batches):
            for t, lang in zip(b.column("text"), b.column("lang")):
                k = place[lang.as_py()]
                for _, part in pieces(t.as_py(), p.pool):
                    pools.setdefault(k, []).append(part)
                    held[k] = held.get(k, 0) + len(part)
                    if held[k] >= p.pool:
                        learn(pools.pop(k), k)
                        del held[k]
            if sum(held.values()) >= 4 * p.pool:
                for k in list(pools):
                    learn(pools.pop(k), k)
                held.clear()
        for k, parts in pools.items():
            learn(parts, k)
        sums[:, buckets] = 0
        flat = sums.ravel()
        hit = np.flatnonzero(flat)
        for i in range(0, len(hit), 200_000):
            part = hit[i:i + 200_000]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array(flat[part], pa.int64())], names=["cell", "n"])

    counts = np.zeros((n_lang, width))
    if names:
        # at most cells numbers, plus the scripts
        got = train.mapInArrow(run, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
        counts.ravel()[got.column("cell").to_numpy()] = got.column("n").to_numpy()
    grams, scripts = counts[:, :buckets], counts[:, buckets + 1:]
    logs = np.log((grams + p.smooth) / (grams.sum(1, keepdims=True) + p.smooth * buckets))
    table = np.zeros((buckets + 1, n_lang), np.float32)
    table[:-1] = logs.T
    own = scripts >= p.min_share * np.maximum(scripts.sum(1, keepdims=True), 1)
    bits = (own.astype(np.uint64) << np.arange(N_SCRIPTS, dtype=np.uint64)).sum(1, dtype=np.uint64)
    return LangModel(names, table, bits, p)


def label_documents(docs: DataFrame, model: LangModel) -> DataFrame:
    """doc_id, lang_pred, score and spans (start, end in characters; lang) of every row of (doc_id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        rows = max(1, m.p.pool // 1000)
        for b in in_slices(batches, rows):
            texts = [t.as_py() or "" for t in b.column("text")]
            out = m.label(texts) if m.names else [(UNDETERMINED, 0.0, [])] * len(texts)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.float64()),
                 pa.array([x[2] for x in out], span)], names=["doc_id", "lang_pred", "score", "spans"])

    return pick(docs, "doc_id", "text").select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id bigint, lang_pred string, score double, spans array<struct<start:bigint,end:bigint,lang:string>>")


def identify(docs: DataFrame, p: LangParams = LangParams()) -> DataFrame:
    """doc_id, held_out, lang_pred, score and spans of every row, learnt from the rows that are not held out."""
    model = fit(pick(docs, "doc_id", "text", "lang").filter(train_flag(p)), p)
    out = label_documents(docs, model)
    return out.select("doc_id", (~train_flag(p)).alias("held_out"), "lang_pred", "score", "spans")
