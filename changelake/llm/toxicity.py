"""Toxicity by the nearest labelled examples.

Labelled texts become TF-IDF vectors over terms (words and word stems) that tell the two
classes apart; a document is compared by exact cosine with every example through an
inverted index in blocks.  For each term and block the index knows the largest weight, so
a block's best possible cosine is known before it is read: blocks are visited from the
best bound down, and the search ends when no bound can beat the k-th neighbour found.
The result equals that of comparing with all examples.  The neighbours vote with weights
that fall with their distance; a logistic curve, fitted to labelled examples that are not
in the index, turns votes into probabilities.

What is bounded: the examples, drawn by a hash of their id (``max_examples``), and the
terms (``max_terms``); so is the index, which is why it may be broadcast.  Which examples
are labelled and how often terms occur in them is found by Spark jobs; every document is
scored, over its whole text, without a shuffle.

Defined results: a null or empty text, or one without any term, gets the score that the
calibration gives to no evidence; labels that are null are no labels, and of several labels
of an id the largest counts; without examples of both classes every score is the smoothed
share of the toxic ones (0 without any label).  Rows with a null id are never examples.
Repeated documents are scored alike.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold, in_slices, per_worker, pick

WORD = re.compile(r"\w+")
MEMO_WORDS = 150_000


@dataclass(frozen=True)
class ToxicityParams:
    max_examples: int = 12_000   # bound of the labelled sample
    max_terms: int = 2_000       # bound of the vocabulary
    min_toxic_docs: int = 3      # toxic examples that must have a term
    min_chi2: float = 20.0       # association of a term with the label
    min_ratio: float = 5.0       # a term's rate in toxic over that in other examples
    stems: tuple[int, ...] = (4, 5, 6)
    neighbours: int = 15
    block: int = 64              # examples per block of the index
    folds: int = 5               # ids of fold 0 are never learnt from


def terms_of(word: str, stems: tuple[int, ...]) -> list[str]:
    """The word itself and its beginnings of the given lengths."""
    return ["=" + word, *("^" + word[:n] for n in stems if len(word) > n)]


@dataclass
class BlockMaxIndex:
    """Inverted index over unit vectors with the largest weight per term and block."""

    ids: np.ndarray            # of the examples
    labels: np.ndarray
    docs: list[np.ndarray]     # per term: positions of examples, ascending
    weights: list[np.ndarray]  # and their weights
    block: int
    bounds: np.ndarray = field(init=False)  # terms x blocks: largest weight
    starts: np.ndarray = field(init=False)  # terms x (blocks + 1): where a block's postings begin

    def __post_init__(self):
        blocks = -(-len(self.ids) // self.block)
        self.bounds = np.zeros((len(self.docs), blocks))
        self.starts = np.zeros((len(self.docs), blocks + 1), np.int64)
        edges = np.arange(blocks + 1) * self.block
        for t, (d, w) in enumerate(zip(self.docs, self.weights)):
            self.starts[t] = np.searchsorted(d, edges)
            np.maximum.at(self.bounds[t], d // self.block, w)

    def search(self, terms: list[int], weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions and cosines of the k nearest examples with a positive cosine.

        Ties go to the smaller position.
        """
        bound = weights @ self.bounds[terms]
        best_pos, best = np.empty(0, np.int64), np.empty(0)
        for b in np.argsort(-bound, kind="stable"):
            if bound[b] <= 0 or (len(best) == k and bound[b] < best[-1] - 1e-12):
                break
            score = np.zeros(self.block)
            for t, q in zip(terms, weights):
                lo, hi = self.starts[t, b], self.starts[t, b + 1]
                if hi > lo:
                    score[self.docs[t][lo:hi] - b * self.block] += q * self.weights[t][lo:hi]
            hit = np.flatnonzero(score > 0)
            best_pos, best = np.concatenate([best_pos, hit + b * self.block]), np.concatenate([best, score[hit]])
            order = np.lexsort((best_pos, -best))[:k]
            best_pos, best = best_pos[order], best[order]
        return best_pos, best


@dataclass
class ToxicityModel:
    terms: dict[str, int]
    idf: np.ndarray
    index: BlockMaxIndex | None
    prior: float
    curve: np.ndarray  # intercept, weight of the vote, weight of the evidence's size
    params: ToxicityParams

    def vector(self, counts: Counter) -> tuple[list[int], np.ndarray, float]:
        """Terms (ascending), unit weights and the length before scaling."""
        terms = sorted(counts)
        w = (1 + np.log([counts[t] for t in terms])) * self.idf[terms]
        norm = float(np.sqrt((w * w).sum()))
        return terms, w / norm, norm

    def vote(self, counts: Counter) -> tuple[float, float, np.ndarray]:
        """The neighbours' vote (0 to 1), the size of the evidence, the neighbours' ids."""
        if not counts or self.index is None:
            return self.prior, 0.0, np.empty(0, np.int64)
        terms, w, norm = self.vector(counts)
        pos, cos = self.index.search(terms, w, self.params.neighbours)
        weight = 1.0 / (1.05 - np.minimum(cos, 1.0))
        toxic = (weight * self.index.labels[pos]).sum()
        return float((toxic + self.prior) / (weight.sum() + 1.0)), float(np.log1p(norm)), self.index.ids[pos]

    def score(self, counts: Counter) -> tuple[float, np.ndarray]:
        vote, size, ids = self.vote(counts)
        return float(1 / (1 + np.exp(-(self.curve @ [1.0, vote, size])))), ids


class TermCounter:
    """Counts the vocabulary's terms of a text; remembers the terms of words."""

    def __init__(self, terms: dict[str, int], stems: tuple[int, ...]):
        class Memo(dict):
            def __missing__(self, word):
                value = self[word] = tuple(terms[t] for t in terms_of(word, stems) if t in terms)
                return value

        self.memo = Memo()

    def __call__(self, text: str | None) -> Counter:
        if len(self.memo) > MEMO_WORDS:
            self.memo.clear()
        return Counter(chain.from_iterable(filter(None, map(self.memo.__getitem__, WORD.findall((text or "").lower())))))


def _logistic(x: np.ndarray, y: np.ndarray, rounds: int = 50, ridge: float = 0.05) -> np.ndarray:
    """Logistic regression by Newton steps with a small ridge."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), x.T @ (y - p) - ridge * w)
        w = w + step
        if np.abs(step).max() < 1e-9:
            break
    return w


def labelled_sample(docs: DataFrame, labels: DataFrame, p: ToxicityParams) -> DataFrame:
    """doc_id, text, toxic and tune (not for the index) of at most ``max_examples`` rows."""
    known = pick(labels, "doc_id", "toxic").filter("toxic IN (0, 1) AND doc_id IS NOT NULL")
    known = known.filter(fold(F.col("doc_id"), p.folds) != 0).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    # the size is bounded by the parameter, so a broadcast is safe
    drawn = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(p.max_examples)
    texts = pick(docs, "doc_id", "text").join(F.broadcast(drawn), "doc_id")
    return texts.groupBy("doc_id", "toxic").agg(F.min("text").alias("text")).withColumn(
        "tune", fold(F.col("doc_id"), p.folds) == 1)


def fit(docs: DataFrame, labels: DataFrame, params: ToxicityParams = ToxicityParams()) -> ToxicityModel:
    """Choose the terms, build the index and fit the calibration."""
    p = params
    sample = labelled_sample(docs, labels, p).persist()
    totals = {(r["tune"], r["toxic"]): r["n"] for r in sample.groupBy("tune", "toxic").agg(F.count("*").alias("n")).collect()}
    n_all, n_toxic = sum(totals.values()), sum(n for (_, y), n in totals.items() if y)
    prior = (n_toxic + 0.5) / (n_all + 1.0) if n_all else 0.0
    n1, n0 = totals.get((False, 1), 0), totals.get((False, 0), 0)
    flat = np.array([np.log(prior / (1 - prior)) if 0 < prior < 1 else -30.0, 0.0, 0.0])
    empty = ToxicityModel({}, np.empty(0), None, prior, flat, p)
    if not n1 or not n0:
        sample.unpersist()
        return empty
    stems = p.stems

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with_term: tuple[Counter, Counter] = (Counter(), Counter())
        for b in in_slices(batches):
            for text, y in zip(b.column("text"), b.column("toxic")):
                words = set(WORD.findall((text.as_py() or "").lower()))
                with_term[y.as_py()].update({t for w in words for t in terms_of(w, stems)})
        terms = list(with_term[0].keys() | with_term[1].keys())
        yield pa.RecordBatch.from_arrays(
            [pa.array(terms, pa.string()), *(pa.array([with_term[y][t] for t in terms], pa.int64()) for y in (0, 1))],
            names=["term", "clean", "toxic"])

    counts = sample.filter("NOT tune").select("text", "toxic").mapInArrow(count, "term string, clean bigint, toxic bigint")
    counts = counts.groupBy("term").agg(F.sum("clean").alias("a0"), F.sum("toxic").alias("a1"))
    a0, a1, m0, m1 = F.col("a0").cast("double"), F.col("a1").cast("double"), float(n0), float(n1)
    chi2 = (m0 + m1) * F.pow(a1 * (m0 - a0) - a0 * (m1 - a1), 2) / (m1 * m0 * (a0 + a1) * (m0 + m1 - a0 - a1) + 1e-9)
    ratio = ((a1 + 0.5) / (m1 + 1)) / ((a0 + 0.5) / (m0 + 1))
    chosen = counts.withColumn("chi2", chi2).filter(
        (F.col("a1") >= p.min_toxic_docs) & (F.col("chi2") >= p.min_chi2) & (ratio >= p.min_ratio)
    ).orderBy(F.desc("chi2"), "term").limit(p.max_terms).collect()
    if not chosen:
        sample.unpersist()
        return empty
    terms = {r["term"]: i for i, r in enumerate(chosen)}
    idf = np.log([(n0 + n1 + 1) / (r["a0"] + r["a1"] + 1) for r in chosen]) + 1.0

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = TermCounter(terms, stems)
        for b in in_slices(batches):
            found = [counter(t.as_py()) for t in b.column("text")]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("toxic"), b.column("tune"),
                 pa.array([list(c.keys()) for c in found], pa.list_(pa.int32())),
                 pa.array([list(c.values()) for c in found], pa.list_(pa.int32()))],
                names=["doc_id", "toxic", "tune", "t", "n"])

    rows = sample.select("doc_id", "toxic", "tune", "text").mapInArrow(
        vectors, "doc_id bigint, toxic int, tune boolean, t array<int>, n array<int>").collect()
    sample.unpersist()
    model = ToxicityModel(terms, idf, None, prior, flat, p)
    # examples without any term have cosine 0 with everything: they only count in the prior
    placed = []
    for r in rows:
        if not r["tune"] and r["t"]:
            t, w, _ = model.vector(Counter(dict(zip(r["t"], r["n"]))))
            placed.append((t[int(np.argmax(w))], r["doc_id"], r["toxic"], t, w))
    placed.sort(key=lambda x: x[:2])  # alike examples share blocks, which sharpens the bounds
    docs_of, weights_of = [[] for _ in terms], [[] for _ in terms]
    for i, (_, _, _, t, w) in enumerate(placed):
        for a, b in zip(t, w):
            docs_of[a].append(i)
            weights_of[a].append(b)
    model.index = BlockMaxIndex(
        np.array([x[1] for x in placed], np.int64), np.array([x[2] for x in placed], float),
        [np.array(x, np.int64) for x in docs_of], [np.array(x, float) for x in weights_of], p.block)
    tune = [r for r in rows if r["tune"]]
    if {r["toxic"] for r in tune} == {0, 1}:
        x = np.array([[1.0, *model.vote(Counter(dict(zip(r["t"], r["n"]))))[:2]] for r in tune])
        model.curve = _logistic(x, np.array([r["toxic"] for r in tune], float))
    else:
        # too few examples for a curve: the vote itself, read as a probability
        model.curve = np.array([-4.0, 8.0, 0.0])
    return model


def score_documents(docs: DataFrame, model: ToxicityModel, text: str = "text") -> DataFrame:
    """Add score, predicted and evidence (ids of the nearest examples) to the rows of ``docs``."""
    added = {"score": "double", "predicted": "int", "evidence": "array<bigint>"}
    docs = docs.drop(*added)
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema), *(f"{k} {v}" for k, v in added.items())])
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by max_examples and max_terms

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        counter = per_worker(("terms", id(m.terms)), lambda: TermCounter(m.terms, m.params.stems))
        for b in in_slices(batches):
            got = [m.score(counter(t.as_py())) for t in b.column(text)]
            scores = np.array([s for s, _ in got], float)
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(scores, pa.float64()), pa.array((scores >= 0.5).astype(np.int32), pa.int32()),
                 pa.array([ids.tolist() for _, ids in got], pa.list_(pa.int64()))],
                names=[*b.schema.names, *added])

    return docs.mapInArrow(run, schema)


def toxicity_scores(docs: DataFrame, labels: DataFrame, params: ToxicityParams = ToxicityParams()) -> DataFrame:
    """doc_id, held_out, score, predicted, evidence of every document."""
    scored = score_documents(pick(docs, "doc_id", "text"), fit(docs, labels, params))
    return scored.select("doc_id", (fold(F.col("doc_id"), params.folds) == 0).alias("held_out"), "score", "predicted", "evidence")
