"""MinHash near-duplicates by a chosen-path set similarity join.

A document's set is its distinct word shingles (``words`` words each).  Equal sets are one
class from the start, so thousands of copies cost one row.  Every class then walks down
independent random trees: at a node a hash of the node chooses one of the class's minwise tokens, and the token
names the child.  Two classes of Jaccard similarity s stay together for a level with
probability s, so similar ones meet in small nodes and others part.  A node that is still
larger than ``small_node`` is divided further, by ``stride`` tokens at a time down to
``last_level``; only its members take part in the next level.  There the walk branches: a
node is divided in one way or more, each by tokens of its own, so many that a pair at the
threshold stays together in one child on average.  So the depth that a node needs costs
such a pair little (:func:`recall`), where a walk without branches loses a fifth of them
with every level.

Links are confirmed on the full sets, step by step, each step only between members that the
steps before have not brought into one component.  A node's hub is the member that shares most
nodes with others over all trees; a class first meets the hub that it shares most nodes with
and then the other ones, so a group of thousands of near copies costs a star of links, not all
pairs.  Then small nodes compare their members exhaustively.  Nodes that are still large at
``last_level`` do so too: a member outside the node's most frequent component takes the members
most like it first, which settles most, and then all.  Nodes compare briefs of the sets
(:func:`may_reach`), large ones in blocks, and only pairs that pass become rows.  Components are
found by joins (:mod:`graph`).

Defined results: upper-case ASCII letters are lowered, words end at ASCII white space; a
text with fewer words than a shingle has its whole sequence as only element; a null or
wordless text has the empty set and is linked with nothing; the smallest doc_id of a component names it and is kept, a
row with a null id only where no other id is in its component; a component of null ids has
a null name and is kept; rows that repeat an id are returned as often as they occur.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import WordHashes, in_slices, in_tasks, materialize, mix64, per_worker, pick, scratch_block
from .graph import connected_components

_STEP = np.uint64(0x9E3779B97F4A7C15)

# rows that a task writes: names and numbers only; with tokens or briefs, or joined with those; with whole sets
NARROW, WIDE, SETS = 100_000, 20_000, 2_000


@dataclass(frozen=True)
class NearDupParams:
    words: int = 5            # words of a shingle
    similarity: int = 80      # per cent of the union that two sets must share
    trees: int = 24           # independent walks; see recall()
    first_level: int = 4      # levels before the first comparison, without branches
    last_level: int = 8
    heads: int = 2            # members of a block that the rest of a large node takes before it takes all
    block: int = 1024         # members of a large node that are compared at once
    stride: int = 2           # tokens that a large node is divided by at a time
    small_node: int = 32      # nodes up to this size are compared exhaustively
    tokens: int = 64          # minwise tokens per class
    bits: int = 1024          # of the parity map of a class

    @property
    def least_tokens(self) -> int:
        """Equal minwise tokens below which a pair is not looked at on full sets.

        Their share estimates the similarity; six standard deviations below the threshold a
        pair at the threshold is lost once in a billion.
        """
        s = self.similarity / 100
        return int(self.tokens * s - 6 * (self.tokens * s * (1 - s)) ** 0.5)

    def most_bits(self, elements: np.ndarray) -> np.ndarray:
        """Different bits of two parity maps above which a pair of so many elements in all is not looked at.

        At the similarity at most ``d`` elements are in one set only, and each changes one bit; where
        maps are crowded, their expected difference and six standard deviations are less than ``d``.
        """
        d = elements * (100 - self.similarity) // (100 + self.similarity)
        expected = self.bits / 2 * (1 - (1 - 2 / self.bits) ** d)
        return np.minimum(d, expected + 6 * self.bits ** 0.5 / 2)


def ways(p: NearDupParams) -> float:
    """In how many ways a large node is divided on average: one child of a pair at the threshold is shared."""
    return (100 / p.similarity) ** p.stride


def recall(p: NearDupParams, level: int) -> float:
    """Share of pairs at the threshold that meet in a node of ``level`` in some tree.

    Taken over independent tokens; a pair's tokens are drawn from ``tokens`` ones, whose share
    of equal ones scatters around the similarity, so the share of all such pairs is a little less.
    """
    s = p.similarity / 100
    keep, least, more = s ** p.stride, int(ways(p)), ways(p) % 1
    apart = 0.0  # probability that a shared node has no shared node at the level, from the bottom up
    for _ in range(p.first_level, level, p.stride):
        lost = 1 - keep * (1 - apart)
        apart = (1 - more) * lost ** least + more * lost ** (least + 1)
    return 1 - (1 - s ** p.first_level * (1 - apart)) ** p.trees


class Shingler:
    """Sets of 64-bit shingle hashes and their minwise tokens."""

    def __init__(self, words: int, tokens: int = 1):
        self.words = words
        self.hashes = WordHashes()
        rng = np.random.default_rng(20240101)
        self.mul = rng.integers(1, 1 << 63, tokens, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.add = rng.integers(0, 1 << 63, tokens, dtype=np.uint64)

    def shingles(self, text: str | None) -> np.ndarray:
        """The distinct shingles' hashes, ascending."""
        h = self.hashes(text)
        n = min(self.words, len(h))  # a short text is one shingle of its own length
        if not n:
            return h
        x = np.full(len(h) - n + 1, np.uint64(n), np.uint64)
        for i in range(n):
            x = mix64(x * _STEP + h[i:len(h) - n + 1 + i])
        return np.unique(x)

    def signature(self, s: np.ndarray) -> np.ndarray:
        out = np.full(len(self.mul), np.iinfo(np.uint64).max, np.uint64)
        for i in range(0, len(s), 2048):
            np.minimum(out, (s[i:i + 2048, None] * self.mul + self.add).min(0), out=out)
        return (out >> np.uint64(32)).astype(np.uint32).view(np.int32)

    @staticmethod
    def brief(s: np.ndarray, signature: np.ndarray, bits: int) -> bytes:
        """Set size, parity map (a bit tells whether the shingles of its hash are odd in number), tokens' low bytes."""
        odd = np.bincount((s % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
        return len(s).to_bytes(8, "little") + np.packbits(odd.astype(np.uint8)).tobytes() + signature.astype(np.uint8).tobytes()


class Briefs:
    """The briefs of rows, taken apart."""

    def __init__(self, rows: pa.StructArray, p: NearDupParams):
        raw = np.frombuffer(b"".join(rows.field("brief").to_pylist()), np.uint8).reshape(len(rows), -1)
        self.cls, self.label, self.p = rows.field("cls"), rows.field("label"), p
        self.size = raw[:, :8].copy().view(np.int64)[:, 0]
        self.odd = raw[:, 8:8 + p.bits // 8].copy().view(np.uint64)
        self.low = raw[:, 8 + p.bits // 8:].copy()


def may_reach(a: Briefs, x: np.ndarray, b: Briefs, y: np.ndarray, tokens: bool = True) -> np.ndarray:
    """Whether rows ``x`` of ``a`` and ``y`` of ``b`` may reach the similarity, by their parity maps and ``tokens``."""
    out = np.empty(len(x), bool)
    for at in range(0, len(x), 1 << 14):
        i, j = x[at:at + (1 << 14)], y[at:at + (1 << 14)]
        near = np.bitwise_count(a.odd[i] ^ b.odd[j]).sum(1, dtype=np.int64) <= a.p.most_bits(a.size[i] + b.size[j])
        out[at:at + (1 << 14)] = near & ((a.low[i] == b.low[j]).sum(1) >= a.p.least_tokens) if tokens else near
    return out


def sketch(docs: DataFrame, p: NearDupParams) -> DataFrame:
    """doc_id, text_hash, n_shingles, cls (hash of the whole set; null if empty), sig and brief of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sh = per_worker(("shingles", p.words, p.tokens), lambda: Shingler(p.words, p.tokens))
        for b in in_slices(batches):
            n, cls, sig, brief = [], [], [], []
            for t in b.column("text"):
                s = sh.shingles(t.as_py())
                n.append(len(s))
                cls.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                sig.append(sh.signature(s) if len(s) else None)
                brief.append(sh.brief(s, sig[-1], p.bits) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("text_hash"), pa.array(n, pa.int64()), pa.array(cls, pa.binary()), pa.array(sig, pa.list_(pa.int32())), pa.array(brief, pa.binary())],
                names=["doc_id", "text_hash", "n_shingles", "cls", "sig", "brief"])

    texts = pick(docs, "doc_id", "text").withColumn("text_hash", F.xxhash64("text"))
    return texts.mapInArrow(run, "doc_id bigint, text_hash bigint, n_shingles bigint, cls binary, sig array<int>, brief binary")


def child(node: Column, sig: Column, level: int, p: NearDupParams) -> Column:
    """The node below ``node`` that the class with minwise tokens ``sig`` belongs to."""
    chosen = F.get(sig, F.pmod(F.xxhash64(node, F.lit(level)), F.lit(p.tokens)).cast("int"))
    return F.xxhash64(node, chosen)


def ways_of(node: Column, p: NearDupParams) -> Column:
    """In how many ways ``node`` is divided: the same for all its members, :func:`ways` on average."""
    least = int(ways(p))
    chance = F.pmod(F.xxhash64(node, F.lit("ways")), F.lit(1 << 20)) < int((ways(p) - least) * (1 << 20))
    return F.lit(least) + chance.cast("int")


def walk(classes: DataFrame, p: NearDupParams) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The members (node, cls, size) of all nodes with two members or more, each class's weight, and those of
    the members whose node is large and not divided further."""
    spark = classes.sparkSession
    folder = scratch_path(spark, "nodes")
    n = classes.count()

    def keep(rows: DataFrame, level: int, n: int) -> DataFrame:
        # sizes are a partial aggregation; written, so that Spark may split a large node in the join
        sizes = rows.groupBy("node").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
        sizes = materialize(in_tasks(sizes, n, NARROW), "sizes")
        in_tasks(rows.join(sizes, "node"), n, NARROW).write.parquet(f"{folder}/level={level}")
        return spark.read.parquet(f"{folder}/level={level}")

    rows = classes.select("cls", "sig", F.explode(F.sequence(F.lit(1), F.lit(p.trees))).alias("tree"))
    rows = rows.withColumn("node", F.xxhash64("tree", F.lit(0)))
    for level in range(p.first_level):
        rows = rows.withColumn("node", child(F.col("node"), F.col("sig"), level, p))
    members = keep(rows.select("node", "cls"), p.first_level, n * p.trees)
    weight = materialize(in_tasks(members.groupBy("cls").agg(F.sum("size").alias("weight")), n, NARROW), "weights")
    big = members.filter(F.col("size") > p.small_node).select("node", "cls").join(classes.select("cls", "sig"), "cls")
    for level in range(p.first_level, p.last_level, p.stride):
        n_big = members.filter(F.col("size") > p.small_node).count()
        if not n_big:
            break
        rows = big.withColumn("way", F.explode(F.sequence(F.lit(1), ways_of(F.col("node"), p))))
        rows = rows.withColumn("node", F.xxhash64("node", "way"))
        for i in range(level, level + p.stride):
            rows = rows.select("cls", "sig", child(F.col("node"), F.col("sig"), i, p).alias("node"))
        members = keep(rows, level + p.stride, int(n_big * ways(p)))
        big = members.filter(F.col("size") > p.small_node).select("node", "cls", "sig")
    schema = "node bigint, cls binary, size bigint"
    return spark.read.schema(schema).parquet(folder), weight, members.filter(F.col("size") > p.small_node).select("node", "cls", "size")


def hub_links(members: DataFrame, weight: DataFrame) -> DataFrame:
    """(cls, hub, shared) of every class and each hub of its nodes, the hub's own row aside; shared: their common nodes."""
    hubs = members.join(weight, "cls").groupBy("node").agg(F.max(F.struct("weight", "cls"))["cls"].alias("hub"))
    hubs = materialize(in_tasks(hubs, members.count(), NARROW), "hubs")
    return members.join(hubs, "node").filter("cls <> hub").groupBy("cls", "hub").agg(F.count(F.lit(1)).alias("shared"))


def _pair(x: str, y: str) -> list[Column]:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def nearest_hubs(hubs: DataFrame) -> DataFrame:
    """Distinct (a, b) of every class with the hub that it shares most nodes with, a < b."""
    best = hubs.groupBy("cls").agg(F.max(F.struct("shared", "hub"))["hub"].alias("hub"))
    return best.select(*_pair("cls", "hub")).distinct()


def _labelled(rows: DataFrame, labels: DataFrame, cls: str = "cls", label: str = "label") -> DataFrame:
    named = labels.select(F.col("node").alias(cls), F.col("label").alias("_label"))
    return rows.join(named, cls, "left").withColumn(label, F.coalesce("_label", cls)).drop("_label")


def other_hubs(hubs: DataFrame, labels: DataFrame) -> DataFrame:
    """Distinct (a, b) of every class with the hubs that are not in its component yet."""
    rows = _labelled(_labelled(hubs.select("cls", "hub"), labels), labels, "hub", "hub_label")
    return rows.filter("label <> hub_label").select(*_pair("cls", "hub")).distinct()


def _names(a: Briefs, x: np.ndarray, b: Briefs, y: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([a.cls.take(pa.array(x)), b.cls.take(pa.array(y))], names=["x", "y"])


def small_node_links(members: DataFrame, classes: DataFrame, labels: DataFrame, p: NearDupParams) -> DataFrame:
    """Distinct pairs of small nodes' members that are not in one component yet and may reach the similarity."""
    small = members.filter(F.col("size") <= p.small_node).join(classes.select("cls", "brief"), "cls")
    # nodes within one component need no work; the others hold at most small_node members
    open_nodes = _labelled(small, labels).groupBy("node").agg(
        F.min("label").alias("lo"), F.max("label").alias("hi"), F.collect_list(F.struct("cls", "label", "brief")).alias("m")).filter("lo <> hi")

    def small_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            lists = batch.column("m")
            rows = lists.flatten()
            n = np.diff(lists.offsets.to_numpy())
            after = np.repeat(np.cumsum(n), n) - np.arange(len(rows)) - 1  # members of the node behind each one
            x = np.repeat(np.arange(len(rows)), after)
            y = x + 1 + np.arange(len(x)) - np.repeat(np.cumsum(after) - after, after)
            label = rows.field("label").dictionary_encode().indices.to_numpy()
            apart = label[x] != label[y]
            x, y, briefs = x[apart], y[apart], Briefs(rows, p)
            near = may_reach(briefs, x, briefs, y)
            yield _names(briefs, x[near], briefs, y[near])

    return open_nodes.select("m").mapInArrow(small_nodes, "x binary, y binary").select(*_pair("x", "y")).distinct()


def open_large_nodes(large: DataFrame, classes: DataFrame, labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(node, part, m) blocks of the members outside their node's most frequent component, and of all members.

    Only of large nodes with several components.  A block's members are about ``block`` of a node's.
    """
    n = large.count()
    rows = _labelled(large, labels)
    parts = rows.groupBy("node", "label").agg(F.count(F.lit(1)).alias("n"))
    most = parts.groupBy("node").agg(F.max(F.struct("n", "label")).alias("m"), F.sum("n").alias("all"), F.count(F.lit(1)).alias("k")).filter("k > 1")
    most = most.select("node", F.col("m.label").alias("most"), (F.col("all") - F.col("m.n")).alias("rest"))
    most = materialize(in_tasks(most, n, WIDE), "open-nodes")
    rows = materialize(in_tasks(rows.join(most, "node").join(classes.select("cls", "brief"), "cls"), n, WIDE), "open-members")
    return rows.filter("label <> most").withColumn("size", F.col("rest")), rows


def large_node_links(large: DataFrame, classes: DataFrame, labels: DataFrame, p: NearDupParams, heads: int | None = None) -> DataFrame:
    """Distinct pairs of large nodes' members that are not in one component yet and may reach the similarity.

    Of such a pair one is outside its node's most frequent component; these members are compared with all
    members of the node, in blocks that the join spreads over tasks.  ``heads``: only the pairs of a
    member and the so many members of a block that share most tokens with it.
    """
    def blocks(rows: DataFrame, name: str) -> DataFrame:
        part = F.pmod(F.xxhash64("cls"), F.ceil(F.col("size") / p.block))
        return rows.groupBy("node", part.alias(f"part_{name}")).agg(F.collect_list(F.struct("cls", "label", "brief")).alias(name))

    rest, rows = open_large_nodes(large, classes, labels)
    met = blocks(rest, "mx").join(blocks(rows, "my"), "node").select("mx", "my")

    def large_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for mx, my in zip(batch.column("mx"), batch.column("my")):
                a, b = Briefs(mx.values, p), Briefs(my.values, p)
                same = np.zeros((len(a.low), len(b.low)), np.uint16)
                for i, low in enumerate(b.low.T.copy()):
                    same += a.low[:, i, None] == low
                label = pa.concat_arrays([a.label, b.label]).dictionary_encode().indices.to_numpy()
                x, y = np.nonzero((same >= p.least_tokens) & (label[:len(same), None] != label[len(same):]))
                near = may_reach(a, x, b, y, tokens=False)
                x, y = x[near], y[near]
                if heads is not None:
                    order = np.lexsort((-same[x, y].astype(np.int64), x))
                    x, y = x[order], y[order]
                    first = np.arange(len(x)) - np.searchsorted(x, x) < heads
                    x, y = x[first], y[first]
                yield _names(a, x, b, y)

    return met.mapInArrow(large_nodes, "x binary, y binary").select(*_pair("x", "y")).distinct()


def _agreement(a: str, b: str) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda u, v: (u == v).cast("int")), F.lit(0), lambda acc, v: acc + v)


def close_signatures(links: DataFrame, classes: DataFrame, p: NearDupParams) -> DataFrame:
    """Links whose minwise tokens agree often enough to be worth a look at the full sets.

    See :attr:`NearDupParams.least_tokens`.
    """
    sig = classes.select("cls", "sig")
    x = links.join(sig.withColumnsRenamed({"cls": "a", "sig": "sa"}), "a").join(sig.withColumnsRenamed({"cls": "b", "sig": "sb"}), "b")
    return x.filter(_agreement("sa", "sb") >= p.least_tokens).select("a", "b")


def confirm(links: DataFrame, sets: DataFrame, p: NearDupParams) -> DataFrame:
    """Links whose full sets reach the similarity."""
    pairs = links.join(sets.withColumnsRenamed({"cls": "a", "set": "x"}), "a").join(
        sets.withColumnsRenamed({"cls": "b", "set": "y"}), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            ok = []
            for x, y in zip(batch.column("x"), batch.column("y")):
                u, v = (np.frombuffer(z.as_buffer(), np.uint64) for z in (x, y))
                both = len(np.intersect1d(u, v, assume_unique=True))
                ok.append(100 * both >= p.similarity * (len(u) + len(v) - both))
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return pairs.select("a", "b", "x", "y").mapInArrow(run, "a binary, b binary")


def full_sets(docs: DataFrame, classes: DataFrame, wanted: DataFrame, p: NearDupParams) -> DataFrame:
    """(cls, set) of the wanted classes, from one text of each."""
    holder = classes.select("cls", F.col("first_id").alias("doc_id")).join(wanted, "cls", "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sh = per_worker(("shingles", p.words, 1), lambda: Shingler(p.words))
        for b in in_slices(batches):
            sets = [sh.shingles(t.as_py()) for t in b.column("text")]
            yield pa.RecordBatch.from_arrays(
                [pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                 pa.array([s.tobytes() for s in sets], pa.binary())], names=["cls", "set"])

    texts = _semi(pick(docs, "doc_id", "text"), holder.select("doc_id").distinct())
    sets = texts.select("text").mapInArrow(run, "cls binary, set binary").join(wanted, "cls", "left_semi")
    # a repeated id may bring the same set more than once
    return sets.groupBy("cls").agg(F.first("set").alias("set"))


def _semi(docs: DataFrame, ids: DataFrame) -> DataFrame:
    ids = ids.withColumnRenamed("doc_id", "_id")
    return docs.join(ids, docs["doc_id"].eqNullSafe(ids["_id"]), "left_semi")


def near_duplicates(docs: DataFrame, params: NearDupParams = NearDupParams()) -> DataFrame:
    """doc_id, text_hash, n_shingles, component_id, kept of every row of (doc_id, text)."""
    with scratch_block(docs.sparkSession, "neardup") as keep:
        return keep(_near_duplicates(docs, params), "near-duplicates")


def _near_duplicates(docs: DataFrame, p: NearDupParams) -> DataFrame:
    sketches = materialize(sketch(docs, p), "sketches")
    spark, n_docs = docs.sparkSession, sketches.count()
    classes = sketches.filter("cls IS NOT NULL").groupBy("cls").agg(
        F.min("doc_id").alias("first_id"), F.first("sig").alias("sig"), F.first("brief").alias("brief"))
    classes = materialize(in_tasks(classes, n_docs, WIDE), "classes")
    members, weight, large = walk(classes, p)
    n_members = members.count()
    hubs = materialize(in_tasks(hub_links(members, weight), n_members, NARROW), "hub-links")
    # each step by the components as they are then
    steps = [lambda _: close_signatures(nearest_hubs(hubs), classes, p), lambda labels: close_signatures(other_hubs(hubs, labels), classes, p),
             lambda labels: small_node_links(members, classes, labels, p)]
    if large.limit(1).count():
        steps += [lambda labels: large_node_links(large, classes, labels, p, p.heads), lambda labels: large_node_links(large, classes, labels, p)]
    links = seen = spark.createDataFrame([], "a binary, b binary")
    labels = spark.createDataFrame([], "node binary, label binary")
    sets = spark.createDataFrame([], "cls binary, set binary")
    for step in steps:
        more = materialize(in_tasks(step(labels).join(seen, ["a", "b"], "left_anti"), n_members, NARROW), "pairs")
        n = more.count()
        if not n:
            continue
        lacking = more.select(F.col("a").alias("cls")).union(more.select("b")).distinct().join(sets.select("cls"), "cls", "left_anti")
        lacking = materialize(in_tasks(lacking, 2 * n, NARROW), "lacking")
        n_lacking = lacking.count()
        if n_lacking:
            sets = sets.union(materialize(in_tasks(full_sets(docs, classes, lacking, p), n_lacking, SETS), "sets"))
        found = materialize(in_tasks(confirm(more, sets, p), n, SETS), "links")
        seen = seen.union(more)
        if found.limit(1).count():
            links = links.union(found)
            labels = connected_components(links)
    named = classes.select("cls", "first_id").join(labels.withColumnRenamed("node", "cls"), "cls", "left")
    named = named.withColumn("label", F.coalesce("label", "cls"))
    names = named.groupBy("label").agg(F.min("first_id").alias("component_id"))
    of_class = named.join(names, "label").select("cls", "component_id")
    out = sketches.drop("sig", "brief").join(of_class, "cls", "left")
    component = F.when(F.col("cls").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    out = out.select("doc_id", "text_hash", "n_shingles", component.alias("component_id"))
    return in_tasks(out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))), n_docs, NARROW)


def drop_near_duplicates(docs: DataFrame, params: NearDupParams = NearDupParams()) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns; rows equal in id and text once."""
    kept = near_duplicates(docs, params).filter("kept").select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"))
    hashed = docs.withColumn("_hash", F.xxhash64("text"))
    same = hashed["doc_id"].eqNullSafe(kept["_id"]) & (hashed["_hash"] == kept["_hash"])
    return hashed.join(kept.distinct(), same, "left_semi").dropDuplicates(["doc_id", "_hash"]).drop("_hash")
