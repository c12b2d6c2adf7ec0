"""Merkle manifest of a table: leaf hashes, subroots of groups, one root, and a proof for every row.

H is the lowercase hex sha256 of its inputs concatenated, digests as hex text.  A row's leaf is H
of its columns, each `-` if null, else its UTF-8 byte count, `:` and the value.  A group's leaves,
in order, form level 0; every ``arity`` neighbours (the last run may be shorter, even one) become
their H, until one node is left: the group's subroot.  Subroots, by group, form a second tree of
the same kind, whose last node is the root.

* *Numbers.* Leaves get their index within the group from range slices of the global order: a
  window over each slice, and per-slice offsets (a group with a third of all rows spans many
  slices).  Texts are hashed in the scan and go no further.
* *Up.* Every level equijoins its nodes with themselves at the computed sibling index: index XOR 1
  for two, else one join for each slot offset.  Each node then knows its siblings, and slot-zero
  rows emit the parents.  A level has 1/arity of the rows of the one below and is written, so a
  lost executor repeats one level only.
* *Down.* Proofs go from the top: a node's steps are its own siblings and its parent's steps, so
  all joins but the last handle 1/arity, 1/arity^2, ... of the rows.
* A row's root is folded from any leaf with its steps, without a further join.

The driver learns the number of levels and the root, two scalars.

Defined results: null columns are `-`; a null group is a group of its own and comes first, as do
null order keys; rows of equal order key are ordered by leaf, equal rows (each a leaf) in any
order; a group of one row has its leaf as subroot, one group's subroot is the root; an empty table
gives an empty result.  Columns beyond those named are not looked at and may have any name.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fold, materialize

# the contract's columns of a leaf, in order
LEAF = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts: Column) -> Column:
    """H of text columns."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def leaf_hash(columns: Sequence[Column]) -> Column:
    """H of the columns, each with its length in front, `-` for null."""
    texts = [c.cast("string") for c in columns]
    return digest(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts])


def number_rows(df: DataFrame, group: str, order: Sequence[str], slices: int | None = None) -> DataFrame:
    """``df`` with i, the row's number from 0 within its group (a text, not null), and n, the group's rows."""
    n = slices or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # the number of its own lets equal rows fall into several slices
    keyed = df.withColumn("_tie", F.monotonically_increasing_id())
    sliced = materialize(keyed.repartitionByRange(n, group, *order, "_tie").withColumn("_slice", F.spark_partition_id()), "merkle-slices")
    local = sliced.withColumn("_at", F.row_number().over(Window.partitionBy(group, "_slice").orderBy(*order, "_tie")).cast("bigint"))
    # one row for each group and slice
    sizes = sliced.groupBy(group, "_slice").agg(F.count(F.lit(1)).alias("_rows"))
    whole = Window.partitionBy(group)
    before = F.sum("_rows").over(whole.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1))
    sizes = sizes.select(group, "_slice", F.coalesce(before, F.lit(0)).alias("_before"), F.sum("_rows").over(whole).alias("n"))
    return local.join(sizes, [group, "_slice"]).withColumn("i", F.col("_at") + F.col("_before") - 1).drop("_at", "_before", "_slice", "_tie")


def with_siblings(nodes: DataFrame, arity: int) -> DataFrame:
    """Nodes (g, i, n, h, ...) with the digests of the run's nodes before and after each, as text."""
    sibs = []
    slot = F.col("i") % arity
    level = nodes
    for d in range(1, arity):
        there = level.select("g", F.col("i").alias("_there"), F.col("h").alias(f"_h{d}"))
        at = F.col("i").bitwiseXOR(F.lit(1)) if arity == 2 else F.col("i") - slot + (slot + d) % arity
        nodes = nodes.withColumn("_there", at).join(there, ["g", "_there"], "left").drop("_there")
        sibs.append(f"_h{d}")

    def side(lo: int, hi: int, s: int) -> list[Column]:
        return [F.coalesce(F.col(f"_h{(t - s) % arity}"), F.lit("")) for t in range(lo, hi)]

    def pick_slot(sides) -> Column:
        out = F.lit("")
        for s in range(arity):
            out = F.when(slot == s, F.concat(F.lit(""), *sides(s))).otherwise(out)
        return out

    return nodes.withColumns({"before": pick_slot(lambda s: side(0, s, s)), "after": pick_slot(lambda s: side(s + 1, arity, s))}).drop(*sibs)


@dataclass
class Tree:
    """The levels of all groups' trees: nodes (g, i, n, h, before, after) that have a parent, and the tops (g, level, h)."""

    levels: list[DataFrame]
    tops: DataFrame
    arity: int

    def steps(self, above: DataFrame) -> DataFrame:
        """Steps of the nodes of level 1: (g, i, steps, ...), from ``above`` (g, steps, ...), what follows each group's top.

        A step is what to put before and after a digest to get the parent's, in 32 bytes each.
        """
        rest = [c for c in above.columns if c not in ("g", "steps")]
        tops = self.tops.select("g", "level").join(above, "g")
        known = None
        for level in range(len(self.levels), 0, -1):
            here = tops.filter(F.col("level") == level).select("g", F.lit(0).cast("bigint").alias("i"), "steps", *rest)
            if known is not None:
                here = here.unionByName(add_step(self.levels[level], known, self.arity).select("g", "i", "steps", *rest))
            known = materialize(here, "merkle-steps")
        return known


def add_step(nodes: DataFrame, parents: DataFrame, arity: int) -> DataFrame:
    """Nodes with their parents' columns, their own siblings in front of the parents' steps."""
    up = parents.withColumnRenamed("i", "_up")
    joined = nodes.withColumn("_up", F.expr(f"i div {arity}")).join(up, ["g", "_up"])
    own = F.struct(F.unhex("before").alias("before"), F.unhex("after").alias("after"))
    return joined.withColumn("steps", F.concat(F.array(own), F.col("steps"))).drop("_up", "before", "after")


NO_STEPS = "cast(array() as array<struct<before:binary,after:binary>>)"


def grow(nodes: DataFrame, arity: int) -> Tree:
    """The trees over numbered nodes (g, i, n, h, ...) of level 0; further columns stay on level 0."""
    most = nodes.agg(F.max("n")).first()[0] or 0
    levels, tops, level = [], [], 0
    while True:
        tops.append(nodes.filter("n = 1").select("g", F.lit(level).alias("level"), "h"))
        if most <= 1:
            break
        levels.append(materialize(with_siblings(nodes.filter("n > 1"), arity), "merkle-level"))
        first = levels[-1].filter(F.col("i") % arity == 0)
        up = lambda c: F.expr(f"{c} div {arity}")
        nodes = first.select("g", up("i").alias("i"), up(f"(n + {arity - 1})").alias("n"), digest(F.col("h"), F.col("after")).alias("h"))
        most = -(-most // arity)
        level += 1
    out = tops[0]
    for t in tops[1:]:
        out = out.unionByName(t)
    return Tree(levels, materialize(out, "merkle-tops"), arity)


def fold_steps(leaf: Column, steps: Column) -> Column:
    """The root that a leaf and its steps lead to."""
    low = lambda b: F.lower(F.hex(b))
    return F.aggregate(steps, leaf, lambda h, s: digest(low(s["before"]), h, low(s["after"])))


def proof_digest(steps: Column) -> Column:
    """H of all siblings on the way to the root, each level's from left to right."""
    return digest(F.lower(F.array_join(F.transform(steps, lambda s: F.concat(F.hex(s["before"]), F.hex(s["after"]))), "")))


def manifest(rows: DataFrame, order: Sequence[str], arity: int = 2) -> DataFrame:
    """``rows`` with subroot, root and steps (the proof), from its columns lang_key (see group_key) and leaf.

    A step is a struct of the siblings' digests before and after the node, as bytes; the steps
    lead from the leaf to the root.  The order columns and lang_key must not be called g, i, n,
    h, level, before, after or steps.
    """
    leaves = materialize(number_rows(rows, "lang_key", [*order, "leaf"]).withColumnsRenamed({"lang_key": "g", "leaf": "h"}), "merkle-leaves")
    groups = grow(leaves, arity)
    # the groups' subroots are the leaves of the second tree, all in one group
    subs = groups.tops.select(F.lit("").alias("all"), F.col("g").alias("name"), "h")
    subs = materialize(number_rows(subs, "all", ["name"]).withColumnRenamed("all", "g"), "merkle-subroots")
    top = grow(subs, arity)
    root = top.tops.first()
    root = root["h"] if root else None
    none = F.expr(NO_STEPS)
    if top.levels:
        above = add_step(top.levels[0], top.steps(top.tops.select("g", none.alias("steps"))), arity)
        above = above.select(F.col("name").alias("g"), F.col("h").alias("subroot"), "steps")
    else:
        above = subs.select(F.col("name").alias("g"), F.col("h").alias("subroot"), none.alias("steps"))
    above = materialize(above, "merkle-above")
    keep = [c for c in leaves.columns if c not in ("i", "n")]
    # groups of a single row have no level of their own
    out = leaves.filter("n = 1").select(*keep).join(above, "g")
    if groups.levels:
        deep = add_step(groups.levels[0], groups.steps(above), arity)
        out = deep.select(*out.columns).unionByName(out)
    return out.withColumnsRenamed({"g": "lang_key", "h": "leaf"}).withColumn("root", F.lit(root).cast("string"))


def group_key(c: Column) -> Column:
    """A text that sorts as the group does, null first, and is never null."""
    return F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit(""))


def document_manifest(docs: DataFrame, arity: int = 2) -> DataFrame:
    """The contract's rows over (doc_id, source, lang, n_chars, text): proofs, and roots folded from tampered leaves.

    Where 7 divides the unsigned crc32 of the id as decimal text, n_chars grows by 1 in the
    tampered leaf; a null n_chars stays, so such a row verifies.
    """
    cols = {c: F.col(f"`{c}`") for c in LEAF}
    more = {**cols, "n_chars": cols["n_chars"].cast("decimal(20,0)") + 1}
    tampered = F.when((fold(cols["doc_id"], 7) == 0) & cols["n_chars"].isNotNull(), leaf_hash([more[c] for c in LEAF]))
    rows = docs.select(cols["doc_id"], group_key(cols["lang"]).alias("lang_key"), leaf_hash(list(cols.values())).alias("leaf"), tampered.alias("tampered"))
    out = manifest(rows, ["doc_id"], arity)
    folded = fold_steps(F.coalesce("tampered", "leaf"), F.col("steps"))
    out = out.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("steps")).alias("proof_sha256"), folded.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
