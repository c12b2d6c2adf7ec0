"""Document quality rules with verdicts of the whole host.

Each text gets counts (words, symbols, repeated lines, repeated three-word windows) by
built-in functions within its own row, so no text is shuffled.  The narrow counts are
written once; failures are aggregated per host (map-side first, so a host with a third of
all rows is a few partial rows), the hosts' failure rates are shrunk towards the overall
rate with a beta prior fitted to all hosts by moments, and the host's verdict is joined
back to its documents.

A document is kept if it passes the base rules, its host is not rejected as a whole, and
it does not fail a soft rule on a host that has lost its trust.

Defined results: a null or blank text has no words and fails; a null host is a host of its
own; repeated rows count and are returned as often as they occur; an empty table gives an
empty result.  Columns beyond those read are not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD_SPACE, materialize, pick

# Symbols that count as such, and white space inside words' contract.
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\f\r"


@dataclass(frozen=True)
class Rules:
    """Limits of the rules; rates are shares between 0 and 1."""

    min_words: int = 50             # base: fewer words fail
    max_repeat_share: float = 0.5   # base: share of words in repeated windows
    max_symbols_per_word: float = 0.1   # soft
    max_dup_line_share: float = 0.3     # soft: of lines with a word
    host_reject: float = 0.8        # hosts whose shrunk failure rate reaches this lose all documents
    host_trust: float = 0.005       # below this shrunk rate a document's soft failure is forgiven
    max_prior: float = 10_000.0     # bound of the prior's weight when hosts hardly differ


def text_counts(text: Column) -> dict[str, Column]:
    """First step: the words, and what needs no word list (see :func:`add_counts`)."""
    t = F.coalesce(text, F.lit(""))
    words = F.filter(F.split(t, WORD_SPACE), lambda w: w != "")
    lines = F.filter(F.split(t, "\n", -1), lambda x: F.translate(x, BLANKS, "") != "")
    return {
        "_words": words,
        "_lines": lines,
        "word_chars": F.char_length(F.translate(t, BLANKS, "")).cast("long"),
        "n_symbols": (F.char_length(t) - F.char_length(F.translate(t, SYMBOLS, ""))).cast("long"),
    }


def add_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """Replace the text column by n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words."""
    df = df.withColumns(text_counts(F.col(text))).drop(text)
    n = F.size("_words")
    df = df.withColumns({
        "n_words": n.cast("long"),
        "n_lines": F.size("_lines").cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        # words have no blanks, so joining three by a blank is one-to-one
        "_windows": F.when(n >= 3, F.sort_array(F.transform(
            F.sequence(F.lit(0), n - 3),
            lambda i: F.struct(F.concat_ws(" ", *[F.get("_words", i + k) for k in range(3)]).alias("w"), i.alias("i"))))),
    }).drop("_words", "_lines")
    # equal windows are neighbours after the sort
    df = df.withColumn("_same", F.zip_with(
        "_windows", F.slice("_windows", 2, F.greatest(F.size("_windows"), F.lit(1))),
        lambda a, b: F.coalesce(a["w"] == b["w"], F.lit(False))))
    df = df.withColumn("_at", F.sort_array(F.transform(
        F.filter(F.transform("_windows", lambda x, k: F.when(
            F.get("_same", k) | F.coalesce(F.get("_same", k - 1), F.lit(False)), x["i"])), lambda i: i.isNotNull()),
        lambda i: i)))
    df = df.drop("_windows", "_same")
    covered = F.zip_with("_at", F.slice("_at", 2, F.greatest(F.size("_at"), F.lit(1))),
                         lambda a, b: F.coalesce(F.least(b - a, F.lit(3)), F.lit(3)).cast("long"))
    return df.withColumn("n_repeat_words", F.coalesce(
        F.aggregate(covered, F.lit(0).cast("long"), lambda s, x: s + x), F.lit(0).cast("long"))).drop("_at")


def rule_columns(rules: Rules) -> dict[str, Column]:
    return {
        "base_failed": (F.col("n_words") < rules.min_words)
        | (F.col("n_repeat_words") > rules.max_repeat_share * F.col("n_words")),
        "soft_failed": (F.col("n_symbols") > rules.max_symbols_per_word * F.col("n_words"))
        | (F.col("n_dup_lines") > rules.max_dup_line_share * F.col("n_lines")),
    }


def host_verdicts(counts: DataFrame, host: str, rules: Rules) -> DataFrame:
    """Per host: documents, failures, shrunk failure rate, and the two verdicts."""
    per = counts.groupBy(F.col(host).alias("_host")).agg(
        F.count(F.lit(1)).alias("n"), F.sum((F.col("base_failed") | F.col("soft_failed")).cast("long")).alias("failed"))
    # moments over all hosts: one row of sums
    rate = F.col("failed") / F.col("n")
    s = per.agg(F.count(F.lit(1)).alias("hosts"), F.sum("n").alias("n"), F.sum("failed").alias("failed"),
                F.avg(rate).alias("avg"), F.avg(rate * rate).alias("sq"), F.avg(F.lit(1.0) / F.col("n")).alias("inv")).first()
    mean = (s["failed"] / s["n"]) if s["n"] else 0.0
    spread = mean * (1 - mean)
    # variance between hosts: what is observed less what chance alone explains
    between = max((s["sq"] or 0.0) - (s["avg"] or 0.0) ** 2 - spread * (s["inv"] or 0.0), 0.0)
    weight = min(rules.max_prior, spread / between - 1) if between > 0 else rules.max_prior
    weight = max(weight, 1.0)
    shrunk = (F.col("failed") + F.lit(mean * weight)) / (F.col("n") + F.lit(weight))
    return per.withColumn("host_rate", shrunk).withColumns({
        "host_rejected": F.col("host_rate") >= rules.host_reject, "host_trusted": F.col("host_rate") < rules.host_trust})


def quality_verdicts(docs: DataFrame, host: str = "source", rules: Rules = Rules()) -> DataFrame:
    """doc_id, the counts, base_failed, soft_failed, host_rate and kept of every row."""
    counts = add_counts(pick(docs, "doc_id", host, "text")).withColumns(rule_columns(rules))
    counts = materialize(counts, "quality-counts")
    # written before the join, so that Spark may split the rows of a hot host
    hosts = materialize(host_verdicts(counts, host, rules).drop("n", "failed"), "hosts")
    joined = counts.join(hosts, counts[host].eqNullSafe(hosts["_host"]), "left")
    return joined.withColumn(
        "kept", ~F.col("base_failed") & ~F.col("host_rejected") & ~(F.col("soft_failed") & ~F.col("host_trusted"))
    ).drop("_host", host)
