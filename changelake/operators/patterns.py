"""Rule sets that name tables by ``%`` patterns.

Names meet patterns in an equijoin, not in all pairs: a pattern is keyed by the longest literal
pieces at the beginning or end of its schema part (the whole schema, where that is literal) and
of its table part, a name is looked up by its own pieces of the lengths that occur, and ``like`` decides
on what meets.  Kinds and lengths of few patterns are broadcast, so names are shuffled only for
those of many.  Only ``%`` is a wildcard; ``_`` is common in names and stands for itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WILD = "%"
# patterns that are broadcast, all kinds and lengths together; the others meet the names by a shuffle
FEW_PATTERNS = 50_000


def _head(c: Column) -> Column:
    return F.substring_index(c, WILD, 1)


def _tail(c: Column) -> Column:
    return F.substring_index(c, WILD, -1)


def _like(name: str, pattern: str) -> Column:
    p = F.col(pattern)
    for c in ("\\", "_"):
        p = F.replace(p, F.lit(c), F.lit("\\" + c))
    return F.like(F.col(name), p)


def _end(c: Column, n: Column) -> Column:
    """The last n characters; null where there are fewer."""
    return F.when(F.char_length(c) >= n, F.when(n == 0, F.lit("")).otherwise(F.substring(c, F.char_length(c) - n + 1, n)))


def _keyed_patterns(rules: DataFrame) -> DataFrame:
    """Patterns with _kind, _sizes and _key: which pieces of a name to look at, how much of them, and what they must be."""
    s, t = F.col("schema_pattern"), F.col("table_pattern")
    of = lambda kind, piece: F.struct(F.char_length(piece).alias("size"), F.lit(kind).alias("kind"), piece.alias("piece"))
    longest = lambda c: F.array_max(F.array(of("head", _head(c)), of("tail", _tail(c))))
    # a literal schema counts as a whole; a literal table is its own head and tail
    schema = F.when(s.contains(WILD), longest(s)).otherwise(F.struct(F.lit(0).alias("size"), F.lit("whole").alias("kind"), s.alias("piece")))
    return (rules.withColumns({"_s": schema, "_t": longest(t)})
            .withColumns({"_kind": F.concat("_s.kind", F.lit(" "), "_t.kind"), "_sizes": F.concat("_s.size", F.lit(" "), "_t.size"),
                          "_key": F.concat("_s.piece", F.lit("\x01"), "_t.piece")}).drop("_s", "_t"))


def _piece(c: Column, kind: str, size: str) -> Column:
    """The piece of a name's part; null where the part is shorter."""
    if kind == "whole":
        return c
    n = int(size)
    return F.when(F.char_length(c) >= n, F.substring(c, 1, n)) if kind == "head" else _end(c, F.lit(n))


def match_patterns(names: DataFrame, rules: DataFrame) -> DataFrame:
    """(schema, table, and the rules' columns) of every name and each distinct rule that matches it.

    ``names`` has schema and table; ``rules`` has schema_pattern and table_pattern (null patterns
    match nothing) and whatever else a match should carry.
    """
    names = names.select("schema", "table").distinct()
    keyed = _keyed_patterns(rules.filter("schema_pattern is not null and table_pattern is not null").distinct())
    # which pieces occur: at most six kinds times the lengths of a schema and of a table
    shapes = sorted(keyed.groupBy("_kind", "_sizes").count().collect(), key=lambda r: (r["count"], r["_kind"], r["_sizes"]))
    few, total = [], 0
    for r in shapes:
        total += r["count"]
        if total <= FEW_PATTERNS:
            few.append((r["_kind"], r["_sizes"]))
    many = [(r["_kind"], r["_sizes"]) for r in shapes[len(few):]]
    met = _meet(names, keyed, few, broadcast=True)
    if many:
        met = met.unionByName(_meet(names, keyed, many))
    return met.filter(_like("schema", "schema_pattern") & _like("table", "table_pattern")).drop("_kind", "_sizes", "_key")


def _meet(names: DataFrame, keyed: DataFrame, shapes: list[tuple[str, int]], broadcast: bool = False) -> DataFrame:
    """Names and patterns of these kinds and sizes of pieces with equal pieces."""
    s, t = F.col("schema"), F.col("table")
    looks = []
    for kind, sizes in sorted(shapes):
        pieces = [_piece(c, *x) for c, *x in zip((s, t), kind.split(" "), sizes.split(" "))]
        looks.append(F.struct(F.lit(kind).alias("_kind"), F.lit(sizes).alias("_sizes"), F.concat(pieces[0], F.lit("\x01"), pieces[1]).alias("_key")))
    if not looks:
        looks = [F.struct(F.lit("").alias("_kind"), F.lit("").alias("_sizes"), F.lit(None).cast("string").alias("_key"))]
    asked = names.withColumn("_l", F.explode(F.array(*looks))).select("schema", "table", "_l.*").filter("_key is not null")
    keyed = keyed.filter(F.concat_ws("/", "_kind", "_sizes").isin([f"{k}/{n}" for k, n in shapes]) if shapes else F.lit(False))
    return asked.join(F.broadcast(keyed) if broadcast else keyed, ["_kind", "_sizes", "_key"])


def wildcard_selection(names: DataFrame, rules: DataFrame) -> DataFrame:
    """(schema, table) of the names that an include rule matches and no exclude rule does.

    ``rules`` are selection rules as ``ingest_rules.rules_tidy`` gives them: action, schema, table,
    the latter two as patterns.
    """
    patterns = rules.select("action", F.col("schema").alias("schema_pattern"), F.col("table").alias("table_pattern"))
    met = match_patterns(names, patterns).groupBy("schema", "table").agg(
        F.max(F.col("action") == "include").alias("_in"), F.max(F.col("action") == "exclude").alias("_out"))
    return met.filter("_in and not _out").select("schema", "table")


def expand_plan(plan: DataFrame, names: DataFrame) -> DataFrame:
    """A plan whose table names are patterns as one that names every table of ``names`` (database, table).

    Rules of a matched table get its name; excluded tables lose all their rules; a rule that
    several patterns give a table is there once; rules without a table (the schema rename) stay.
    The result goes through ``ingest_rules.apply_ingest_plan`` like any plan.
    """
    cols = [c for c in plan.columns if c not in ("database", "table_name")]
    rules = plan.filter("table_name is not null").select(F.col("database").alias("schema_pattern"), F.col("table_name").alias("table_pattern"), *cols)
    met = match_patterns(names.select(F.col("database").alias("schema"), "table"), rules)
    facts = [c for c in cols if c not in ("rule_id", "rule_name")]
    out = met.groupBy("schema", "table", *facts).agg(*[F.min(c).alias(c) for c in cols if c not in facts])
    gone = out.filter("rule_action = 'exclude'").select("schema", "table").distinct()
    out = out.filter("rule_action <> 'exclude'").join(gone, ["schema", "table"], "left_anti")
    return (out.withColumnsRenamed({"schema": "database", "table": "table_name"}).select(*plan.columns)
            .unionByName(plan.filter("table_name is null")))
