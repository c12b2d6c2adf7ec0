"""Change-event transforms (C1-C14) and the ordered transform chain.

Each transform is ``DataFrame -> DataFrame`` built from column expressions only, so it
runs inside whole-stage codegen, needs no shuffle, and works the same on a batch frame
and on a streaming frame.

Two frame shapes occur:
  * envelope frame: Kafka metadata + ``before``, ``after``, ``source``, ``op``, ``ts_ms``...
  * flat frame (after :func:`unwrap`): row fields + ``__op``, ``__db``, ``__table``,
    ``__ts_ms``, ``__deleted`` (+ the Kafka metadata columns that were present).
"""

from __future__ import annotations

import re
import string
from collections.abc import Callable, Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changelake.functions.temporal import format_epoch_millis

ENVELOPE_FIELDS = ("before", "after", "source", "op", "ts_ms", "ts_us", "ts_ns")
KAFKA_FIELDS = ("topic", "partition", "offset", "timestamp", "key")

# fixed values: operation codes of the replace-value transform
OP_CODES = {"c": "I", "u": "U", "d": "D"}
# fixed values: timestamp text written by the converter transform
TS_TEXT_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSS"


def _is_tombstone(df: DataFrame) -> Column:
    if "value" in df.columns and "op" not in df.columns:
        return F.col("value").isNull()
    present = [c for c in ("before", "after", "source", "op") if c in df.columns]
    return reduce(lambda a, b: a & b, [F.col(c).isNull() for c in present])


def drop_tombstones(df: DataFrame) -> DataFrame:
    """C14: ignore null-value records (raw Kafka frame or decoded envelope frame).

    Tombstones are decided on the raw value. An envelope frame without that value must hold
    decodable records only (``framing.decode_error`` routes the others to dead letters
    first); there a row without any envelope field is a tombstone.
    """
    return df.filter(~_is_tombstone(df))


def ignore_read_op(df: DataFrame, topic_regex: str = "^(local.*)\\..*") -> DataFrame:
    """Drop snapshot reads (``op = 'r'``) on topics matching ``topic_regex``.

    Topics that do not match pass untouched, and a null ``op`` is kept: the predicate
    is wrapped in ``coalesce(..., false)`` so SQL's three-valued logic cannot drop it.
    """
    hit = F.col("topic").rlike(topic_regex) & F.col("op").eqNullSafe(F.lit("r"))
    return df.filter(~F.coalesce(hit, F.lit(False)))


def ts_convert(df: DataFrame, field: str = "ts_ms", fmt: str = TS_TEXT_FORMAT) -> DataFrame:
    """Epoch-millisecond field -> text in UTC (runs on the envelope, before unwrap)."""
    return df.withColumn(field, format_epoch_millis(F.col(field), fmt))


def unwrap(df: DataFrame, add_fields: Sequence[str] = ("op", "db", "table", "ts_ms"),
           keep: Iterable[str] = KAFKA_FIELDS) -> DataFrame:
    """Change envelope -> flat row.

    Deletes are rewritten: the row image comes from ``before`` and ``__deleted`` is
    ``'true'``; other events take ``after`` and ``'false'``. Tombstones are dropped.
    ``add_fields`` become ``__<name>`` columns: ``op``/``ts_ms`` from the envelope,
    anything else from the ``source`` block.
    """
    df = drop_tombstones(df)
    is_delete = F.col("op") == "d"
    image = F.when(is_delete, F.col("before")).otherwise(F.col("after"))
    row_fields = df.schema["after"].dataType.fieldNames()
    extra = []
    for name in add_fields:
        src = F.col(name) if name in ENVELOPE_FIELDS else F.col("source").getField(name)
        extra.append(src.alias(f"__{name}"))
    kept = [F.col(c) for c in keep if c in df.columns]
    return df.select(
        *kept,
        *[image.getField(f).alias(f) for f in row_fields],
        *extra,
        F.when(is_delete, F.lit("true")).otherwise(F.lit("false")).alias("__deleted"),
    )


def format_field(df: DataFrame, name: str = "__db_table", fields: Sequence[str] = ("__db", "__table"),
                 fmt: str = "$1_bronze.$2") -> DataFrame:
    """C4: ``name`` = template with ``$1..$n`` replaced by the given fields (null in -> null out)."""
    parts: list[Column] = []
    for piece in re.split(r"(\$\d+)", fmt):
        if not piece:
            continue
        if re.fullmatch(r"\$\d+", piece):
            parts.append(F.col(fields[int(piece[1:]) - 1]))
        else:
            parts.append(F.lit(piece))
    return df.withColumn(name, F.concat(*parts))


def replace_value(df: DataFrame, field: str = "__op", mapping: dict[str, str] | None = None) -> DataFrame:
    """Map values of ``field`` (c->I, u->U, d->D); other values stay as they are."""
    mapping = OP_CODES if mapping is None else mapping
    lookup = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return df.withColumn(field, F.coalesce(lookup[F.col(field)], F.col(field)))


def replace_field(df: DataFrame, renames: dict[str, str] | None = None) -> DataFrame:
    """Rename fields (``__ts_ms`` -> ``last_applied_date``)."""
    renames = {"__ts_ms": "last_applied_date"} if renames is None else renames
    return df.withColumnsRenamed({k: v for k, v in renames.items() if k in df.columns})


def hash_key(df: DataFrame, key_fields: Sequence[str] | None = None, field: str = "id_iceberg",
             delimiter: str = "|") -> DataFrame:
    """md5 of the record-key fields joined with ``delimiter``.

    Without ``key_fields`` the fields of the record's ``key`` struct are used (the
    primary-key columns the connector puts in the Kafka key). ``concat_ws`` skips nulls,
    so key fields must be non-null; rows with a null key field get a null hash instead
    of a colliding one.
    """
    if key_fields is None:
        if "key" not in df.columns or not hasattr(df.schema["key"].dataType, "fieldNames"):
            raise ValueError("hash_key needs key_fields or a struct column 'key'")
        key_fields = [f"key.`{f}`" for f in df.schema["key"].dataType.fieldNames()]
    cols = [F.col(k).cast("string") for k in key_fields]
    any_null = reduce(lambda a, b: a | b, [c.isNull() for c in cols])
    return df.withColumn(field, F.when(~any_null, F.md5(F.concat_ws(delimiter, *cols))))


def table_include(df: DataFrame, database: str, tables: Iterable[str], connector: str = "mysql") -> DataFrame:
    """Keep events of listed tables (``db.table`` for MySQL, ``db.dbo.table`` for SQL Server)."""
    if connector == "mysql":
        names = sorted({f"{database}.{t}" for t in tables})
        full = F.concat_ws(".", F.col("source.db"), F.col("source.table"))
    elif connector == "sqlserver":
        names = sorted({f"{database}.dbo.{t}" for t in tables})
        fields = df.schema["source"].dataType.fieldNames()
        schema = F.col("source.schema") if "schema" in fields else F.lit("dbo")
        full = F.concat_ws(".", F.col("source.db"), schema, F.col("source.table"))
    else:
        raise ValueError(f"unsupported connector: {connector}")
    return df.filter(full.isin(names))


def table_include_frame(df: DataFrame, tables: DataFrame) -> DataFrame:
    """C9 for long lists: semi join against a frame of (db, table) pairs.

    A plain join: Spark broadcasts the list by its measured bytes or shuffles, with skewed
    tables split.
    """
    keyed = df.withColumn("_db", F.col("source.db")).withColumn("_tb", F.col("source.table"))
    wanted = tables.select(F.col("db").alias("_db"), F.col("table").alias("_tb")).distinct()
    return keyed.join(wanted, ["_db", "_tb"], "left_semi").drop("_db", "_tb")


def tinyint1_to_boolean(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """TINYINT(1) columns -> boolean (null stays null)."""
    return df.withColumns({c: F.col(c) != 0 for c in columns})


def decimal_precise(df: DataFrame, columns: Sequence[str], precision: int = 12, scale: int = 8) -> DataFrame:
    """Exact decimal columns (never through double)."""
    return df.withColumns({c: F.col(c).cast(f"decimal({precision},{scale})") for c in columns})


def normalize_char(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Strip the blank padding SQL Server adds to CHAR columns."""
    return df.withColumns({c: F.rtrim(F.col(c)) for c in columns})


# --- C8: the chain -------------------------------------------------------------------

TransformFn = Callable[..., DataFrame]

# name -> (function, default settings). Settings are strings as in connector configs;
# "${topic_prefix}" is interpolated, "$1" placeholders are left alone.
TRANSFORMS: dict[str, tuple[TransformFn, dict]] = {
    "ignoreReadOp": (ignore_read_op, {"topic_regex": "^(${topic_prefix}.*)\\..*"}),
    "unwrap": (unwrap, {}),
    "tsConvertor": (ts_convert, {"field": "ts_ms", "fmt": TS_TEXT_FORMAT}),
    "formatField": (format_field, {"name": "__db_table", "fields": ("__db", "__table"), "fmt": "$1_bronze.$2"}),
    "replaceValue": (replace_value, {"field": "__op"}),
    "replaceField": (replace_field, {"renames": {"__ts_ms": "last_applied_date"}}),
    "hashKey": (hash_key, {"field": "id_iceberg", "delimiter": "|"}),
    "dropTombstones": (drop_tombstones, {}),
}


def _interpolate(value, context: dict[str, str]):
    if isinstance(value, str):
        return string.Template(value).safe_substitute(context)
    return value


def transform_chain(df: DataFrame, names: Sequence[str], topic_prefix: str = "local",
                    overrides: dict[str, dict] | None = None) -> DataFrame:
    """Apply the named transforms in order; unknown names are skipped."""
    context = {"topic_prefix": topic_prefix}
    overrides = overrides or {}
    steps = []
    for name in names:
        if name not in TRANSFORMS:
            continue
        fn, defaults = TRANSFORMS[name]
        kwargs = {k: _interpolate(v, context) for k, v in {**defaults, **overrides.get(name, {})}.items()}
        steps.append((fn, kwargs))
    return reduce(lambda acc, step: step[0](acc, **step[1]), steps, df)


# The flagship chain of the capture connector (order matters: tsConvertor must run
# before unwrap because it rewrites the envelope field).
BRONZE_CHAIN = ("ignoreReadOp", "unwrap", "formatField", "replaceValue", "replaceField", "hashKey")
