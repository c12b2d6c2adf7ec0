"""Schema-registry wire frames around Kafka values.

Two frames are handled, both as binary column expressions:

* Confluent: byte 0 = magic 0, bytes 1-4 = big-endian schema id, then the body.
* Glue registry (GSR): byte 0 = header version 3, byte 1 = compression (0 none,
  5 zlib), bytes 2-17 = schema-version UUID, then the body.

JSON bodies decode with ``from_json``; Avro bodies need the ``spark-avro`` package
and go through ``from_avro``/``to_avro`` (a thin call, no codec of our own).
"""

from __future__ import annotations

import zlib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# fixed values: wire-format header bytes
CONFLUENT_MAGIC = 0
CONFLUENT_HEADER = 5
GSR_VERSION = 3
GSR_COMPRESSION_NONE = 0
GSR_COMPRESSION_ZLIB = 5
GSR_HEADER = 18


def _bin(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _from(v: Column, start: int) -> Column:
    """Everything from byte ``start`` (1-based) on."""
    return F.substring(v, F.lit(start), F.octet_length(v))


def has_magic_byte(value: str | Column) -> Column:
    """True when the value starts with the Confluent magic byte; null/empty -> false."""
    v = _bin(value)
    return F.coalesce((F.octet_length(v) > 0) & (F.substring(v, 1, 1) == F.lit(bytes([CONFLUENT_MAGIC]))),
                      F.lit(False))


def confluent_schema_id(value: str | Column) -> Column:
    """Schema id of a Confluent-framed value (null when the frame is absent)."""
    v = _bin(value)
    return F.when(has_magic_byte(v) & (F.octet_length(v) >= CONFLUENT_HEADER),
                  F.conv(F.hex(F.substring(v, 2, 4)), 16, 10).cast("int"))


def strip_confluent_frame(value: str | Column) -> Column:
    """Body of a Confluent-framed value; values without the frame are returned as they are."""
    v = _bin(value)
    return F.when(has_magic_byte(v), _from(v, CONFLUENT_HEADER + 1)).otherwise(v)


def confluent_frame(body: Column, schema_id: int | Column) -> Column:
    """Magic byte + 4-byte big-endian id + body (S8/S9 encode)."""
    if isinstance(schema_id, int):
        id_bytes = F.lit(schema_id.to_bytes(4, "big"))
    else:
        id_bytes = F.unhex(F.lpad(F.hex(schema_id.cast("int")), 8, "0"))
    return F.concat(F.lit(bytes([CONFLUENT_MAGIC])), id_bytes, body)


def is_gsr_framed(value: str | Column) -> Column:
    v = _bin(value)
    return F.coalesce((F.octet_length(v) >= GSR_HEADER) & (F.substring(v, 1, 1) == F.lit(bytes([GSR_VERSION]))),
                      F.lit(False))


def gsr_schema_version(value: str | Column) -> Column:
    """Schema-version UUID text of a GSR-framed value."""
    v = _bin(value)
    h = F.lower(F.hex(F.substring(v, 3, 16)))
    uuid = F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4),
                       F.substring(h, 17, 4), F.substring(h, 21, 12))
    return F.when(is_gsr_framed(v), uuid)


def gsr_compression(value: str | Column) -> Column:
    v = _bin(value)
    return F.when(is_gsr_framed(v), F.conv(F.hex(F.substring(v, 2, 1)), 16, 10).cast("int"))


def strip_gsr_frame(value: str | Column, inflate: bool = False) -> Column:
    """Body of a GSR-framed value, null where it is compressed.

    With ``inflate`` zlib bodies are inflated too, in Arrow batches (Spark has no built-in
    inflate); a body that does not inflate is null.
    """
    v = _bin(value)
    body, plain = _from(v, GSR_HEADER + 1), is_gsr_framed(v) & (gsr_compression(v) == GSR_COMPRESSION_NONE)
    out = F.when(plain, body)
    if inflate:
        packed = is_gsr_framed(v) & (gsr_compression(v) == GSR_COMPRESSION_ZLIB)
        out = out.when(packed, _inflate(F.when(packed, body)))
    return out


def _inflate_one(body: bytes | None) -> bytes | None:
    try:
        return None if body is None else zlib.decompress(body)
    except zlib.error:
        return None


@F.pandas_udf(T.BinaryType())
def _inflate(bodies: pd.Series) -> pd.Series:
    return bodies.map(_inflate_one)


def gsr_frame(body: Column, schema_version: str) -> Column:
    """Header version 3 + no compression + schema-version UUID + body (S10 encode)."""
    uid = F.unhex(F.lit(schema_version.replace("-", "")))
    return F.concat(F.lit(bytes([GSR_VERSION, GSR_COMPRESSION_NONE])), uid, body)


# --- decoders over a Kafka-record frame -------------------------------------------

CORRUPT = "_corrupt_record"


def utf8_text(body: Column) -> Column:
    """The body as text; null where its bytes are not UTF-8 (``decode`` would fail the whole query)."""
    return F.try_validate_utf8(body.cast("string"))


def is_utf8(body: Column) -> Column:
    return F.is_valid_utf8(body.cast("string"))


def add_json(df: DataFrame, out: str, text: Column, schema: T.StructType) -> DataFrame:
    """``df`` with the parsed text as struct column ``out``: null, not a struct of nulls, where it does not decode.

    The text is parsed below a generator of one row. Without it the optimizer copies the parse
    into every use of a field, and a filter and ten columns parse each record dozens of times.
    """
    parsed = F.from_json(text, T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())]),
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    df = df.withColumn("__json", F.explode(F.array(parsed)))
    p = F.col("__json")
    good = p.isNotNull() & p.getField(CORRUPT).isNull()
    return df.withColumn(out, F.when(good, F.struct(*[p.getField(n).alias(n) for n in schema.fieldNames()]))).drop("__json")


def _body_and_meta(v: Column, frame: str | None, inflate: bool) -> tuple[Column, dict[str, Column]]:
    if frame == "confluent":
        return strip_confluent_frame(v), {"schema_id": confluent_schema_id(v)}
    if frame == "gsr":
        return strip_gsr_frame(v, inflate), {"schema_version": gsr_schema_version(v)}
    if frame is None:
        return v, {}
    raise ValueError(f"unknown frame {frame!r}")


def decode_json(records: DataFrame, schema: T.StructType, value_col: str = "value", frame: str | None = None,
                out: str = "data", inflate: bool = False) -> DataFrame:
    """UTF-8 JSON values (plain, Confluent- or GSR-framed) -> struct column ``out``.

    ``out`` is null for a tombstone (null value) and for a value that does not decode; the
    two are told apart by the raw value, see :func:`decode_error`.
    """
    v = F.col(value_col)
    body, meta = _body_and_meta(v, frame, inflate)
    return add_json(records.withColumns(meta), out, utf8_text(body), schema)


def decode_error(value: str | Column, data: str | Column, frame: str | None = None, strict: bool = True) -> Column:
    """Why a decoded record is a dead letter; null for good records and tombstones.

    ``strict``: a Confluent topic must not hold values without the frame.
    """
    v, d = _bin(value), _bin(data)
    error = F.when(v.isNull(), F.lit(None).cast("string"))
    if frame == "confluent":
        if strict:
            error = error.when(~has_magic_byte(v), F.lit("missing magic byte"))
        error = error.when(has_magic_byte(v) & (F.octet_length(v) < CONFLUENT_HEADER), F.lit("cut header"))
    elif frame == "gsr":
        error = error.when(~is_gsr_framed(v), F.lit("missing registry header"))
        error = error.when(d.isNull() & (gsr_compression(v) != GSR_COMPRESSION_NONE), F.lit("compressed body"))
    body, _ = _body_and_meta(v, frame, False)
    error = error.when(d.isNull() & ~is_utf8(body), F.lit("not UTF-8"))
    return error.when(d.isNull(), F.lit("undecodable body"))


def connect_json_decode(records: DataFrame, schema: T.StructType, schemas_enable: bool,
                        value_col: str = "value", out: str = "data") -> DataFrame:
    """Kafka Connect JSON. With ``schemas.enable`` the value is ``{"schema":..,"payload":..}``.

    ``out`` is null where the value does not decode; ``decode_error`` of it gives the reason.
    """
    text = utf8_text(F.col(value_col))
    if schemas_enable:
        wrapped = T.StructType([T.StructField("payload", schema)])
        return add_json(records, out, text, wrapped).withColumn(out, F.col(out).getField("payload"))
    return add_json(records, out, text, schema)


def decode_avro(records: DataFrame, avro_schema_json: str, value_col: str = "value", frame: str = "confluent",
                out: str = "data") -> DataFrame:
    """Framed Avro values -> struct (needs the spark-avro package on the classpath)."""
    from pyspark.sql.avro.functions import from_avro

    v = F.col(value_col)
    body = strip_confluent_frame(v) if frame == "confluent" else strip_gsr_frame(v)
    return records.withColumn(out, from_avro(body, avro_schema_json, {"mode": "PERMISSIVE"}))


def encode_json(df: DataFrame, schema_id: int | None = None, schema_version: str | None = None,
                key: Column | None = None) -> DataFrame:
    """Rows -> (key, value) with a UTF-8 JSON body, optionally framed."""
    body = F.encode(F.to_json(F.struct(*[F.col(c) for c in df.columns])), "UTF-8")
    if schema_id is not None:
        body = confluent_frame(body, schema_id)
    elif schema_version is not None:
        body = gsr_frame(body, schema_version)
    k = key if key is not None else F.encode(F.expr("uuid()"), "UTF-8")
    return df.select(k.alias("key"), body.alias("value"))


def encode_avro(df: DataFrame, avro_schema_json: str, schema_id: int | None = None,
                schema_version: str | None = None) -> DataFrame:
    """Rows -> framed Avro values (needs spark-avro)."""
    from pyspark.sql.avro.functions import to_avro

    body = to_avro(F.struct(*[F.col(c) for c in df.columns]), avro_schema_json)
    if schema_id is not None:
        body = confluent_frame(body, schema_id)
    elif schema_version is not None:
        body = gsr_frame(body, schema_version)
    return df.select(F.encode(F.expr("uuid()"), "UTF-8").alias("key"), body.alias("value"))


def decode_json_by_schema_id(records: DataFrame, schemas_by_id: dict[int, T.StructType], value_col: str = "value",
                             out: str = "data") -> DataFrame:
    """S3 over evolving schemas: each record decoded with its own registry schema, in one pass.

    The fields of all versions are merged in the order of their ids, a later version's type
    winning; a field that a record's version lacks is null. Records with an unknown id are
    kept with a null ``out``, as are those that do not decode.
    """
    v = F.col(value_col)
    text = utf8_text(strip_confluent_frame(v))
    fields: dict[str, T.DataType] = {}
    for _, schema in sorted(schemas_by_id.items()):
        fields |= {f.name: f.dataType for f in schema.fields}
    merged = T.StructType([T.StructField(n, t) for n, t in fields.items()])
    decoded = None
    records = records.withColumn("schema_id", confluent_schema_id(v))
    for schema_id, schema in sorted(schemas_by_id.items()):
        # a record is parsed by its own version only
        records = add_json(records, f"__v{schema_id}", F.when(F.col("schema_id") == schema_id, text), schema)
        own = F.col(f"__v{schema_id}")
        row = F.struct(*[(own.getField(n).cast(t) if n in schema.fieldNames() else F.lit(None).cast(t)).alias(n)
                         for n, t in fields.items()])
        here = own.isNotNull()
        decoded = F.when(here, row) if decoded is None else decoded.when(here, row)
    return records.withColumn(out, decoded.cast(merged)).drop(*[f"__v{i}" for i in schemas_by_id])


def decode_avro_by_schema_id(records: DataFrame, schemas_by_id: dict[int, str], value_col: str = "value",
                             out: str = "data") -> DataFrame:
    """S2 over evolving schemas: the writer schema of each record's id (needs spark-avro).

    The structs must have the same Spark type, so evolved writers are read with their own
    schema and cast to the newest one.
    """
    from pyspark.sql.avro.functions import from_avro

    v = F.col(value_col)
    body, newest = strip_confluent_frame(v), schemas_by_id[max(schemas_by_id)]
    decoded = None
    for schema_id, schema in sorted(schemas_by_id.items()):
        own = from_avro(F.when(F.col("schema_id") == schema_id, body), schema, {"mode": "PERMISSIVE", "avroSchema": newest})
        decoded = F.when(F.col("schema_id") == schema_id, own) if decoded is None else decoded.when(F.col("schema_id") == schema_id, own)
    return records.withColumn("schema_id", confluent_schema_id(v)).withColumn(out, decoded)
