"""changelake: change-data-capture pipelines as PySpark DataFrame and Structured Streaming operators.

Modules
-------
session               runtime settings, shared checkpoint folder, lineage cuts
schemas               change envelope, lake row, Kafka record, spec and rule-set schemas
functions.temporal    epoch / ISO / day / time-of-day decoding, lake partition parts
functions.numbering   row numbers within a group without one task per group
functions.joins       counted broadcast for configuration-sized join sides
operators.transforms  connector transforms (filter reads, unwrap, key hash, chain, ...)
operators.bronze      newest state per key, upsert of change batches
operators.lag         topic filter/split, last record per partition, latency, freshness
operators.topology    consumers per topic, topics per group, connectors per worker
operators.catalog     table specifications, audits, type map, comment reconciliation
operators.ingest_rules  rule-set parsing, rule planning, plan application
sources.framing       schema-registry frames and JSON/Avro decode/encode
sources.kafka         Kafka reader/writer options
sources.lake          daily change lake sink, scan, schema versions, archive, dead letters
sources.catalog_io    catalog reads, spec snapshots, comment DDL, head
streaming.jobs        streaming versions of the sinks, folds and metrics
plans                 registered queries over the test tables and their SQL oracles
"""

__version__ = "0.1.0"
