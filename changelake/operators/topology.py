"""Consumer-group and connector topology.

Inputs are listings as tables (the live admin calls are outside Spark):
assignments ``(group_id, member_id, topic, partition)``, topics ``(topic)``, groups
``(group_id)`` and connector status ``(name, worker_id)``. Lists are emitted both as
sorted arrays and as comma-joined text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def topic_consumers(topics: DataFrame, assignments: DataFrame) -> DataFrame:
    """Per topic, the sorted list of groups holding its partitions.

    A left join from the topic listing, so an idle topic gets ``[]``; a group that holds
    several partitions of a topic appears once per partition. The listing side is
    pre-aggregated per (topic, group) before the join so a hot topic shuffles one row
    per (map task, group) instead of one per assignment.
    """
    per_group = (assignments.groupBy("topic", "group_id").agg(F.count("*").alias("_n")))
    joined = topics.select("topic").distinct().join(per_group, "topic", "left")
    groups = F.array_sort(F.flatten(F.collect_list(
        F.when(F.col("group_id").isNotNull(), F.array_repeat(F.col("group_id"), F.col("_n").cast("int"))))))
    return (joined.groupBy("topic").agg(groups.alias("groups"))
            .withColumn("groups_text", F.array_join("groups", ",")))


def consumer_topics(groups: DataFrame, assignments: DataFrame, errors: DataFrame | None = None) -> DataFrame:
    """Per group, the sorted distinct topics it reads; a group without members -> ``[]``.

    ``errors`` (group_id, error) lists groups whose description failed; their entry is
    the error text instead of a topic list, as in the exported listing.
    """
    pairs = assignments.select("group_id", "topic").distinct()
    joined = groups.select("group_id").distinct().join(pairs, "group_id", "left")
    out = joined.groupBy("group_id").agg(F.array_sort(F.collect_set("topic")).alias("topics"))
    if errors is not None:
        # fixed values: the text of a failed description
        err = errors.select("group_id", F.concat(F.lit("Error describing group: "), F.col("error")).alias("_err"))
        out = (out.join(err, "group_id", "left")
               .withColumn("topics", F.when(F.col("_err").isNotNull(), F.array(F.col("_err")))
                           .otherwise(F.col("topics")))
               .drop("_err"))
    return out.withColumn("topics_text", F.array_join("topics", ","))


def connectors_by_worker(status: DataFrame) -> DataFrame:
    """Connectors grouped by the host part of their worker id (text before the first dot).

    ``connectors`` keeps every status column of each connector, by name.
    """
    host = F.split(F.col("worker_id"), r"\.").getItem(0)
    entry = F.struct("name", *[c for c in status.columns if c != "name"])
    return (status.withColumn("worker_host", host)
            .groupBy("worker_host")
            .agg(F.sort_array(F.collect_list(entry)).alias("connectors"), F.count("*").alias("n_connectors"))
            .withColumn("connectors_text", F.array_join("connectors.name", ",")))


# status document of the Connect REST listing (`?expand=status`): name -> {status: {connector: {...}}}
_CONNECTOR_STATUS = T.MapType(T.StringType(), T.StructType([
    T.StructField("status", T.StructType([
        T.StructField("name", T.StringType()),
        T.StructField("connector", T.StructType([
            T.StructField("state", T.StringType()), T.StructField("worker_id", T.StringType())])),
    ])),
]))


def parse_connector_status(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Connector status documents (JSON text, one map per document) -> (name, state, worker_id) rows."""
    parsed = docs.select(F.explode(F.from_json(F.col(text_col), _CONNECTOR_STATUS)).alias("name", "v"))
    return parsed.select("name", F.col("v.status.connector.state").alias("state"),
                         F.col("v.status.connector.worker_id").alias("worker_id"))


_GROUP_DESCRIPTION = T.StructType([
    T.StructField("group_id", T.StringType()),
    T.StructField("members", T.ArrayType(T.StructType([
        T.StructField("member_id", T.StringType()),
        T.StructField("assignment", T.ArrayType(T.StructType([
            T.StructField("topic", T.StringType()), T.StructField("partition", T.IntegerType())]))),
    ]))),
])


def parse_group_descriptions(docs: DataFrame, text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Consumer-group descriptions (JSON text, one group per document) -> (groups, assignments).

    ``groups`` lists every described group (also those without members);
    ``assignments`` has one row per (group, member, topic, partition) held.
    """
    g = docs.select(F.from_json(F.col(text_col), _GROUP_DESCRIPTION).alias("g")).filter(F.col("g").isNotNull())
    groups = g.select(F.col("g.group_id").alias("group_id"))
    members = g.select(F.col("g.group_id").alias("group_id"), F.explode("g.members").alias("m"))
    assignments = members.select("group_id", F.col("m.member_id").alias("member_id"),
                                 F.explode("m.assignment").alias("tp")) \
        .select("group_id", "member_id", F.col("tp.topic").alias("topic"), F.col("tp.partition").alias("partition"))
    return groups, assignments
