"""Nodes that stay large lose no link between members that the hub is not linked with."""

from changelake.llm import neardup


def test_a_large_last_node_links_all_its_members(spark):
    # each text shares 80 % or more only with its neighbours; all meet in one large node that is not divided
    word = [f"w{i}" for i in range(100)]
    rows = [(i, " ".join(word[2 * i:2 * i + 40])) for i in range(12)]
    rows += [(100 + i, " ".join(f"v{j}" for j in range(2 * i, 2 * i + 40))) for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    p = neardup.NearDupParams(words=2, trees=1, first_level=0, last_level=0, small_node=4, heads=2)
    got = {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(docs, p).collect()}
    assert got == {i: 0 if i < 100 else 100 for i, _ in rows}


def test_walk_is_not_branched_far(spark):
    p = neardup.NearDupParams()
    assert neardup.ways(p) ** ((p.last_level - p.first_level) / p.stride) < 3
