"""Near-duplicates and components against all pairs by brute force, edge rows."""

import random


from changelake.llm import graph, neardup
from changelake.llm.queries import QUERIES


def shingles(text, n=2):
    w = "".join(c.lower() if c.isascii() else c for c in text or "").replace("\x0b", " ").replace("\x0c", " ")
    w = [x for x in w.replace("\t", " ").replace("\n", " ").replace("\r", " ").split(" ") if x]
    return frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])


def brute(rows, n=2):
    sets = [(i, shingles(t, n)) for i, t in rows]
    classes = sorted({s for _, s in sets if s}, key=lambda s: sorted(map(str, s)))
    par = {s: s for s in classes}

    def find(s):
        while par[s] != s:
            s = par[s]
        return s

    for k, a in enumerate(classes):
        for b in classes[:k]:
            if 100 * len(a & b) >= 80 * len(a | b):
                par[find(a)] = find(b)
    name = {}
    for i, s in sets:
        if s and i is not None:
            name[find(s)] = min(i, name.get(find(s), i))
    out = []
    for i, s in sets:
        c = name.get(find(s)) if s else i
        out.append((i, len(s), c, i == c))
    return sorted(out, key=str)


def got(df, n=2):
    out = neardup.near_duplicates(df, neardup.NearDupParams(words=n)).drop("text_hash")
    return sorted((tuple(r) for r in out.collect()), key=str)


def test_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted((tuple(r) for r in QUERIES["op9_minhash_near_dedup"](spark, sf_dir).collect()), key=str) == brute(rows)


def test_planted_groups_hot_copies_and_edge_rows(spark):
    rng = random.Random(5)
    vocab = [f"w{i}" for i in range(300)]
    rows = []
    for _ in range(12):
        base = [rng.choice(vocab) for _ in range(rng.choice([4, 12, 60, 200]))]
        for _ in range(rng.choice([1, 3, 40])):
            w = list(base)
            for _ in range(rng.randint(0, max(1, len(w) // 20))):
                w[rng.randrange(len(w))] = rng.choice(vocab)
            rows.append(" ".join(w))
    rows += ["copy Of one\tText"] * 200 + ["COPY of one text", None, "", " \n", "one", "ONE", "two", "École a b c", "école a b c"]
    rows = [(i * 3 + 1, t) for i, t in enumerate(rows)] + [(None, "copy of one text"), (None, "alone here"), (None, None), (4, rows[1] + ' x'),
                                                           (9000, "long " * 3 + " ".join(str(i) for i in range(30_000)))]
    df = spark.createDataFrame([(i, t, "clash") for i, t in rows], "doc_id long, text string, cls string")
    assert got(df) == brute(rows)
    assert got(df, 5) == brute(rows, 5)
    kept = neardup.drop_near_duplicates(df, neardup.NearDupParams(words=2))
    assert kept.columns == df.columns
    # (id, set size) tells the rows apart here
    want = {(i, n) for i, n, _, k in brute(rows) if k}
    assert sorted(((r["doc_id"], len(shingles(r["text"]))) for r in kept.collect()), key=str) == sorted(want, key=str)
    assert neardup.near_duplicates(df.limit(0)).count() == 0


def test_components_of_long_chains(spark):
    edges = [(i, i + 1) for i in range(0, 70)] + [(200, 201), (202, 201)]
    labels = {r["node"]: r["label"] for r in graph.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert labels == {**{i: 0 for i in range(71)}, 200: 200, 201: 200, 202: 200}


def test_recall_in_nodes_that_stay_large(spark):
    """Pairs at the threshold among many texts that share most of their words: the walk must go deep."""
    p = neardup.NearDupParams(words=1, small_node=2)
    rng = random.Random(11)
    shared = [f"s{i}" for i in range(300)]
    rows = []
    for k in range(400):
        own = [f"k{k}n{i}" for i in range(100)]
        rows.append(" ".join(shared + own))
        if k < 120:  # 360 of 440 words are common: 0.818
            rows.append(" ".join(shared + own[:60] + [f"k{k}m{i}" for i in range(40)]))
    rows = list(enumerate(rows))
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = {i for i, _, _, kept in brute(rows, 1) if not kept}
    found = {r["doc_id"] for r in neardup.near_duplicates(df, p).filter("NOT kept").collect()}
    assert len(want) == 120 and found <= want
    assert len(found) >= 0.95 * len(want)


def test_recall_by_level():
    p = neardup.NearDupParams()
    assert abs(neardup.recall(p, 4) - (1 - (1 - 0.8 ** 4) ** 24)) < 1e-12
    assert all(neardup.recall(p, level) > 0.96 for level in range(p.first_level, p.last_level + 1, p.stride))
