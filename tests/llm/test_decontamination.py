"""Benchmark leaks against all windows by brute force; the Hamming guarantee; edge rows."""

import random
from collections import Counter

from changelake.llm import decontamination as dec
from changelake.llm.queries import QUERIES


def brute(text, items, p):
    words = dec.WORD.findall((text or "").lower())
    out = set()
    for i, t in items:
        w = dec.WORD.findall((t or "").lower())
        if not w or not words:
            continue
        want = Counter(dec.shingles_of(w, p.shingle))
        n = min(len(w), len(words))
        if any(dec.weighted_jaccard(want, Counter(dec.shingles_of(words[s:s + n], p.shingle))) >= p.similarity
               for s in range(len(words) - n + 1)):
            out.add(i)
    return out


def test_hamming_index_finds_all_within_radius():
    rng = random.Random(1)
    prints = [rng.getrandbits(64) for _ in range(300)]
    for radius in (0, 3, 10, 24):
        index = dec.HammingIndex(prints, radius)
        for _ in range(100):
            f = rng.choice(prints)
            for b in rng.sample(range(64), rng.randint(0, radius + 2)):
                f ^= 1 << b
            assert index.near(f) == [i for i, g in enumerate(prints) if (f ^ g).bit_count() <= radius]


def test_equals_brute_force():
    rng = random.Random(2)
    vocab = [f"v{i}" for i in range(40)]
    items = [(i, " ".join(rng.choice(vocab) for _ in range(rng.choice([2, 4, 5, 15, 30, 57])))) for i in range(40)]
    p = dec.LeakParams()
    finder = dec.LeakFinder(items, p)
    hits = 0
    for _ in range(150):
        w = [rng.choice(vocab) for _ in range(rng.randint(0, 80))]
        leak = rng.choice(items)[1].split()
        for _ in range(rng.choice([0, 0, 1, 1, 2])):
            k = rng.randrange(len(leak))
            leak[k:k + 1] = rng.choice([[], ["new"], [leak[k], "more"]])
        at = rng.randint(0, len(w))
        text = " ".join(w[:at] + leak + w[at:]).upper()
        found = {h[0] for h in finder.find(text)}
        assert found == brute(text, items, p)
        hits += bool(found)
    assert hits > 50


def test_query_finds_verbatim_passages(spark, sf_dir):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    rows = QUERIES["op10_benchmark_decontamination"](spark, sf_dir).collect()
    assert len(rows) == len(docs)
    p = dec.LeakParams()
    for r in rows:
        text = " ".join(dec.WORD.findall(docs[r["doc_id"]].lower()))
        verbatim = {i for i, t in items if " ".join(dec.WORD.findall(t.lower())) in text}
        assert verbatim <= set(r["items"]) and r["contaminated"] == bool(r["items"])
        assert set(r["items"]) <= verbatim or set(r["items"]) == brute(docs[r["doc_id"]], items, p)


def test_blocks_nulls_and_clashes(spark):
    leak = "one two three four five six seven eight nine ten"
    docs = spark.createDataFrame([(1, f"x {leak} y", "c"), (2, None, "c"), (None, leak, "c"), (3, "", "c"), (1, "clean", "c"),
                                  (4, "word " * 50_000 + leak, "c")], "doc_id long, text string, items string")
    bench = spark.createDataFrame([(7, leak), (8, leak), (9, None), (10, ""), (11, "not in any document at all")], "item_id long, text string")
    for size in (8 << 20, 30):
        rows = dec.decontaminate(docs, bench, dec.LeakParams(block_bytes=size)).collect()
        got = sorted(((r["doc_id"] or 0, r["contaminated"], r["items"]) for r in rows), key=str)
        assert got == sorted([(1, True, [7, 8]), (2, False, []), (0, True, [7, 8]), (3, False, []), (1, False, []), (4, True, [7, 8])], key=str)
    assert dec.decontaminate(docs, bench.limit(0)).filter("contaminated").count() == 0
    assert dec.decontaminate(docs.limit(0), bench).count() == 0
