"""BPE against the tokenizers library, and the round trip."""

import hashlib
import random
import time
import unicodedata

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from changelake.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def ours():
    with open(PATH, encoding="utf-8") as f:
        return bpe.BacktrackingBpe(f.read())


LIB = Tokenizer.from_file(PATH)
OURS = None


def same(b, text):
    e = LIB.encode(text, add_special_tokens=False).ids
    assert b.encode(text) == e
    assert b.decode_bytes(np.array(e, np.int64)).decode() == LIB.decode(e, skip_special_tokens=False)


def test_edge_texts(ours):
    for t in ["", " \n\t", "Σας ΟΔΟΣ", "x² ½ Ⅷ 10 a_b __ 's 'LL don't", "<|endoftext|> a<|startoftext|>b",
              "\x1c\x1f a\x85b", "é é İstanbul", "日本語 👍🏽", "a" * 5000, "ab" * 3000]:
        same(ours, t)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="aeiouthngs' śÉß²_-!?.\n\t09", max_size=80))
def test_random_texts(ours, text):
    same(ours, text)


def test_random_words(ours):
    rng = random.Random(3)
    for _ in range(2000):
        same(ours, "".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(1, 40))))


def test_documents(spark, sf_dir):
    from changelake.llm.queries import QUERIES

    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = QUERIES["op3_bpe_encode_decode"](spark, sf_dir).collect()
    assert len(rows) == len(docs)
    for r in rows:
        e = LIB.encode(docs[r["doc_id"]], add_special_tokens=False).ids
        assert r["n_tokens"] == len(e)
        assert r["ids_sha256"] == hashlib.sha256(np.array(e, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(LIB.decode(e, skip_special_tokens=False).encode()).hexdigest()


def test_nulls_empties_repeats_and_extra_columns(spark):
    df = spark.createDataFrame([(1, None, 7), (None, "", 8), (2, "the cat", 9), (2, "the cat", 9)],
                               "doc_id long, text string, n_tokens int")
    rows = bpe.encode_documents(df, PATH).collect()
    assert sorted(r["n_tokens"] for r in rows) == [0, 0, 2, 2]
    assert [list(r["ids"]) for r in rows if r["n_tokens"]] == [LIB.encode("the cat", add_special_tokens=False).ids] * 2
    assert bpe.bpe_digest(df.limit(0), PATH).count() == 0


def normal(text):
    return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()


def test_split_patterns_agree_and_ascii_is_fast(ours):
    """Each text takes the pattern of its code points; the narrow ones find the same pieces in a fraction of the time."""
    odd = ["it's 12 a_b\x1cc\x1fd\x85e\xa0f", "não  x 　 ²٠́ don't", "\U0001d400 \U00020000\U0001f600 ² l'll", "\U0001d7d8a\U0001d7d9"]
    for text in odd:
        assert ours._pieces(text) == ours._splits[2].findall(normal(text))
    assert {i: ours._splits[i].findall(t) for i, t in enumerate(["a'll 1x", "é'll ٠1x"])} == {0: ["a", "'ll", "1", "x"], 1: ["é", "'ll", "٠", "1", "x"]}
    text = "some words, of an ordinary text 17 " * 3000

    def seconds(f):
        times = []
        for _ in range(5):
            t = time.process_time()
            f(text)
            times.append(time.process_time() - t)
        return min(times)

    assert 2 * seconds(ours._pieces) < seconds(ours._splits[2].findall)


def test_longest_token_of_a_path(ours):
    """Below every path of the trie stands the longest usable token that it begins with."""
    words = ["unbelievable", "xqzjv", "aaaaaaaa", "ofwhlyly", "123"]
    for word in words:
        s = word + bpe.END
        for at in range(len(s)):
            token = ours._longest(s[at:])
            fits = [i for n in range(1, len(s) - at + 1) for i in [ours.automaton.get(s[at:at + n], -1)] if i >= 0]
            assert token == fits[-1]
