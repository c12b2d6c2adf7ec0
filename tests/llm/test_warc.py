"""WARC: exact round trip, any cut into ranges, false magic numbers, edge rows."""

import gzip
import io
import random
import zlib

import pytest

from changelake.llm import warc
from changelake.llm.queries import QUERIES
from changelake.session import scratch_path


def expected(pages):
    best = {}
    for i, html in pages:
        k = html or ""
        if i is not None:
            best[k] = max(best.get(k, i), i)
    out = []
    for i, html in pages:
        raw = (html or "").encode()
        top = best.get(html or "")
        ref = top if top is not None and (i is None or i < top) else None
        out.append((i, len(raw), warc.sha1_base32(raw), "revisit" if ref is not None else "response", ref))
    return sorted(out, key=str)


def test_query(spark, sf_dir):
    pages = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "html").collect()]
    assert sorted((tuple(r) for r in QUERIES["op2_warc_round_trip"](spark, sf_dir).collect()), key=str) == expected(pages)


@pytest.mark.parametrize("range_bytes", [5000, 1 << 20])
def test_round_trip_by_any_ranges(spark, range_bytes):
    rng = random.Random(1)
    pages = [(i, rng.choice([None, "", "a", "é" * 500, f"page {i} " * rng.randint(0, 300), "\r\n\r\nWARC/1.1"])) for i in range(200)]
    pages += [(7, "twice"), (7, "twice"), (None, "twice"), (None, "only null"), (None, "only null"), (500, "x" * 300_000)]
    df = spark.createDataFrame([(i, "http://h/\r\nx" if i and i % 3 else None, h, "clash") for i, h in pages],
                               "page_id long, url string, html string, digest string").repartition(3)
    folder = scratch_path(spark, "warc-test")
    manifest = warc.write_warc(df, folder, file_bytes=20_000)
    assert manifest.agg({"records": "sum"}).first()[0] == len(pages)
    for m in (manifest, None):
        got = warc.read_warc(spark, folder, m, range_bytes=range_bytes).collect()
        assert sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got),
                      key=str) == expected(pages)
    payload = {r["page_id"]: r["payload"] for r in got if r["record_type"] == "response"}
    assert payload[500] == b"x" * 300_000


def test_scanner_passes_over_false_magic_numbers():
    members, raws = [], []
    for i in range(30):
        body = random.Random(i).randbytes(400) + warc.MAGIC * 5 + gzip.compress(b"not a record")
        raw = warc.VERSION + b"\r\nX: y\r\n\r\n" + body
        z = zlib.compressobj(0, zlib.DEFLATED, 31)  # stored: the false magic numbers stay visible
        members.append(z.compress(raw) + z.flush())
        raws.append(raw)
    data = b"junk" + warc.MAGIC + b"".join(members) + warc.MAGIC
    for size in (50, 333, 10**6):
        got = [r for s in range(0, len(data), size) for r in warc.RangeScanner(io.BytesIO(data), len(data), s, s + size, step=64)]
        assert got == raws


def test_minimum_size_and_empty_table(spark):
    df = spark.createDataFrame([(1, None, "aa"), (2, None, "aa"), (3, None, "bbbb"), (4, None, "bbbb")], "page_id long, url string, html string")
    folder = scratch_path(spark, "warc-test")
    got = warc.read_warc(spark, folder, warc.write_warc(df, folder, min_dedup_bytes=3)).collect()
    assert {r["page_id"]: r["refers_to"] for r in got} == {1: None, 2: None, 3: 4, 4: None}
    folder = scratch_path(spark, "warc-test")
    assert warc.read_warc(spark, folder, warc.write_warc(df.limit(0), folder)).count() == 0


def damaged_archive(spark, change):
    """Five records in one file, changed at will: (folder, manifest, offsets of the members)."""
    folder = scratch_path(spark, "warc-test")
    df = spark.createDataFrame([(i, None, f"page {i} " * 200) for i in range(5)], "page_id long, url string, html string").coalesce(1)
    manifest = warc.write_warc(df, folder)
    name = f"{folder}/{manifest.first()['file']}"
    data = bytearray(open(name, "rb").read())
    starts = [i for i in range(len(data)) if data[i:i + 3] == warc.MAGIC]
    assert len(starts) == 5
    data = change(data, starts)
    open(name, "wb").write(data)
    size = spark.createDataFrame([(manifest.first()["file"], len(data), 5)], warc.MANIFEST)
    return folder, size, starts


def flip(at):
    def change(data, starts):
        data[at(starts)] ^= 0xFF
        return data
    return change


@pytest.mark.parametrize("change,lost", [
    (flip(lambda s: s[3] - 12), 2),               # in the deflated body
    (flip(lambda s: s[2] - 6), 1),                # in the check sum
    (lambda d, s: d[:-20], 4),                    # the last member is cut
])
def test_damaged_members_are_reported(spark, change, lost):
    folder, manifest, starts = damaged_archive(spark, change)
    with pytest.raises(Exception, match=f"at {starts[lost]}"):
        warc.read_warc(spark, folder, manifest).collect()
    rows = warc.read_warc(spark, folder, manifest, damaged="rows").collect()
    assert sorted(r["page_id"] for r in rows if r["error"] is None) == [i for i in range(5) if i != lost]
    assert [(r["offset"], r["file"]) for r in rows if r["error"]] == [(starts[lost], manifest.first()["file"])]
    found = warc.archive_damage(spark, folder, manifest).collect()
    assert sorted((r["offset"] is None, r["error"][:1]) for r in found)[-1] == (True, "4") and len(found) == 2


def test_a_spoilt_header_shows_in_the_count(spark):
    folder, manifest, _ = damaged_archive(spark, flip(lambda s: s[1]))
    assert warc.read_warc(spark, folder, manifest).count() == 4
    assert [tuple(r) for r in warc.archive_damage(spark, folder, manifest).collect()] == [(manifest.first()["file"], None, "4 of 5 records")]


def test_a_record_against_its_digest(spark):
    def change(data, starts):
        raw = zlib.decompress(bytes(data[starts[2]:starts[3]]), 31).replace(b"page 2", b"page X", 1)
        z = zlib.compressobj(6, zlib.DEFLATED, 31)
        return data[:starts[2]] + z.compress(raw) + z.flush() + data[starts[3]:]
    folder, manifest, starts = damaged_archive(spark, change)
    bad = [r for r in warc.read_warc(spark, folder, manifest, damaged="rows").collect() if r["error"]]
    assert len(bad) == 1 and bad[0]["offset"] == starts[2] and "digest" in bad[0]["error"]
