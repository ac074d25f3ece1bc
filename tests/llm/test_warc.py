"""Seekable WARC bundles: round trip, revisits, single records."""

import base64
import hashlib
import random

import pyarrow as pa
import pytest
import zstandard
from pyarrow import fs
from samples import prose

from carelake.llm import seekable_warc as warc
from carelake.session import workspace

SCHEMA = "page_id long, url string, html string, digest string, salt int, payload string, bundle string"


def sample():
    rng = random.Random(4)
    shared = prose(rng, 50)
    rows = [(i, f"http://a.example/{i}", prose(rng, 40)) for i in range(60)]
    rows += [(100 + i, "http://b.example/", shared) for i in range(40)]
    rows += [(200, "http://c.example/x\r\ny zé", "é" * 30), (201, None, None), (202, "", ""), (203, "u", "WARC/1.1\r\n\r\n"),
             (204, "u", prose(rng, 60_000)), (None, "n", shared), (None, None, "only here"), (205, "u", "twice"), (205, "u", "twice"), (206, "v", "twice")]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "d", 1, "p", "b") for r in rows], SCHEMA).repartition(3)


def plain(rows, min_bytes=0):
    first = {}
    for i, _, h in rows:
        if i is not None:
            first[h or ""] = max(first.get(h or "", i), i)
    out = []
    for i, _, h in rows:
        data = (h or "").encode()
        top = first.get(h or "")
        later = len(data) >= min_bytes and i != top
        out.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if later else "response", top if later else None))
    return sorted(out, key=str)


COLUMNS = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def read(spark, archive):
    return sorted((tuple(r) for r in warc.read(spark, archive).select(*COLUMNS).collect()), key=str)


@pytest.mark.parametrize("min_bytes", [0, 1, 200])
def test_round_trip(spark, min_bytes):
    rows = sample()
    archive = warc.write(frame(spark, rows), workspace(spark, "warc"), min_bytes, frame_bytes=4096, bundle_bytes=16384)
    assert read(spark, archive) == plain(rows, min_bytes)
    payloads = {r["page_id"]: bytes(r["payload"]) for r in warc.read(spark, archive).collect() if r["record_type"] == "response"}
    for i, _, h in rows:
        if i in payloads and i is not None:
            assert payloads[i] == (h or "").encode()


def test_single_records_and_other_readers(spark):
    rows = sample()
    archive = warc.write(frame(spark, rows), workspace(spark, "warc"), frame_bytes=4096, bundle_bytes=1024)
    index = archive.index(spark).collect()
    assert len(index) == len(rows) and len({(r["bundle"], r["frame_start"]) for r in index}) > 5
    assert len({r["bundle"] for r in index}) > 2
    ids = spark.createDataFrame([(5,), (204,), (100,), (5,), (999,), (None,)], "page_id long")
    got = {r["page_id"]: r for r in warc.fetch(spark, archive, ids).collect()}
    assert set(got) == {5, 204, 100}
    assert bytes(got[5]["payload"]).decode() == rows[5][2] and len(got[204]["payload"]) > warc.FRAME_BYTES // 8
    assert got[100]["record_type"] == "revisit" and got[100]["refers_to"] == 139 and got[100]["payload"] is None
    # a plain reader skips the seek table and gives the whole WARC file; every frame stands alone
    files, path = fs.FileSystem.from_uri(archive.bundles)
    seen = 0
    for name in {r["bundle"] for r in index}:
        with files.open_input_file(f"{path}/{name}") as source:
            table = warc.seek_table(source)
            data = source.read_at(source.size(), 0)
        whole = zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read()
        assert len(whole) == sum(t[2] for t in table)
        seen += sum(1 for _ in warc.records(whole))
        assert b"".join(zstandard.ZstdDecompressor().decompress(data[s:s + n]) for s, n, _, _ in table) == whole
    assert seen == len(rows)


def test_damage_and_unfinished_attempts(spark):
    rows = sample()
    archive = warc.write(frame(spark, rows), workspace(spark, "warc"))
    files, path = fs.FileSystem.from_uri(archive.bundles)
    with files.open_output_stream(f"{path}/000000-lost-0.warc.zst", compression=None) as out:
        out.write(b"half a bundle")
    assert read(spark, archive) == plain(rows)
    damaged = warc._batch([(1, "u", "response", 3, "x", None, b"abc")])
    assert isinstance(damaged, pa.RecordBatch)
    one = warc.record(1, "u", b"abc", hashlib.sha1(b"abd").hexdigest(), None, False, "2024-01-01T00:00:00Z")
    with pytest.raises(ValueError):
        [warc._row(f, b) for f, b, _ in warc.records(one)]


def test_empty_table(spark):
    archive = warc.write(frame(spark, sample()).limit(0), workspace(spark, "warc"))
    assert read(spark, archive) == [] and archive.index(spark).count() == 0
