"""Archives: exact round trips at any cut, members that only look like records, damage, and the query's contract."""

from __future__ import annotations

import base64
import gzip
import hashlib
import os
import random
import uuid

import pytest
from pyspark.sql import functions as F

from plumbline.llm import warc
from plumbline.llm.queries import op12_warc

SCHEMA = "page_id long, url string, html string"
PAGES = [
    *[(i, f"http://a/{i}", f"<p>{'x' * (i % 6)}é</p>") for i in range(30)],
    (100, None, None), (101, "http://b/ c\n", ""), (102, "u", "big " * 50_000), (None, "n", "<p>xé</p>"),
    (None, "m", "alone"), (7, "http://a/7", "<p>xé</p>"), (25, "again", "<p>xé</p>"), (25, "again", "<p>xé</p>"),
]


def expected(rows, min_bytes=0):
    out = []
    for key, _, html in rows:
        payload = (html or "").encode()
        same = [k for k, _, h in rows if (h or "").encode() == payload and k is not None]
        top = max(same, default=None)
        refers = top if len(payload) >= min_bytes and top is not None and key != top else None
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        out.append((key, len(payload), digest, "response" if refers is None else "revisit", refers))
    return sorted(out, key=str)


def read(found):
    return sorted(
        (
            (None if r.key is None else int(r.key), r.payload_bytes, r.payload_digest, r.record_type,
             None if r.refers_to_key is None else int(r.refers_to_key))
            for r in found.collect()
        ),
        key=str,
    )


@pytest.mark.parametrize("kwargs", [{}, {"sent": 0}, {"min_bytes": 8}, {"file_bytes": 500}])
def test_round_trip(spark, tmp_path, kwargs):
    pages = spark.createDataFrame(PAGES, SCHEMA).withColumn("key", F.lit(1)).withColumn("payload", F.lit("p"))
    manifest = warc.write_archives(pages, folder=str(tmp_path / "w"), **kwargs)
    assert manifest.agg(F.sum("records")).first()[0] == len(PAGES)
    for size in (1 << 20, 97):
        found = warc.read_archives(spark, manifest, range_bytes=size)
        assert read(found) == expected(PAGES, kwargs.get("min_bytes", 0))
    texts = {(r.key, r.payload_digest): r.payload for r in found.where("record_type = 'response'").collect()}
    assert all(warc.digest_of(bytes(p)) == d for (_, d), p in texts.items())
    listed = warc.list_archives(spark, str(tmp_path / "w"))
    assert listed.agg(F.sum("bytes")).first()[0] == manifest.agg(F.sum("bytes")).first()[0]


def test_standard_tools_can_read_the_files(spark, tmp_path):
    manifest = warc.write_archives(spark.createDataFrame(PAGES, SCHEMA), folder=str(tmp_path / "w"))
    data = b"".join(gzip.open(r.path.removeprefix("file:"), "rb").read() for r in manifest.collect())
    assert data.count(b"WARC/1.1\r\n") == len(PAGES)
    assert b"WARC-Target-URI: http://b/%20c%0A\r\n" in data and b"WARC-Target-URI: about:blank\r\n" in data
    refers = {x.split(b"\r\n")[0] for x in data.split(b"WARC-Refers-To: ")[1:]}
    ids = {x.split(b"\r\n")[0] for x in data.split(b"WARC-Record-ID: ")[1:]}
    assert refers <= ids and all(uuid.UUID(i[10:-1].decode()) for i in ids)


def archive(path, payloads, stored=False):
    """An archive of responses; where stored, members hold their content uncompressed."""
    at = []
    with open(path, "wb") as out:
        for i, p in enumerate(payloads):
            at.append(out.tell())
            data = warc.record(str(i), "u", p, None, "2020-01-01T00:00:00Z")
            out.write(gzip.compress(data, 0 if stored else 6))
    return at


def test_members_inside_payloads_are_no_records(spark, tmp_path):
    rng = random.Random(5)
    inner = str(tmp_path / "inner.warc.gz")
    archive(inner, [b"inner %d" % i for i in range(4)])
    inside = open(inner, "rb").read()
    payloads = [rng.randbytes(rng.choice([3, 200, 900])) + rng.choice([b"", inside, warc.MAGIC * 3]) for _ in range(12)]
    path = str(tmp_path / "outer.warc.gz")
    at = archive(path, payloads, stored=True)
    size = os.path.getsize(path)
    assert len(inside) < 1500  # longer ranges are not deceived
    for cut in (1500, 2048, 5000, size):
        owned = [x for b in range(0, size, cut) for x in warc.Members(path).owned(b, b + cut, False)]
        assert [a for a, _ in owned] == at
        assert [warc.parsed(d)["payload"] for _, d in owned] == payloads


def test_damage_is_reported_or_skipped(spark, tmp_path):
    path = str(tmp_path / "d.warc.gz")
    at = archive(path, [b"page %d " % i * 40 for i in range(8)])
    data = bytearray(open(path, "rb").read())
    data[at[3] + 40 : at[3] + 60] = b"\0" * 20
    open(path, "wb").write(data[:-5])
    files = warc.list_archives(spark, str(tmp_path))
    for cut in (50, 1 << 20):
        with pytest.raises(Exception, match="is damaged at"):
            warc.read_archives(spark, files, range_bytes=cut).collect()
        found = warc.read_archives(spark, files, range_bytes=cut, on_damage="skip").orderBy("offset").collect()
        good = [r for r in found if r.record_type == "response"]
        assert [r.key for r in good] == ["0", "1", "2", "4", "5", "6"]
        assert {r.offset for r in found if r.record_type == "damaged"} == {at[3], at[7]}


def test_empty_table_and_bad_bytes(spark, tmp_path):
    none = warc.write_archives(spark.createDataFrame([], SCHEMA), folder=str(tmp_path / "e"))
    assert warc.read_archives(spark, none).count() == 0
    bad = spark.sql("SELECT 'k k/1' AS page_id, 'u' AS url, CAST(unhex('61FF62') AS STRING) AS html")
    row = warc.read_archives(spark, warc.write_archives(bad, folder=str(tmp_path / "b"))).first()
    assert (row.key, bytes(row.payload), row.payload_bytes) == ("k k/1", b"a\xffb", 3)


def test_query_on_edge_cases(spark, tmp_path):
    spark.createDataFrame(PAGES, SCHEMA).write.parquet(f"{tmp_path}/pages.parquet")
    assert sorted((tuple(r) for r in op12_warc(spark, str(tmp_path)).collect()), key=str) == expected(PAGES)
