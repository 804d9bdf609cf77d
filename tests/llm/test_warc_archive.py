"""The archive against a plain reading of the contract, its exported files against a plain WARC reader."""

import glob
import hashlib
import re
from collections import Counter

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from courtview.llm import warc_archive as wa

SCHEMA = "page_id long, url string, html string, digest string, record long, salt int, payload string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "d", 1, 2, "p") for r in rows], SCHEMA).repartition(4)


def plain(rows, least=1000):
    """(page_id, bytes, sha1, type, refers_to) of each row, counted."""
    groups = {}
    for page_id, _, html in rows:
        groups.setdefault((html or "").encode(), []).append(page_id)
    out = Counter()
    for body, ids in groups.items():
        ids.sort(key=lambda i: (i is not None, i or 0))
        for k, page_id in enumerate(ids):
            last = len(body) < least or k == len(ids) - 1
            out[(page_id, len(body), hashlib.sha1(body).hexdigest(), "response" if last else "revisit", None if last else ids[-1])] += 1
    return out


def read_warc(data):
    """(headers, block) of each record, by Content-Length alone."""
    out, at = [], 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        first, *lines = data[at:end].decode().split("\r\n")
        assert first == "WARC/1.1"
        head = dict(x.split(": ", 1) for x in lines)
        start, n = end + 4, int(head["Content-Length"])
        assert data[start + n:start + n + 4] == b"\r\n\r\n"
        out.append((head, data[start:start + n]))
        at = start + n + 4
    return out


@pytest.fixture(scope="module")
def rows():
    big, edge, long = "é<p>page</p>\r\n\r\n" * 100, "x" * 999, "WARC/1.1\r\nContent-Length: 3\r\n\r\n" * 20_000
    out = [(i, f"http://a/{i}", big) for i in range(40)] + [(100 + i, "http://b/ é\r\nX: y", edge) for i in range(3)]
    out += [(110 + i, None, "y" * 1000) for i in range(3)] + [(120, "u", None), (121, "u", ""), (122, "u", None), (None, "u", big), (None, None, None), (None, "n", "z" * 1500), (None, "n", "z" * 1500)]
    return out + [(130, "l", long), (130, "l", long), (131, "l", long + "!"), (-5, "m", "w" * 2000), (-6, "m", "w" * 2000)]


def test_records_equal_a_plain_version(spark, rows, monkeypatch):
    got = Counter(tuple(r) for r in wa.archived_pages(frame(spark, rows)).collect())
    assert got == plain(rows)
    monkeypatch.setattr(wa, "MIN_SHARE", 2)  # the large groups are salted
    assert Counter(tuple(r) for r in wa.archived_pages(frame(spark, rows)).collect()) == got
    assert wa.archived_pages(frame(spark, [])).count() == 0


def test_payloads_are_kept_once_and_checked(spark, rows, tmp_path, monkeypatch):
    monkeypatch.setattr(wa, "MIN_SHARE", 5)
    path = str(tmp_path / "archive")
    wa.write_archive(frame(spark, rows), path)
    stored = spark.read.parquet(f"{path}/payloads")
    assert Counter(bytes(r.payload) for r in stored.collect()) == Counter({(h or "").encode() for _, _, h in rows})
    headers = spark.read.parquet(f"{path}/headers")
    assert headers.count() == len(rows) and headers.agg(F.max("salt")).first()[0] > 0
    other = str(tmp_path / "broken")
    headers.write.parquet(f"{other}/headers")
    stored.withColumn("payload", F.concat("payload", F.lit(b"!"))).write.parquet(f"{other}/payloads")
    with pytest.raises(PySparkException, match="does not have its digest"):
        wa.read_archive(spark, other).select("warc").collect()


def test_exported_files_are_warc(spark, rows, tmp_path):
    path, out = str(tmp_path / "archive"), str(tmp_path / "warc")
    wa.write_archive(frame(spark, rows), path)
    records = wa.read_archive(spark, path)
    wa.export_warc(records, out)
    found = [r for f in glob.glob(f"{out}/part-*") for r in read_warc(open(f, "rb").read())]
    assert len(found) == len(rows)
    by_id = {h["WARC-Record-ID"]: (h, b) for h, b in found}
    assert len(by_id) == len(rows) and all(re.fullmatch("<urn:uuid:[0-9a-f-]{36}>", i) for i in by_id)
    want = plain(rows)
    got = Counter()
    for head, block in found:
        whole = by_id[head["WARC-Refers-To"]][1] if head["WARC-Type"] == "revisit" else block
        http, body = whole.split(b"\r\n\r\n", 1)
        assert block.startswith(http) and f"Content-Length: {len(body)}".encode() in http
        assert head["WARC-Payload-Digest"] == "sha1:" + hashlib.sha1(body).hexdigest() and re.fullmatch("[!-~]+", head["WARC-Target-URI"])
        number = lambda c: int(head[c]) if c in head else None  # noqa: E731, B023
        got[(number("Page-ID"), len(body), hashlib.sha1(body).hexdigest(), head["WARC-Type"], number("Refers-To-Page-ID"))] += 1
    assert got == want
