"""WARC archives: exact round trips, repeated payloads, splits at every place, damage."""

import gzip
import hashlib
import io
import random

import pyarrow as pa
import pytest

from plume.llm import warc
from plume.llm.queries import QUERIES
from plume.session import scratch_path

PAGES = "page_id long, url string, html string"


def plain(rows):
    """Sorted (page_id, bytes, digest, type, refers_to) by looking at all pages."""
    raws = [(p, (h or "").encode()) for p, _, h in rows]
    out = []
    for p, raw in raws:
        ids = [q for q, other in raws if other == raw and q is not None]
        low = min(ids) if ids and len(raw) >= 100 else None
        revisit = low is not None and p != low
        out.append((p, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if revisit else "response",
                    low if revisit else None))
    return sorted(out, key=str)


def result(df):
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect()),
                  key=str)


def messy_pages():
    rnd = random.Random(3)
    long_one = "".join(rnd.choice("abc <>\né漢") for _ in range(6_000))
    rows = [(i, f"http://h/{i}", rnd.choice(["<p>" + "x" * k + "</p>" for k in (0, 50, 93, 94, 500)])) for i in range(60)]
    rows += [(100, None, None), (101, "u", ""), (None, "u", "y" * 200), (102, "u", "y" * 200), (None, None, "z" * 200),
             (None, "u", "z" * 200), (103, "a\r\nWARC-Type: evil", "w" * 150), (103, "b", "w" * 150), (99, "c", "w" * 149),
             (104, "u", long_one), (105, "u", long_one), (-7, "u", long_one), (106, "漢", "\x1f\r\n\r\nWARC/1.1\r\n")]
    return rows


@pytest.mark.parametrize("split,most", [(150, 200_000), (1000, 0), (1 << 20, 200_000)])
def test_round_trip_at_any_split(spark, monkeypatch, split, most):
    monkeypatch.setattr(warc, "MAX_BROADCAST_ROWS", most)  # 0: the salted join
    rows = messy_pages()
    df = spark.createDataFrame([(*r, "x", "d") for r in rows], PAGES + ", d string, refers_to string")
    assert result(warc.archive_and_read(df.repartition(3), split)) == plain(rows)


def test_registered_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.page_id, r.url, r.html) for r in spark.read.parquet(f"{sf}/pages.parquet").collect()]
    assert result(QUERIES["op11_warc"](spark, sf)) == plain(rows)


def test_payloads_come_back_whole_and_files_are_cut(spark):
    rows = [(i, f"u{i}", f"page {i} " * (i + 1)) for i in range(40)]
    df = spark.createDataFrame(rows, PAGES)
    manifest = warc.write_warc(df, scratch_path(spark, "t"), archive_bytes=2000)
    assert manifest.count() > 4 and manifest.agg({"records": "sum"}).first()[0] == 40
    got = warc.read_warc(manifest, 700).where("record_type = 'response'").collect()
    assert sorted((r.record_id, r.url, bytes(r.payload).decode()) for r in got) == \
        sorted((f"<urn:x-page:{i}>", u, h) for i, u, h in rows)
    for r in manifest.collect():  # a plain gzip reader sees whole records one after the other
        with open(r.path.replace("file:", "", 1), "rb") as f:
            text = gzip.decompress(f.read())
        assert text.count(b"WARC/1.1\r\nWARC-Type: ") == r.records + 1


def test_empty_table(spark):
    assert warc.archive_and_read(spark.createDataFrame([], PAGES)).count() == 0


def ranges(raw, size, step):
    file = pa.PythonFile(io.BytesIO(raw), "r")
    return [x for start in range(0, size, step) for x in warc.records(file, size, start, min(size, start + step))]


@pytest.mark.parametrize("step", [1, 37, 10_000])
def test_each_record_has_one_owner(step):
    members = []
    for i in range(9):
        payload = bytes(random.Random(i).choices(range(256), k=300))
        members.append(warc.page_record(i, "u", payload, hashlib.sha256(payload).hexdigest(), None))
    raw = b"".join(members)
    got = ranges(raw, len(raw), step)
    assert [r["record_id"] for r in got] == [f"<urn:x-page:{i}>" for i in range(9)]
    assert [r["offset"] for r in got] == [sum(map(len, members[:i])) for i in range(9)]


def test_damage_is_told_and_passed(spark):
    p = b"some payload " * 40
    good = [warc.page_record(i, "u", p, hashlib.sha256(p).hexdigest(), None) for i in range(4)]
    bad_sum = good[1][:-6] + bytes(2) + good[1][-4:]
    wrong_digest = warc.page_record(2, "u", p, "0" * 64, None)
    noise = b"\x1f\x8b\x08\x00" + b"q" * 30 + b"\x1f\x8b\x08\xff" + gzip.compress(b"not a record")
    raw = good[0] + bad_sum + noise + wrong_digest + good[3] + good[1][:-9]
    for step in (50, 100_000):
        got = ranges(raw, len(raw), step)
        assert [(r["record_type"], r.get("record_id")) for r in got] == [
            ("response", "<urn:x-page:0>"), ("damaged", None), ("damaged", None), ("response", "<urn:x-page:3>"),
            ("damaged", None)]
