import base64
import gzip
import hashlib
import io

import pytest

from benefacta.llm import warc
from benefacta.session import fresh_path
from .conftest import ODD

SCHEMA = "page_id long, url string, html string"


def expected(rows, least=0):
    payloads = {}
    for page, _, html in rows:
        payloads.setdefault((html or "").encode(), []).append(page)
    out = []
    for page, _, html in rows:
        body = (html or "").encode()
        known = [p for p in payloads[body] if p is not None]
        first = min(known) if known else None
        response = page == first or len(body) < least
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        out.append((page, len(body), digest, "response" if response else "revisit", None if response else first))
    return sorted(out, key=str)


def got(records):
    assert all(r["intact"] for r in records)
    return sorted([(r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in records], key=str)


@pytest.mark.parametrize("range_bytes,least", [(8 << 20, 0), (40, 0), (700, 4)])
def test_round_trip(frame, range_bytes, least):
    rows = [(i, f"http://x/{i}", t) for i, t in enumerate(ODD + ODD + ["<p>é\r\n\r\nWARC/1.1\r\n</p>", "\x1f\u008b\x08 not gzip"])]
    rows += [(3, "http://again", "a"), (3, "http://again", "a"), (None, None, "a"), (None, "bad url\r\nWARC-Type: x", "only here")]
    records = warc.round_trip(frame(rows, SCHEMA), least, range_bytes).collect()
    assert got(records) == expected(rows, least)
    texts = {(r["page_id"], r["payload"].decode()) for r in records if r["record_type"] == "response"}
    assert texts == {(p, h or "") for p, _, h in rows if (p, len((h or "").encode())) in {(e[0], e[1]) for e in expected(rows, least) if e[3] == "response"}}
    assert {r["url"] for r in records if r["page_id"] is None} == {None, "bad%20url%0D%0AWARC-Type:%20x"}


def test_members_are_plain_gzip_and_hold_the_records(frame, spark):
    rows = [(i, "u", f"page {i % 3}") for i in range(9)]
    manifest = warc.write_archive(frame(rows, SCHEMA), fresh_path(spark, "warc-test")).collect()
    assert sum(m["records"] for m in manifest) == 9
    heads = []
    for m in manifest:
        store, path = warc.open_store(m["path"])
        data = store.open_input_file(path).read()
        assert len(data) == m["bytes"]
        plain = gzip.GzipFile(fileobj=io.BytesIO(data)).read()
        heads += [h for h, _ in warc.parse(plain)]
    assert len(heads) == 9 and all(h["warc-date"] == warc.DATE for h in heads)
    assert sorted(h["warc-type"] for h in heads) == ["response"] * 3 + ["revisit"] * 6


@pytest.mark.parametrize("step", [1, 7, 64, 1000])
def test_every_split_gives_every_record_once(step):
    stored = warc.member(b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n", level=0)
    bodies = [b"x" * n for n in (0, 1, 50)] + [warc.MAGIC * 20, stored]
    parts = [warc.member(warc.record(i, None, b, "D", None), level=i % 3) for i, b in enumerate(bodies)]
    parts.insert(2, b"junk \x1f\x8b\x08 between" + warc.member(b"no warc in here"))
    data = b"".join(parts) + parts[0][:-9]  # the last member breaks off
    seen = []
    for start in range(0, len(data), step):
        seen += list(warc.read_range(io.BytesIO(data), len(data), start, min(start + step, len(data))))
    payloads = [block.partition(warc.END)[2] for _, headers, block in seen if "warc-record-id" in headers]
    assert sorted(payloads) == sorted(bodies)


@pytest.mark.parametrize("range_bytes", [8 << 20, 50_000])
def test_headers_of_any_length(frame, rng, range_bytes):
    urls = ["http://x/" + "".join(rng.choices("abcdefghijklmnop", k=n)) for n in (40_000, 70_000, 140_000, 400_000)]
    urls += ["http://x/" + " " * 200_000, "http://x/" + "é" * 300_000]
    rows = [(i, u, f"page {i % 4}") for i, u in enumerate(urls)] + [(90, "http://x/", "page 2")]
    records = warc.round_trip(frame(rows, SCHEMA), 0, range_bytes).collect()
    assert got(records) == expected(rows)
    assert {r["page_id"]: r["url"] for r in records} == {p: u.replace(" ", "%20") for p, u, _ in rows}


def test_empty_table(frame):
    assert warc.round_trip(frame([], SCHEMA)).count() == 0
