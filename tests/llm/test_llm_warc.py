"""WARC round trips, revisits and salvage of damaged archives."""

from __future__ import annotations

import base64
import hashlib
import io
import random
import zlib
from collections import Counter

import pytest
from pyspark.errors import PySparkException

from propgraph.llm import warc

HTML = ["<p>one</p>", "<p>one</p>", "<p>two é</p>", "", None, "<p>two é</p>", "WARC/1.1\r\n\r\n\x1f\x8b\x08",
        "big " * 300_000]


def digest(p: bytes) -> str:
    return base64.b32encode(hashlib.sha1(p).digest()).decode()


def slow_plan(rows, min_bytes=0):
    top: dict[bytes, int | None] = {}
    for page, html in rows:
        p = (html or "").encode()
        if len(p) >= min_bytes and page is not None:
            top[p] = max(top.get(p) if top.get(p) is not None else page, page)
    out = []
    for page, html in rows:
        p = (html or "").encode()
        first = top.get(p)
        visit = first is not None and page != first
        out.append((page, len(p), digest(p), "revisit" if visit else "response", first if visit else None))
    return Counter(out)


def read_back(spark, files):
    rows = warc.read_warc(files).collect()
    num = lambda u: int(u[9:]) if u and u[9:] else None
    recs = Counter((num(r.page_uri), r.payload_bytes, r.payload_digest, r.record_type, num(r.refers_to_uri))
                   for r in rows if r.record_type)
    return recs, rows


@pytest.mark.parametrize("min_bytes", [0, 11])
def test_round_trip(spark, tmp_path, min_bytes):
    r = random.Random(1)
    rows = [(i, f"http://h/{i}\r\nX: y", r.choice(HTML), "clash") for i in range(80)]
    rows += [(None, None, "<p>one</p>", ""), (None, "u", "alone", ""), (79, rows[79][1], rows[79][2], "")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string, path string").repartition(3)
    manifest = warc.write_warc(df, str(tmp_path), min_bytes=min_bytes, file_bytes=4000)
    assert manifest.count() > 3
    recs, back = read_back(spark, manifest)
    assert recs == slow_plan([(p, h) for p, _, h, _ in rows], min_bytes)
    assert not [x for x in back if x.gap_begin is not None]
    texts = {p: (h or "").encode() for p, _, h, _ in rows}
    for x in back:
        if x.record_type == "response" and x.page_uri != "urn:page:":
            assert bytes(x.payload) == texts[int(x.page_uri[9:])]


def test_empty_and_hot_payload(spark, tmp_path):
    df = spark.createDataFrame([], "page_id bigint, url string, html string")
    m = warc.write_warc(df, str(tmp_path / "none"))
    assert m.count() == 0 and warc.read_warc(m).count() == 0
    rows = [(i, "u", "<p>same</p>" if i % 3 else f"<p>{i}</p>") for i in range(1200)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    recs, _ = read_back(spark, warc.write_warc(df, str(tmp_path / "hot")))
    assert recs == slow_plan([(p, h) for p, _, h in rows])


def members(n, gz=True, seed=0):
    r = random.Random(seed)
    out = []
    for i in range(n):
        p = bytes(r.randrange(256) for _ in range(r.choice([0, 5, 300, 4000])))
        raw = warc.build_record(i, f"http://h/{i}", p, len(p), digest(p))
        if gz:
            z = zlib.compressobj(1, zlib.DEFLATED, 31)
            raw = z.compress(raw) + z.flush()
        out.append(raw)
    return out


def salvaged(data: bytes, step: int = 1 << 18):
    items = list(warc.salvage(io.BytesIO(data).read, step))
    recs = [(o, int(x.headers["warc-page-id"][9:])) for o, x in (i for i in items if isinstance(i, tuple))]
    return recs, [i for i in items if isinstance(i, warc.Gap)]


@pytest.mark.parametrize("gz", [True, False])
@pytest.mark.parametrize("step", [64, 1000, 1 << 18])
def test_salvage_finds_everything_undamaged(gz, step):
    r = random.Random(9)
    for trial in range(12):
        parts = members(12, gz, trial)
        starts = [sum(map(len, parts[:i])) for i in range(12)]
        bad = set(r.sample(range(12), r.choice([0, 1, 3, 12])))
        hurt = list(parts)
        for i in bad:
            p = bytearray(parts[i])
            kind = r.choice(["flip", "cut", "zero", "junk"])
            if kind == "flip":
                p[r.randrange(20, len(p) - 10)] ^= 0xFF
            elif kind == "cut":
                p = p[:len(p) // 2]
            elif kind == "zero":
                p = bytearray(len(p))
            else:
                p = bytearray(r.randrange(256) for _ in range(50)) + warc._MAGIC + b"WARC/1.0"
            hurt[i] = bytes(p)
        data = b"".join(hurt)
        at = [sum(map(len, hurt[:i])) for i in range(12)]
        recs, gaps = salvaged(data, step)
        found = {n: o for o, n in recs}
        for i in range(12):
            if i not in bad:
                assert found[i] == at[i], (trial, i)
        # records and gaps tile the file
        # (a flipped byte in a plain header may leave a valid record, so sizes go by offset)
        covered = sorted([(o, o + len(hurt[at.index(o)])) for o, _ in recs] + [(g.begin, g.end) for g in gaps])
        assert all(a[1] == b[0] for a, b in zip(covered, covered[1:]))
        assert not data or (covered[0][0], covered[-1][1]) == (0, len(data))
        assert starts[0] == 0


def test_salvage_checks():
    good = members(1, gz=False)[0]
    for hurt, why in ((good.replace(b"WARC-Block-Digest: sha1:", b"WARC-Block-Digest: sha1:A"), "digest"),
                      (good.replace(b"Content-Length: ", b"Content-Length: 9"), "cut off"),
                      (good.replace(b"\r\nContent-Length: ", b"\r\nContent-Size: ", 1), "missing"),
                      (good.replace(b"WARC-Date: ", b"WARC-Type: "), "repeated"), (good.replace(b"WARC/1.1", b"WARC/1", 1), "version"),
                      (good.replace(b"WARC-Date: ", b"WARC-Date\x00: "), "header line"),
                      (good[:-1] + b"x", "record end"), (b"garbage", "version")):
        recs, gaps = salvaged(hurt + b"")
        assert not recs and len(gaps) == 1 and why in gaps[0].reason, (why, gaps)
    assert salvaged(b"") == ([], [])
    huge = good.replace(b"Content-Type: application/http;msgtype=response\r\nContent-Length: ",
                        b"Content-Type: application/http;msgtype=response\r\nContent-Length: 99999999999")
    recs, gaps = salvaged(huge + good)
    assert [n for _, n in recs] == [0] and "range" in gaps[0].reason


def test_read_reports_gaps(spark, tmp_path):
    parts = members(5)
    (tmp_path / "a.warc.gz").write_bytes(parts[0] + b"\x00" * 40 + parts[1] + parts[2][:30] + parts[3])
    (tmp_path / "b.warc").write_bytes(b"not a warc")
    (tmp_path / "c.warc").write_bytes(b"")
    files = spark.createDataFrame([(str(tmp_path / n),) for n in ("a.warc.gz", "b.warc", "c.warc")], "path string")
    recs, rows = read_back(spark, files)
    assert sorted(k[0] for k in recs) == [0, 1, 3]
    gaps = sorted((x.path[-9:], x.gap_end - x.gap_begin) for x in rows if x.gap_begin is not None)
    assert sorted(g[1] for g in gaps) == [10, 30, 40]


def gzipped(raw: bytes) -> bytes:
    z = zlib.compressobj(1, zlib.DEFLATED, 31)
    return z.compress(raw) + z.flush()


def test_every_control_character_and_long_urls_come_back(spark, tmp_path):
    rows = [(i, f"http://h/{chr(i)}/x{chr(i)}", f"<p>{i % 7}</p>") for i in range(0x21)]
    rows += [(100, "http://h/" + "long" * 50_000, "<p>long</p>"), (101, "\x7f\x85\u2028", "x"), (102, "\r\n\r\nWARC/1.1\r\n", "y")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(2)
    back = warc.round_trip(spark, df, str(tmp_path / "a")).collect()
    assert sorted(int(r.page_uri[9:]) for r in back) == sorted(p for p, _, _ in rows)
    urls = {int(r.page_uri[9:]): r.target_uri for r in back}
    assert urls[11] == "http://h/ /x" and urls[100] == rows[33][1]
    # the same records without compression: a header over 64 KiB is read as well
    raw = b"".join(warc.build_record(p, u, h.encode(), len(h), digest(h.encode())) for p, u, h in rows)
    for step in (1000, 1 << 18):
        recs, gaps = salvaged(raw, step)
        assert [n for _, n in recs] == [p for p, _, _ in rows] and not gaps


def test_members_of_many_records():
    parts = members(6, gz=False)
    whole = gzipped(b"".join(parts[:3])) + gzipped(parts[3]) + gzipped(b"".join(parts[4:]))
    for step in (64, 1 << 18):
        recs, gaps = salvaged(whole, step)
        assert [n for _, n in recs] == [0, 1, 2, 3, 4, 5] and not gaps
        assert len({o for o, _ in recs}) == 3
    hurt = bytearray(parts[1])
    hurt[-8] ^= 0xFF
    for bad in (bytes(hurt), parts[1][:50], b"junk"):
        recs, gaps = salvaged(gzipped(parts[0] + bad + parts[2]) + gzipped(parts[3]))
        assert [n for _, n in recs] == [0, 2, 3] and len(gaps) == 1 and "inside a member" in gaps[0].reason
    recs, gaps = salvaged(gzipped(bytes(hurt)) + gzipped(parts[3]))
    assert [n for _, n in recs] == [3] and len(gaps) == 1


def test_folded_header_lines():
    raw = members(2, gz=False)
    folded = raw[0].replace(b"WARC-Target-URI: http://h/0", b"WARC-Target-URI: http://h/0\r\n \t?more\r\n\tand more")
    items = list(warc.salvage(io.BytesIO(folded + gzipped(folded) + raw[1]).read))
    assert [x.headers["warc-target-uri"] for _, x in items] == ["http://h/0 ?more and more"] * 2 + ["http://h/1"]


def test_what_could_not_be_read_back_stops_the_writer(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "MAX_RECORD", 1000)
    with pytest.raises(ValueError, match="could not be read back"):
        warc.build_record(1, "u", b"x" * 2000, 2000, "d")
    monkeypatch.setattr(warc, "MAX_HEADER", 500)
    with pytest.raises(ValueError, match="could not be read back"):
        warc.build_record(1, "u" * 600, b"x", 1, "d")


def test_a_lost_record_is_an_error(spark, tmp_path):
    df = spark.createDataFrame([(i, "u", f"<p>{i}</p>") for i in range(20)], "page_id bigint, url string, html string").coalesce(1)
    manifest = warc.write_warc(df, str(tmp_path))
    path = manifest.first().path.replace("file:", "")
    data = open(path, "rb").read()
    last = data.rfind(warc._MAGIC)
    open(path, "wb").write(data[:last])            # the archive ends early, at a member's end
    rows = warc.read_warc(manifest).collect()
    assert [r.gap_reason for r in rows if r.gap_reason] == ["19 of 20 records"]
    assert len([r for r in rows if r.record_type]) == 19


def test_round_trip_stops_on_a_gap(spark, tmp_path, monkeypatch):
    df = spark.createDataFrame([(1, "u", "x")], "page_id bigint, url string, html string")
    write = warc.write_warc

    def damaged(pages, folder, **kw):
        manifest = write(pages, folder, **kw)
        path = manifest.first().path.replace("file:", "")
        open(path, "ab").write(b"rubbish")
        return manifest

    monkeypatch.setattr(warc, "write_warc", damaged)
    with pytest.raises(PySparkException, match="gap in"):
        warc.round_trip(spark, df, str(tmp_path)).collect()
