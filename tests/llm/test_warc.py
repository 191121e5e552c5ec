import base64
import hashlib
import struct

import pytest
import zstandard

from hirelens.llm import warc

PAGES = "page_id bigint, url string, html string, payload string, key string, id int, response int"


def pages_of(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", "y", 1, 2) for i, u, h in rows], PAGES)


def page(i):
    return f"<html><head><title>Page {i}</title></head><body>" + "".join(f"<p>line {i} {k}</p>" for k in range(40)) + "</body></html>"


@pytest.mark.parametrize("archive_bytes", [64 << 20, 20_000])
def test_round_trip(spark, tmp_path, archive_bytes):
    rows = [(i, f"http://a.example/{i}", page(i % 150)) for i in range(200)]
    files = warc.write_archives(pages_of(spark, rows).repartition(2), str(tmp_path), archive_bytes=archive_bytes)
    names = sorted(tmp_path.glob("*.warc.zst"))
    assert files == len(names) and (files == 2 or archive_bytes < 1 << 20)
    assert all(struct.unpack("<I", n.read_bytes()[:4])[0] == warc.DICTIONARY_MAGIC for n in names if n.stat().st_size > 9000)
    got = {r.page_id: r for r in warc.read_archives(spark, str(tmp_path)).collect()}
    assert len(got) == 200
    for i, url, html in rows:
        r = got[i]
        last = i + 150 if i + 150 < 200 else i
        assert (r.url, r.payload_bytes, r.payload_digest) == (
            url, len(html), base64.b32encode(hashlib.sha1(html.encode()).digest()).decode())
        assert (r.record_type, r.refers_to) == (("response", None) if last == i else ("revisit", last))
        assert r.payload == (html.encode() if last == i else None)


def test_archives_follow_the_formats():
    raw = [warc.record("response", i, f"http://a/{i}", page(i).encode(), None, "2000-01-01T00:00:00Z") for i in range(100)]
    archive = b"".join(warc.compressed(raw))
    magic, size = struct.unpack("<II", archive[:8])
    dictionary = zstandard.ZstdCompressionDict(archive[8 : 8 + size])
    assert magic == 0x184D2A5D and dictionary.dict_id()
    plain = zstandard.ZstdDecompressor(dict_data=dictionary)
    assert plain.decompress(archive[8 + size :], read_across_frames=False) == raw[0]
    assert list(warc.records_of(memoryview(archive))) == raw
    without = sum(len(zstandard.ZstdCompressor(level=3).compress(r)) for r in raw)
    assert len(archive) - size < without
    assert raw[0].startswith(b"WARC/1.1\r\nWARC-Type: response\r\n") and raw[0].endswith(b"\r\n\r\n")
    with pytest.raises(ValueError):
        list(warc.records_of(memoryview(archive[:-10])))
    with pytest.raises(ValueError):
        warc.parse(raw[0].replace(b"line 0 3", b"line 0 X"))


def test_odd_rows(spark, tmp_path):
    long = "<p>long</p>" * 300_000
    rows = [(1, None, None), (2, "u\r\nX: y", ""), (3, "http://ü/日本", "a\r\n\r\nb"), (4, "u", "same"), (5, "u", "same"),
            (5, "u", "same"), (None, "u", "same"), (None, "u", "alone"), (None, "v", "alone"), (6, "u", long), (7, "v", long),
            (8, "u", "nul \x00 ünïcode")]
    frame = pages_of(spark, rows)
    warc.write_archives(frame, str(tmp_path / "all"))
    back = warc.read_archives(spark, str(tmp_path / "all"))
    got = [(r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in back.collect()]
    n = lambda t: len((t or "").encode())
    refers = [2, None, None, 5, None, None, 5, None, None, 7, None, None]
    want = [(i, n(h), "revisit" if to else "response", to) for (i, _, h), to in zip(rows, refers)]
    assert sorted(got, key=str) == sorted(want, key=str)
    urls = {r.page_id: r.url for r in back.collect()}
    assert urls[1] is None and urls[2] == "u%0D%0AX:%20y" and urls[3] == "http://ü/日本"
    warc.write_archives(frame, str(tmp_path / "some"), min_bytes=5)
    some = {(r.page_id, r.record_type) for r in warc.read_archives(spark, str(tmp_path / "some")).collect()}
    assert (4, "response") in some and (6, "revisit") in some and (1, "response") in some
    assert warc.write_archives(frame.limit(0), str(tmp_path / "none")) == 0
    assert warc.read_archives(spark, str(tmp_path / "none")).count() == 0


def test_many_repeated_payloads_meet_by_a_shuffle(spark, tmp_path, monkeypatch):
    rows = [(i, f"u{i}", page(i % 7) if i % 3 else None) for i in range(60)]
    warc.write_archives(pages_of(spark, rows), str(tmp_path / "a"))
    monkeypatch.setattr(warc, "fits_broadcast", lambda df: False)
    plan = warc.marked_pages(pages_of(spark, rows))._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" not in plan
    warc.write_archives(pages_of(spark, rows), str(tmp_path / "b"), archive_bytes=9000)
    one, other = (warc.read_archives(spark, str(tmp_path / n)).orderBy("page_id").collect() for n in "ab")
    assert one == other and len(one) == 60


def test_other_column_names(spark, tmp_path):
    frame = spark.createDataFrame([(1, "u", "h")], "a bigint, b string, c string")
    warc.write_archives(frame, str(tmp_path / "x"), id_col="a", url_col="b", html_col="c")
    assert warc.read_archives(spark, str(tmp_path / "x"), payloads=False).first() == (
        1, "u", 1, base64.b32encode(hashlib.sha1(b"h").digest()).decode(), "response", None, None)
