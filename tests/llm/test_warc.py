import zstandard

from viagrid.llm import warc

ODD = [
    (1, "http://a", "x"), (2, None, "x"), (3, "http://b\nX: y é", ""), (4, "u", None), (5, "u", "WARC/1.1\r\n\r\né" * 900), (6, "u", "x"), (None, "u", "x"),
    (6, "u", "x"), (None, "u", "alone"), (8, "u", "y" * 300_000),
]


def pages(spark):
    from pyspark.sql import functions as F

    return spark.createDataFrame(ODD, "page_id long, url string, html string").withColumns({"file": F.lit(1), "first": F.lit("z"), "payload": F.lit(None).cast("string")})


def test_round_trip(spark, monkeypatch):
    index = warc.write_archives(pages(spark))
    found = warc.read_archives(index).collect()
    assert len(found) == len(ODD)
    want = []
    for page, _, html in ODD:
        payload = (html or "").encode()
        first = max((p for p, _, h in ODD if (h or "").encode() == payload and p is not None), default=None)
        other = first if page != first else None
        want.append((page, len(payload), warc.digest(payload), "response" if other is None else "revisit", other))
    assert sorted(map(tuple, found), key=repr) == sorted(want, key=repr)


def test_files_are_plain_seekable_zstandard(spark):
    rows = warc.write_archives(pages(spark)).collect()
    for name in {r.file for r in rows}:
        own = [r for r in rows if r.file == name]
        with warc.opened(name) as file:
            raw = file.read()
        whole = zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True).read()
        assert whole.count(b"WARC/1.1\r\nWARC-Type") == len(own)
        assert len(whole) == sum(r.length for r in own)
        archive = warc.Archive(name)
        for r in reversed(own):
            assert warc.parsed(archive.read(r.frame, r.offset, r.length))["page_id"] == r.page_id


def test_many_frames(tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "FRAME_BYTES", 2_000)
    bundle = warc.Bundle(f"{tmp_path}/x.warc.zst")
    for k in range(50):
        bundle.add(k, warc.record(k, "http://x", b"p" * k * 20, None))
    rows = bundle.close()
    archive = warc.Archive(f"{tmp_path}/x.warc.zst")
    assert len(archive.places) > 5
    assert [warc.parsed(archive.read(*r[2:]))["payload_bytes"] for r in rows] == [k * 20 for k in range(50)]


def test_least_bytes_and_no_rows(spark):
    kinds = {r.record_type for r in warc.read_archives(warc.write_archives(pages(spark), 2)).where("page_id = 1 or page_id = 3").collect()}
    assert kinds == {"response"}
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.read_archives(warc.write_archives(none)).count() == 0


def test_equals_sql(same_as_sql):
    same_as_sql("op5_seekable_archives")
