from __future__ import annotations

import glob
import hashlib
import io

import pytest
import zstandard

from tidewater.llm import warc
from tidewater.session import fresh_path


def brute(rows):
    out = []
    for page, _, html in rows:
        data = (html or "").encode()
        same = [p for p, _, h in rows if (h or "").encode() == data and p is not None]
        stands = max(same) if len(data) >= 1000 and same and sum((h or "").encode() == data for *_, h in rows) > 1 else None
        revisit = stands is not None and page != stands
        out.append((page, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", stands if revisit else None))
    return sorted(out, key=repr)


ROWS = [
    (1, "http://a/", "<p>ä</p>" * 300), (2, "http://b/\r\nX: y", "<p>ä</p>" * 300), (9, None, "<p>ä</p>" * 300),
    (3, "http://c/", "short"), (4, "http://c/", "short"), (5, "", None), (6, "ü?q=%", ""), (7, "x", "\r\n\r\nWARC/1.1" * 200),
    (8, "x", "z" * 3_000_000), (None, "n", "q" * 1000), (10, "n", "q" * 1000), (11, "r", "r" * 1000), (11, "r", "r" * 1000),
    *[(20 + i, f"http://s/{i}", f"<html><body>page {i} of the same site</body></html>" * 5) for i in range(60)],
]


def test_round_trip(spark):
    pages = spark.createDataFrame([(*r, "x") for r in ROWS], "page_id long, url string, html string, digest string")
    archives = warc.archived(pages, archive_bytes=1 << 20)
    read = warc.read(archives).collect()
    got = sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in read), key=repr)
    assert got == brute(ROWS)
    html = {}
    for p, u, h in ROWS:
        html.setdefault(p, []).append((u or "", (h or "").encode()))
    for r in read:
        assert (r["url"], bytes(r["payload"]) if r["payload"] is not None else html[r["page_id"]][0][1]) in html[r["page_id"]]


def test_every_record_stands_alone_behind_the_dictionary(spark):
    pages = spark.createDataFrame(ROWS, "page_id long, url string, html string")
    folder = "file://" + fresh_path(spark, "warc-test").removeprefix("file://").removeprefix("file:")
    rows = warc.write(warc.marked(pages).coalesce(1), folder).collect()
    names = glob.glob(folder.removeprefix("file://") + "/*.warc.zst")
    assert sorted(r["path"].removeprefix("file://") for r in rows) == sorted(names)
    assert sum(r["n_records"] for r in rows) == len(ROWS)
    data = open(names[0], "rb").read()
    size = int.from_bytes(data[4:8], "little")
    assert int.from_bytes(data[:4], "little") == warc.SKIPPABLE and size > 0
    frames = data[8 + size :].split(warc.FRAME)
    own = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data[8 : 8 + size]))
    assert own.decompressobj().decompress(warc.FRAME + frames[-1]).startswith(b"WARC/1.1\r\n")


def test_broken_archives_are_refused():
    data = warc.archive([warc.record(1, "u", b"payload" * 100, None)])
    assert len(list(warc.read_archive(io.BytesIO(data)))) == 1
    with pytest.raises(ValueError):
        list(warc.read_archive(io.BytesIO(data[:-3])))
    with pytest.raises(ValueError):
        list(warc.read_archive(io.BytesIO(data[1:])))


def test_empty_table(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.read(warc.archived(pages)).count() == 0


def test_a_damaged_payload_is_refused():
    data = warc.record(1, "http://a/", b"payload " * 10, None)
    read = warc.parse(data)
    assert (read["payload_bytes"], read["payload_digest"]) == (80, hashlib.sha1(b"payload " * 10).hexdigest())
    head, _, tail = data.rpartition(b"payload ")
    for damaged in (head + b"pAyload " + tail, head[:-8]):
        with pytest.raises(ValueError, match="urn:page:1"):
            warc.parse(damaged)
    revisit = warc.parse(warc.record(2, "http://a/", b"payload " * 10, 1))
    assert (revisit["payload_bytes"], revisit["payload_digest"], revisit["payload"]) == (80, read["payload_digest"], None)
