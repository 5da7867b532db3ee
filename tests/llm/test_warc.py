import gzip
import hashlib
import zlib

import pytest

from recordflow.llm import warc
from recordflow.llm.common import filesystem

BIG = "<p>ü</p>" * 50
PAGES = [
    (5, "http://a/", BIG), (3, "http://b/", BIG), (9, None, BIG), (1, "http://c\r\nX: y/", ""), (2, "", ""), (4, "u", None),
    (6, "u", "x" * 99), (7, "u", "x" * 99), (8, "u", "y" * 100), (10, "u", "y" * 100), (11, "u", "WARC/1.1\r\n\r\n" * 30_000), (None, "u", "z" * 200),
    (3, "http://b/", BIG),
]


@pytest.fixture
def pages(spark):
    kinds = "page_id long, url string, html string, digest string, first long, size int"
    return spark.createDataFrame([(*p, "d", 1, 2) for p in PAGES], kinds)


def expected():
    out = []
    for page_id, _, html in PAGES:
        raw = (html or "").encode()
        same = [p for p, _, h in PAGES if (h or "") == (html or "") and p is not None]
        first = min(same, default=None)
        again = len(raw) >= 100 and first is not None and page_id != first
        out.append((page_id, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response", first if again else None))
    return sorted(out, key=repr)


def test_round_trip(pages):
    crawl = warc.write_monolithic(pages)
    members = warc.normalise(crawl)
    assert sorted(map(tuple, warc.read_pages(members).collect()), key=repr) == expected()
    for row in crawl.collect():
        whole = open(filesystem(row.file)[1], "rb").read()
        engine = zlib.decompressobj(31)
        engine.decompress(whole)
        assert engine.eof and not engine.unused_data  # one stream
    for row in members.collect():
        path = filesystem(row.file)[1]
        data, lines = open(path, "rb").read(), open(path + ".idx").read().splitlines()
        assert len(lines) == row.records and len(data) == row.bytes
        spans = [tuple(map(int, x.split("\t")[:2])) for x in lines]
        assert [a for a, _ in spans] == [sum(n for _, n in spans[:i]) for i in range(len(spans))]
        for a, n in spans:
            one = gzip.decompress(data[a : a + n])
            assert one.startswith(b"WARC/1.1\r\n") and one.endswith(b"\r\n\r\n")
            assert b"\r\nX: y" not in one.split(b"\r\n\r\n")[0]


def test_no_pages(pages):
    assert warc.read_pages(warc.normalise(warc.write_monolithic(pages.limit(0)))).collect() == []


def test_any_members_and_broken_archives(tmp_path):
    records = [warc.record(i, "u", b"p" * i * 1000, "d", None) for i in range(30)]
    source, target = str(tmp_path / "a.warc.gz"), str(tmp_path / "b.warc.gz")
    for cut in (1, 7, 30):
        open(source, "wb").write(b"".join(gzip.compress(b"".join(records[i : i + cut])) for i in range(0, 30, cut)))
        assert warc.normalise_file(source, target)[0] == 30
        assert [len(b) for _, b in warc.read_members(target)] == [len(r.split(b"\r\n\r\n", 1)[1]) - 4 for r in records]
    whole = gzip.compress(b"".join(records))
    for bad in (whole[:-20], gzip.compress(b"".join(records)[:-500]), gzip.compress(b"not a record\r\n\r\n")):
        open(source, "wb").write(bad)
        with pytest.raises(ValueError):
            warc.normalise_file(source, target)
