"""WARC archives and index: round trip, revisits, lookups."""

import gzip
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from quarry.llm import warc as W
from quarry.llm.shared_files import open_folder
from quarry.session import scratch_path

BIG = "<html>" + "é same body " * 30 + "</html>"
ROWS = [
    (5, "http://www.Example.com:80/a?b#c", BIG), (3, "https://example.com/a", BIG), (9, "http://www.Example.com:80/a?b#c", BIG),
    (1, "http://example.com/small", "tiny"), (2, "http://example.com/small", "tiny"), (4, None, None), (6, "", ""),
    (None, "http://example.com/x", BIG), (None, "http://example.com/x", "other " * 40), (3, "https://example.com/a", BIG),
    (7, "not a url\twith tab", "y" * 100), (8, "http://[bad", "z" * 99 + "é"), (10, "http://user@host.org:8080/p\r\nq", "\x00\r\n\r\nWARC/1.1\r\n" * 20),
]


def pages(spark, rows=ROWS):
    return spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, digest string").repartition(4)


def expected(rows):
    first = {}
    for p, _, h in rows:
        b = (h or "").encode()
        if p is not None and len(b) >= 100:
            first[b] = min(p, first.get(b, p))
    out = []
    for p, _, h in rows:
        b = (h or "").encode()
        to = first.get(b) if p is not None and len(b) >= 100 and first.get(b) != p else None
        out.append((p, len(b), hashlib.sha256(b).hexdigest(), "revisit" if to is not None else "response", to))
    return sorted(out, key=repr)


def test_round_trip(spark):
    assert sorted(map(tuple, W.warc_digest(pages(spark)).collect()), key=repr) == expected(ROWS)


def test_many_pages_and_small_blocks(spark, monkeypatch):
    rng = random.Random(1)
    rows = [(i, f"http://h{rng.randint(0, 3)}.example.com/{rng.randint(0, 20)}", rng.choice([BIG, "short", "body %d " % rng.randint(0, 50) * 20])) for i in range(500)]
    df = pages(spark, rows)
    assert sorted(map(tuple, W.warc_digest(df).collect()), key=repr) == expected(rows)
    folder = scratch_path(spark, "warc")
    index = W.write_index(W.write_archives(df, folder + "/a"), folder + "/i", block_lines=7)
    reader = W.IndexReader(index)
    for host in range(4):
        for n in range(22):
            url = f"http://h{host}.example.com/{n}"
            assert sorted(x[0] for x in reader.find(W.url_key(url).encode())) == sorted(p for p, u, _ in rows if u == url)
    asked = spark.createDataFrame([(W.url_key(f"http://h1.example.com/{n}"), None) for n in range(25)], "key string, page_id long")
    found = W.look_up(asked, index)
    assert sorted(r.page_id for r in found.collect()) == sorted(p for p, u, _ in rows if u.startswith("http://h1."))
    html = {p: h for p, _, h in rows}
    for r in W.read_records(found).where(F.col("record_type") == "response").collect():
        assert r.payload.decode() == html[r.page_id]


def test_archives_are_plain_gzip_members(spark):
    captures = W.write_archives(pages(spark), scratch_path(spark, "warc")).collect()
    for path in {c.path for c in captures}:
        fs, at = open_folder(path)
        with fs.open_input_file(at) as f:
            data = f.read()
        text = gzip.decompress(data)
        assert text.startswith(b"WARC/1.1\r\n") and text.endswith(b"\r\n\r\n")
        mine = [c for c in captures if c.path == path]
        assert sum(c.length for c in mine) == len(data)
        for c in mine:
            fields, _ = W.parse_record(data[c.offset : c.offset + c.length])
            assert fields["warc-type"] in ("response", "revisit")


def test_damage_is_noticed():
    record = W.make_record(1, "http://a.b/", b"payload", hashlib.sha256(b"other").hexdigest(), None)
    with pytest.raises(ValueError):
        W.parse_record(gzip.compress(record))


def test_url_keys():
    assert W.url_key("http://www.Example.com:80/a?b#c") == "com,example,www)/a?b"
    assert W.url_key("https://u@a.org:8443") == "org,a:8443)/"
    assert W.url_key(None) == W.url_key("") == ""


def test_empty_table(spark):
    assert W.warc_digest(pages(spark).where("false")).collect() == []
