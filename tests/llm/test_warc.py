import gzip
import hashlib
import json
import random
import zlib
from collections import Counter
from urllib.parse import urlparse

import pytest
from pyspark.sql import types as T

from brindle.llm import warc

SCHEMA = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("html", T.StringType()),
                       *[T.StructField(c, T.StringType()) for c in ("digest", "rid", "copies", "revisit", "refers_to", "n", "path", "payload")]])


def pages(seed=1):
    rng = random.Random(seed)
    rows = [(i, f"http://h{i % 3}.example/{i}", "<p>" + "".join(rng.choice("abc é\n") for _ in range(rng.choice([10, 96, 97, 200, 3000]))) + "</p>") for i in range(60)]
    same = "<html>" + "x" * 200 + "</html>"
    rows += [(i, f"http://c/{i}", same) for i in range(100, 140)] + [(i, "u", "small") for i in (200, 201)]
    rows += [(300, None, None), (301, "http://a b/\r\nWARC-Type: revisit\r\nü", "y" * 150), (None, "z", "y" * 150), (None, "z", "k" * 150), (None, "a", "k" * 150)]
    rows += [(302, "q", "r" * 99), (303, "q", "r" * 99), (304, "q", "é" * 50), (305, "q", "é" * 50), (306, "m", "w" * 3_000_000), (7, rows[7][1], rows[7][2] + "other")]
    rows += [rows[5], rows[5], rows[64], (306, "m", "w" * 3_000_000), (400, "t", "HTTP/1.1 200 OK\r\n\r\nWARC/1.1\r\n\r\n" * 9)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, *["clash"] * 8) for r in rows], SCHEMA)


def wanted(rows):
    """Of the rows of a payload the first by (id, nulls last; url, null first) answers; the rest refer to it."""
    groups, out = {}, Counter()
    for r in rows:
        groups.setdefault((r[2] or "").encode(), []).append(r)
    for payload, found in groups.items():
        digest = hashlib.sha256(payload).hexdigest()
        found.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1] is not None, r[1] or ""))
        for i, r in enumerate(found):
            again = i > 0 and len(payload) >= 100
            out[r[0], len(payload), digest, "revisit" if again else "response", found[0][0] if again else None] += 1
    return out


def test_round_trip(spark):
    rows = pages()
    got = warc.archived_pages(frame(spark, rows)).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert Counter(map(tuple, got)) == wanted(rows)


def test_members_index_and_payloads(spark):
    rows = pages()
    archives = warc.write_archives(frame(spark, rows), archive_bytes=5000)
    members = warc.normalise(archives)
    assert archives.count() > 3 and sum(r.n_records for r in archives.collect()) == sum(r.n_records for r in members.collect()) == len(rows)
    whole, parts = Counter(), Counter()
    for r in archives.collect():
        with open(urlparse(r.path).path, "rb") as f:
            data = f.read()
        first = zlib.decompressobj(31)
        first.decompress(data)
        assert first.eof and not first.unused_data  # one stream a file
        whole[gzip.decompress(data)] += 1
    for r in members.collect():
        with open(urlparse(r.path).path, "rb") as f, open(urlparse(r.path).path + ".idx") as g:
            data, index = f.read(), [json.loads(x) for x in g]
        assert len(index) == r.n_records and index[0]["offset"] == 0 and index[-1]["offset"] + index[-1]["length"] == len(data)
        for e in index:
            one = zlib.decompressobj(31)
            text = one.decompress(data[e["offset"] : e["offset"] + e["length"]])
            assert one.eof and not one.unused_data and text.startswith(b"WARC/1.1\r\n") and text.endswith(b"\r\n\r\n") and e["id"].encode() in text
        parts[gzip.decompress(data)] += 1
    assert whole == parts
    texts = Counter((r.page_id, r.payload) for r in warc.read_archives(members).collect() if r.record_type == "response")
    assert all(p.decode() in [t or "" for i, _, t in rows if i == page] for page, p in texts)
    # archives that are in members already pass again, and come out the same
    again = warc.normalise(members)
    assert Counter(map(tuple, warc.read_archives(again).collect())) == Counter(map(tuple, warc.read_archives(members).collect()))


def test_small_pieces_and_stretches(spark, monkeypatch, tmp_path):
    """Pieces of a few bytes cut headers, line ends and members everywhere."""
    rows, blob, want = [r for r in pages() if len(r[2] or "") < 5000], b"", 0
    for page, url, html in rows:
        payload = (html or "").encode()
        blob += b"".join(warc.record(page, url, payload, hashlib.sha256(payload).hexdigest(), None, False))
        want += 1
    monkeypatch.setattr(warc, "PIECE", 7)
    for name, data in (("one", gzip.compress(blob)), ("two", gzip.compress(blob[:9999]) + gzip.compress(blob[9999:]))):
        (tmp_path / name).write_bytes(data)
        assert warc.normalise_file(str(tmp_path / name), str(tmp_path / f"{name}.out")) == want
        assert gzip.decompress((tmp_path / f"{name}.out").read_bytes()) == blob


def test_damaged_archives_are_refused(tmp_path):
    payload = b"p" * 500
    blob = b"".join(warc.record(1, "u", payload, hashlib.sha256(payload).hexdigest(), None, False))
    bad = blob.replace(b"ppp", b"pqp", 1)
    (tmp_path / "bad").write_bytes(gzip.compress(bad))
    assert warc.normalise_file(str(tmp_path / "bad"), str(tmp_path / "bad.out")) == 1
    with open(tmp_path / "bad.out", "rb") as f, pytest.raises(ValueError):
        warc.parse_member(warc.Inflate(f), True)
    (tmp_path / "short").write_bytes(gzip.compress(blob)[:-30])
    with pytest.raises(ValueError):
        warc.normalise_file(str(tmp_path / "short"), str(tmp_path / "short.out"))
    (tmp_path / "none").write_bytes(gzip.compress(b"not a record\r\n\r\n"))
    with pytest.raises(ValueError):
        warc.normalise_file(str(tmp_path / "none"), str(tmp_path / "none.out"))


def test_nothing(spark):
    assert warc.archived_pages(frame(spark, [])).count() == 0
