"""WARC archives: written as whole-file gzip streams, normalised to one member a record with an offset index, read back by offset.

1. `write_archives` lays the pages down as WARC 1.1 records, each file one gzip stream.  Of equal payloads one record is the response,
   the others revisit it.
2. `normalise` inflates such a stream once, from start to end, and writes every record as a gzip member of its own; beside the archive
   it writes a sidecar index with the offset and length of each member.  It reads any WARC file, of one member or of many.
3. `read_archives` deals stretches of the index out to tasks, each of which seeks to its members, inflates them one by one and checks
   the digest of each payload.

Files lie in the shared folder under names of their own for each attempt; only those that a finished task has named in the manifest
count, so a task that runs again or twice leaves nothing that is read.  Streams pass in pieces of a megabyte; a payload is held whole
only where it is a value of a row.
"""

from __future__ import annotations

import hashlib
import json
import uuid
import zlib
from collections.abc import Callable, Iterator
from itertools import chain
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, functions as F

from brindle.llm.common import lookup, slices, staged
from brindle.sources.scratch import scratch_path

PIECE = 1 << 20
ARCHIVE_BYTES = 256 << 20  # payload after which a task begins the next file
STRETCH_BYTES = 32 << 20  # members that one row of the read plan covers
SMALL = 100  # payloads of fewer bytes are never revisited
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"  # fixed value of the format
DATE = "1970-01-01T00:00:00Z"


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


def _uri(folder: str) -> str:
    """file:/x and file:///x are the same place."""
    return "file://" + folder[5:] if folder.startswith("file:/") and not folder.startswith("file://") else folder


# ---- records ---------------------------------------------------------------------------------------------------------------


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> Iterator[bytes]:
    """The bytes of one record, in pieces.  A revisit has the headers of the answer but not its payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {DATE}",
             f"WARC-Payload-Digest: sha256:{digest}", "Content-Type: application/http;msgtype=response"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=%-._~' + chr(39))}")
    if revisit:
        lines += [f"WARC-Profile: {PROFILE}", "WARC-Truncated: length"] + ([] if refers_to is None else [f"WARC-Refers-To: <urn:page:{refers_to}>"])
    lines.append(f"Content-Length: {len(http) + (0 if revisit else len(payload))}")
    yield "\r\n".join(lines).encode() + b"\r\n\r\n" + http
    if not revisit:
        for i in range(0, len(payload), PIECE):
            yield payload[i : i + PIECE]
    yield b"\r\n\r\n"


class Inflate:
    """The text of a gzip file of one or many members, read piece by piece."""

    def __init__(self, source) -> None:
        self.source, self.inner, self.ready, self.at, self.rest = source, None, b"", 0, b""

    def _more(self) -> bool:
        """Inflate up to one more piece; false behind the last member."""
        while True:
            if self.inner is not None and self.inner.eof:
                self.rest, self.inner = self.inner.unused_data, None
            raw = self.rest or self.source.read(PIECE)
            if self.inner is None:
                if not raw:
                    return False
                self.inner = zlib.decompressobj(31)
            made = self.inner.decompress(raw, PIECE)
            self.rest = self.inner.unconsumed_tail
            if made:
                self.ready, self.at = self.ready[self.at :] + made, 0
                return True
            if not raw and not self.inner.eof:
                raise ValueError("the archive ends inside a gzip member")

    def line(self) -> bytes | None:
        """One line without its end, or None behind the last."""
        while (end := self.ready.find(b"\r\n", self.at)) < 0:
            if not self._more():
                if self.at < len(self.ready):
                    raise ValueError("the archive ends inside a line")
                return None
        line, self.at = self.ready[self.at : end], end + 2
        return line

    def take(self, n: int) -> Iterator[bytes]:
        while n:
            if self.at == len(self.ready) and not self._more():
                raise ValueError("the archive ends inside a record")
            piece = self.ready[self.at : self.at + min(n, PIECE)]
            self.at += len(piece)
            n -= len(piece)
            yield piece


def read_record(stream: Inflate) -> tuple[list[bytes], dict[str, str], int] | None:
    """(header lines, headers by lower-case name, length of the block) of the next record; the block is the caller's to take."""
    line = stream.line()
    while line == b"":  # the blank lines that end the record before
        line = stream.line()
    if line is None:
        return None
    if not line.startswith(b"WARC/"):
        raise ValueError(f"no record begins with {line[:40]!r}")
    lines = [line]
    while line := stream.line():
        lines.append(line)
    headers = {k.decode().strip().lower(): v.decode().strip() for k, _, v in (x.partition(b":") for x in lines[1:])}
    return lines, headers, int(headers["content-length"])


# ---- writing ---------------------------------------------------------------------------------------------------------------

_MANIFEST = "path string, n_records bigint"


def _manifest(path: str, n: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"path": [path], "n_records": [n]}, schema=pa.schema([("path", pa.string()), ("n_records", pa.int64())]))


def _writer(folder: str, archive_bytes: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, gz, path, n, size = None, None, "", 0, 0
        inflate = zstandard.ZstdDecompressor()
        for part in batches:
            for i in range(part.num_rows):
                page_id, url, packed, digest, refers_to, revisit = (part.column(c)[i].as_py() for c in ("page_id", "url", "packed", "digest", "refers_to", "revisit"))
                if out is None:
                    path, n, size = f"{folder}/{uuid.uuid4().hex}.warc.gz", 0, 0
                    store, name = _open(path)
                    out, gz = store.open_output_stream(name, compression=None), zlib.compressobj(6, zlib.DEFLATED, 31)
                payload = inflate.decompress(packed)
                for piece in record(page_id, url, payload, digest, refers_to, revisit):
                    out.write(gz.compress(piece))
                n, size = n + 1, size + len(payload)
                if size >= archive_bytes:
                    out.write(gz.flush())
                    out.close()
                    yield _manifest(path, n)
                    out = None
        if out is not None:
            out.write(gz.flush())
            out.close()
            yield _manifest(path, n)

    return run


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """html to its compressed UTF-8 bytes, which is what the shuffle carries and keeps on disk."""
    deflate = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        for part in slices(batch):
            made = pa.array([deflate.compress(x.encode()) for x in part.column("html").to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("rid", "page_id", "url", "digest")), made], ["rid", "page_id", "url", "digest", "packed"])


def assign_types(pages: DataFrame) -> DataFrame:
    """(page_id, url, packed, digest, copies, revisit, refers_to), one row for all equal rows: of equal payloads of SMALL bytes or more,
    all but one are revisits.

    The one that stays is that of the smallest page_id (rows without one come last), then of the least url (null first); of equal rows
    it is one of the copies.  Texts are shuffled once; only narrow rows meet by payload.
    """
    named = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    named = named.withColumn("digest", F.sha2("html", 256))
    rid = F.concat(F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(" "), "digest", F.coalesce(F.concat(F.lit(" "), "url"), F.lit("")))
    named = named.withColumn("rid", F.sha2(rid, 256))
    packed = named.select("rid", "page_id", "url", "digest", "html").mapInArrow(_pack, "rid string, page_id bigint, url string, digest string, packed binary")
    full = packed.groupBy("rid").agg(*[F.first(c).alias(c) for c in ("page_id", "url", "packed", "digest")], F.count("*").alias("copies"))
    narrow = named.where(F.octet_length("html") >= SMALL).groupBy("rid").agg(F.count("*").alias("copies"), *[F.first(c).alias(c) for c in ("page_id", "url", "digest")])
    order = F.struct(F.col("page_id").isNull(), "page_id", "url", "rid")
    first = narrow.groupBy("digest").agg(F.min(order).alias("first"), F.sum("copies").alias("all"), F.count("*").alias("n")).where("all > 1")
    first = first.select("digest", F.col("first.rid").alias("first_rid"), F.col("first.page_id").alias("refers_to"), "n")
    again = lookup(narrow.select("rid", "digest"), first, ["digest"], "n").where("first_rid IS NOT NULL")
    again = again.select("rid", (F.col("first_rid") != F.col("rid")).alias("revisit"), "refers_to")
    return full.join(again, "rid", "left").drop("rid")


def write_archives(pages: DataFrame, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """(path, n_records) of the archives that the tasks have written, one gzip stream a file."""
    spark = pages.sparkSession
    folder = _uri(scratch_path(spark, "llm-warc"))
    _make(folder)
    typed = assign_types(pages).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))))
    # a copy is a revisit too; payloads too small for one have no verdict
    typed = typed.withColumn("revisit", F.coalesce(F.col("revisit") | (F.col("copy") > 1), F.lit(False))).drop("copies", "copy")
    return staged(typed.mapInArrow(_writer(folder, archive_bytes), _MANIFEST), "manifest")


def _make(folder: str) -> None:
    store, name = _open(folder)
    store.create_dir(name, recursive=True)


# ---- normalising -----------------------------------------------------------------------------------------------------------


def normalise_file(source: str, target: str) -> int:
    """Rewrite an archive with each record as its own gzip member, and `target`.idx with a line a member; the number of records."""
    store, name = _open(source)
    goal, goal_name = _open(target)
    n, offset = 0, 0
    with store.open_input_stream(name, compression=None) as raw, goal.open_output_stream(goal_name, compression=None) as out, \
            goal.open_output_stream(goal_name + ".idx", compression=None) as index:
        stream = Inflate(raw)
        while (found := read_record(stream)) is not None:
            lines, headers, length = found
            gz, size = zlib.compressobj(6, zlib.DEFLATED, 31), 0
            for piece in chain([b"\r\n".join(lines) + b"\r\n\r\n"], stream.take(length), [b"\r\n\r\n", None]):
                made = gz.flush() if piece is None else gz.compress(piece)
                out.write(made)
                size += len(made)
            entry = {"offset": offset, "length": size, "type": headers.get("warc-type"), "id": headers.get("warc-record-id"), "uri": headers.get("warc-target-uri")}
            index.write(json.dumps(entry).encode() + b"\n")
            n, offset = n + 1, offset + size
    return n


def normalise(archives: DataFrame) -> DataFrame:
    """(path, n_records) of the normalised archives, one for each that is named; the index lies at `path`.idx."""
    spark = archives.sparkSession
    folder = _uri(scratch_path(spark, "llm-warc-members"))
    _make(folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            for path in part.column("path").to_pylist():
                target = f"{folder}/{uuid.uuid4().hex}.warc.gz"
                yield _manifest(target, normalise_file(path, target))

    # one archive a task: a gzip stream can only be read from its start
    return staged(_spread(archives.select("path"), "path").mapInArrow(run, _MANIFEST), "members")


def _spread(rows: DataFrame, *columns: str) -> DataFrame:
    """Few rows that each stand for much work, one a task where there are enough tasks."""
    n = max(rows.sparkSession.sparkContext.defaultParallelism, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return rows.repartition(n, *columns)


# ---- reading ---------------------------------------------------------------------------------------------------------------


def stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Archives to runs of members of about STRETCH_BYTES, from their indexes."""
    for part in batches:
        rows = []
        for path in part.column("path").to_pylist():
            store, name = _open(path)
            start, size, n, left = 0, 0, 0, b""
            with store.open_input_stream(name + ".idx", compression=None) as index:
                while piece := index.read(PIECE):
                    *entries, left = (left + piece).split(b"\n")
                    for entry in map(json.loads, entries):
                        if size >= STRETCH_BYTES:
                            rows.append((path, start, size, n))
                            start, size, n = entry["offset"], 0, 0
                        size, n = size + entry["length"], n + 1
            if n:
                rows.append((path, start, size, n))
        yield pa.RecordBatch.from_pydict(dict(zip(("path", "start", "size", "n"), map(list, zip(*rows)))) if rows else {"path": [], "start": [], "size": [], "n": []},
                                         schema=pa.schema([("path", pa.string()), ("start", pa.int64()), ("size", pa.int64()), ("n", pa.int64())]))


_RECORDS = pa.schema([("page_id", pa.int64()), ("uri", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())])


def _page(urn: str | None) -> int | None:
    number = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def parse_member(stream: Inflate, keep: bool) -> tuple:
    """The row of one record; a response's payload must have the digest that its header names."""
    _, headers, length = read_record(stream)
    block = stream.take(length)
    http, payload, digest, size, named = b"", [], hashlib.sha256(), 0, headers["warc-payload-digest"].removeprefix("sha256:")
    for piece in block:
        if http is not None:
            http += piece
            head, gap, rest = http.partition(b"\r\n\r\n")
            if not gap:
                continue
            full = next(int(v) for k, _, v in (x.partition(b":") for x in head.split(b"\r\n")[1:]) if k.lower() == b"content-length")
            http, piece = None, rest
        digest.update(piece)
        size += len(piece)
        if keep:
            payload.append(piece)
    kind = headers["warc-type"]
    if kind == "response" and (digest.hexdigest() != named or size != full):
        raise ValueError(f"{headers['warc-record-id']}: the payload does not match its digest")
    return _page(headers["warc-record-id"]), headers.get("warc-target-uri"), kind, _page(headers.get("warc-refers-to")), full, named, b"".join(payload) if keep and kind == "response" else None


def read_archives(archives: DataFrame, payloads: bool = True) -> DataFrame:
    """(page_id, uri, record_type, refers_to, payload_bytes, payload_digest, payload) of all records of normalised archives.

    Size and digest are those of the full payload; a revisit's payload is null, as are all where `payloads` is off.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            for path, start, n in zip(*(part.column(c).to_pylist() for c in ("path", "start", "n"))):
                store, name = _open(path)
                with store.open_input_file(name) as file:
                    file.seek(start)
                    stream, rows, size = Inflate(file), [], 0
                    for _ in range(n):
                        rows.append(parse_member(stream, payloads))
                        size += len(rows[-1][-1] or b"") + 256
                        if size > 4 * PIECE:
                            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows), _RECORDS)], schema=_RECORDS)
                            rows, size = [], 0
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows), _RECORDS)], schema=_RECORDS)

    plan = archives.select("path").mapInArrow(stretches, "path string, start bigint, size bigint, n bigint")
    return _spread(plan, "path", "start").mapInArrow(run, "page_id bigint, uri string, record_type string, refers_to bigint, payload_bytes bigint, payload_digest string, payload binary")


def archived_pages(pages: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of each row of pages, as its archives tell.

    A null html is an empty payload; a null url leaves its header out; a row without a page_id is archived under an empty number and
    revisited only where no row of its payload has one (refers_to is then null).  Repeated rows are records of their own.  An empty
    table makes no archive and no row.
    """
    return read_archives(normalise(write_archives(pages)), payloads=False).drop("uri", "payload")
