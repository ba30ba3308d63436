"""WARC archives and a two-level capture index.

Writing: each task writes its pages as one ``.warc.gz`` file -- a gzip member for each record, so that a record can be
read by its byte range -- with ``pyarrow.fs``, which reaches local, HDFS and object stores by URI.  A file gets its name
from the partition and the attempt; only files named in the (Parquet) list of captures count, so that a lost executor's
leftovers are never read.  Of pages with equal payloads the largest page_id is the response and the others are revisits.

Index: captures are range-partitioned and sorted by their reversed-host URL key; each partition packs its lines into
zlib-compressed blocks of a fixed number of captures, and ends its file with the directory of its blocks (their keys and
places).  What Spark and the driver hold is the root: one row for each index file.  A look-up bisects the root, reads that
file's directory, bisects it, inflates the block that can hold the key, bisects that, and reads the byte range of each
capture it finds.  Many look-ups are range-partitioned and sorted as the index is, so that a task reads a block once.

Defined results: a null html is an empty payload; a null url has the key ``""``; rows with a null page_id are never
the original of a revisit unless all rows of a payload have none (then all are responses); repeated rows (same id, same
payload) are written once for each row, all with the same type.  An empty table gives no file and an empty result.
"""

from __future__ import annotations

import base64
import bisect
import contextlib
import hashlib
import io
import posixpath
import uuid
import zlib
from urllib.parse import urlsplit

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import lookup, materialize, new_path, partitions, read_table

#: Captures in a block of the index.
BLOCK = 3000
DATE = "2024-01-01T00:00:00Z"


def surt(url: str | None) -> str:
    """``http://www.Example.com:80/a?b`` -> ``com,example,www)/a?b``; the scheme, user, port 80/443 and fragment go."""
    if not url:
        return ""
    try:
        parts = urlsplit(url.strip())
        host, port = (parts.hostname or ""), parts.port
    except ValueError:
        return url
    if not host:
        return url
    key = ",".join(reversed(host.split(".")))
    if port not in (None, 80, 443):
        key += f":{port}"
    return f"{key}){parts.path or '/'}" + (f"?{parts.query}" if parts.query else "")


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, payload_digest: str, refers_to: int | None) -> bytes:
    """One WARC/1.1 record; a revisit has no payload of its own but names the payload's digest and the response."""
    uri = (url or "").replace("\r", "%0D").replace("\n", "%0A")
    body = b"" if refers_to is not None else payload
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    name = lambda i: f"<urn:page:{'' if i is None else i}>"
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {name(page_id)}", f"WARC-Date: {DATE}", f"WARC-Target-URI: {uri}", f"WARC-Payload-Digest: sha1:{payload_digest}"]
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {name(refers_to)}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(http) + len(body)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + http + body + b"\r\n\r\n"


def member(data: bytes, level: int = 1) -> bytes:
    """A gzip member of its own, without a time stamp: equal records give equal bytes."""
    c = zlib.compressobj(level, zlib.DEFLATED, 31)
    return c.compress(data) + c.flush()


def parse(data: bytes) -> dict:
    """The headers of a record, its payload, and whether the payload's digest holds (None for a revisit)."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
    n = int(headers["Content-Length"])
    block = rest[:n]
    if len(block) < n or rest[n : n + 4] != b"\r\n\r\n":
        raise ValueError("the WARC record is cut off")
    http, _, payload = block.partition(b"\r\n\r\n")
    length = next(int(x.split(b":", 1)[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    kind = headers["WARC-Type"]
    said = headers["WARC-Payload-Digest"].removeprefix("sha1:")
    if kind == "response" and (len(payload) != length or digest(payload) != said):
        raise ValueError(f"the payload of {headers['WARC-Record-ID']} does not match its digest")
    ident = lambda x: int(v) if (v := x[len("<urn:page:") : -1]) else None
    return {"page_id": ident(headers["WARC-Record-ID"]), "url": headers["WARC-Target-URI"], "record_type": kind, "payload_digest": said, "payload_bytes": length, "refers_to": ident(headers["WARC-Refers-To"]) if "WARC-Refers-To" in headers else None, "payload": payload}


def with_digest(pages: DataFrame) -> DataFrame:
    """page_id, url, html (binary, never null), payload_digest."""

    def run(batches):
        for b in batches:
            html = [x or b"" for x in b.column("html").cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(html, pa.binary()), pa.array([digest(x) for x in html], pa.string())], names=["page_id", "url", "html", "payload_digest"])

    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")).mapInArrow(run, "page_id long, url string, html binary, payload_digest string")


def _digest_only(pages: DataFrame) -> DataFrame:
    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("page_id"), pa.array([digest(x or b"") for x in b.column("html").cast(pa.binary()).to_pylist()], pa.string())], names=["page_id", "payload_digest"])

    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("html").cast("string").alias("html")).mapInArrow(run, "page_id long, payload_digest string")


def qualified(spark: SparkSession, folder: str) -> str:
    """The folder's URI as Spark understands it: a path without scheme lies in Spark's default file system, not on an executor's disk."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    uri = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path).toString()
    return "file://" + uri.removeprefix("file:").removeprefix("//") if uri.startswith("file:") else uri


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 0) -> DataFrame:
    """Writes the archives under ``folder`` and returns the list of captures: surt, page_id, url, file, offset, length, ..."""
    folder = qualified(pages.sparkSession, folder)
    groups = _digest_only(pages).groupBy("payload_digest").agg(F.count("*").alias("n"), F.max("page_id").alias("best"))
    # Only payloads that occur again have a row here; the others are responses.
    again = materialize(groups.where("n > 1"), "payloads")
    full = with_digest(pages)
    marked = lookup(full, again, ["payload_digest"], ["best"], "n")
    again_id = F.when((F.octet_length("html") >= min_bytes) & F.col("best").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("best")), F.col("best"))
    marked = marked.select("page_id", "url", "html", "payload_digest", again_id.alias("refers_to"))

    def run(batches):
        fs, base = pafs.FileSystem.from_uri(folder)
        fs.create_dir(base, recursive=True)
        name = f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex[:12]}.warc.gz"
        with contextlib.ExitStack() as files:
            out, at = None, 0
            for b in batches:
                rows = {k: [] for k in ("surt", "page_id", "url", "file", "offset", "length")}
                for page_id, url, html, said, ref in zip(*(b.column(i).to_pylist() for i in range(5)), strict=True):
                    if out is None:
                        out = files.enter_context(fs.open_output_stream(posixpath.join(base, name), compression=None))
                    data = member(record(page_id, url, html, said, ref))
                    out.write(data)
                    for k, v in zip(rows, (surt(url), page_id, url, name, at, len(data)), strict=True):
                        rows[k].append(v)
                    at += len(data)
                yield pa.RecordBatch.from_pydict(rows, schema=_CAPTURE)

    return marked.mapInArrow(run, "surt string, page_id long, url string, file string, offset long, length long")


_CAPTURE = pa.schema([("surt", pa.string()), ("page_id", pa.int64()), ("url", pa.string()), ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64())])
_READ = "page_id long, url string, record_type string, payload_digest string, payload_bytes long, refers_to long, payload binary"


def read_captures(captures: DataFrame, folder: str) -> DataFrame:
    """Range reads of the captures' records: headers and payloads, checksums tested.  Neighbours in a file are read together."""
    window = 8 << 20
    folder = qualified(captures.sparkSession, folder)

    def run(batches):
        fs, base = pafs.FileSystem.from_uri(folder)
        file, name, have, have_at = None, None, b"", 0
        try:
            for b in batches:
                rows = []
                for f, at, n in zip(b.column("file").to_pylist(), b.column("offset").to_pylist(), b.column("length").to_pylist(), strict=True):
                    if f != name:
                        if file is not None:
                            file.close()
                        file, name, have = fs.open_input_file(posixpath.join(base, f)), f, b""
                    if not (have_at <= at and at + n <= have_at + len(have)):
                        file.seek(at)
                        have, have_at = file.read(max(n, window)), at
                    rows.append(parse(zlib.decompress(have[at - have_at : at - have_at + n], 31)))
                yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("refers_to", pa.int64()), ("payload", pa.binary())]))
        finally:
            if file is not None:
                file.close()

    return captures.select("file", "offset", "length").mapInArrow(run, _READ)


# ---- the index ---------------------------------------------------------------------------------------------------

_BLOCK = pa.schema([("surt", pa.string()), ("page_id", pa.int64()), ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64())])
_DIRECTORY = pa.schema([("first_surt", pa.string()), ("first_id", pa.int64()), ("last_surt", pa.string()), ("last_id", pa.int64()), ("offset", pa.int64()), ("length", pa.int64()), ("captures", pa.int64())])
_ROOT = pa.schema([*_DIRECTORY, ("blocks", pa.int64()), ("index_file", pa.string())])


def _pack(rows: list[dict], schema: pa.Schema) -> bytes:
    sink = io.BytesIO()
    with pa.ipc.new_stream(sink, schema) as w:
        w.write_batch(pa.RecordBatch.from_pylist(rows, schema=schema))
    return zlib.compress(sink.getvalue(), 6)


def build_index(captures: DataFrame, folder: str, block: int = BLOCK) -> DataFrame:
    """Sorts the captures by SURT key into blocks (files under ``folder``, each with its own directory at the end) and returns the root: one row a file."""
    cols = ["surt", "page_id", "file", "offset", "length"]
    folder = qualified(captures.sparkSession, folder)
    # The page_id is part of the range key: a host or URL with very many captures is spread over partitions.
    ordered = captures.select(*cols).repartitionByRange(partitions(captures.sparkSession), "surt", "page_id", "file", "offset").sortWithinPartitions("surt", "page_id", "file", "offset")

    def run(batches):
        fs, base = pafs.FileSystem.from_uri(folder)
        fs.create_dir(base, recursive=True)
        name = f"index-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex[:12]}.cdx.z"
        with contextlib.ExitStack() as files:
            out, at, held, directory = None, 0, [], []

            def write(rows, schema):
                nonlocal out, at
                if out is None:
                    out = files.enter_context(fs.open_output_stream(posixpath.join(base, name), compression=None))
                data = _pack(rows, schema)
                out.write(data)
                at += len(data)
                return {"offset": at - len(data), "length": len(data)}

            def flush(rows):
                ends = {"first_surt": rows[0]["surt"], "first_id": rows[0]["page_id"], "last_surt": rows[-1]["surt"], "last_id": rows[-1]["page_id"]}
                directory.append(ends | write(rows, _BLOCK) | {"captures": len(rows)})

            for b in batches:
                held += b.to_pylist()
                while len(held) >= block:
                    flush(held[:block])
                    held = held[block:]
            if held:
                flush(held)
            if directory:
                ends = {k: directory[0][k] for k in ("first_surt", "first_id")} | {k: directory[-1][k] for k in ("last_surt", "last_id")}
                root = ends | write(directory, _DIRECTORY) | {"captures": sum(x["captures"] for x in directory), "blocks": len(directory), "index_file": name}
                yield pa.RecordBatch.from_pylist([root], schema=_ROOT)

    longs = ("offset", "length", "captures", "blocks", "first_id", "last_id")
    return ordered.mapInArrow(run, ", ".join(f"{f.name} {'long' if f.name in longs else 'string'}" for f in _ROOT))


def _key(text: str, page_id: int | None) -> tuple:
    """Captures in Spark's order: text by its bytes, missing ids first."""
    return text, page_id is not None, page_id or 0


class CaptureIndex:
    """Look-ups by bisection.  The root, one row for each index file, is held in memory; directories and blocks are read when they are needed, the last ones kept."""

    def __init__(self, root: list[dict], folder: str, kept: int = 2):
        self.fs, self.base = pafs.FileSystem.from_uri(folder)
        self.root = sorted(root, key=lambda r: _key(r["first_surt"], r["first_id"]))
        self.kept: dict[tuple, list[dict]] = {}
        self.most, self.reads = kept, 0

    @classmethod
    def open(cls, root: DataFrame, folder: str) -> CaptureIndex:
        """For look-ups by the driver."""
        return cls([r.asDict() for r in root.collect()], qualified(root.sparkSession, folder))

    def _read(self, name: str, row: dict) -> list[dict]:
        place = name, row["offset"]
        if place not in self.kept:
            while len(self.kept) >= self.most:
                del self.kept[next(iter(self.kept))]
            with self.fs.open_input_file(posixpath.join(self.base, name)) as f:
                f.seek(row["offset"])
                self.kept[place] = pa.ipc.open_stream(zlib.decompress(f.read(row["length"]))).read_all().to_pylist()
            self.reads += 1
        return self.kept[place]

    @staticmethod
    def _between(rows: list[dict], low: tuple, high: tuple) -> list[dict]:
        """Of rows with first and last keys in order, those that can hold keys from low to high."""
        begin = bisect.bisect_left(rows, low, key=lambda r: _key(r["last_surt"], r["last_id"]))
        return rows[begin : max(begin, bisect.bisect_right(rows, high, key=lambda r: _key(r["first_surt"], r["first_id"])))]

    def between(self, low: tuple, high: tuple):
        """Captures from low to high, in lists, one from a block."""
        for file in self._between(self.root, low, high):
            for block in self._between(self._read(file["index_file"], file), low, high):
                rows = self._read(file["index_file"], block)
                by = lambda r: _key(r["surt"], r["page_id"])
                yield rows[bisect.bisect_left(rows, low, key=by) : bisect.bisect_right(rows, high, key=by)]

    def find(self, url: str | None) -> list[dict]:
        """All captures of a URL."""
        key = surt(url)
        return [r for rows in self.between(_key(key, None), (key, True, 1 << 63)) for r in rows]


def surt_keys(pages: DataFrame) -> DataFrame:
    """surt, page_id of each page."""

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([surt(x) for x in b.column("url").to_pylist()], pa.string()), b.column("page_id")], names=["surt", "page_id"])

    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url")).mapInArrow(run, "surt string, page_id long")


def find_captures(wanted: DataFrame, root: DataFrame, folder: str) -> DataFrame:
    """The captures of ``wanted`` (surt, page_id; each pair once): surt, page_id, file, offset, length.

    The root is broadcast: it has a row for each index file, of which there are as many as shuffle partitions at most.
    """
    spark = wanted.sparkSession
    shared, folder = spark.sparkContext.broadcast([r.asDict() for r in root.collect()]), qualified(spark, folder)

    def run(batches):
        index = CaptureIndex(shared.value, folder)
        for b in batches:
            held = []
            for place in map(_key, b.column("surt").to_pylist(), b.column("page_id").to_pylist()):
                for rows in index.between(place, place):
                    held += rows
                    if len(held) >= BLOCK:
                        yield pa.RecordBatch.from_pylist(held, schema=_BLOCK)
                        held = []
            yield pa.RecordBatch.from_pylist(held, schema=_BLOCK)

    ordered = wanted.repartitionByRange(partitions(spark), "surt", "page_id").sortWithinPartitions("surt", "page_id")
    return ordered.mapInArrow(run, "surt string, page_id long, file string, offset long, length long")


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes the archives and their index, looks every page up in the index and reads its record back."""
    folder = new_path(spark, "warc")
    pages = read_table(spark, sf_dir, "pages")
    captures = materialize(write_archives(pages, folder), "captures")
    root = materialize(build_index(captures, folder), "root")
    found = find_captures(materialize(surt_keys(pages).distinct(), "wanted"), root, folder)
    # Dealt by file and stretch, so that each task reads its archives from front to back.
    found = found.repartition(partitions(spark), "file", F.floor(F.col("offset") / (4 << 20))).sortWithinPartitions("file", "offset")
    back = read_captures(found, folder)
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
