"""WARC archives with a two-level capture index.

Archives are gzip members, one per record, written by tasks into the shared folder under names no
other attempt uses; what a task reports about its file counts only once the task has succeeded, so
lost executors leave at worst a file that nothing names.

The index sorts captures by reversed-host URL key and page id. Each of its files holds compressed
blocks of ``LINES`` sorted lines; the sparse directory has one row per block with its first key.
A lookup finds the index file by binary search over the files' first keys, the block by binary
search in that file's part of the directory, the lines by binary search in the block, and then
reads just the records' byte ranges.
"""

from __future__ import annotations

import base64
import bisect
import gzip
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F

from starmill.llm.tables import partitions, staged
from starmill.sources import shared

LEAST = 1000  # payloads below this many bytes are never revisits
LINES = 512  # captures of an index block
OPEN_FILES = 32
DATE = "1970-01-01T00:00:00Z"  # tables of pages say nothing about when a page was fetched
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def url_key(url: str | None) -> str:
    """Sort key of a URL: host parts reversed, then the path; no scheme, user, port or fragment."""
    rest = (url or "").strip().split("#", 1)[0]
    rest = rest.split("://", 1)[-1]
    host, slash, path = rest.partition("/")
    host = host.rpartition("@")[2].partition(":")[0].lower()
    return quote(f"{','.join(reversed(host.split('.')))})/{path}" if host or slash else "", safe="!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")


def _field(value: str) -> str:
    return "".join(c if c >= " " and c != "\x7f" else quote(c) for c in value)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One gzip member; a revisit has the headers of its response and no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {digest}')}>"),
        ("WARC-Date", DATE),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
        ("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()),
    ]
    if url is not None:
        fields.append(("WARC-Target-URI", _field(url)))
    if page_id is not None:
        fields.append(("X-Page-ID", str(page_id)))
    if refers_to is not None:
        fields.append(("WARC-Profile", PROFILE))
        fields.append(("WARC-Refers-To", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{refers_to} {digest}')}>"))
        fields.append(("X-Refers-To-Page-ID", str(refers_to)))
    head = "WARC/1.1\r\n" + "".join(f"{name}: {value}\r\n" for name, value in fields) + "\r\n"
    return gzip.compress(head.encode() + block + b"\r\n\r\n", compresslevel=6, mtime=0)


def parse(member: bytes) -> dict:
    """Fields of one record as it was written; the digest of a response is that of its bytes."""
    data = gzip.decompress(member)
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in lines)
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = next(int(line.split(b":", 1)[1]) for line in http.split(b"\r\n") if line.lower().startswith(b"content-length:"))
    named = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    response = fields["WARC-Type"] == "response"
    if response and (len(payload) != length or hashlib.sha1(payload).hexdigest() != named):
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    ids = [int(fields[name]) if name in fields else None for name in ("X-Page-ID", "X-Refers-To-Page-ID")]
    return {"page_id": ids[0], "payload_bytes": length, "payload_digest": named, "record_type": fields["WARC-Type"], "refers_to": ids[1], "payload": payload if response else None}


def _opened(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder)


CAPTURE = "key string, page_id long, file string, offset long, length long"
CAPTURES = pa.schema([("key", pa.string()), ("page_id", pa.int64()), ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64())])


def _archive(folder: str):
    """Write the task's records to one new file and report where each is."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = _opened(folder)
        name, at, stream = f"{uuid.uuid4().hex}.warc.gz", 0, None
        try:
            for batch in batches:
                if not len(batch):
                    continue
                stream = stream or files.open_output_stream(f"{root}/{name}", compression=None)
                rows = []
                for page_id, url, html, digest, refers_to in zip(*(batch.column(i) for i in range(5)), strict=True):
                    page_id, url = page_id.as_py(), url.as_py()
                    member = record(page_id, url, (html.as_py() or "").encode(), digest.as_py(), refers_to.as_py())
                    stream.write(member)
                    rows.append((url_key(url), page_id, name, at, len(member)))
                    at += len(member)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), CAPTURES, strict=True)], schema=CAPTURES)
        finally:
            if stream:
                stream.close()

    return run


def write_archives(pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """One record per row of ``pages``; returns where each capture lies.

    Null html is an empty payload. Of rows with equal payloads of at least ``LEAST`` bytes that with
    the largest page id is the response and the others revisit it; rows that repeat this id are
    responses too. Rows without an id revisit like others, and are responses if no row of equal
    payload has an id. Payloads are compared by SHA-1 and length.
    """
    files, root = _opened(folder)
    files.create_dir(root, recursive=True)
    payload = F.coalesce(F.col(f"`{html}`").cast("string"), F.lit(""))
    rows = pages.select(
        F.col(f"`{page_id}`").cast("long").alias("page_id"),
        F.col(f"`{url}`").cast("string").alias("url"),
        payload.alias("html"),
        F.sha1(payload.cast("binary")).alias("digest"),
        F.octet_length(payload).alias("size"),
    )
    several = rows.filter(F.col("size") >= LEAST).groupBy("digest", "size").agg(F.max("page_id").alias("kept"), F.count("*").alias("n"))
    several = several.filter("n > 1 AND kept IS NOT NULL").select("digest", "size", "kept")
    refers_to = F.when(~F.col("page_id").eqNullSafe(F.col("kept")), F.col("kept"))
    decided = rows.join(several, ["digest", "size"], "left").select("page_id", "url", "html", "digest", refers_to.alias("refers_to"))
    return staged(decided.mapInArrow(_archive(folder), CAPTURE), "captures")


DIRECTORY = "file string, block int, first_key string, first_id long, offset long, length long"


def _order(page_id: int | None) -> int:
    return -(1 << 63) if page_id is None else page_id


def _index_file(folder: str):
    """Write the task's sorted captures as one index file; one row per block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = _opened(folder)
        name, at, number, stream, lines, rows = f"{uuid.uuid4().hex}.cdx", 0, 0, None, [], []

        def flush() -> None:
            nonlocal at, number, stream, lines
            if not lines:
                return
            stream = stream or files.open_output_stream(f"{root}/{name}", compression=None)
            data = zlib.compress("\n".join(json.dumps(line) for line in lines).encode())
            stream.write(data)
            rows.append((name, number, lines[0][0], _order(lines[0][1]), at, len(data)))
            at, number, lines = at + len(data), number + 1, []

        try:
            for batch in batches:
                for line in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                    lines.append(line)
                    if len(lines) == LINES:
                        flush()
            flush()
        finally:
            if stream:
                stream.close()
        if rows:
            types = (pa.string(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64())
            names = ["file", "block", "first_key", "first_id", "offset", "length"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    return run


def build_index(captures: DataFrame, folder: str) -> DataFrame:
    """Sort captures into index files; returns the directory. Page ids are part of the order, so a
    host or a URL with very many captures spreads over files like any others."""
    files, root = _opened(folder)
    files.create_dir(root, recursive=True)
    ordered = captures.repartitionByRange(partitions(captures.sparkSession), "key", "page_id")
    return staged(ordered.sortWithinPartitions("key", "page_id").mapInArrow(_index_file(folder), DIRECTORY), "directory")


READ = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
READ_WITH = READ + ", payload binary"


def _lookup(archives: str, index: str, with_payload: bool):
    """Captures with the keys asked for in one index file."""

    def run(key: tuple, asked: pa.Table, directory: pa.Table) -> pa.Table:
        files, root = _opened(archives)
        index_files, index_root = _opened(index)
        blocks = sorted(zip(*(directory.column(c).to_pylist() for c in ("first_key", "first_id", "offset", "length")), strict=True))
        firsts = [b[:2] for b in blocks]
        wanted = sorted({(k, _order(p)) for k, p in zip(asked.column("q_key").to_pylist(), asked.column("q_page_id").to_pylist(), strict=True)})
        places = set()
        if blocks and wanted:
            with index_files.open_input_file(f"{index_root}/{key[0].as_py()}") as source:
                loaded, lines, keys = -1, [], []
                for item in wanted:
                    # the key may start before the block that it opens
                    b = max(bisect.bisect_left(firsts, item) - 1, 0)
                    while b < len(blocks) and firsts[b] <= item:
                        if b != loaded:
                            lines = [json.loads(x) for x in zlib.decompress(source.read_at(blocks[b][3], blocks[b][2])).decode().split("\n")]
                            keys, loaded = [(x[0], _order(x[1])) for x in lines], b
                        for at in range(bisect.bisect_left(keys, item), bisect.bisect_right(keys, item)):
                            places.add(tuple(lines[at][2:]))
                        b += 1
        out, open_name, source = [], None, None
        for name, offset, length in sorted(places):
            if name != open_name:
                if source:
                    source.close()
                open_name, source = name, files.open_input_file(f"{root}/{name}")
            found = parse(source.read_at(length, offset))
            out.append(found if with_payload else {k: v for k, v in found.items() if k != "payload"})
        if source:
            source.close()
        fields = [("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())]
        return pa.Table.from_pylist(out, pa.schema(fields + [("payload", pa.binary())] * with_payload))

    return run


def lookup(keys: DataFrame, directory: DataFrame, archives: str, index: str, with_payload: bool = False) -> DataFrame:
    """Records of all captures whose (key, page_id) is in ``keys``, each once.

    The driver holds the first key of every index file, of which there are as many as the index had
    partitions; everything below a file is read by the task that looks it up.
    """
    spark = keys.sparkSession
    starts = directory.groupBy("file").agg(F.min(F.struct("first_key", "first_id")).alias("first")).select("file", "first.*").collect()
    starts = sorted((r["first_key"], r["first_id"], r["file"]) for r in starts)
    empty = READ_WITH if with_payload else READ
    if not starts:
        return spark.createDataFrame([], empty)
    firsts, names = [s[:2] for s in starts], [s[2] for s in starts]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for k, p in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                item = (k, _order(p))
                # equal keys may end one file and open the next ones
                at = max(bisect.bisect_left(firsts, item) - 1, 0)
                while at < len(firsts) and firsts[at] <= item:
                    rows.append((k, p, names[at]))
                    at += 1
            columns = zip(*rows, strict=True) if rows else ((), (), ())
            types = (pa.string(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["q_key", "q_page_id", "q_file"])

    asked = keys.select("key", "page_id").distinct().mapInArrow(assign, "q_key string, q_page_id long, q_file string")
    met = asked.groupBy("q_file").cogroup(directory.groupBy("file"))
    return met.applyInArrow(_lookup(archives, index, with_payload), empty)


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = pa.array([url_key(u) for u in batch.column(0).to_pylist()], pa.string())
        yield pa.RecordBatch.from_arrays([keys, batch.column(1)], names=["key", "page_id"])


def digest(pages: DataFrame) -> DataFrame:
    """Archive all pages, index them, look every page up again and report what the archives say."""
    spark: SparkSession = pages.sparkSession
    archives, index = shared.new_path(spark, "warc"), shared.new_path(spark, "cdx")
    directory = build_index(write_archives(pages, archives), index)
    asked = pages.select(F.col("url").cast("string"), F.col("page_id").cast("long")).mapInArrow(_keyed, "key string, page_id long")
    return lookup(asked, directory, archives, index)
