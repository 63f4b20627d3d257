"""Web archives: write records, normalise monolithic gzip files, read by offset index."""

from __future__ import annotations

import gzip
import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talusflow.llm.common import written
from talusflow.session import shared_path

_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_DATE = "2024-01-01T00:00:00Z"
_CHUNK = 1 << 20


def _filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path)


def record_bytes(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC record; a revisit keeps the HTTP header (with the payload's length) and no payload."""
    block = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
             + f"Content-Length: {len(payload)}\r\n\r\n".encode())
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {_DATE}",
            f"WARC-Payload-Digest: sha256:{digest}", "Content-Type: application/http;msgtype=response"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if refers_to is None:
        block += payload
    else:
        head += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parsed(record: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (lower-case names) and block of a record."""
    head, _, rest = record.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    headers = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:])}
    return headers, rest[:int(headers["content-length"])]


def records_of(stream: Iterator[bytes]) -> Iterator[bytes]:
    """Cut inflated bytes into whole records, holding one record at a time."""
    held = bytearray()
    for piece in stream:
        held += piece
        at = 0
        while (end := held.find(b"\r\n\r\n", at)) >= 0:
            length = re.search(rb"\r\ncontent-length: *([0-9]+)", held[at:end], re.IGNORECASE)
            stop = end + 4 + int(length[1]) + 4
            if len(held) < stop:
                break
            yield bytes(held[at:stop])
            at = stop
        del held[:at]
    if held.strip():
        raise ValueError("the archive ends within a record")


def inflated(source) -> Iterator[bytes]:
    """The bytes of a gzip file read once from start to end, whatever its number of members."""
    inflate = zlib.decompressobj(31)
    while data := source.read(_CHUNK):
        while data:
            if inflate.eof:
                inflate = zlib.decompressobj(31)
            # bounded output, so a file that inflates far does not fill the memory
            yield inflate.decompress(data, _CHUNK)
            data = inflate.unconsumed_tail or inflate.unused_data
    yield inflate.flush()
    if not inflate.eof:
        raise ValueError("the archive ends within its gzip stream")


def write_archives(pages: DataFrame, folder: str, archive_bytes: int = 64 << 20) -> DataFrame:
    """One gzip stream per archive from page_id, url, payload, digest, refers_to; returns the files.

    Each task writes archives under names of its own. Only the names of tasks that succeeded are in
    the returned list (`archive`, `records`), so files of lost or repeated tasks are never read.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _filesystem(folder)
        fs.create_dir(root, recursive=True)
        out = pack = None
        name, size, count = "", 0, 0

        def closed() -> pa.RecordBatch:
            out.write(pack.flush())
            out.close()
            return pa.RecordBatch.from_pydict({"archive": [name], "records": [count]})

        for batch in batches:
            for first in range(0, batch.num_rows, 64):
                for row in batch.slice(first, 64).to_pylist():
                    if out is None:
                        name, size, count = f"pages-{uuid.uuid4().hex}.warc.gz", 0, 0
                        out, pack = fs.open_output_stream(f"{root}/{name}", compression=None), zlib.compressobj(1, zlib.DEFLATED, 31)
                    record = record_bytes(row["page_id"], row["url"], row["payload"], row["digest"], row["refers_to"])
                    out.write(pack.compress(record))
                    size, count = size + len(record), count + 1
                    if size >= archive_bytes:
                        yield closed()
                        out = None
        if out is not None:
            yield closed()

    return written(pages.select("page_id", "url", "payload", "digest", "refers_to")
                   .mapInArrow(run, "archive string, records long"), "warc-files")


def normalise(archives: DataFrame, source: str, target: str, level: int = 4) -> DataFrame:
    """Rewrite each archive with every record as its own gzip member; returns the offset index.

    The source is inflated once as a stream. Next to each new file goes a sidecar with one JSON
    line per record; the same rows (archive, offset, length, record_id, record_type) are returned.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _filesystem(source)
        new_fs, new_root = _filesystem(target)
        new_fs.create_dir(new_root, recursive=True)
        for name in (n for batch in batches for n in batch.column("archive").to_pylist()):
            new = f"{name.removesuffix('.warc.gz')}-{uuid.uuid4().hex[:8]}.warc.gz"
            offset = 0
            rows: list[dict] = []
            with (fs.open_input_stream(f"{root}/{name}", compression=None) as raw,
                  new_fs.open_output_stream(f"{new_root}/{new}", compression=None) as out,
                  new_fs.open_output_stream(f"{new_root}/{new}.idx", compression=None) as side):
                for record in records_of(inflated(raw)):
                    headers, _ = parsed(record)
                    member = gzip.compress(record, level, mtime=0)
                    out.write(member)
                    rows.append({"archive": new, "offset": offset, "length": len(member),
                                 "record_id": headers["warc-record-id"], "record_type": headers["warc-type"]})
                    side.write(json.dumps(rows[-1]).encode() + b"\n")
                    offset += len(member)
                    if len(rows) == 10_000:
                        yield pa.RecordBatch.from_pylist(rows)
                        rows = []
            if rows:
                yield pa.RecordBatch.from_pylist(rows)

    return written(archives.select("archive").mapInArrow(
        run, "archive string, offset long, length long, record_id string, record_type string"), "warc-index")


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """The records at the index's offsets: page_id, url, record_type, refers_to, digest, payload_bytes, payload.

    A response's digest and length come from its payload, and must agree with its headers; those of
    a revisit come from its headers, and its payload is null.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _filesystem(folder)
        name, file = None, None
        page = lambda v: int(m[1]) if (m := re.fullmatch(r"<urn:page:(-?[0-9]+)>", v or "")) else None
        schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()),
                            ("refers_to", pa.int64()), ("digest", pa.string()),
                            ("payload_bytes", pa.int64()), ("payload", pa.binary())])
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                rows = []
                for at in batch.slice(first, 256).to_pylist():
                    if at["archive"] != name:
                        if file is not None:
                            file.close()
                        name, file = at["archive"], fs.open_input_file(f"{root}/{at['archive']}")
                    headers, block = parsed(gzip.decompress(file.read_at(at["length"], at["offset"])))
                    http, _, payload = block.partition(b"\r\n\r\n")
                    stated = headers["warc-payload-digest"].removeprefix("sha256:")
                    size = int(re.search(rb"Content-Length: ([0-9]+)", http)[1])
                    whole = headers["warc-type"] == "response"
                    digest = hashlib.sha256(payload).hexdigest() if whole else stated
                    if digest != stated or whole and len(payload) != size:
                        raise ValueError(f"record {headers['warc-record-id']} of {name} does not match its digest")
                    rows.append({"page_id": page(headers["warc-record-id"]), "url": headers.get("warc-target-uri"),
                                 "record_type": headers["warc-type"], "refers_to": page(headers.get("warc-refers-to")),
                                 "digest": digest, "payload_bytes": size, "payload": payload if whole else None})
                yield pa.RecordBatch.from_pylist(rows, schema)

    return index.mapInArrow(run, "page_id long, url string, record_type string, refers_to long, digest string, "
                                 "payload_bytes long, payload binary")


def prepared(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
             least_bytes: int = 100) -> DataFrame:
    """page_id, url, payload, digest and the page a repeated payload refers to."""
    payload = F.encode(F.coalesce(F.col(html_col), F.lit("")), "UTF-8")
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"),
                        payload.alias("payload")).withColumn("digest", F.sha2("payload", 256))
    first = written(
        rows.where(F.octet_length("payload") >= least_bytes).groupBy("digest")
        .agg(F.min("page_id").alias("_first"), F.count(F.lit(1)).alias("_n")).where("_n > 1"), "warc-repeated")
    return rows.join(first.select("digest", "_first"), "digest", "left").select(
        "page_id", "url", "payload", "digest",
        F.when(~F.col("page_id").eqNullSafe(F.col("_first")), F.col("_first")).alias("refers_to"))


def archive_round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
                       html_col: str = "html", folder: str | None = None) -> DataFrame:
    """Write pages to archives, normalise these and read all records back.

    Null html is an empty payload. Of equal payloads of at least 100 bytes the one with the smallest
    page_id is a response and the others revisit it; repeated rows with that id are all responses,
    and without any id all are. A null id or url is left out of the header. An empty table writes no
    archive and gives no records. Other columns are not read.
    """
    spark = pages.sparkSession
    folder = folder or shared_path(spark, "warc")
    files = write_archives(prepared(pages, id_col, url_col, html_col), f"{folder}/monolithic")
    index = normalise(files.repartition(max(1, files.count())), f"{folder}/monolithic", f"{folder}/records")
    return read_records(index, f"{folder}/records")
