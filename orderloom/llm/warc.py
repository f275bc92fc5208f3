"""WARC archives of pages: writing, normalising one-stream gzip files, reading by a sidecar index.

* `write_archives` writes a record per page into archives that are one gzip stream each, as many crawlers do.
  Such a file cannot be entered in the middle.
* `normalise` inflates each archive once, from end to end, rewrites every record as a gzip member of its own and
  writes an index beside it, with a line per record: offset, length, type, identifier.
* `read_records` reads records through the index, each by seeking to its own member.

All three stream: memory is bounded by one record's payload when reading and by a buffer otherwise. Files lie
in a folder that all executors share, given as a URI of a file system that Arrow knows. Every attempt of a task
writes files under a new name and reports it in its rows, so a file of a lost or repeated attempt is never
read. Archives are rolled at a size, so a task of any size writes files of bounded size.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.llm.common import Staged, or_empty, ship

#: Payloads of fewer bytes are always stored; uncompressed bytes after which an archive is closed; read buffer (gzip makes at most
#: about a thousand times as much of it).
REVISIT_BYTES, ARCHIVE_BYTES, BUFFER = 1000, 64 << 20, 1 << 15
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_GZIP = 31
_LEVEL = 4


def _store(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder; Spark writes local ones as file:/path as well as file:///path."""
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(uri)


def _id(name) -> str:
    return f"<urn:page:{'' if name is None else name}>"


def _page(urn: str | None) -> int | None:
    text = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(text) if text else None


def _record(page, url: str | None, payload: bytes, size: int, digest: str, refers_to, revisit: bool, date: str) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    clean = "".join(c if " " < c <= "~" else "".join(f"%{b:02X}" for b in c.encode("utf-8", "replace")) for c in url or "")
    block = http if revisit else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_id(page)}",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {clean or 'urn:page:unknown'}",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}",
    ]
    if revisit:
        head += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: {_id(refers_to)}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(head).encode() + block + b"\r\n\r\n"


def plan_records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", revisit_bytes: int = REVISIT_BYTES) -> DataFrame:
    """page, url, payload, size, digest and keeper: the page whose response a revisit refers to, null for responses.

    Null payloads are empty. Of equal payloads of at least `revisit_bytes` the largest identifier is the
    response; rows that repeat it with the same payload are responses too; a null identifier is always one.
    """
    payload = or_empty(F.col(payload_col).cast("string"))
    rows = pages.select(
        F.col(id_col).cast("long").alias("page"),
        F.col(url_col).alias("url"),
        payload.alias("payload"),
        F.octet_length(payload).alias("size"),
        F.sha1(payload.cast("binary")).alias("digest"),
    )
    groups = rows.where(F.col("size") >= revisit_bytes).groupBy("digest").agg(F.max("page").alias("last"), F.count("*").alias("n")).where("n > 1").select("digest", "last")
    keeper = F.when((F.col("size") >= revisit_bytes) & (F.col("last") > F.col("page")), F.col("last"))
    return rows.join(groups, "digest", "left").select("page", "url", "payload", "size", "digest", keeper.alias("keeper"))


def write_archives(planned: DataFrame, folder: str, date: str = "2024-01-01T00:00:00Z", archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write every planned record; rows: path of each archive (one gzip stream) and how many records it has.

    The rows must be staged before use: computing them writes the files.
    """
    ship(planned.sparkSession)

    def run(batches):
        store, root = _store(folder)
        store.create_dir(root, recursive=True)
        done: list[tuple[str, int]] = []
        out = packer = None
        written = records = 0

        def close():
            nonlocal out
            out.write(packer.flush())
            out.close()
            done.append((name, records))
            out = None

        for batch in batches:
            for page, url, payload, size, digest, keeper in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    name = f"{uuid.uuid4().hex}.warc.gz"
                    out, packer, written, records = store.open_output_stream(f"{root}/{name}", compression=None), zlib.compressobj(_LEVEL, zlib.DEFLATED, _GZIP), 0, 0
                record = _record(page, url, payload.encode("utf-8", "surrogatepass"), size, digest, keeper, keeper is not None, date)
                out.write(packer.compress(record))
                written += len(record)
                records += 1
                if written >= archive_bytes:
                    close()
        if out is not None:
            close()
        if done:
            yield pa.RecordBatch.from_pydict({"path": pa.array([d[0] for d in done]), "records": pa.array([d[1] for d in done], pa.int64())})

    return planned.mapInArrow(run, "path string, records long")


def inflate(chunks: Iterator[bytes]) -> Iterator[bytes]:
    """The bytes of a gzip stream of one or many members. A stream that ends early is an error."""
    unpack = zlib.decompressobj(_GZIP)
    open_member = False
    for chunk in chunks:
        while chunk:
            open_member = True
            if data := unpack.decompress(chunk):
                yield data
            chunk = unpack.unused_data
            if unpack.eof:
                unpack, open_member = zlib.decompressobj(_GZIP), False
    if open_member:
        raise ValueError("gzip stream ends early")


def _fields(head: bytes) -> dict[str, str]:
    """Named fields of a header block; names in lower case. A block that is no WARC header is an error."""
    first, *lines = head.decode("utf-8", "replace").split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError(f"no WARC record: {first[:40]!r}")
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines if line)}


def split_records(data: Iterator[bytes]) -> Iterator[tuple[dict[str, str], Iterator[bytes]]]:
    """Fields and bytes (header to trailing line ends, in pieces) of each record of an uncompressed stream.

    The pieces of a record must be used up before the next record is asked for.
    """
    held = bytearray()

    def more() -> bool:
        piece = next(data, None)
        if piece is None:
            return False
        held.extend(piece)
        return True

    while True:
        while (at := held.find(b"\r\n\r\n")) < 0 and more():
            pass
        if at < 0:
            if held.strip():
                raise ValueError("archive ends within a header")
            return
        head = bytes(held[: at + 4])
        del held[: at + 4]
        fields = _fields(head[:-4])
        left = int(fields["content-length"]) + 4

        def pieces(head: bytes = head, left: int = left) -> Iterator[bytes]:
            yield head
            while left:
                if not held and not more():
                    raise ValueError("archive ends within a record")
                piece = bytes(held[:left])
                del held[: len(piece)]
                left -= len(piece)
                yield piece

        yield fields, pieces()


def _chunks(stream) -> Iterator[bytes]:
    while chunk := stream.read(BUFFER):
        yield chunk


def normalise(archives: DataFrame, source: str, target: str) -> DataFrame:
    """Rewrite each archive (path, under `source`) into `target`; rows: path, index, records.

    Every record becomes a member of its own, and <path>.idx gets its offset, length, type and identifier, tab
    separated. The rows must be staged before use.
    """
    ship(archives.sparkSession)

    def run(batches):
        store, root = _store(source)
        out_store, out_root = _store(target)
        out_store.create_dir(out_root, recursive=True)
        for batch in batches:
            for path in batch.column("path").to_pylist():
                name, offset, records = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                with store.open_input_stream(f"{root}/{path}", compression=None) as stream, out_store.open_output_stream(f"{out_root}/{name}", compression=None) as out, out_store.open_output_stream(f"{out_root}/{name}.idx", compression=None) as index:
                    for fields, pieces in split_records(inflate(_chunks(stream))):
                        packer, length = zlib.compressobj(_LEVEL, zlib.DEFLATED, _GZIP), 0
                        for piece in pieces:
                            if packed := packer.compress(piece):
                                out.write(packed)
                                length += len(packed)
                        packed = packer.flush()
                        out.write(packed)
                        length += len(packed)
                        index.write(f"{offset}\t{length}\t{fields.get('warc-type', '')}\t{fields.get('warc-record-id', '')}\n".encode())
                        offset += length
                        records += 1
                yield pa.RecordBatch.from_pydict({"path": pa.array([name]), "index": pa.array([f"{name}.idx"]), "records": pa.array([records], pa.int64())})

    return archives.select("path").mapInArrow(run, "path string, index string, records long")


def read_records(normalised: DataFrame, folder: str) -> DataFrame:
    """page_id, record_type, refers_to, target, payload (binary; null for revisits), payload_bytes, payload_digest.

    Size and digest are of the full payload: of a response as it is read, of a revisit as its header states.
    """
    ship(normalised.sparkSession)
    schema = "page_id long, record_type string, refers_to long, target string, payload binary, payload_bytes long, payload_digest string"
    names = [f.split()[0] for f in schema.split(", ")]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.binary(), pa.int64(), pa.string()]

    def parse(member: bytes) -> tuple:
        record = zlib.decompress(member, _GZIP)
        head, _, rest = record.partition(b"\r\n\r\n")
        fields = _fields(head)
        block = rest[: int(fields["content-length"])]
        http, _, payload = block.partition(b"\r\n\r\n")
        kind = fields["warc-type"]
        if kind == "revisit":
            sizes = [line.partition(b":")[2] for line in http.split(b"\r\n") if line.lower().startswith(b"content-length:")]
            digest = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")).hex()
            return _page(fields["warc-record-id"]), kind, _page(fields["warc-refers-to"]), fields["warc-target-uri"], None, int(sizes[0]), digest
        return _page(fields["warc-record-id"]), kind, None, fields["warc-target-uri"], payload, len(payload), hashlib.sha1(payload).hexdigest()

    def run(batches):
        store, root = _store(folder)

        def flush(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

        for batch in batches:
            for path, index in zip(batch.column("path").to_pylist(), batch.column("index").to_pylist()):
                with store.open_input_stream(f"{root}/{index}", compression=None) as lines:
                    entries = [tuple(map(int, line.split(b"\t")[:2])) for line in lines.read().splitlines()]
                rows, size = [], 0
                with store.open_input_file(f"{root}/{path}") as file:
                    for offset, length in entries:
                        rows.append(parse(file.read_at(length, offset)))
                        size += rows[-1][5]
                        if size > 8 << 20:
                            yield flush(rows)
                            rows, size = [], 0
                if rows:
                    yield flush(rows)

    return normalised.select("path", "index").mapInArrow(run, schema)


def round_trip(spark: SparkSession, pages: DataFrame, **columns: str) -> DataFrame:
    """Write the pages as one-stream archives, normalise these, and read all records back."""
    staged = Staged(spark)
    raw, fine = staged.path("raw"), staged.path("normalised")
    archives = staged.write("archives", write_archives(plan_records(pages, **columns), raw))
    count = archives.count()
    # An archive is the unit of work of the two steps that follow.
    spread = archives.repartition(max(1, min(count, 100_000)))
    normalised = staged.write("members", normalise(spread, raw, fine))
    staged.drop("raw")
    return read_records(normalised.repartition(max(1, min(count, 100_000))), fine)
