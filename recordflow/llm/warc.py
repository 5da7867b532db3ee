"""WARC archives: writing, normalising monolithic gzip files, and reading by offset.

A monolithic archive is one gzip stream over all its records, so a record can only be reached by
inflating everything before it. The normaliser inflates such a stream once, in pieces, and writes every
record as a gzip member of its own, with a sidecar index of the members' offsets. Records are streamed
from the one to the other; only headers are held in memory.

The index (``<archive>.idx``) is a text file: a line per record with offset, length, type, record id,
referred record, payload digest and target address, separated by tabs; ``-`` stands for none.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordflow.llm.common import filesystem, staged, write_file
from recordflow.session import scratch_path

#: Payloads from this size on are stored once.
REVISIT_BYTES = 100
_STEP = 1 << 20
_GZIP = 31  # zlib's number for the gzip format
_END = b"\r\n\r\n"
_ID = "urn:page:"
DATE = "1970-01-01T00:00:00Z"


def _line(text: str) -> str:
    """A header value on one line: control characters and spaces are percent-encoded."""
    return "".join(f"%{ord(c):02X}" if ord(c) < 0x21 or ord(c) == 0x7F else c for c in text)


def record(page_id, url: str | None, payload: bytes, digest: str, refers_to) -> bytes:
    """One record: a response with its payload, or a revisit with the response's header lines only."""
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <{_ID}{page_id}>", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {_line(url)}")
    if revisit:
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.append(f"WARC-Refers-To: <{_ID}{refers_to}>")
    head.append(f"WARC-Payload-Digest: sha256:{digest}")
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + _END + block + _END


def headers(head: bytes) -> dict[str, str]:
    """Header lines by lower-case name; the first line is not one."""
    out = {}
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        name, _, value = line.partition(":")
        out[name.strip().lower()] = value.strip()
    return out


def inflate(chunks: Iterator[bytes]) -> Iterator[bytes]:
    """The bytes of a gzip file, in pieces of bounded size, whatever number of members it has."""
    engine, began = zlib.decompressobj(_GZIP), False
    for data in chunks:
        while data:
            began = True
            piece = engine.decompress(data, _STEP)
            if piece:
                yield piece
            data = engine.unconsumed_tail
            if engine.eof:
                data = engine.unused_data.lstrip(b"\0")
                engine, began = zlib.decompressobj(_GZIP), False
    if began and not engine.eof:
        raise ValueError("the archive ends within a gzip stream")


def split_records(pieces: Iterator[bytes]) -> Iterator[tuple[dict[str, str], Iterator[bytes]]]:
    """Each record's headers, and the pieces of its bytes, which must be used up before the next."""
    buffer = bytearray()

    def more() -> bool:
        piece = next(pieces, None)
        if piece is not None:
            buffer.extend(piece)
        return piece is not None

    while True:
        while buffer[:2] == b"\r\n" or len(buffer) < 2:
            if buffer[:2] == b"\r\n":
                del buffer[:2]
            elif not more():
                if buffer.strip():
                    raise ValueError("the archive ends within a record")
                return
        at = 0
        while (end := buffer.find(_END, at)) < 0:
            at = max(0, len(buffer) - 3)
            if not more():
                raise ValueError("the archive ends within a record's headers")
        head = bytes(buffer[: end + 4])
        if not head.startswith(b"WARC/"):
            raise ValueError("not a WARC record")
        fields = headers(head[:-4])
        del buffer[: end + 4]

        def body(head=head, left=int(fields["content-length"])) -> Iterator[bytes]:
            yield head
            while left:
                if not buffer and not more():
                    raise ValueError("the archive ends within a record's block")
                part = bytes(buffer[:left])
                del buffer[:left]
                left -= len(part)
                yield part
            yield _END

        yield fields, body()


def normalise_file(source: str, target: str, level: int = 6) -> tuple[int, int]:
    """Rewrite one archive with a member per record and write its index; (records, bytes) written."""
    system, path = filesystem(source)
    index, size = [], 0

    def members() -> Iterator[bytes]:
        nonlocal size
        with system.open_input_stream(path, compression=None) as stream:
            chunks = iter(lambda: stream.read(_STEP), b"")
            for fields, pieces in split_records(inflate(chunks)):
                engine, start = zlib.compressobj(level, zlib.DEFLATED, _GZIP), size
                for piece in pieces:
                    out = engine.compress(piece)
                    size += len(out)
                    yield out
                out = engine.flush()
                size += len(out)
                yield out
                named = ("warc-type", "warc-record-id", "warc-refers-to", "warc-payload-digest", "warc-target-uri")
                index.append("\t".join([str(start), str(size - start), *[fields.get(n) or "-" for n in named]]))

    write_file(target, members())
    write_file(f"{target}.idx", ["".join(line + "\n" for line in index).encode()])
    return len(index), size


def _first_pages(pages: DataFrame) -> DataFrame:
    """digest and the smallest page of each payload that several pages share and that is large enough."""
    groups = pages.where(F.col("size") >= REVISIT_BYTES).groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
    return groups.where("n > 1").select(F.col("digest").alias("same"), "first")


def write_monolithic(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write a record per page into archives that are one gzip stream each; a row per archive.

    Of pages with equal payloads of at least 100 bytes, the one with the smallest ``page_id`` is the
    response and the others revisit it; smaller payloads are always responses. Rows that repeat the
    smallest ``page_id`` are responses as well, and so are pages whose group has no ``page_id`` at all.
    A null ``html`` is empty, a null ``url`` has no target line. An empty table gives no archive. Only
    ``page_id``, ``url`` and ``html`` are read.
    """
    folder = folder or scratch_path(pages.sparkSession, "warc")
    filesystem(folder)[0].create_dir(filesystem(folder)[1], recursive=True)
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).cast("binary").alias("payload")
    )
    rows = rows.select("*", F.octet_length("payload").alias("size"), F.sha2("payload", 256).alias("digest"))
    first = _first_pages(rows.select("page_id", "size", "digest"))
    typed = rows.join(first, F.col("digest") == F.col("same"), "left").select(
        "page_id", "url", "payload", "digest", F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("first")
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, count = f"{folder}/crawl-{TaskContext.get().partitionId():08d}.warc.gz", 0

        def stream() -> Iterator[bytes]:
            nonlocal count
            engine = zlib.compressobj(1, zlib.DEFLATED, _GZIP)
            for batch in batches:
                for page in zip(*[batch.column(i) for i in range(5)]):
                    page_id, url, payload, digest, refers_to = (x.as_py() for x in page)
                    yield engine.compress(record(page_id, url, payload, digest, refers_to))
                    count += 1
            yield engine.flush()

        write_file(name, stream())
        if count:
            yield pa.RecordBatch.from_pydict({"file": [name], "records": [count]})

    return staged(typed.mapInArrow(write, "file string, records long"), "crawl")


def normalise(archives: DataFrame, folder: str | None = None) -> DataFrame:
    """Rewrite the archives in column ``file``; a row per archive with its new ``file``, records, bytes."""
    folder = folder or scratch_path(archives.sparkSession, "warc-members")
    filesystem(folder)[0].create_dir(filesystem(folder)[1], recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column("file").to_pylist():
                target = f"{folder}/{name.rsplit('/', 1)[-1]}"
                records, size = normalise_file(name, target)
                yield pa.RecordBatch.from_pydict({"file": [target], "records": [records], "bytes": [size]})

    return staged(_spread(archives.select("file")).mapInArrow(run, "file string, records long, bytes long"), "members")


def _spread(files: DataFrame) -> DataFrame:
    return files.repartition(int(files.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def read_members(file: str) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of a normalised archive, each inflated alone from its offset."""
    system, path = filesystem(file)
    with system.open_input_stream(f"{path}.idx", compression=None) as lines:
        index = lines.read().decode().splitlines()
    with system.open_input_file(path) as archive:
        for line in index:
            start, length = map(int, line.split("\t")[:2])
            archive.seek(start)
            whole = zlib.decompress(archive.read(length), _GZIP)
            end = whole.index(_END) + 4
            fields = headers(whole[: end - 4])
            yield fields, whole[end : end + int(fields["content-length"])]


def read_pages(archives: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every record in the archives.

    A response's size and digest are those of the payload that was read; a revisit's are what its
    header lines say of the payload it refers to.
    """

    def number(name: str | None) -> int | None:
        value = (name or "").strip("<>").removeprefix(_ID)
        return int(value) if value not in ("", "None") else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
        for batch in batches:
            for file in batch.column("file").to_pylist():
                rows = []
                for fields, block in read_members(file):
                    at = block.index(_END) + 4
                    kind = fields["warc-type"]
                    size = len(block) - at if kind == "response" else int(headers(block[: at - 4])["content-length"])
                    digest = fields["warc-payload-digest"].removeprefix("sha256:")
                    if kind == "response":
                        digest = hashlib.sha256(memoryview(block)[at:]).hexdigest()
                    rows.append((number(fields["warc-record-id"]), size, digest, kind, number(fields.get("warc-refers-to"))))
                kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    kinds = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    return _spread(archives.select("file")).mapInArrow(run, kinds)
