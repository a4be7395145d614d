"""Web archives: a writer with deduplicated payloads and a reader that splits compressed files."""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cdclake.llm.tables import column, id_filter, numpy_column, passes, written
from cdclake.session import scratch_dir

#: Payloads of fewer bytes are always written out.
LEAST_PAYLOAD = 100
FILE_BYTES = 256 << 20
SPLIT_BYTES = 32 << 20
# Fixed values of the formats.
_MAGIC = b"\x1f\x8b\x08"
_VERSION = b"WARC/"
_REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: What one stored block of a compressed record can hold as it stands: a format's fixed value.
_STORED = 65_535
_BLOCK = 1 << 18


def _open(path: str):
    from pyarrow.fs import FileSystem

    files, local = FileSystem.from_uri(path)
    return files, local


def record_bytes(fields: dict[str, str | None], payload: bytes, digest: str, revisit: bool, date: str) -> bytes:
    """One archive record of a page as a gzip member. A revisit has the page's HTTP header, but no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": f"<{fields['record_id']}>",
        "WARC-Date": date,
        "WARC-Target-URI": None if fields["uri"] is None else quote(fields["uri"], safe="!#$%&'()*+,/:;=?@[]~"),
        "WARC-Payload-Digest": f"sha256:{digest}",
        "WARC-Refers-To": f"<{fields['refers_to']}>" if revisit else None,
        "WARC-Profile": _REVISIT_PROFILE if revisit else None,
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": str(len(block)),
    }
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items() if v is not None)
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(f"WARC/1.1\r\n{lines}\r\n".encode() + block + b"\r\n\r\n") + packer.flush()


def write_records(records: DataFrame, folder: str, date: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write rows (record_id, uri, refers_to, digest, payload) as archives; rows (path, bytes) of the files.

    Rows with ``refers_to`` are revisits. Each task writes files of its own with names used once and
    lists them when they are closed: files of failed or repeated attempts are in no list.
    """

    def write(batches):
        files, local = _open(folder)
        path, out, size = None, None, 0
        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    path, size = f"part-{uuid.uuid4().hex}.warc.gz", 0
                    out = files.open_output_stream(f"{local}/{path}", compression=None)
                data = record_bytes(row, row["payload"], row["digest"], row["refers_to"] is not None, date)
                out.write(data)
                size += len(data)
                if size >= file_bytes:
                    out.close()
                    out = None
                    yield pa.RecordBatch.from_arrays([pa.array([f"{folder}/{path}"]), pa.array([size])], names=["path", "bytes"])
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([f"{folder}/{path}"]), pa.array([size])], names=["path", "bytes"])

    files, local = _open(folder)
    files.create_dir(local, recursive=True)
    return records.select("record_id", "uri", "refers_to", "digest", "payload").mapInArrow(write, "path string, bytes long")


def record_id(page_id: Column, digest: Column) -> Column:
    """The same for rows with equal ids and payloads only."""
    return F.concat_ws(":", F.lit("urn:page"), F.coalesce(page_id.cast("string"), F.lit("none")), F.substring(digest, 1, 16))


def write_pages(
    pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", html: str = "html",
    date: str = "1970-01-01T00:00:00Z", least: int = LEAST_PAYLOAD,
) -> DataFrame:
    """Archive every page; rows (path, bytes) of the files.

    Of pages with equal payloads of at least ``least`` bytes that with the smallest id is a response, the
    others are revisits of it; smaller ones are all responses. Null html is an empty payload, a null url
    is left out. Pages without an id revisit one with an id if there is one, else they are responses.
    Repeated rows of the first page are responses each.

    Payloads are not shuffled, but for those that are not alone by a bounded filter of their digests;
    counts and smallest ids are aggregated before the shuffle, so a payload may be any share of all.
    """
    payload = F.coalesce(column(html).cast("string").cast("binary"), F.lit(b""))
    rows = pages.select(column(page_id).cast("long").alias("page_id"), column(url).cast("string").alias("uri"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    large = rows.filter(F.octet_length("payload") >= least)
    firsts = large.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1")
    key = F.conv(F.substring("digest", 1, 16), 16, -10).cast("long")
    firsts = written(firsts.select("digest", "first", key.alias("key")), "payloads")
    bits = id_filter(firsts, "key")
    own = record_id(F.col("page_id"), F.col("digest"))
    keyed = rows.withColumn("key", key).withColumn("record_id", own).withColumn("refers_to", F.lit(None).cast("string"))

    def chosen(repeated: bool):
        def rows_of(batches):
            for batch in batches:
                keep = passes(numpy_column(batch, "key"), bits)
                yield batch.filter(pa.array(keep == repeated))

        return rows_of

    names = "page_id long, uri string, payload binary, digest string, key long, record_id string, refers_to string"
    alone = keyed.mapInArrow(chosen(False), names)
    shared = keyed.mapInArrow(chosen(True), names).drop("refers_to").join(firsts.select("digest", "first"), "digest", "left")
    again = (F.octet_length("payload") >= least) & F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    shared = shared.withColumn("refers_to", F.when(again, record_id(F.col("first"), F.col("digest"))))
    files = [write_records(part, folder, date) for part in (alone, shared)]
    return written(files[0].union(files[1]), "archives")


class _Bytes:
    """Bytes of a file by position, read in blocks."""

    def __init__(self, file, size: int):
        self._file, self.size = file, size
        self._start, self._block = 0, b""

    def at(self, position: int, n: int) -> bytes:
        inside = position - self._start
        if inside < 0 or inside + n > len(self._block):
            self._file.seek(position)
            self._start, self._block = position, self._file.read(max(n, _BLOCK))
            inside = 0
        return self._block[inside : inside + n]


def _find(data: _Bytes, position: int, end: int) -> int | None:
    """The first gzip magic that begins in a range."""
    while position < end:
        block = data.at(position, min(_BLOCK, data.size - position))
        found = block.find(_MAGIC)
        if found >= 0:
            return position + found if position + found < end else None
        if len(block) < len(_MAGIC):
            return None
        position += len(block) - len(_MAGIC) + 1
    return None


def _member(data: _Bytes, position: int) -> tuple[bytes, int] | None:
    """A member that begins here and holds a record, and where it ends; None if it is none, or broken."""
    packer = zlib.decompressobj(31)
    parts: list[bytes] = []
    try:
        while not packer.eof:
            block = data.at(position, min(1 << 16, data.size - position))
            if not block:
                return None
            parts.append(packer.decompress(block))
            if parts[0] and not parts[0].startswith(_VERSION[: len(parts[0])]):
                return None
            position += len(block) - len(packer.unused_data)
    except zlib.error:
        return None
    record = b"".join(parts)
    return (record, position) if record.startswith(_VERSION) else None


def _own(data: _Bytes, position: int) -> bool | None:
    """Whether the member here belongs to the file itself; None if what follows does not tell.

    A record may hold an archive as it stands, but no more than a stored block of it in a row: a chain of
    members over more bytes, or to the end of the file, is the file's own.
    """
    first = position
    while position < data.size and position - first <= _STORED:
        member = _member(data, position) if data.at(position, 3) == _MAGIC else None
        if member is None:
            return None if position > first else False
        position = member[1]
    return True


def members(data: _Bytes, start: int, end: int) -> Iterator[tuple[int, bytes]]:
    """Offset and bytes of the records that begin in a range of a file, wherever they end.

    A range that does not begin the file looks for the first member. Where it may be one of an archive
    that a record holds, the file is read from its beginning, so every split gives the same records. After
    a broken member the scan goes on behind its first byte.
    """
    position, linked = start, start == 0
    while position < end:
        found = position if linked and data.at(position, 3) == _MAGIC else _find(data, position, end)
        if found is None:
            return
        own = True if linked else _own(data, found)
        if own is None and start > 0:
            yield from ((at, record) for at, record in members(data, 0, end) if at >= found)
            return
        member = None if own is False else _member(data, found)
        if member is None:
            position, linked = found + 1, False
            continue
        yield found, member[0]
        position, linked = member[1], True


_HEADER = re.compile(rb"([^:\r\n]+):[ \t]*([^\r\n]*)")


def parse_record(record: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields by lower-case name, and the payload: of an HTTP response what follows its header."""
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = {m[1].decode("utf-8", "replace").strip().lower(): m[2].decode("utf-8", "replace").strip() for m in _HEADER.finditer(head)}
    block = rest[: int(fields.get("content-length", "0"))] if fields.get("content-length", "0").isdigit() else b""
    if fields.get("content-type", "").startswith("application/http"):
        block = block.partition(b"\r\n\r\n")[2]
    return fields, block


_MOST_TASKS = 100_000
_RECORD = """path string, offset long, record_id string, record_type string, uri string, refers_to string,
    declared_digest string, payload_bytes long, payload_digest string, payload binary"""


def read_records(files: DataFrame, split_bytes: int = SPLIT_BYTES, payloads: bool = True) -> DataFrame:
    """The records of gzip archives given as rows (path, bytes); large files are read by several tasks.

    Tasks take ranges of files and own the records that begin in them. Columns: ``path``, ``offset``,
    ``record_id``, ``record_type``, ``uri``, ``refers_to``, ``declared_digest``; ``payload_bytes``,
    ``payload_digest`` (SHA-256) and, if wanted, ``payload`` of what the record holds. Members that are
    broken or hold no record are passed over; files without records, and no files, give no rows.
    """
    splits = files.filter("bytes > 0").select(
        "path", "bytes", F.explode(F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(split_bytes).cast("long"))).alias("start")
    ).withColumn("end", F.least(F.col("start") + split_bytes, F.col("bytes")))

    def read(batches):
        for batch in batches:
            for split in batch.to_pylist():
                files, local = _open(split["path"])
                rows, size = [], 0
                with files.open_input_file(local) as file:
                    for offset, record in members(_Bytes(file, split["bytes"]), split["start"], split["end"]):
                        fields, payload = parse_record(record)
                        rows.append((
                            split["path"], offset, fields.get("warc-record-id", "").strip("<>"), fields.get("warc-type"),
                            fields.get("warc-target-uri"), fields.get("warc-refers-to", "").strip("<>") or None,
                            fields.get("warc-payload-digest"), len(payload), hashlib.sha256(payload).hexdigest(),
                            payload if payloads else None,
                        ))
                        size += len(payload) if payloads else 500
                        if size > 4 << 20:
                            yield _batch(rows)
                            rows, size = [], 0
                yield _batch(rows)

    # A number of its own keeps adaptive execution from merging these few small rows into one task.
    tasks = min(max(1, splits.count()), _MOST_TASKS)
    return splits.repartition(tasks, "path", "start").mapInArrow(read, _RECORD)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    text, number, data = pa.string(), pa.int64(), pa.binary()
    kinds = [text, number, text, text, text, text, text, number, text, data]
    names = ["path", "offset", "record_id", "record_type", "uri", "refers_to", "declared_digest", "payload_bytes", "payload_digest", "payload"]
    columns = list(zip(*rows, strict=True)) or [[] for _ in kinds]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def resolve_revisits(records: DataFrame) -> DataFrame:
    """Give revisits the payload size and digest of the response they refer to; others stay as they are.

    A revisit whose response is not there keeps its declared digest, with a null size.
    """
    targets = records.filter("record_type = 'response'").groupBy("record_id").agg(
        F.first("payload_bytes").alias("full_bytes"), F.first("payload_digest").alias("full_digest")
    ).withColumnRenamed("record_id", "refers_to")
    revisit = F.col("record_type") == "revisit"
    declared = F.regexp_replace("declared_digest", "^sha256:", "")
    own = records.filter(~revisit | F.col("record_type").isNull())
    again = records.filter(revisit).drop("payload_bytes", "payload_digest").join(targets, "refers_to", "left")
    again = again.withColumn("payload_bytes", F.col("full_bytes")).withColumn("payload_digest", F.coalesce("full_digest", declared))
    return own.unionByName(again.select(*own.columns))


def archive_round_trip(pages: DataFrame) -> DataFrame:
    """Write pages as archives below the shared folder and read them back: a row per page."""
    folder = scratch_dir(pages.sparkSession, "warc")
    records = written(read_records(write_pages(pages, folder), payloads=False).drop("payload"), "records")
    number = lambda c: F.expr(f"try_cast(split({c}, ':')[2] AS long)")
    return resolve_revisits(records).select(
        number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", number("refers_to").alias("refers_to")
    )
