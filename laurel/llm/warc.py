"""WARC archives: a writer, and a reader that salvages what lies behind damage and logs the gaps."""

from __future__ import annotations

import base64
import hashlib
import io
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from laurel.session import stored_copy

# Fixed by the format: gzip members and version lines are what the reader looks for after damage.
MEMBER = b"\x1f\x8b\x08"
VERSION = re.compile(rb"WARC/1\.[01]\r\n")
ARCHIVE_BYTES = 64 << 20
STEP = 1 << 18
# Packed bytes that are unpacked at once.
PACKED = 1 << 15
RECORDS = (
    "path string, offset long, length long, kind string, reason string, record_id string, record_type string, url string, "
    "refers_to_id string, payload_digest string, payload_bytes long, payload binary, inner long, inner_length long"
)
_FIELDS = [x.split()[0] for x in RECORDS.split(", ")]
_SCHEMA = pa.schema([(n, {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[x.split()[1]]) for n, x in zip(_FIELDS, RECORDS.split(", "))])


def file_system(path: str):
    """Arrow file system of a folder that all executors share, and the path in it."""
    from pyarrow import fs

    if re.match(r"file:/(?!/)", path):
        path = "file://" + path.removeprefix("file:")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def with_record_types(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """(page_id, url, payload, refers_to): of equal payloads the largest page_id is the response, others refer to it.

    Payloads below `least_bytes` are all responses. A null html is an empty payload. Payloads are equal if
    their SHA-1 is; the largest id per digest is aggregated before the shuffle, and a digest that a third of
    all pages share is one side of a join that adaptive execution splits. Pages without an id refer to the
    response of their payload if there is one; pages that repeat the response's id are responses too.
    """
    payload = F.encode(F.coalesce("html", F.lit("")), "utf-8")
    own = pages.select("page_id", "url", payload.alias("payload"), F.sha1(payload).alias("digest"))
    largest = own.where(F.octet_length("payload") >= least_bytes).groupBy("digest").agg(F.max("page_id").alias("response"))
    refers = F.when(~F.col("response").eqNullSafe(F.col("page_id")), F.col("response")).alias("refers_to")
    return own.join(largest, "digest", "left").select("page_id", "url", "payload", refers)


def record_bytes(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str) -> bytes:
    """One record: an HTTP response with the payload, or a revisit that has its headers only."""
    name = f"<urn:page:{page_id}>" if page_id is not None else f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{url} {sha1_base32(payload)}')}>"
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    lines = [f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {name}", f"WARC-Date: {date}"]
    if url is not None:
        # A header is one line.
        lines.append("WARC-Target-URI: " + re.sub(r"[\r\n]", lambda m: f"%{ord(m[0]):02X}", url))
    if refers_to is not None:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    else:
        block += payload
    lines += [f"WARC-Payload-Digest: sha1:{sha1_base32(payload)}", f"WARC-Block-Digest: sha1:{sha1_base32(block)}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return b"WARC/1.1\r\n" + "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def write_archives(typed: DataFrame, folder: str, date: str = "2024-01-01T00:00:00Z", compress: bool = True) -> DataFrame:
    """Write the rows of `with_record_types` as archives below `folder`; (path, records, bytes) of each, stored.

    Every record is a gzip member of its own, or plain. A task starts a new archive at ARCHIVE_BYTES. An
    archive counts when its row is in the result: a file of a lost or repeated attempt has another name and
    is in no row.
    """

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = file_system(folder)
        system.create_dir(base, recursive=True)
        context, number = TaskContext.get(), 0
        out = name = None
        records = size = 0
        for batch in batches:
            done = []
            for row in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "payload", "refers_to"))):
                if out is None:
                    name = f"{base}/part-{context.partitionId():05d}-{context.taskAttemptId()}-{number:04d}.warc" + ".gz" * compress
                    out, number, records, size = system.open_output_stream(name, compression=None), number + 1, 0, 0
                data = record_bytes(*row, date)
                if compress:
                    packer = zlib.compressobj(3, zlib.DEFLATED, 31)
                    data = packer.compress(data) + packer.flush()
                out.write(data)
                records, size = records + 1, size + len(data)
                if size >= ARCHIVE_BYTES:
                    out.close()
                    done.append((name, records, size))
                    out = None
            yield manifest(done)
        if out is not None:
            out.close()
            yield manifest([(name, records, size)])

    def manifest(done: list) -> pa.RecordBatch:
        names, counts, sizes = zip(*done) if done else ((), (), ())
        files = [folder.rstrip("/") + "/" + n.rpartition("/")[2] for n in names]
        return pa.RecordBatch.from_arrays([pa.array(files, pa.string()), pa.array(counts, pa.int64()), pa.array(sizes, pa.int64())], names=["path", "records", "bytes"])

    return stored_copy(typed.select("page_id", "url", "payload", "refers_to").mapInArrow(written, "path string, records long, bytes long"))


class Source:
    """Bytes of a file by offset, read in steps."""

    def __init__(self, file):
        self.file, self.start, self.held = file, 0, b""
        self.size = file.size() if hasattr(file, "size") else file.seek(0, io.SEEK_END)

    def at(self, offset: int, count: int) -> bytes:
        if offset < self.start or offset + count > self.start + len(self.held):
            self.file.seek(offset)
            self.start, self.held = offset, self.file.read(max(count, STEP))
        a = offset - self.start
        return self.held[a : a + count]

    def find(self, what: re.Pattern, offset: int) -> int:
        """Offset of the next match at or behind `offset`, or the size of the file."""
        while offset < self.size:
            part = self.at(offset, STEP)
            if m := what.search(part):
                return offset + m.start()
            if offset + len(part) >= self.size:
                break
            # A match may lie across two parts.
            offset += max(1, len(part) - 16)
        return self.size


class Damaged(Exception):
    pass


def parsed_record(data: bytes) -> tuple[dict, int]:
    """Fields of the record at the start of `data` and its length; raises Damaged."""
    head, gap, _ = data.partition(b"\r\n\r\n")
    if not VERSION.match(data) or not gap:
        raise Damaged("no version line or no end of the header")
    headers = {}
    for line in head.split(b"\r\n")[1:]:
        key, colon, value = line.partition(b":")
        if not colon:
            raise Damaged("header line without a name")
        headers[key.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    if not headers.get("content-length", "").isdigit() or "warc-type" not in headers:
        raise Damaged("no type or no length")
    start, length = len(head) + 4, int(headers["content-length"])
    block = data[start : start + length]
    if len(block) < length or data[start + length : start + length + 4] != b"\r\n\r\n":
        raise Damaged("record is cut or its end is missing")
    digest = headers.get("warc-block-digest", "")
    checked = digest.startswith("sha1:")
    if checked and digest[5:] != sha1_base32(block):
        raise Damaged("block digest differs")
    http, has_http, payload = block.partition(b"\r\n\r\n")
    if not (http.startswith(b"HTTP/") and has_http):
        http, payload = b"", block
    size, own = len(payload), None
    declared = headers.get("warc-payload-digest", "").removeprefix("sha1:") or None
    if headers["warc-type"] == "revisit":
        m = re.search(rb"(?i)\ncontent-length:\s*(\d+)", http)
        size, own, payload = int(m[1]) if m else None, declared, None
    else:
        own = sha1_base32(payload)
        if declared and declared != own:
            raise Damaged("payload digest differs")
    fields = {
        "record_id": headers.get("warc-record-id"), "record_type": headers["warc-type"], "url": headers.get("warc-target-uri"),
        "refers_to_id": headers.get("warc-refers-to"), "payload_digest": own, "payload_bytes": size, "payload": payload, "checked": checked,
    }
    return fields, start + length + 4


class Member:
    """Unpacked bytes of the gzip member at `offset` of an archive, read forwards.

    Only what was asked for last is held, so the size of a member does not matter. What unpacks before an error
    is given out; `fault` then has the reason, and `after` the offset where reading ended.
    """

    def __init__(self, source: Source, offset: int):
        self.source, self.offset, self.after = source, offset, offset
        self.unpack, self.start, self.held = zlib.decompressobj(31), 0, bytearray()
        self.ended, self.fault, self.whole = False, None, None

    def _more(self) -> None:
        part = self.source.at(self.after, PACKED)
        if not part:
            self.ended, self.fault = True, "member is cut"
            return
        before = self.unpack.copy()
        try:
            self.held += self.unpack.decompress(part)
            self.after += len(part) - len(self.unpack.unused_data)
            self.ended = self.unpack.eof
        except zlib.error as e:
            # An error loses the output of its call, so the part is gone through in bytes up to there.
            self.ended, self.fault = True, f"gzip: {e}"
            for k in range(len(part)):
                try:
                    self.held += before.decompress(part[k : k + 1])
                except zlib.error:
                    self.after += k
                    break

    def at(self, offset: int, count: int) -> bytes:
        # Cut now and then only, as each cut moves the bytes behind it.
        if offset - self.start > len(self.held) // 2:
            del self.held[: offset - self.start]
            self.start = offset
        while not self.ended and self.start + len(self.held) < offset + count:
            self._more()
        a = offset - self.start
        return bytes(self.held[a : a + count])

    def find(self, what: re.Pattern, offset: int) -> int:
        """Offset of the next match at or behind `offset`, or the end of the bytes."""
        while True:
            part = self.at(offset, STEP)
            if m := what.search(part):
                return offset + m.start()
            if len(part) < STEP:
                return offset + len(part)
            # A match may lie across two parts.
            offset += STEP - 16

    def intact(self) -> bool:
        """Whether the whole member unpacks with its checksum; it is read once more for that, in parts."""
        if self.whole is None:
            probe = Member(self.source, self.offset)
            while not probe.ended:
                probe._more()
                probe.held.clear()
            self.whole = probe.fault is None
        return self.whole


def _record(bytes_of: Source | Member, offset: int, most: int) -> tuple[dict, int]:
    """Record at `offset` of unpacked bytes, and the offset behind it; raises Damaged."""
    count = 1 << 14
    while True:
        data = bytes_of.at(offset, count)
        try:
            fields, length = parsed_record(data)
            return fields, offset + length
        except Damaged:
            head, gap, _ = data.partition(b"\r\n\r\n")
            m = re.search(rb"(?i)\ncontent-length:\s*(\d+)", head)
            need = len(head) + int(m[1]) + 8 if gap and m else 2 * count
            if len(data) < count or need > most or need <= count:
                raise
            count = need


def member_rows(member: Member, most: int) -> Iterator[dict]:
    """Records of a gzip member and the gaps between them, by their offset and length in the unpacked bytes.

    A record without a digest of its own counts if the checksum of the member holds; the record at which a damaged
    member breaks off does not count. Nothing for a member without
    a record that passes, whose `fault` then has the reason.
    """
    place, lost, reason, some = 0, None, None, False
    while member.at(place, 1):
        try:
            fields, after = _record(member, place, most)
            if not fields.pop("checked") and not member.intact():
                raise Damaged("no digest, and the checksum of the member fails")
            if not member.at(after, 1) and member.fault:
                raise Damaged(member.fault)
        except Damaged as problem:
            if not some and lost is None and not b"WARC/1.".startswith(member.at(place, 7)):
                problem = Damaged("member holds no record")
            lost, reason = (place, str(problem)) if lost is None else (lost, reason)
            place = member.find(VERSION, place + 1)
            continue
        if lost is not None:
            yield {"kind": "gap", "reason": reason, "inner": lost, "inner_length": place - lost}
            lost = None
        some = True
        yield fields | {"kind": "record", "inner": place, "inner_length": after - place}
        place = after
    if lost is not None and some:
        yield {"kind": "gap", "reason": reason, "inner": lost, "inner_length": place - lost}
    if not some:
        member.fault = member.fault or reason or "member holds no record"


def salvaged(file, most: int = 1 << 30) -> Iterator[dict]:
    """Records (kind 'record') and quarantined stretches (kind 'gap') of an archive, in order.

    Each record is checked: version line, header, length, end, block and payload digests, and the gzip checksum
    of its member where it has no digest. After a failed check the reader looks for the next place where a gzip
    member or a version line begins a record that passes, logs the bytes between as a gap with the reason, and
    goes on from there. A member is read as a stream: damage inside costs the records that it meets, and the
    next version line of the unpacked bytes is looked for; records ahead of the one at which unpacking fails are kept. Rows
    of a member have its offset, and their own offset and length in its unpacked bytes (`inner`, `inner_length`);
    `length`, its bytes in the archive, stands at the member's last row and is 0 at those before. Records above
    `most` bytes are quarantined.
    """
    source, offset, lost = Source(file), 0, None
    start = re.compile(re.escape(MEMBER) + b"|" + VERSION.pattern)

    def gap(end: int) -> dict:
        return {"kind": "gap", "reason": lost[1], "offset": min(lost[0], end), "length": max(0, end - lost[0])}

    while offset < source.size:
        if source.at(offset, 3) != MEMBER:
            try:
                fields, after = _record(source, offset, most)
            except Damaged as problem:
                lost = lost or (offset, str(problem))
                offset = source.find(start, offset + 1)
                continue
            if lost:
                yield gap(offset)
            del fields["checked"]
            yield fields | {"kind": "record", "offset": offset, "length": after - offset}
            offset, lost = after, None
            continue
        member, held = Member(source, offset), None
        for row in member_rows(member, most):
            if held is None and lost:
                yield gap(offset)
                lost = None
            if held:
                yield held
            # A row waits for the next one, as the last has the length of the member.
            held = row | {"offset": offset, "length": 0}
        if held:
            yield held | {"length": member.after - offset}
        if member.fault:
            lost = lost or (member.after if held else offset, member.fault)
            # A member that is cut may have run into the next one. Version lines in front of its break are those of
            # the records that it gave, where it only stores its bytes.
            after = source.find(start if not held else re.compile(re.escape(MEMBER)), offset + 1)
            offset = source.find(start, member.after) if held and after >= member.after else after
        else:
            offset = member.after
    if lost:
        yield gap(source.size)


def archive_rows(path: str, records: int | None = None) -> Iterator[dict]:
    """Rows of `salvaged` of one archive with its path; a missing file is a gap of unknown length.

    Any other error of the store is raised, also amid the archive, as is another number of records than `records`.
    """
    system, inside = file_system(path)
    found = 0
    try:
        file = system.open_input_file(inside)
    except FileNotFoundError as problem:
        yield {"path": path, "kind": "gap", "reason": str(problem)}
    else:
        with file:
            for row in salvaged(file):
                found += row["kind"] == "record"
                yield row | {"path": path}
    if records is not None and found != records:
        raise RuntimeError(f"{path}: {found} of {records} records can be read")


def read_archives(archives: DataFrame, counted: bool = False) -> DataFrame:
    """Records and gaps of the archives in column `path`, one task for each archive; see `salvaged`.

    An archive that does not exist is a gap of unknown length. Other read errors fail the task, which Spark
    tries again. If `counted`, column `records` has the records that each archive must give, as in the result
    of `write_archives`, and any other number is an error. Nulls in `path` are left out.
    """

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = batch.column("records").to_pylist() if counted else [None] * batch.num_rows
            for path, count in zip(batch.column("path").to_pylist(), counts):
                rows, held = [], 0
                for row in archive_rows(path, count):
                    rows.append(row)
                    held += len(row.get("payload") or b"") + 500
                    if held > STEP * 16:
                        yield pa.RecordBatch.from_pylist(rows, schema=_SCHEMA)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=_SCHEMA)

    paths = archives.where("path is not null").select("path", *["records"] * counted)
    count = max(1, int(archives.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return paths.repartition(count, "path").mapInArrow(records, RECORDS)


def archive_paths(spark: SparkSession, folder: str) -> DataFrame:
    """`path` of every archive below `folder`, listed by Spark without reading their contents."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.warc*").load(folder).select("path")


def page_records(records: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of archived pages."""
    page = lambda c: F.regexp_extract(c, r"^<urn:page:(-?\d+)>$", 1).try_cast("long")
    return records.where("kind = 'record'").select(
        page("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", page("refers_to_id").alias("refers_to")
    )
