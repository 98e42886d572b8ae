"""WARC archives: a parallel writer with revisit records and a splittable reader.

Writer.  Each task writes its rows as one archive file of gzip members, one
member for each record, into a shared folder, and returns the file's name and
size.  A file is written under a name that no other attempt uses, and only
files of the returned list are ever read, so a repeated or lost task does no
harm.  Equal payloads (by SHA-1) of at least ``min_bytes`` become one
``response``, that of the smallest page id; the others are ``revisit`` records
of the identical-payload-digest profile, which carry no payload.

Reader.  Files are cut into byte ranges; each range is one task's work.  A task
scans its range for the gzip magic, validates each candidate by decoding the
start of the member and parsing a WARC header from it, and then reads member
after member.  It owns the records whose member starts inside its range, and
reads beyond the range's end to finish the last one.  So ranges need no index
and no agreement, and any cut gives the same records.

The archives are opened through ``pyarrow.fs``, which reads local and shared
mounts and the common object and Hadoop stores.

Defined results: a null html is an empty payload; a null url leaves out the
target address; rows without a page id are always responses and never referred
to; repeated rows with the smallest page id are all responses; an empty table
gives no records; extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airwave.llm.common import binary_texts, checkpoint_dir, stage

RANGE_BYTES = 4 << 20
READ_BYTES = 1 << 18
MAGIC = b"\x1f\x8b\x08"
STEP_BYTES = 1 << 16
EPOCH = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def digest32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_name(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def page_of(name: str | None) -> int | None:
    text = (name or "").removeprefix("<urn:page:").removesuffix(">")
    return int(text) if text else None


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC record as a gzip member."""
    kind = "response" if refers_to is None else "revisit"
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
            ).encode()
    block = http + payload if refers_to is None else http
    head = [("WARC-Type", kind), ("WARC-Record-ID", record_name(page_id)), ("WARC-Date", EPOCH)]
    if url is not None:
        # A line break inside an address would end the header line.
        head.append(("WARC-Target-URI", url.replace("\r", "%0D").replace("\n", "%0A")))
    head.append(("WARC-Payload-Digest", f"sha1:{digest}"))
    if refers_to is not None:
        head += [("WARC-Refers-To", record_name(refers_to)), ("WARC-Profile", PROFILE)]
    head += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    text = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head) + "\r\n"
    packer = zlib.compressobj(3, zlib.DEFLATED, 31)
    return packer.compress(text.encode("utf-8", "surrogatepass") + block + b"\r\n\r\n") + packer.flush()


def parse_head(data: bytes) -> tuple[dict, int] | None:
    """WARC header fields (lower-case names) and the block's offset, or None if this is no whole WARC header."""
    end = data.find(b"\r\n\r\n")
    if not data.startswith(b"WARC/1.") or end < 0:
        return None
    fields = {}
    for line in data[:end].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            return None
        fields[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "surrogatepass")
    if not {"warc-type", "warc-record-id"} <= fields.keys() or not fields.get("content-length", "").isdigit():
        return None
    return fields, end + 4


class Tape:
    """Reads a file forward from any offset, keeping only what is still needed."""

    def __init__(self, file, size: int):
        self.file, self.size, self.at, self.data = file, size, 0, b""

    def seek(self, at: int) -> None:
        if self.at <= at <= self.at + len(self.data):
            self.data = self.data[at - self.at:]
        else:
            self.data = b""
        self.at = at

    def more(self, n: int = READ_BYTES) -> bytes:
        """Append the next bytes to what is held; empty at the end of the file."""
        got = self.file.read_at(min(n, max(0, self.size - self.at - len(self.data))), self.at + len(self.data))
        self.data += got
        return got


def member_head(tape: Tape) -> bool:
    """Whether a gzip member with a WARC header starts at the tape's place."""
    unpack, plain, fed, rest = zlib.decompressobj(31), bytearray(), 0, b""
    while True:
        if not rest:
            if len(tape.data) == fed and not tape.more():
                return False
            rest = tape.data[fed:fed + 4096]
            fed += len(rest)
        try:
            more = unpack.decompress(rest, STEP_BYTES)
        except zlib.error:
            return False
        rest = unpack.unconsumed_tail
        behind = max(0, len(plain) - 3)
        plain += more
        if not b"WARC/1.".startswith(plain[:7]):
            return False
        # The header may be of any length, so only its end, or the member's, decides.
        if plain.find(b"\r\n\r\n", behind) >= 0:
            return parse_head(bytes(plain)) is not None
        if unpack.eof:
            return False


def member(tape: Tape) -> tuple[bytes, int]:
    """The whole member at the tape's place, and the offset behind it."""
    unpack, parts, at = zlib.decompressobj(31), [], tape.at
    while not unpack.eof:
        if not tape.data and not tape.more():
            raise EOFError(f"the member at {at} is cut off")
        parts.append(unpack.decompress(tape.data))
        used = len(tape.data) - len(unpack.unused_data)
        tape.seek(tape.at + used)
    return b"".join(parts), tape.at


def records(file, size: int, start: int, stop: int) -> Iterator[tuple[int, bytes]]:
    """(offset, record) of all records that start in [start, stop)."""
    tape = Tape(file, size)
    tape.seek(start)
    synced = False
    while tape.at < stop:
        if len(tape.data) < len(MAGIC) and not tape.more():
            return
        if not synced:
            found = tape.data.find(MAGIC)
            if found < 0:
                tape.seek(tape.at + max(1, len(tape.data) - len(MAGIC) + 1))
                continue
            tape.seek(tape.at + found)
            if tape.at >= stop:
                return
            if not member_head(tape):
                tape.seek(tape.at + 1)
                continue
            synced = True
        at = tape.at
        data, behind = member(tape)
        if parse_head(data):
            yield at, data
        if behind < stop:
            if len(tape.data) < len(MAGIC):
                tape.more()
            synced = tape.data.startswith(MAGIC)


def with_referrals(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(page_id, url, html binary, digest string, refers_to): decide which rows are revisits."""
    def marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([hashlib.sha1(t or b"").digest() for t in binary_texts(b.column(1))]),
                 pa.array([len(t or b"") for t in binary_texts(b.column(1))], pa.int64())],
                names=["page_id", "sha", "n"])

    seen = pages.select("page_id", "html").mapInArrow(marks, "page_id long, sha binary, n long")
    seen = stage(seen.where((F.col("n") >= min_bytes) & F.col("page_id").isNotNull()))
    first = seen.groupBy("sha").agg(F.min("page_id").alias("refers_to"), F.max("page_id").alias("last")).where(
        "refers_to < last")
    again = seen.join(first.select("sha", "refers_to"), "sha").where("page_id > refers_to").select(
        "page_id", F.col("sha").alias("again_sha"), "refers_to").distinct()
    # Two rows may share an id and differ in payload, so the referral is looked up by id and digest.
    return pages.join(again.groupBy("page_id").agg(F.map_from_entries(
        F.collect_list(F.struct("again_sha", "refers_to"))).alias("referrals")), "page_id", "left")


def write(pages: DataFrame, folder: str, min_bytes: int = 0) -> DataFrame:
    """Write one record per row of (page_id long, url, html); returns (path, size, n_records), one row per file.

    The list is itself written to the shared folder before it is returned, so
    reading it again never writes again.
    """
    store, root = fs.FileSystem.from_uri(folder)
    store.create_dir(root, recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, n, out = None, 0, None
        for b in batches:
            for page_id, url, html, referrals in zip(b.column(0).to_pylist(), b.column(1).to_pylist(),
                                                     binary_texts(b.column(2)), b.column(3).to_pylist()):
                if out is None:
                    place, base = fs.FileSystem.from_uri(folder)
                    name = f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.warc.gz"
                    out = place.open_output_stream(f"{base}/{name}", compression=None)
                payload = html or b""
                sha = hashlib.sha1(payload).digest()
                out.write(record(page_id, url, payload, base64.b32encode(sha).decode(),
                                 dict(referrals or ()).get(sha)))
                n += 1
        if out is not None:
            size = out.tell()
            out.close()
            yield pa.RecordBatch.from_pylist([{"path": f"{folder}/{name}", "size": size, "n_records": n}])

    rows = with_referrals(pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html"), min_bytes)
    return stage(rows.select("page_id", "url", "html", "referrals").mapInArrow(
        run, "path string, size long, n_records long"))


def read(files: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(path, offset, page_id, url, record_type, payload_digest, refers_to, payload_bytes, payload) of all records.

    ``files`` holds (path, size).  The payload of a revisit is null; its length
    is the one its HTTP header states.  The digest of a response is computed
    from the payload and must equal the header's.
    """
    ranges = files.select("path", "size", F.explode(F.sequence(F.lit(0), F.greatest(F.lit(0), F.col("size") - 1),
                                                               F.lit(range_bytes))).alias("start"))
    spark = files.sparkSession
    n = ranges.count()
    spread = ranges.repartition(max(1, min(n, 4 * spark.sparkContext.defaultParallelism + n // 16)), "path", "start")
    kind = ("path string, offset long, page_id long, url string, record_type string, payload_digest string, "
            "refers_to long, payload_bytes long, payload binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, size, start in zip(*(c.to_pylist() for c in b.columns)):
                place, inner = fs.FileSystem.from_uri(path)
                with place.open_input_file(inner) as file:
                    rows, held = [], 0
                    for at, data in records(file, size, start, min(size, start + range_bytes)):
                        rows.append(parsed(path, at, data))
                        held += len(data)
                        if held > RANGE_BYTES:
                            yield batch_of(rows)
                            rows, held = [], 0
                    if rows:
                        yield batch_of(rows)

    return spread.mapInArrow(run, kind)


FIELDS = pa.schema([("path", pa.string()), ("offset", pa.int64()), ("page_id", pa.int64()), ("url", pa.string()),
                    ("record_type", pa.string()), ("payload_digest", pa.string()), ("refers_to", pa.int64()),
                    ("payload_bytes", pa.int64()), ("payload", pa.binary())])


def batch_of(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=FIELDS)


def parsed(path: str, at: int, data: bytes) -> dict:
    fields, begin = parse_head(data)
    block = data[begin:begin + int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    revisit = fields["warc-type"] == "revisit"
    stated = next((int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")), 0)
    digest = fields.get("warc-payload-digest", "").removeprefix("sha1:")
    if not revisit and digest32(payload) != digest:
        raise ValueError(f"digest of the record at {at} of {path} does not match its payload")
    return {"path": path, "offset": at, "page_id": page_of(fields["warc-record-id"]),
            "url": fields.get("warc-target-uri"), "record_type": fields["warc-type"], "payload_digest": digest,
            "refers_to": page_of(fields.get("warc-refers-to")), "payload_bytes": stated if revisit else len(payload),
            "payload": None if revisit else payload}


def archive_folder(spark: SparkSession) -> str:
    """A fresh folder for archives under the shared checkpoint folder."""
    return f"{checkpoint_dir(spark)}/warc-{uuid.uuid4().hex}"
