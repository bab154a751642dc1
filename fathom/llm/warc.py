"""WARC archives: writing one gzip member per record, and a reader that splits files anywhere."""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fathom.llm.common import work_folder, written

MAGIC = b"\x1f\x8b\x08"
#: Payloads below this many bytes are always written whole.
LEAST_REVISIT = 100
#: Bytes of a file that one reading task owns, and of one read.
SPLIT_BYTES = 8 << 20
READ_BYTES = 1 << 20
#: An archive file ends once it has this many bytes.
FILE_BYTES = 64 << 20


def open_store(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a URI or local path, as tasks open it."""
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


# ---------------------------------------------------------------- writing


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, response: bool, refers_to: int | None) -> bytes:
    """One record as a gzip member. A revisit has no payload, but its length and digest."""
    clean = (url or "").replace("\r", " ").replace("\n", " ")
    ident = "null" if page_id is None else str(page_id)
    lines = ["WARC/1.1", f"WARC-Type: {'response' if response else 'revisit'}", f"WARC-Record-ID: <urn:page:{ident}>", f"WARC-Target-URI: {clean}", "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha256:{digest}", f"Payload-Length: {len(payload)}"]
    if not response:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    body = payload if response else b""
    lines.append(f"Content-Length: {len(body)}")
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(lines).encode("utf-8") + b"\r\n\r\n" + body + b"\r\n\r\n") + packer.flush()


def with_types(pages: DataFrame) -> DataFrame:
    """Adds payload_digest, record_type and refers_to to pages (page_id, url, html).

    The first of equal payloads is found by a grouped minimum over (digest, page_id) alone; a digest that stands once
    never joins, so the join carries copies only and Spark can split a hot one.
    """
    payload = F.coalesce("html", F.lit(""))
    base = pages.select(pages["page_id"].cast("long").alias("page_id"), "url", payload.alias("html"), F.sha2(payload, 256).alias("payload_digest"))
    first = base.where(F.octet_length("html") >= LEAST_REVISIT).groupBy("payload_digest").agg(F.min("page_id").alias("first_id"), F.count("*").alias("n")).where("n > 1 and first_id is not null").drop("n")
    revisit = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return base.join(first, "payload_digest", "left").select(
        "page_id", "url", "html", "payload_digest", F.when(revisit, "revisit").otherwise("response").alias("record_type"), F.when(revisit, F.col("first_id")).alias("refers_to")
    )


def write_warc(pages: DataFrame, folder: str) -> DataFrame:
    """Writes a record per row of `pages` (page_id, url, html) to archives in `folder`; returns the manifest (path, bytes, records).

    Each task attempt writes files of its own name and only those of the attempt that Spark accepts are in the
    manifest, so attempts that were lost or repeated do no harm. Null html is an empty payload; a null page_id is kept;
    rows of equal page_id and payload are all response if that page_id is the smallest.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = open_store(folder)
        store.create_dir(base, recursive=True)
        found: list[tuple[str, int, int]] = []
        out, name, size, n = None, "", 0, 0
        for batch in batches:
            for page_id, url, html, digest, kind, refers_to in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if out is None:
                    name, size, n = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = store.open_output_stream(f"{base}/{name}", compression=None)
                data = record(page_id, url, html.encode("utf-8"), digest, kind == "response", refers_to)
                out.write(data)
                size += len(data)
                n += 1
                if size >= FILE_BYTES:
                    out.close()
                    found.append((f"{folder}/{name}", size, n))
                    out = None
        if out is not None:
            out.close()
            found.append((f"{folder}/{name}", size, n))
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.int64()), pa.array([x[2] for x in found], pa.int64())], names=["path", "bytes", "records"])

    return written(with_types(pages).mapInArrow(run, "path string, bytes long, records long"), "manifest")


# ---------------------------------------------------------------- reading


class _Window:
    """A file from `start` on, read on demand; what is before `keep` is let go."""

    def __init__(self, source: pa.NativeFile, start: int, size: int):
        self.source, self.base, self.size, self.data = source, start, size, b""

    def more(self) -> bool:
        at = self.base + len(self.data)
        if at >= self.size:
            return False
        self.source.seek(at)
        self.data += self.source.read(min(READ_BYTES, self.size - at))
        return True

    def at(self, position: int, n: int) -> bytes:
        while self.base + len(self.data) < position + n and self.more():
            pass
        return self.data[position - self.base : position - self.base + n]

    def keep(self, position: int) -> None:
        self.data = self.data[position - self.base :]
        self.base = position

    def find(self, what: bytes, position: int, end: int) -> int:
        """First place of `what` from position on that is below end, or -1."""
        while True:
            i = self.data.find(what, position - self.base)
            if i >= 0:
                return self.base + i if self.base + i < end else -1
            position = max(position, self.base + len(self.data) - len(what) + 1)
            if position >= end or not self.more():
                return -1


def _member(window: _Window, at: int) -> tuple[bytes, int] | None:
    """The decoded member that starts at `at` and where it ends, or None if none with a WARC header does."""
    unpack = zlib.decompressobj(31)
    out: list[bytes] = []
    head, position = b"", at
    try:
        while not unpack.eof:
            piece = window.at(position, READ_BYTES // 4)
            if not piece:
                return None
            data = unpack.decompress(piece)
            position += len(piece)
            if len(head) < 5:
                head += data[:5]
                if len(head) >= 5 and head[:5] != b"WARC/":
                    return None
            out.append(data)
    except zlib.error:
        return None
    position -= len(unpack.unused_data)
    follows = window.at(position, 3)
    return (b"".join(out), position) if head[:5] == b"WARC/" and follows in (b"", MAGIC) else None


def records_in(source: pa.NativeFile, size: int, start: int, end: int) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and content of the records that start in [start, end); the last one is read beyond the end.

    Members follow each other without a gap, so a damaged one is noticed, by the split of the record before it even
    where it starts in the next split, and raises an error: no record is lost silently.
    """
    window = _Window(source, start, size)
    at, due = start, 0 if start == 0 else None  # where the next record must start, once one is known

    def damaged() -> ValueError:
        return ValueError(f"no readable record where one must start, at byte {due}")

    while at < end:
        at = window.find(MAGIC, at, end)
        if at < 0:
            if due is not None and due < end:
                raise damaged()
            return
        found = _member(window, at)
        if due is not None and (at != due or found is None):
            raise damaged()
        if found is None:
            at += 1
            continue
        data, at = found
        due = at
        head, _, rest = data.partition(b"\r\n\r\n")
        fields = dict(x.split(": ", 1) for x in head.decode("utf-8").split("\r\n")[1:] if ": " in x)
        yield fields, rest[: int(fields["Content-Length"])]
        window.keep(min(at, window.base + len(window.data)))
    if due is not None and due < size and _member(window, due) is None:
        raise damaged()


READ_SCHEMA = "page_id long, url string, record_type string, payload binary, payload_bytes long, payload_digest string, refers_to long"


def read_warc(spark: SparkSession, files: DataFrame, split_bytes: int = SPLIT_BYTES, payload: bool = True) -> DataFrame:
    """Records of the archives in `files` (path string, bytes long), read in splits of `split_bytes` that need no index.

    A split looks for the gzip magic from its first byte on, tries each candidate by decoding its header, checksum and
    what follows it, and owns the records that start inside it. The columns are READ_SCHEMA's; payload is null for
    revisits (and with payload=False). A response whose payload does not have its digest raises an error, as does a
    damaged or cut off archive.
    """
    starts = F.explode(F.expr(f"sequence(0L, greatest(0L, bytes - 1), {int(split_bytes)}L)"))
    splits = files.where("bytes > 0").select("path", "bytes", starts.alias("start"))

    def number(text: str | None) -> int | None:
        found = (text or "").removeprefix("<urn:page:").removesuffix(">")
        return int(found) if found not in ("", "null", "None") else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.string(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.int64()]
        names = [x.split()[0] for x in READ_SCHEMA.split(", ")]
        full = lambda rows: pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True) if rows else [[]] * 7, kinds, strict=True)], names=names)
        for batch in batches:
            for path, size, start in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                store, name = open_store(path)
                rows, held = [], 0
                with store.open_input_file(name) as source:
                    for fields, body in records_in(source, size, start, min(size, start + split_bytes)):
                        digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
                        response = fields["WARC-Type"] == "response"
                        if response and hashlib.sha256(body).hexdigest() != digest:
                            raise ValueError(f"payload of {fields['WARC-Record-ID']} in {path} does not have its digest")
                        rows.append((number(fields["WARC-Record-ID"]), fields["WARC-Target-URI"], fields["WARC-Type"], body if response and payload else None, len(body) if response else int(fields["Payload-Length"]), digest, number(fields.get("WARC-Refers-To"))))
                        held += len(body) if payload else 100
                        if held > READ_BYTES:
                            yield full(rows)
                            rows, held = [], 0
                yield full(rows)

    tasks = max(1, spark.sparkContext.defaultParallelism)
    return splits.repartition(tasks * 2).mapInArrow(run, READ_SCHEMA)


def round_trip(pages: DataFrame) -> DataFrame:
    """Writes `pages` as archives in the work folder and reads them back: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    spark = pages.sparkSession
    files = write_warc(pages, f"{work_folder(spark)}/warc-{uuid.uuid4().hex}")
    return read_warc(spark, files, payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
