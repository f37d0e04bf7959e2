"""WARC archives in Zstandard: a dictionary in the leading skippable frame, one frame per record."""

from __future__ import annotations

import base64
import hashlib
import io
import re
import struct
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import binary, store
from tidemark.session import ship_package

SKIPPABLE = 0x184D2A5D
FRAME_MAGIC = b"\x28\xb5\x2f\xfd"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
LEAST_REVISIT = 1000
DICTIONARY_BYTES = 64 << 10
SAMPLES, SAMPLE_BYTES = 400, 32 << 10
ARCHIVE_BYTES = 8 << 20
BROADCAST_ROWS = 100_000
ROWS = ("page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, "
        "payload binary")


def payloads(pages: DataFrame) -> DataFrame:
    """``page_id, url, payload, payload_bytes, digest`` of ``pages(page_id, url, html)``; a null html is empty."""
    raw = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        raw.alias("payload"), F.octet_length(raw).cast("long").alias("payload_bytes"), F.sha1(raw).alias("digest"))


def with_targets(rows: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """Adds ``refers_to``: among equal payloads of at least ``least`` bytes the largest page id, for all others but that.

    Only repeated digests are looked up; while they are few they go to every task, so that payloads stay where
    they are, otherwise both sides are exchanged by digest.
    """
    repeated = rows.where(F.col("payload_bytes") >= least).groupBy("digest").agg(
        F.max("page_id").alias("target"), F.count("*").alias("n")).where("n > 1")
    repeated, _ = store(repeated.select(F.reverse("digest").alias("k"), "target"), "repeated-payloads")
    few = repeated.count() <= BROADCAST_ROWS
    joined = rows.join(F.broadcast(repeated) if few else repeated, F.reverse("digest") == F.col("k"), "left")
    other = (F.col("payload_bytes") >= least) & F.col("target").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("target"))
    return joined.select(*rows.columns, F.when(other, F.col("target")).alias("refers_to"))


def train_dictionary(rows: DataFrame, samples: int = SAMPLES, sample_bytes: int = SAMPLE_BYTES, size: int = DICTIONARY_BYTES) -> bytes:
    """A dictionary from at most ``samples`` payloads, each cut to ``sample_bytes``; empty if there is too little text."""
    import zstandard

    picked = rows.where("payload_bytes > 0").orderBy(F.xxhash64("page_id", "digest"), "digest").limit(samples)
    texts = [bytes(r["s"]) for r in picked.select(F.substring("payload", 1, sample_bytes).alias("s")).collect()]
    try:
        return zstandard.train_dictionary(size, texts).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


def _record(page_id, url, payload: bytes, digest: str, refers_to, date: str) -> bytes:
    sha = base64.b32encode(bytes.fromhex(digest)).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    place = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url) if url else f"urn:page:{page_id}"
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{page_id}>",
            f"WARC-Date: {date}", f"WARC-Target-URI: {place}", f"WARC-Payload-Digest: sha1:{sha}",
            "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {PROFILE}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _dictionary_frame(dictionary: bytes) -> bytes:
    import zstandard

    held = zstandard.ZstdCompressor(level=19).compress(dictionary) if dictionary else b""
    return struct.pack("<II", SKIPPABLE, len(held)) + held


def write_archives(pages: DataFrame, path: str, date: str = "1970-01-01T00:00:00Z", level: int = 6,
                   archive_bytes: int = ARCHIVE_BYTES) -> int:
    """Writes ``pages(page_id, url, html)`` as ``*.warc.zst`` files below ``path``; returns the number of records.

    Every task writes files of about ``archive_bytes``, each complete in itself: the dictionary, then a frame per
    record. A file gets its final name when it is complete, and the name follows from the task's number, so a
    task that runs again replaces its files with equal ones. ``path`` is a folder that all executors share.
    """
    import pyarrow.fs as pafs

    ship_package(pages.sparkSession)
    rows = payloads(pages)
    dictionary = train_dictionary(rows)
    filesystem, folder = pafs.FileSystem.from_uri(path)
    filesystem.create_dir(folder, recursive=True)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import zstandard
        from pyspark import TaskContext

        task = TaskContext.get()
        place, base = pafs.FileSystem.from_uri(path)
        # the dictionary's number is in every frame, so a reader sees when it holds another one
        shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        packer = zstandard.ZstdCompressor(level=level, dict_data=shared, write_checksum=True, write_content_size=True)
        head, made, total = _dictionary_frame(dictionary), 0, 0
        held: list[bytes] = []
        size = 0

        def close() -> None:
            nonlocal made, held, size
            name = f"part-{task.partitionId():06d}-{made:05d}.warc.zst"
            draft = f"{base}/_{name}.{task.taskAttemptId()}"
            with place.open_output_stream(draft) as out:
                out.write(head)
                for frame in held:
                    out.write(frame)
            place.move(draft, f"{base}/{name}")
            made, held, size = made + 1, [], 0

        for batch in batches:
            ids, urls, digests, targets = (batch.column(i).to_pylist() for i in (0, 1, 3, 4))
            for page_id, url, payload, digest, target in zip(ids, urls, binary(batch.column(2)), digests, targets):
                held.append(packer.compress(_record(page_id, url, payload, digest, target, date)))
                size += len(held[-1])
                total += 1
                if size >= archive_bytes:
                    close()
        if held:
            close()
        yield pa.RecordBatch.from_arrays([pa.array([total], pa.int64())], names=["records"])

    chosen = with_targets(rows).select("page_id", "url", "payload", "digest", "refers_to")
    return chosen.mapInArrow(run, "records long").agg(F.coalesce(F.sum("records"), F.lit(0))).first()[0]


def frames(archive: bytes) -> Iterator[bytes]:
    """Decoded records of an archive: the dictionary comes from the leading skippable frame, then one frame per record."""
    import zstandard

    view = memoryview(archive)
    if len(view) < 8:
        raise ValueError("no leading frame")
    magic, size = struct.unpack("<II", view[:8])
    if magic != SKIPPABLE or 8 + size > len(view):
        raise ValueError("the archive does not begin with a dictionary frame")
    raw = bytes(view[8:8 + size])
    if raw.startswith(FRAME_MAGIC):
        raw = zstandard.ZstdDecompressor().decompress(raw)
    reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw) if raw else None)
    at = 8 + size
    while at < len(view):
        one, out = reader.decompressobj(), io.BytesIO()
        while not one.eof:
            if at >= len(view):
                raise ValueError("a frame is cut off")
            part = view[at:at + (64 << 10)]
            out.write(one.decompress(part))
            at += len(part) - len(one.unused_data)
        yield out.getvalue()


def parse_record(record: bytes) -> tuple:
    """``page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload`` of a record; raises on a bad one."""
    head, gap, rest = record.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not gap or lines[0] not in ("WARC/1.0", "WARC/1.1"):
        raise ValueError("not a record")
    fields = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon or name.lower() in fields:
            raise ValueError(f"bad header {line!r}")
        fields[name.lower()] = value.strip()
    missing = {"warc-type", "warc-record-id", "warc-date", "content-length"} - fields.keys()
    if missing:
        raise ValueError(f"missing headers {sorted(missing)}")
    size = int(fields["content-length"])
    if len(rest) != size + 4 or rest[size:] != b"\r\n\r\n":
        raise ValueError("the length does not match the block")
    kind = fields["warc-type"]
    http, gap, payload = rest[:size].partition(b"\r\n\r\n")
    lengths = [h.split(b":", 1)[1] for h in http.split(b"\r\n")[1:] if h.lower().startswith(b"content-length:")]
    if not gap or not http.startswith(b"HTTP/") or len(lengths) != 1:
        raise ValueError("not an HTTP message")
    full = int(lengths[0])
    algorithm, _, value = fields.get("warc-payload-digest", "").partition(":")
    digest = base64.b32decode(value).hex() if algorithm == "sha1" else None
    target = None
    if kind == "response":
        if len(payload) != full or digest != hashlib.sha1(payload).hexdigest():
            raise ValueError("the payload does not match its length or digest")
    elif kind == "revisit":
        if payload or fields.get("warc-profile") != PROFILE or digest is None:
            raise ValueError("a revisit has a profile, a digest and no payload")
        target = _page(fields.get("warc-refers-to", ""))
    else:
        raise ValueError(f"unexpected type {kind}")
    return _page(fields["warc-record-id"]), fields.get("warc-target-uri"), full, digest, kind, target, payload


def _page(urn: str) -> int | None:
    m = re.fullmatch(r"<urn:page:(-?\d+|None)>", urn)
    if not m:
        raise ValueError(f"unexpected record id {urn!r}")
    return None if m[1] == "None" else int(m[1])


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the ``*.warc.zst`` files below ``path``, each frame decoded and checked.

    ``payload_bytes`` and ``payload_digest`` are of the full payload, also for a revisit, whose own payload is null.
    A damaged archive, header or length fails the job with its name.
    """
    ship_package(spark)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
        names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]

        def made(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

        for batch in batches:
            for name, archive in zip(batch.column(0).to_pylist(), binary(batch.column(1))):
                rows, size = [], 0
                try:
                    for record in frames(archive):
                        row = parse_record(record)
                        rows.append(row[:6] + (row[6] if row[4] == "response" else None,))
                        size += len(record)
                        if size > 16 << 20:
                            yield made(rows)
                            rows, size = [], 0
                except ValueError as problem:
                    raise ValueError(f"{name}: {problem}") from problem
                if rows:
                    yield made(rows)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(path)
    return files.select("path", "content").mapInArrow(run, ROWS)
