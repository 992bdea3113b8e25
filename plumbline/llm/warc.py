"""WARC archives: records written with revisits, and transactions assembled from them.

Each capture is written as a request, a response or revisit, and a metadata record; request and
metadata name the response in WARC-Concurrent-To. Archives are gzip files with a member a
record. Reading streams the records; captures are assembled by joining the three kinds through
their concurrent-to identifiers into one nested row.

Of captures with equal payloads of at least ``revisit_from`` bytes, the one with the smallest id is
the response and the others revisit it.

A capture is named by its id, url and payload digest; rows alike in all three are one capture that was
written several times, and are read back as so many transactions.

Defined results: a null payload is empty; a null url has no target header and reads back null; a null
id is always a response; repeated rows of the smallest id are all responses, and a revisit names the one with the least
url (null first); an empty table writes no record; extra columns are ignored. Line ends in a url are percent-encoded in its header.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import column, file_system, salted_join, tables, text_steps, written

DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SPACE = uuid.UUID("6f2b8a52-6c0e-4e0f-9a41-0d7c9d4b2f10")
#: Compressed bytes after which an archive is closed and the next begun.
ARCHIVE_BYTES = 64 << 20


def record_id(kind: str, capture: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(SPACE, f'{kind}:{capture}')}>"


def capture_name(page: int, url: str | None, digest: str) -> str:
    return f"{page}|{digest}|{'' if url is None else f'+{url}'}"


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(kind: str, headers: dict[str, str | None], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in headers.items() if v is not None)
    return f"WARC/1.1\r\nWARC-Type: {kind}\r\n{head}Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"


def capture_records(capture: str, page: int | None, url: str | None, payload: bytes, digest: str, refers_to: str | None) -> list[bytes]:
    """The records of one capture; ``refers_to`` is the capture that this one revisits."""
    target = url.replace("\r", "%0D").replace("\n", "%0A") if url is not None else None
    kind = "response" if refers_to is None else "revisit"
    own = record_id("response", capture)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    main = {
        "WARC-Record-ID": own, "WARC-Date": DATE, "WARC-Target-URI": target, "WARC-Payload-Digest": f"sha1:{digest}",
        "WARC-Profile": PROFILE if refers_to else None, "WARC-Refers-To": record_id("response", refers_to) if refers_to else None, "Content-Type": "application/http; msgtype=response",
    }
    side = lambda name, mime: {"WARC-Record-ID": record_id(name, capture), "WARC-Date": DATE, "WARC-Target-URI": target, "WARC-Concurrent-To": own, "Content-Type": mime}
    asked = f"GET {target or '/'} HTTP/1.1\r\n\r\n".encode()
    about = f"page-id: {'' if page is None else page}\r\n".encode()
    return [
        record("request", side("request", "application/http; msgtype=request"), asked),
        record(kind, main, http if refers_to else http + payload),
        record("metadata", side("metadata", "application/warc-fields"), about),
    ]


def _writing(folder: str, level: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, top = file_system(folder)
        fs.create_dir(top, recursive=True)
        context = TaskContext.get()
        stem = f"part-{context.partitionId():06d}-{context.taskAttemptId()}"
        files: list[list] = []
        out, name, size, row = None, "", 0, 0

        def close() -> None:
            out.close()
            fs.move(f"{top}/{name}.tmp", f"{top}/{name}")
            files[-1][2] = size

        for batch in batches:
            for step in text_steps(batch, "payload"):
                for page, url, payload, digest, first, first_url in zip(*(column(step, c).to_pylist() for c in ("page_id", "url", "payload", "digest", "first_id", "first_url"))):
                    if out is None:
                        name, size = f"{stem}-{len(files):04d}.warc.gz", 0
                        out = fs.open_output_stream(f"{top}/{name}.tmp", compression=None)
                        files.append([name, 0, 0])
                    # rows without an id are told apart by their place
                    capture = capture_name(page, url, digest) if page is not None else f"none-{stem}-{row}"
                    for data in capture_records(capture, page, url, payload, base64.b32encode(bytes.fromhex(digest)).decode(), None if first is None else capture_name(first, first_url, digest)):
                        z = zlib.compressobj(level, zlib.DEFLATED, 31)
                        data = z.compress(data) + z.flush()
                        out.write(data)
                        size += len(data)
                        files[-1][1] += 1
                    row += 1
                    if size >= ARCHIVE_BYTES:
                        close()
                        out = None
        if out is not None:
            close()
        yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in files], pa.string()), pa.array([f[1] for f in files], pa.int64()), pa.array([f[2] for f in files], pa.int64())], names=["name", "records", "bytes"])

    return run


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", revisit_from: int = 0, level: int = 6) -> DataFrame:
    """Write all captures; returns the manifest (``name, records, bytes``) of the finished archives.

    Equal payloads meet as digests; a digest with many pages is dealt in parts. Payloads move only if
    the revisits are too many to be broadcast.
    """
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.coalesce(F.col(payload_col).cast("binary"), F.lit(b"")).alias("payload")).withColumn("digest", F.sha1("payload"))
    with tables(pages.sparkSession) as keep:
        slim = written(rows.where((F.octet_length("payload") >= revisit_from) & F.col("page_id").isNotNull()).select("page_id", "url", "digest"), "digests")
        firsts = slim.groupBy("digest").agg(F.min(F.struct("page_id", "url")).alias("first"), F.max("page_id").alias("last_id"), F.count("*").alias("weight")).where("first.page_id < last_id")
        firsts = written(firsts.selectExpr("digest", "first.page_id AS first_id", "first.url AS first_url", "weight"), "firsts")
        revisits = salted_join(slim.select("page_id", "digest"), firsts.drop("weight"), "digest", "page_id", slim.count(), firsts.select("digest", "weight")).where("page_id > first_id")
        revisits = written(revisits.select("page_id", "digest", "first_id", "first_url").distinct(), "revisits")
        known = rows.join(revisits, ["page_id", "digest"], "left").select("page_id", "url", "payload", "digest", "first_id", "first_url")
        manifest = written(known.mapInArrow(_writing(folder, level), "name string, records long, bytes long"), "warc-manifest")
        keep(manifest)
    return manifest


def read_records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record of an open, decompressed archive."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError("not a WARC record")
        headers: dict[str, str] = {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            key, _, value = line.decode().partition(":")
            headers[key.strip().lower()] = value.strip()
        size = int(headers["content-length"])
        block = stream.read(size)
        if len(block) != size or stream.read(4) != b"\r\n\r\n":
            raise ValueError("truncated record")
        yield headers, block


RECORDS = "record_id string, kind string, concurrent_to string, target string, refers_to string, declared string, digest string, payload_bytes long, page_id long"


def _reading(folder: str, with_payload: bool):
    names = [f.split()[0] for f in RECORDS.split(", ")] + ["payload"] * with_payload

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, top = file_system(folder)
        for batch in batches:
            for name in column(batch, "name").to_pylist():
                rows, held = [], 0
                with fs.open_input_stream(f"{top}/{name}", compression=None) as raw, gzip.GzipFile(fileobj=raw) as f:
                    for h, block in read_records(f):
                        kind = h["warc-type"]
                        digest = size = page = payload = None
                        if kind in ("response", "revisit"):
                            head, _, payload = block.partition(b"\r\n\r\n")
                            size = next(int(x.split(b":")[1]) for x in head.split(b"\r\n") if x.lower().startswith(b"content-length:"))
                            if kind == "response":
                                digest = base32_sha1(payload)
                                if len(payload) != size or h["warc-payload-digest"] != f"sha1:{digest}":
                                    raise ValueError("damaged payload")
                        elif kind == "metadata":
                            value = block.split(b":", 1)[1].strip()
                            page = int(value) if value else None
                        rows.append((h["warc-record-id"], kind, h.get("warc-concurrent-to"), h.get("warc-target-uri"), h.get("warc-refers-to"), h.get("warc-payload-digest", "sha1:")[5:] or None, digest, size, page, *([payload] if with_payload else [])))
                        held += len(block) if with_payload else 200
                        if held > 4 << 20:
                            yield _batch(rows, names)
                            rows, held = [], 0
                if rows:
                    yield _batch(rows, names)

    return run


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = [pa.string()] * 7 + [pa.int64(), pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def read_archives(manifest: DataFrame, folder: str, with_payload: bool = False) -> DataFrame:
    """All records of the manifest's archives, a row each."""
    parts = max(2, min(10_000, manifest.count()))
    return manifest.select("name").repartition(parts).mapInArrow(_reading(folder, with_payload), RECORDS + ", payload binary" * with_payload)


def transactions(records: DataFrame) -> DataFrame:
    """One nested row per capture.

    Returns ``capture_id`` and the structs ``request``, ``response`` (or revisit) and ``metadata``, with
    ``response.refers_page`` the id of the page whose response a revisit names (null if its record is not there).
    """
    extra = [c for c in ("payload",) if c in records.columns]
    # Records of one id are copies of one record: they are counted, joined once and given back as often.
    own = [c for c in records.columns if c not in ("record_id", "page_id", *extra)]
    main = records.where("kind in ('response', 'revisit')").groupBy(F.col("record_id").alias("capture_id"), *own).agg(F.count("*").alias("copies"), *(F.first(c).alias(c) for c in extra))
    side = lambda kind, name: records.where(F.col("kind") == kind).select(F.col("concurrent_to").alias("capture_id"), F.struct("record_id", "target", "page_id").alias(name)).dropDuplicates(["capture_id"])
    captures = main.join(side("request", "request"), "capture_id", "left").join(side("metadata", "metadata"), "capture_id", "left")
    # Only revisits look for the page that they refer to; a response with many revisits is dealt in parts.
    revisits = records.where("refers_to IS NOT NULL")
    pages = records.where("kind = 'metadata'").select(F.col("concurrent_to").alias("refers_to"), F.col("page_id").alias("refers_page")).dropDuplicates(["refers_to"])
    known = salted_join(captures.where("refers_to IS NOT NULL"), pages.join(revisits.select("refers_to").distinct(), "refers_to", "left_semi"), "refers_to", "capture_id", revisits.count(), revisits.groupBy("refers_to").agg(F.count("*").alias("weight")), how="left")
    rest = captures.where("refers_to IS NULL").withColumn("refers_page", F.lit(None).cast("long"))
    every = rest.unionByName(known).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return every.select("capture_id", "request", F.struct("kind", "target", "refers_to", "declared", "digest", "payload_bytes", "refers_page", *extra).alias("response"), "metadata")
