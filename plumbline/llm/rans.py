"""Token-id files coded with a static range asymmetric numeral system.

One frequency table of the whole corpus is shared by all files. A block holds up to
``BLOCK`` ids in interleaved lanes: id i of a block belongs to lane i mod lanes, each
lane has its own 64-bit state, and words of 32 bits leave or enter the states of a step in
lane order, so that numpy codes all lanes of a step at once. A block decodes alone; its
checkpoints hold the states and the word position at inner steps, so that parts of
a block decode alone too; checksums guard the words and the ids.

File: magic, then the documents' table (ids and lengths), then blocks. ``FILE`` and
``BLOCK_HEAD`` give the fields. All numbers are little-endian.

Defined results: null and empty texts are documents of their end id alone; a document may
span blocks; repeated rows are written once each; an empty table gives no file.
"""

from __future__ import annotations

import io
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.common import column, dropped, file_system, scratch, text_steps, trim, written_to
from plumbline.llm.wordbpe import word_ids

MAGIC = b"PLRANS1\n"
#: magic, shard, first id's place in the corpus, documents, ids, blocks, bytes of the documents' table
FILE = struct.Struct("<8sqqqqqq")
#: ids, lanes, words, checkpoints, steps between them, crc32 of states and words, crc32 of the ids as 32-bit integers
BLOCK_HEAD = struct.Struct("<IIIIIII")
BLOCK = 1 << 19
LANES = 2048
CHECKPOINT_STEPS = 128
SCALE = 20
_LOW = np.uint64(1 << 31)


def frequencies(counts: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """Counts scaled to sum to ``2 ** scale``, every symbol at least 1."""
    total = 1 << scale
    if len(counts) > total:
        raise ValueError("more symbols than slots")
    spare = total - len(counts)
    share = counts.astype(np.float64) * (spare / max(counts.sum(), 1))
    out = np.floor(share).astype(np.int64)
    rest = spare - int(out.sum())
    if rest:
        order = np.argsort(out - share, kind="stable")
        out[np.resize(order, rest)] += 1 if rest <= len(out) else 0
        if rest > len(out):
            out += rest // len(out)
            out[: rest % len(out)] += 1
    return (out + 1).astype(np.uint32)


class Coder:
    """Encoder and decoder of blocks for one frequency table."""

    def __init__(self, freq: np.ndarray, scale: int = SCALE) -> None:
        self.scale = np.uint64(scale)
        self.freq = freq.astype(np.uint64)
        self.start = np.concatenate(([0], np.cumsum(freq[:-1], dtype=np.uint64))).astype(np.uint64)
        self.mask = np.uint64((1 << scale) - 1)
        self._symbol: np.ndarray | None = None

    @property
    def symbol(self) -> np.ndarray:
        if self._symbol is None:
            self._symbol = np.repeat(np.arange(len(self.freq), dtype=np.uint32), self.freq.astype(np.int64))
        return self._symbol

    def encode(self, ids: np.ndarray) -> bytes:
        """One block."""
        n = len(ids)
        lanes = max(1, min(LANES, n // 64))
        steps = -(-n // lanes)
        x = np.full(lanes, _LOW, np.uint64)
        out: list[np.ndarray] = []
        marks: list[tuple[np.ndarray, int]] = []
        word_count = 0
        f_all, s_all = self.freq[ids], self.start[ids]
        limit = np.uint64(1 << (31 - int(self.scale) + 32))
        for t in range(steps - 1, -1, -1):
            a, b = t * lanes, min((t + 1) * lanes, n)
            f, live = f_all[a:b], x[: b - a]
            full = live >= limit * f
            sent = live[full]
            out.append(sent.astype(np.uint32))
            word_count += len(sent)
            live[full] = sent >> np.uint64(32)
            q = live // f
            live[:] = (q << self.scale) + (live - q * f) + s_all[a:b]
            if t and t % CHECKPOINT_STEPS == 0:
                marks.append((x.copy(), word_count))
        words = np.concatenate(out[::-1]) if out else np.zeros(0, np.uint32)
        body = io.BytesIO()
        body.write(x.tobytes())
        for states, sent in marks[::-1]:
            body.write(struct.pack("<I", word_count - sent))
            body.write(states.tobytes())
        body.write(words.tobytes())
        data = body.getvalue()
        return BLOCK_HEAD.pack(n, lanes, len(words), len(marks), CHECKPOINT_STEPS, zlib.crc32(data), zlib.crc32(ids.astype("<u4"))) + data

    def decode(self, block: bytes, part: int | None = None) -> np.ndarray:
        """The ids of a block, or only those from checkpoint ``part`` (0: the block's start) to the next."""
        n, lanes, n_words, n_marks, every, check, id_check = BLOCK_HEAD.unpack_from(block)
        data = block[BLOCK_HEAD.size :]
        if zlib.crc32(data) != check:
            raise ValueError("damaged block")
        states = [(0, np.frombuffer(data, np.uint64, lanes))]
        at = 8 * lanes
        for _ in range(n_marks):
            states.append((struct.unpack_from("<I", data, at)[0], np.frombuffer(data, np.uint64, lanes, at + 4)))
            at += 4 + 8 * lanes
        words = np.frombuffer(data, "<u4", n_words, at).astype(np.uint64)
        steps = -(-n // lanes)
        first, last = (0, steps) if part is None else (part * every, min((part + 1) * every, steps))
        pos, x = states[part or 0]
        x = x.copy()
        out = np.empty(min(last * lanes, n) - first * lanes, np.uint32)
        for t in range(first, last):
            width = min(lanes, n - t * lanes)
            live = x[:width]
            slot = live & self.mask
            s = self.symbol[slot.astype(np.int64)]
            out[(t - first) * lanes : (t - first) * lanes + width] = s
            live[:] = self.freq[s] * (live >> self.scale) + slot - self.start[s]
            low = np.flatnonzero(live < _LOW)
            live[low] = (live[low] << np.uint64(32)) | words[pos : pos + len(low)]
            pos += len(low)
        if part is None and zlib.crc32(out.astype("<u4")) != id_check:
            raise ValueError("damaged ids")
        return out


def _tokenised(path: str, end_id: int, bounds: list[int]):
    """Rows of packed ids with their shard; one more row per task with its counts of ids (kind 1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trim()
        encoder = word_ids(path)
        end = np.array([end_id], encoder.dtype).tobytes()
        cuts = np.array(bounds, np.int64)
        counts = np.zeros(max(encoder.tokenizer.get_vocab_size(), end_id + 1), np.int64)
        for batch in batches:
            for step in text_steps(batch, "text"):
                ids = [encoder.packed(d or b"") + end for d in column(step, "text").to_pylist()]
                counts += np.bincount(np.frombuffer(b"".join(ids), encoder.dtype), minlength=len(counts))
                doc = column(step, "doc_id")
                low = np.iinfo(np.int64).min
                shard = np.searchsorted(cuts, doc.fill_null(low).to_numpy(), side="right")
                n = [len(x) // encoder.dtype.itemsize for x in ids]
                zero = pa.array(np.zeros(len(ids), np.int32))
                yield pa.RecordBatch.from_arrays([zero, doc, pa.array(shard.astype(np.int32)), pa.array(n, pa.int64()), pa.array(ids, pa.binary())], names=["kind", "doc_id", "shard", "n_tokens", "ids"])
        one = pa.array([1], pa.int32())
        yield pa.RecordBatch.from_arrays([one, pa.array([None], pa.int64()), one, pa.array([len(counts)], pa.int64()), pa.array([zlib.compress(counts.tobytes(), 1)], pa.binary())], names=["kind", "doc_id", "shard", "n_tokens", "ids"])

    return run


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = None
    for batch in batches:
        for data in column(batch, "ids").to_pylist():
            own = np.frombuffer(zlib.decompress(data), np.int64)
            total = own.copy() if total is None else total + own
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array([zlib.compress(total.tobytes(), 1)], pa.binary())], names=["ids"])


def file_head(shard: int, start: int, documents: int, ids: int, blocks: int, table_bytes: int) -> bytes:
    return FILE.pack(MAGIC, shard, start, documents, ids, blocks, table_bytes)


def _encoding(folder: str, freq_shared, width: str, starts: dict[int, int]):
    """Writes the file of each shard; a partition holds one shard's rows in order of id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(freq_shared.value)
        attempt = TaskContext.get().taskAttemptId()
        current, docs, sizes, blocks, held, held_n = None, [], [], [], [], 0
        files = []

        def flush(final: bool) -> None:
            nonlocal held, held_n
            while held_n >= BLOCK or final and held_n:
                ids = np.concatenate(held)
                blocks.append(coder.encode(ids[:BLOCK].astype(np.int64)))
                held = [ids[BLOCK:]]
                held_n = len(held[0])

        def close() -> None:
            nonlocal current, docs, sizes, blocks, held, held_n
            flush(True)
            ids, lengths = np.concatenate(docs), np.concatenate(sizes)
            index = zlib.compress(ids.astype("<i8").tobytes() + lengths.astype("<u4").tobytes(), 1)
            fs, top = file_system(folder)
            fs.create_dir(top, recursive=True)
            name = f"shard-{current:08d}-{attempt}.rans"
            with fs.open_output_stream(f"{top}/{name}.tmp") as f:
                f.write(file_head(current, starts[current], len(ids), int(lengths.sum()), len(blocks), len(index)))
                f.write(index)
                for b in blocks:
                    f.write(struct.pack("<I", len(b)))
                    f.write(b)
            fs.move(f"{top}/{name}.tmp", f"{top}/{name}")
            files.append((current, name, len(ids), int(lengths.sum())))
            current, docs, sizes, blocks, held, held_n = None, [], [], [], [], 0

        for batch in batches:
            shards = column(batch, "shard").to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero(np.diff(shards)) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                if current is not None and current != shards[a]:
                    close()
                current = int(shards[a])
                part = batch.slice(a, b - a)
                docs.append(column(part, "doc_id").fill_null(np.iinfo(np.int64).min).to_numpy(zero_copy_only=False))
                sizes.append(column(part, "n_tokens").to_numpy(zero_copy_only=False))
                for data in column(part, "ids").to_pylist():
                    held.append(np.frombuffer(data, width))
                    held_n += len(held[-1])
                    if held_n >= BLOCK:
                        flush(False)
        if current is not None:
            close()
        yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in files], pa.int32()), pa.array([f[1] for f in files], pa.string()), pa.array([f[2] for f in files], pa.int64()), pa.array([f[3] for f in files], pa.int64())], names=["shard", "name", "documents", "tokens"])

    return run


def write_token_files(docs: DataFrame, tokenizer: str, end_id: int, folder: str, id_col: str = "doc_id", text_col: str = "text", shard_rows: int = 20_000) -> tuple[DataFrame, np.ndarray]:
    """Write all documents in ascending id (null first) to files in ``folder``.

    A file covers a range of ids with about ``shard_rows`` documents. Returns the manifest
    (``shard, name, documents, tokens``; only files of successful tasks are in it) and the
    frequency table that the files share, which also lies in the folder as ``table.npy``.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    rows = texts.count()
    shards = max(2, -(-rows // shard_rows))
    # Bounds of the files: quantiles of the ids, one number a file.
    bounds = sorted({int(x) for x in texts.approxQuantile("doc_id", [k / shards for k in range(1, shards)], 0.2 / shards)}) if rows else []
    staged, staged_path = written_to(texts.mapInArrow(_tokenised(tokenizer, end_id, bounds), "kind int, doc_id long, shard int, n_tokens long, ids binary"), "token-ids")
    partial = staged.where("kind = 1").select("ids").coalesce(8).mapInArrow(_summed, "ids binary").collect()  # one table of the vocabulary's size each
    counts = sum((np.frombuffer(zlib.decompress(r["ids"]), np.int64) for r in partial), np.zeros(1, np.int64))
    freq = frequencies(counts)
    per_shard = {r["shard"]: r["n"] for r in staged.where("kind = 0").groupBy("shard").agg(F.sum("n_tokens").alias("n")).collect()}
    starts, at = {}, 0
    for shard in sorted(per_shard):
        starts[shard] = at
        at += per_shard[shard]
    fs, top = file_system(folder)
    fs.create_dir(top, recursive=True)
    with fs.open_output_stream(f"{top}/table.npy") as f:
        np.save(f, freq)
    width = word_ids(tokenizer).dtype.str
    ordered = staged.where("kind = 0").select("doc_id", "shard", "n_tokens", "ids").repartitionById(len(bounds) + 1, F.col("shard")).sortWithinPartitions("shard", F.asc_nulls_first("doc_id"), "ids")
    encode = _encoding(folder, spark.sparkContext.broadcast(freq), width, starts)
    manifest = ordered.mapInArrow(encode, "shard int, name string, documents long, tokens long")
    manifest, _ = written_to(manifest, "manifest")
    manifest.count()
    dropped(spark, staged_path)
    return manifest, freq


def read_file(source, coder: Coder) -> Iterator[tuple[int | None, int, np.ndarray]]:
    """(doc_id, start, ids) of each document of an open file, holding a block and a document at a time."""
    magic, _, start, n_docs, _, n_blocks, size = FILE.unpack(source.read(FILE.size))
    if magic != MAGIC:
        raise ValueError("not a token file")
    index = zlib.decompress(source.read(size))
    ids, lengths = np.frombuffer(index, "<i8", n_docs), np.frombuffer(index, "<u4", n_docs, 8 * n_docs)
    held = np.zeros(0, np.uint32)
    read = 0
    none = np.iinfo(np.int64).min
    for doc, n in zip(ids.tolist(), lengths.tolist()):
        while len(held) < n:
            (length,) = struct.unpack("<I", source.read(4))
            held = np.concatenate((held, coder.decode(source.read(length))))
            read += 1
        yield (None if doc == none else doc), start, held[:n]
        held = held[n:]
        start += n
    if read != n_blocks or len(held):
        raise ValueError("truncated file")


def read_token_files(manifest: DataFrame, folder: str, freq: np.ndarray, with_ids: bool = False) -> DataFrame:
    """Documents read back: ``doc_id, start, n_tokens, ids_crc32`` and, on demand, ``ids``."""
    shared = manifest.sparkSession.sparkContext.broadcast(freq)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(shared.value)
        fs, top = file_system(folder)
        for batch in batches:
            for name in column(batch, "name").to_pylist():
                with fs.open_input_stream(f"{top}/{name}") as f:
                    rows: list[tuple] = []
                    size = 0
                    for doc, start, ids in read_file(f, coder):
                        data = ids.astype("<u4")
                        rows.append((doc, start, len(ids), zlib.crc32(data), data.tolist() if with_ids else None))
                        size += len(ids)
                        if len(rows) >= 8192 or with_ids and size > 1 << 20:
                            yield batch_of(rows)
                            rows, size = [], 0
                    if rows:
                        yield batch_of(rows)

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows))
        arrays = [pa.array(c, pa.int64()) for c in columns[:4]] + ([pa.array(columns[4], pa.list_(pa.int64()))] if with_ids else [])
        return pa.RecordBatch.from_arrays(arrays, names=["doc_id", "start", "n_tokens", "ids_crc32", *(["ids"] if with_ids else [])])

    parts = max(2, min(4096, manifest.count()))
    return manifest.select("name").repartition(parts).mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids)


def token_folder(spark: SparkSession) -> str:
    return scratch(spark, "rans")
