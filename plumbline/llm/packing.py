"""Best-fit packing of documents into sequences, after Martello and Toth's dominance reduction.

Only the histogram of piece lengths decides a packing: lengths are at most the
capacity, so the histogram fits the driver however many documents there are, and both
the reduction and best fit run on lengths with multiplicities. The outcome is a short list
of runs ("pieces of length s with ranks i..j go, q to a bin, to bins from b on, from offset
o"); every piece then finds its place from its rank among the pieces of its length.

Reduction: a set of one, two or three pieces that contains a piece of length s and dominates
every other set around it (an exact fit; nothing else fits; the largest partners where
no more could fit) is fixed for good. The remainder is packed best fit, longest first.

Defined results: a null or empty text is a document of its end id alone; repeated rows are
packed once each; very long documents are cut at the capacity, the last piece being shorter;
an empty table gives no sequence; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.common import column, text_steps, trim, written
from plumbline.llm.wordbpe import word_ids


@dataclass(frozen=True)
class Run:
    """``count`` pieces of ``length``, from rank ``first`` on, ``each`` to a bin from ``bin`` on, at ``offset``."""

    length: int
    first: int
    count: int
    bin: int
    each: int
    offset: int


class Packing:
    """The packing of a histogram ``counts[length]``; ``runs`` and ``bins`` are the result, ``fixed`` the bins of the reduction."""

    def __init__(self, counts: dict[int, int], capacity: int) -> None:
        self.capacity = capacity
        self.left = {s: n for s, n in counts.items() if n and 0 < s <= capacity}
        self.lengths = sorted(self.left)
        self.taken = dict.fromkeys(self.lengths, 0)
        self.runs: list[Run] = []
        self.bins = 0
        self._reduce()
        self.fixed = self.bins
        self._best_fit()

    def _use(self, s: int, n: int, first_bin: int, each: int, offset: int) -> None:
        self.runs.append(Run(s, self.taken[s], n, first_bin, each, offset))
        self.taken[s] += n
        self.left[s] -= n
        if not self.left[s]:
            del self.lengths[bisect_left(self.lengths, s)]

    def _largest(self, room: int, without: dict[int, int]) -> int | None:
        """The longest length that fits ``room`` and is still there beside the pieces in ``without``."""
        k = bisect_left(self.lengths, room + 1) - 1
        while k >= 0:
            s = self.lengths[k]
            if self.left[s] > without.get(s, 0):
                return s
            k -= 1
        return None

    def _smallest(self, number: int, above: int, without: dict[int, int]) -> list[int]:
        """The ``number`` shortest pieces longer than ``above`` beside those in ``without``."""
        out: list[int] = []
        k = bisect_left(self.lengths, above + 1)
        while k < len(self.lengths) and len(out) < number:
            s = self.lengths[k]
            out += [s] * min(number - len(out), max(0, self.left[s] - without.get(s, 0)))
            k += 1
        return out

    def dominating(self, s: int) -> list[int] | None:
        """Partners of a piece of length ``s`` in a set that dominates all others with it, or None."""
        room = self.capacity - s
        own = {s: 1}
        one = self._largest(room, own)
        if one is None:
            return []
        low = self._smallest(3, 0, own)
        if one == room or sum(low[:2]) > room or len(low) < 2:
            return [one]
        two = self._largest(room - one, {s: 1} | {one: 1 + (one == s)})
        if two is None:
            return None
        if len(low) == 3 and sum(low) <= room and one + two < room:
            return None
        if one + two == room and sum(low) <= room:
            return None  # three or more shorter ones could still do what this set does not dominate
        # A rival pair either has its shorter piece within `two`, or holds two pieces longer than `two`.
        rivals = self._smallest(2, two, own)
        if len(rivals) == 2 and sum(rivals) <= room:
            return None
        return [one, two]

    def _reduce(self) -> None:
        for s in reversed(list(self.lengths)):
            while self.left.get(s):
                partners = self.dominating(s)
                if partners is None:
                    break
                group = sorted([s, *partners], reverse=True)
                n = min(self.left[x] // group.count(x) for x in set(group))
                offset = 0
                for x in sorted(set(group), reverse=True):
                    c = group.count(x)
                    self._use(x, n * c, self.bins, c, offset)
                    offset += c * x
                self.bins += n

    def _best_fit(self) -> None:
        open_bins: dict[int, list[tuple[int, int]]] = {}  # by room left: runs of bins (first, number)
        rooms: list[int] = []

        def put(room: int, first: int, number: int) -> None:
            if room and number:
                if room not in open_bins:
                    open_bins[room] = []
                    insort(rooms, room)
                open_bins[room].append((first, number))

        for s in reversed(list(self.lengths)):
            while (todo := self.left.get(s, 0)) > 0:
                k = bisect_left(rooms, s)
                if k < len(rooms):
                    room = rooms[k]
                    first, number = open_bins[room].pop()
                    if not open_bins[room]:
                        del open_bins[room], rooms[k]
                else:
                    room, first = self.capacity, self.bins
                    number = -(-todo // (room // s))
                    self.bins += number
                each = room // s
                full = min(number, todo // each)
                if full:
                    self._use(s, full * each, first, each, self.capacity - room)
                    put(room - each * s, first, full)
                rest = todo - full * each
                if full < number and rest:
                    self._use(s, rest, first + full, rest, self.capacity - room)
                    put(room - rest * s, first + full, 1)
                    full += 1
                put(room, first + full, number - full)


#: Words of a generation of the encoder's cache here, where processes may have served other stages.
CACHE = 250_000


def _pieces(path: str, capacity: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trim()
        encoder = word_ids(path, CACHE)
        end = np.array([end_id], "<u4")
        for batch in batches:
            for step in text_steps(batch, "text"):
                row, number, start, length, crc = [], [], [], [], []
                for k, data in enumerate(column(step, "text").to_pylist()):
                    ids = np.append(np.frombuffer(encoder.packed(data or b""), encoder.dtype).astype("<u4"), end)
                    for j, a in enumerate(range(0, len(ids), capacity)):
                        part = ids[a : a + capacity]
                        row.append(k)
                        number.append(j)
                        start.append(a)
                        length.append(len(part))
                        crc.append(zlib.crc32(part))
                yield pa.RecordBatch.from_arrays(
                    [column(step, "doc_id").take(pa.array(row, pa.int64())), pa.array(number, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    return run


def _placed(runs: list[Run], base: dict[tuple[int, int], int]):
    """Adds ``sequence_id`` and ``offset`` from a piece's rank: both tables are bounded by the capacity."""
    order = sorted(runs, key=lambda r: (r.length, r.first))
    keys = np.array([(r.length << 44) + r.first for r in order], np.int64)
    first, bins, each, offset = (np.array([getattr(r, f) for r in order], np.int64) for f in ("first", "bin", "each", "offset"))
    base_keys = np.array(sorted((s << 20) + salt for s, salt in base), np.int64)
    base_first = np.array([base[int(k) >> 20, int(k) & 0xFFFFF] for k in base_keys], np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            length, salt, rn = (column(batch, c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("length", "salt", "rn"))
            rank = base_first[np.searchsorted(base_keys, (length << 20) + salt)] + rn - 1
            at = np.searchsorted(keys, (length << 44) + rank, side="right") - 1
            inside = rank - first[at]
            keep = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays(
                [*(column(batch, c) for c in keep), pa.array(bins[at] + inside // each[at]), pa.array(offset[at] + inside % each[at] * length)],
                names=[*keep, "sequence_id", "offset"],
            )

    return run


def packed(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", salts: int | None = None) -> DataFrame:
    """Every piece of every document with its place.

    Returns ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``. Full pieces are sequences
    of their own, numbered below zero; the others are numbered from 0. ``salts`` splits the
    ranking of a hot length (by default a part for each 50,000 pieces, 1024 at most).
    """
    id_type = dict(docs.dtypes)[id_col]
    schema = f"doc_id {id_type}, piece int, start long, length long, ids_crc32 long"
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    pieces = written(texts.mapInArrow(_pieces(tokenizer, capacity, end_id), schema), "pieces")
    full = pieces.where(F.col("length") == capacity).select("*", (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    part = pieces.where(F.col("length") < capacity)
    if salts is None:
        salts = max(8, min(1024, part.count() // 50_000))
    part = part.withColumn("salt", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(salts)).cast("int"))
    counts = part.groupBy("length", "salt").count().collect()  # at most capacity * salts rows
    total: dict[int, int] = {}
    base: dict[tuple[int, int], int] = {}
    for r in sorted(counts, key=lambda r: (r["length"], r["salt"])):
        base[r["length"], r["salt"]] = total.get(r["length"], 0)
        total[r["length"]] = total.get(r["length"], 0) + r["count"]
    plan = Packing(total, capacity)
    ranked = part.withColumn("rn", F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")))
    return ranked.mapInArrow(_placed(plan.runs, base), schema + ", sequence_id long, offset long").union(full)
