"""SentencePiece encoding that keeps the place of every piece, and decoding.

``CharacterMap`` reads the compiled character map of a model file (a double-array trie and
its replacement strings), normalises by the longest matching prefix as the library does,
and records for every normalised byte the source byte it comes from; ``spans`` projects the
pieces onto the bytes of the original text.

Every text goes through the map, and its pieces are projected by the alignment; where the map has no
entries the alignment is made in one vectorised step. In that case, if also no piece crosses from a word
to a following space (both are read off the model), the words of a text are encoded independently: each is
encoded once by the library and its ids are kept in a bounded cache. Other models are encoded text by text.

Defined results: a null or empty text has the end id alone and decodes to the empty text;
very long texts are read whole; repeated rows give repeated results; extra columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import column, registered, text_steps
from plumbline.llm.wordbpe import CACHE_WORDS, _Cache

SPACE = "▁"


def _fields(data: bytes) -> Iterator[tuple[int, int, object]]:
    """(number, wire type, value) of the fields of a protocol-buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            b = data[at]
            at += 1
            value |= (b & 0x7F) << shift
            shift += 7
            if b < 0x80:
                return value

    while at < len(data):
        key = varint()
        number, kind = key >> 3, key & 7
        if kind == 0:
            yield number, kind, varint()
        elif kind == 1:
            at += 8
            yield number, kind, data[at - 8 : at]
        elif kind == 2:
            size = varint()
            at += size
            yield number, kind, data[at - size : at]
        elif kind == 5:
            at += 4
            yield number, kind, data[at - 4 : at]
        else:
            raise ValueError("unknown wire type")


class CharacterMap:
    """Normalisation of a model: longest-prefix replacement with source alignment.

    Fields of the normaliser's message: 2 the compiled map, 3 the dummy prefix, 4 removal of
    extra spaces, 5 the space escape.
    """

    def __init__(self, model: bytes) -> None:
        spec = next((v for n, k, v in _fields(model) if n == 3 and k == 2), b"")
        found = {n: v for n, _, v in _fields(spec)}
        compiled = found.get(2, b"")
        self.dummy_prefix, self.remove_extra, self.escape = (bool(found.get(n, 1)) for n in (3, 4, 5))
        trainer = next((v for n, k, v in _fields(model) if n == 2 and k == 2), b"")
        self.suffix = bool({n: v for n, _, v in _fields(trainer)}.get(24, 0))
        self.units: list[int] = []
        self.blob = b""
        if compiled:
            size = struct.unpack_from("<I", compiled)[0]
            self.units = list(struct.unpack_from(f"<{size // 4}I", compiled, 4))
            self.blob = compiled[4 + size :]

    def longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """Length and replacement of the longest key of the map that ``data`` has at ``at``."""
        if not self.units:
            return None
        offset = lambda u: (u >> 10) << ((u & 0x200) >> 6)
        node = offset(self.units[0])
        best = None
        for k in range(at, len(data)):
            node ^= data[k]
            if node >= len(self.units):
                break
            unit = self.units[node]
            if unit & 0x800000FF != data[k]:
                break
            node ^= offset(unit)
            if unit >> 8 & 1:
                start = self.units[node] & 0x7FFFFFFF
                best = (k + 1 - at, self.blob[start : self.blob.index(b"\0", start)])
        return best

    def normalised(self, data: bytes) -> tuple[bytes, np.ndarray]:
        """Normalised bytes of valid UTF-8, and the source byte of each of them and of the end."""
        if not self.units and not self.remove_extra and data:
            return self._copied(data)
        out, source = bytearray(), []
        space = SPACE.encode() if self.escape else b" "

        def put(piece: bytes, at: int) -> None:
            out.extend(piece)
            source.extend([at] * len(piece))

        at, end = 0, len(data)
        steps: list[tuple[bytes, int]] = []
        while at < end:
            hit = self.longest(data, at)
            if hit:
                steps.append((hit[1], at))
                at += hit[0]
                continue
            first = data[at]
            size = 1 if first < 0x80 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4
            try:
                data[at : at + size].decode()
                steps.append((data[at : at + size], at))
                at += size
            except UnicodeDecodeError:
                steps.append(("�".encode(), at))
                at += 1
        if self.remove_extra:
            while steps and not steps[0][0].strip(b" "):
                steps.pop(0)
        if not steps:
            return b"", np.array([end])
        if self.dummy_prefix and not self.suffix:
            put(space, steps[0][1])
        was_space = self.remove_extra
        for piece, place in steps:
            if was_space and self.remove_extra:
                piece = piece.lstrip(b" ")
            if piece:
                # every byte of a copied character keeps its own source byte
                same = data[place : place + len(piece)] == piece
                for k in range(len(piece)):
                    b = piece[k : k + 1]
                    put(space if b == b" " else b, place + k if same else place)
                was_space = piece.endswith(b" ")
        if self.remove_extra:
            while out.endswith(space):
                del out[-len(space) :], source[-len(space) :]
        if self.dummy_prefix and self.suffix:
            put(space, end)
        source.append(end)
        return bytes(out), np.array(source)

    def _copied(self, data: bytes) -> tuple[bytes, np.ndarray]:
        """The same where no key can match: every byte is copied, a space perhaps as its escape."""
        space = SPACE.encode() if self.escape else b" "
        source = np.arange(len(data) + 1)
        if self.escape:
            source = np.repeat(source, np.where(np.frombuffer(data + b"\0", np.uint8) == 32, len(space), 1))
        out = data.replace(b" ", space)
        if self.dummy_prefix and self.suffix:
            return out + space, np.concatenate((source[:-1], np.full(len(space) + 1, len(data))))
        if self.dummy_prefix:
            return space + out, np.concatenate((np.zeros(len(space), source.dtype), source))
        return out, source


class PieceModel:
    """A model file with its cache: ``encoded(text)`` gives ids and the source bytes that each id covers."""

    def __init__(self, path: str, cache_words: int = CACHE_WORDS) -> None:
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_file=path)
        with open(path, "rb") as f:
            model = f.read()
        self.map = CharacterMap(model)
        size = self.sp.get_piece_size()
        self.text = [self.sp.id_to_piece(i) for i in range(size)]
        self.width = [1 if self.sp.is_byte(i) else 0 if self.sp.is_control(i) else len(p.encode()) for i, p in enumerate(self.text)]
        self.widths = np.array(self.width, np.int64)
        kinds = [next((v for n, _, v in _fields(piece) if n == 3), 1) for n, k, piece in _fields(model) if n == 1 and k == 2]
        m = self.map
        self.by_word = not m.units and m.dummy_prefix and not m.remove_extra and m.escape and not m.suffix and 4 not in kinds and not any(SPACE in p.lstrip(SPACE) for p in self.text) and size <= 1 << 16 and SPACE in self.text
        self.decimal = [str(i) for i in range(size)]
        self.eos = self.sp.eos_id()
        self.words = registered(_Cache(self._word, cache_words))

    def _word(self, word: str) -> bytes:
        ids = self.sp.encode(word) if word else [self.sp.piece_to_id(SPACE)]
        return np.array(ids, "<u2").tobytes()

    def encoded(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids without the end id, and the end of each piece's bytes in the text's UTF-8 (its start is the end before)."""
        if not text:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        if not self.by_word or SPACE in text:
            return self.encoded_whole(text)
        parts = text.split(" ")
        if "" in parts:
            parts = _with_runs(parts)
        ids = np.frombuffer(b"".join(map(self.words.__getitem__, parts)), "<u2").astype(np.int64)
        _, source = self.map.normalised(text.encode())
        return ids, source[np.cumsum(self.widths[ids])]

    def encoded_whole(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """The same by the library's encoding of the whole text, projected through the map."""
        data = text.encode()
        ids = self.sp.encode(text)
        normal, source = self.map.normalised(data)
        # an unknown piece covers what its surface has: the next known piece tells how much
        ends, at = [], 0
        unknown = self.sp.unk_id()
        surfaces = self.sp.encode(text, out_type=str) if unknown in ids else None
        for k, i in enumerate(ids):
            at += self.width[i] if i != unknown else len(surfaces[k].encode())
            ends.append(source[min(at, len(normal))])
        return np.array(ids, np.int64), np.array(ends, np.int64)

    def decoded(self, ids: list[int]) -> str:
        return self.sp.decode(ids)


def _with_runs(parts: list[str]) -> list[str]:
    """Words of a text split at each space, with the spaces of a run put before the word that they precede.

    One space before a word is its prefix; a run at the end is a word of spaces.
    """
    out, empty = [], 0
    for p in parts:
        if p:
            out.append(" " * empty + p)
            empty = 0
        else:
            empty += 1
    if empty:
        out.append(" " * (empty - 1))
    return out


@functools.cache
def piece_model(path: str) -> PieceModel:
    """The model of this process for ``path``, with its cache."""
    return PieceModel(path)


def encode_decode(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Whole texts encoded with an end id and decoded again.

    Returns ``doc_id``, ``n_tokens``, ``ids_sha256`` (of the decimal ids joined by spaces), ``decoded_sha256``,
    ``spans_crc32`` (of the pieces' source ends as 32-bit integers) and ``spans_end`` (source bytes
    covered); with ``with_ids`` also ``ids`` and ``ends``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = piece_model(model)
        names = m.decimal
        for batch in batches:
            for step in text_steps(batch, "text", 1 << 20 if with_ids else 4 << 20):
                rows = []
                for text in column(step, "text").to_pylist():
                    ids, ends = m.encoded(text or "")
                    full = [*ids.tolist(), m.eos]
                    rows.append((
                        len(full),
                        hashlib.sha256(" ".join(map(names.__getitem__, full)).encode()).hexdigest(),
                        hashlib.sha256(m.decoded(full).encode()).hexdigest(),
                        zlib.crc32(ends.astype("<u4")),
                        int(ends[-1]) if len(ends) else 0,
                        *((full, ends.tolist()) if with_ids else ()),
                    ))
                kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())]
                names_out = ["n_tokens", "ids_sha256", "decoded_sha256", "spans_crc32", "spans_end", "ids", "ends"]
                columns = list(zip(*rows))
                yield pa.RecordBatch.from_arrays([column(step, "doc_id"), *(pa.array(c, k) for c, k in zip(columns, kinds))], names=["doc_id", *names_out[: len(columns)]])

    schema = f"doc_id {dict(docs.dtypes)[id_col]}, n_tokens long, ids_sha256 string, decoded_sha256 string, spans_crc32 long, spans_end long" + ", ids array<long>, ends array<long>" * with_ids
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, schema)
