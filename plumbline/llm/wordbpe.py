"""Exact token ids of a Hugging Face tokenizer file, cached word by word.

White space ends every pre-token of the supported kind of file (NFC, white space to
a space, lower case; split at letters, digits and symbols; byte-level BPE with word
ends), so the ids of a text are those of its words in order. Words are encoded once
by the tokenizers library and kept in a bounded cache as packed little-endian integers,
so that a text is one join of cached bytes. Any other file is encoded text by text.
"""

from __future__ import annotations

import functools
import json
from array import array

import numpy as np
import regex

from plumbline.llm.common import registered

#: Words of a generation of the cache; two generations are kept at most.
CACHE_WORDS = 600_000

#: Characters that normalisation only lowers: printable ASCII and Latin-1 without its spaces.
_PLAIN = regex.compile(r"[!-~¡-ÿ]+")


class _Cache(dict):
    """Values made on demand. When a generation is full it becomes the old one, from which entries in use return."""

    def __init__(self, make, limit: int) -> None:
        super().__init__()
        self.make, self.limit, self.old = make, limit, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable Latin-1 stands for itself, other bytes for 256 and up in order."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + k) for k, b in enumerate(rest)}


class WordIds:
    """``packed(text_bytes)`` gives a text's ids as packed integers of ``dtype``."""

    def __init__(self, path: str, cache_words: int = CACHE_WORDS) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        with open(path, encoding="utf-8") as f:
            config = json.load(f)
        pattern = self._pattern(config)
        self.by_word = pattern is not None
        self.split = regex.compile(pattern) if pattern else None
        self.letters = _byte_letters()
        self.words = registered(_Cache(self._word, cache_words))
        self.pieces = registered(_Cache(self._piece, cache_words // 2))
        self.model, self.typecode = self.tokenizer.model, "H" if self.dtype.itemsize == 2 else "I"
        self.specials = [t["content"] for t in config.get("added_tokens") or []]

    @staticmethod
    def _pattern(config: dict) -> str | None:
        """The split pattern, if the file is of the kind whose words are independent."""
        try:
            kinds = [n["type"] for n in config["normalizer"]["normalizers"]]
            split, level = config["pre_tokenizer"]["pretokenizers"]
            fine = kinds == ["NFC", "Replace", "Lowercase"] and config["normalizer"]["normalizers"][1] == {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}
            fine = fine and (split["type"], split["behavior"], split["invert"]) == ("Split", "Removed", True) and split["pattern"]["Regex"].endswith(r"[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
            fine = fine and level["type"] == "ByteLevel" and not level["use_regex"] and not level["add_prefix_space"]
            fine = fine and not any(" " in t["content"] or t["lstrip"] or t["rstrip"] for t in config["added_tokens"]) and not config["post_processor"] and not config["truncation"]
            return split["pattern"]["Regex"] if fine else None
        except (KeyError, TypeError, ValueError):
            return None

    def _piece(self, piece: str) -> bytes:
        spelled = piece if piece.isascii() else piece.encode().decode("latin-1").translate(self.letters)
        return array(self.typecode, [t.id for t in self.model.tokenize(spelled)]).tobytes()

    def _word(self, word: bytes) -> bytes:
        text = word.decode("utf-8", "replace")
        if _PLAIN.fullmatch(text):
            if text.isalpha():
                return self.pieces[text.lower()]
            if not any(s in text for s in self.specials):
                return b"".join(map(self.pieces.__getitem__, self.split.findall(text.lower())))
        return self._library(text)

    def _library(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def packed(self, data: bytes) -> bytes:
        if not self.by_word:
            return self._library(data.decode("utf-8", "replace"))
        return b"".join(map(self.words.__getitem__, data.split()))


@functools.cache
def word_ids(path: str, cache_words: int = CACHE_WORDS) -> WordIds:
    """The encoder of this process for ``path``, with its cache."""
    return WordIds(path, cache_words)
