"""Encoding whole texts with a public tokenizer inside Spark tasks."""

from __future__ import annotations

import json
import re
from collections.abc import Callable

import numpy as np
from tokenizers import Tokenizer


def vocabulary(name: str) -> str:
    """Path of a vocabulary file; every worker has the package installed."""
    import public_tokenizers

    return public_tokenizers.path(name)


#: The shape of a vocabulary whose words never depend on their
#: neighbours across white space.
WORDWISE = {
    "normalizer": {
        "type": "Sequence",
        "normalizers": [
            {"type": "NFC"},
            {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
            {"type": "Lowercase"},
        ],
    },
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {
                "type": "Split",
                "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
                "behavior": "Removed",
                "invert": True,
            },
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
}
#: Letters beyond ASCII that never compose with a neighbour of ``COMMON`` and whose lower case is one of them.
LATIN, SPACES = "À-ÖØ-öø-įĲ-ňŊ-ž", " \t\n\r\x0b\x0c"
#: Texts of white space, printable ASCII and these letters, and the same split for them in lower case.
COMMON = re.compile(f"[{SPACES}!-~{LATIN}]*")
COMMON_PIECES = re.compile(f"[a-z{LATIN}]+|[0-9]|'(?:[stmd]|re|ve|ll)|[^a-z0-9{LATIN}{SPACES}]+")
#: Names of UTF-8's bytes at byte level, where they are not Latin-1's (printable bytes keep theirs).
BYTE_NAMES = {b: 256 + i for i, b in enumerate([*range(0x21), *range(0x7F, 0xA1), 0xAD])}
#: Characters at which str.split() separates words and the vocabulary doesn't.
ODD_SPACES = re.compile("[\x1c-\x1f]")


class Encoder:
    """Ids of a text, without special tokens, as little-endian bytes of ``dtype``.

    Words repeat far more than texts, and pieces of words more than words with
    their capitals and punctuation. So for vocabularies of the shape above each
    piece of a common text is encoded once and remembered; of other texts each
    word is (at most ``limit`` of either, then that memory starts afresh). Other
    vocabularies encode whole texts.
    """

    def __init__(self, path: str, limit: int = 400_000):
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.wordwise = all(spec.get(k) == v for k, v in WORDWISE.items()) and spec.get("post_processor") is None
        self.memory = _Memory(self.word, limit)
        self.pieces = _Memory(self.piece, limit)

    def whole(self, text: str) -> bytes:
        return self.pack(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def pack(self, ids: list[int]) -> bytes:
        return np.array(ids, dtype=self.dtype).tobytes()

    def piece(self, piece: str) -> bytes:
        """Ids of a piece of a common text."""
        if not piece.isascii():
            piece = piece.encode().decode("latin-1").translate(BYTE_NAMES)
        return self.pack([t.id for t in self.model.tokenize(piece)])

    def common(self, text: str) -> bytes | None:
        """Ids of a common text, put together from its pieces; None for other texts."""
        if "<|" in text or not COMMON.fullmatch(text):
            return None
        return b"".join(map(self.pieces.__getitem__, COMMON_PIECES.findall(text.lower())))

    def word(self, word: str) -> bytes:
        ids = self.common(word)
        return self.whole(word) if ids is None else ids

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if not self.wordwise:
            return self.whole(text)
        ids = self.common(text)
        if ids is not None:
            return ids
        if ODD_SPACES.search(text):
            return self.whole(text)
        return b"".join(map(self.memory.__getitem__, text.split()))


class _Memory(dict):
    """What ``encode`` has returned for the strings asked for, at most ``limit`` of them."""

    def __init__(self, encode: Callable[[str], bytes], limit: int):
        self.encode, self.limit = encode, limit

    def __missing__(self, string: str) -> bytes:
        if len(self) >= self.limit:
            self.clear()
        ids = self[string] = self.encode(string)
        return ids


_loaded: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder for a vocabulary; Python workers are reused by later tasks."""
    if path not in _loaded:
        _loaded[path] = Encoder(path)
    return _loaded[path]
