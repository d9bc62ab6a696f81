"""Ids of the lower-casing word-end BPE vocabulary, word by word with a bounded cache of the words that come back.

Neither the normaliser nor the splitter of that tokenizer looks across ASCII white space, so a text's ids are those of its
white-space-separated words in turn, and words repeat. New words in plain Latin script go through the byte-pair core of tiktoken, in which
byte 255, which no UTF-8 text holds, marks the word's end; any other word goes to the tokenizer itself.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator

CACHED, DOOR = 1 << 15, 1 << 20
SLICE = 1 << 20
_SPACE = re.compile(rb"[ \t\n\r\x0b\x0c]")
_LETTERS = "a-zß-öø-įı-ɏ"
_PLAIN = re.compile("[!-~À-įı-ɏ]+")
_PIECES = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[0-9]|[^0-9{_LETTERS}]+")
_END = b"\xff"


def byte_alphabet() -> dict[str, int]:
    """The printable stand-ins of byte-level vocabularies: visible Latin-1 characters stand for themselves, the rest follow from 256."""
    shown = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b <= 0xFF]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


def _core(path: str):
    """A tiktoken encoding over bytes with the end mark, and the vocabulary id of each of its ranks."""
    import tiktoken

    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    alphabet, end = byte_alphabet(), "</w>"

    def raw(token: str) -> bytes:
        body = token.removesuffix(end)
        return bytes(alphabet[c] for c in body) + (_END if body != token else b"")

    ranks, ids = {}, {}
    for c, b in alphabet.items():  # the end mark joins its byte before any merge
        ranks[bytes([b]) + _END] = b
        ids[b] = model["vocab"][c + end]
    for k, pair in enumerate(model["merges"]):
        left, right = pair if isinstance(pair, list) else pair.split(" ")
        ranks[raw(left) + raw(right)] = 256 + k
        ids[256 + k] = model["vocab"][left + right]
    for c, b in alphabet.items():
        ranks[bytes([b])] = 256 + len(model["merges"]) + b
        ids[256 + len(model["merges"]) + b] = model["vocab"][c]
    return tiktoken.Encoding("word-ends", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={}), ids


class TwoAges(dict):
    """A bounded table that computes what it lacks. When full, it becomes the old table, from which what is used again comes back."""

    size, longest = 250_000, 64

    def __init__(self):
        super().__init__()
        self.old: dict = {}

    def made(self, key):
        raise NotImplementedError

    def __missing__(self, key):
        out = self.old.get(key)
        if out is None:
            out = self.made(key)
        if len(key) < self.longest:
            if len(self) >= self.size:
                self.old = dict(self)
                self.clear()
            self[key] = out
        return out


class WordIds(TwoAges):
    """word (bytes) -> its ids as little-endian unsigned 32-bit integers.

    Most distinct words come once. A word is kept from its second coming on, which one byte per hash value tells (words that share it are kept
    early), so a quarter of the table finds as much, and a worker stays small."""

    size = 1 << 16

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.whole = Tokenizer.from_file(path)
        self.whole.no_truncation()
        self.whole.no_padding()
        self.core, self.ids = _core(path)
        self.pieces: dict[str, bytes] = {}
        self.met = bytearray(DOOR)

    def __missing__(self, key: bytes) -> bytes:
        if key not in self.old:
            at = hash(key) % DOOR
            if not self.met[at]:
                self.met[at] = 1
                return self.made(key)
        if len(self) >= self.size:
            self.met = bytearray(DOOR)
        return super().__missing__(key)

    def _piece(self, piece: bytes) -> bytes:
        return array("I", [self.ids[r] for r in self.core._encode_single_piece(piece + _END)]).tobytes()

    def made(self, word: bytes) -> bytes:
        if word.isalpha():  # of bytes, only ASCII letters are
            return self._piece(word.lower())
        text = word.decode("utf-8")
        if not _PLAIN.fullmatch(text) or "<|" in text:
            return array("I", self.whole.encode(text, add_special_tokens=False).ids).tobytes()
        ids = b""
        for piece in _PIECES.findall(text.lower()):
            known = self.pieces.get(piece)
            if known is None:
                known = self._piece(piece.encode())
                if len(self.pieces) >= CACHED:
                    self.pieces.clear()
                if len(piece) < self.longest:
                    self.pieces[piece] = known
            ids += known
        return ids

    def stream(self, body: bytes) -> Iterator[bytes]:
        """The ids of a text, in parts; never cuts a word."""
        at = 0
        while at < len(body):
            end = at + SLICE
            if end < len(body):
                space = _SPACE.search(body, end)
                end = space.start() if space else len(body)
            else:
                end = len(body)
            yield b"".join(map(self.__getitem__, body[at:end].split()))
            at = end


_LOADED: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    if path not in _LOADED:
        _LOADED[path] = WordIds(path)
    return _LOADED[path]
