"""Byte-level BPE as a bounded-lookahead streaming transducer, and its decoder.

Encoding reads a text in parts. Two facts keep its memory constant:

* The splitter cuts a text into pretokens (letters, digits, other signs, white space). Whether a pretoken ends is settled a few
  characters later, so all but the last ones of a part are passed on.
* Inside a pretoken, merging a pair can disturb what stands to its left only through rules of lower priority that end in a token the
  merge uses up or makes. ``sufficient_lookahead`` follows these chains through the merge list, in rule order, and so bounds how far a
  change at the right end reaches. Tokens that end earlier than that are stable and are emitted; the rest waits for more.

A token boundary is a fresh start for BPE (neighbouring tokens that stay apart in the whole stay apart in a suffix), so a held rest is simply
encoded again with what follows. Short pretokens are kept in a bounded table.

Decoding turns ids into bytes and feeds them to an incremental UTF-8 decoder, whose state is at most three bytes.

Nulls and odd rows: a null or empty text has no ids and decodes to the empty text; special tokens in the text are single ids; repeated
rows are encoded each for itself; ids of documents are carried along, null ones too; other columns are not looked at.
"""

from __future__ import annotations

import codecs
import hashlib
import json
import re
from array import array
from collections.abc import Iterator
from itertools import pairwise

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import filled
from .wordids import TwoAges, byte_alphabet

PART, CACHED, RUN = 1 << 16, 200_000, 1 << 9
# fixed values: the white space of Unicode, and the splitter of this vocabulary
WHITE = r"\t\n\x0b\x0c\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^" + WHITE + r"\p{L}\p{N}]+|[" + WHITE + "]+(?![^" + WHITE + "])|[" + WHITE + "]+"


def sufficient_lookahead(merges: list[tuple[bytes, bytes]]) -> int:
    """Bytes to the right of a position after which further text cannot move a token boundary at or before it.

    ``reach[t]`` is the longest stretch, from the start of an occurrence of token t to the end of what is known, over which an
    unknown right end can decide whether t stays whole, is used up or comes into being. A rule (u, v) extends what reaches v by u.
    """
    reach: dict[bytes, int] = {}
    most = 1
    for u, v in merges:
        span = len(u) + max(len(v), reach.get(v, 0))
        for t in (u, u + v):
            if reach.get(t, 0) < span:
                reach[t] = span
        most = max(most, span)
    return most + max((len(u) + len(v) for u, v in merges), default=1)


_WORDS = re.compile(r"(?<=[!-~]) | (?=[!-~])")


class _Words(TwoAges):
    """Ids of what follows a space, up to the next place where a space begins a pretoken."""

    def __init__(self, bpe: ByteBpe):
        super().__init__()
        self.bpe = bpe

    def made(self, word: str) -> bytes:
        return b"".join(map(self.bpe.piece, self.bpe.split.findall(" " + word)))


class ByteBpe:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        alphabet = byte_alphabet()
        raw = lambda token: bytes(alphabet[c] for c in token)
        self.ids = {raw(t): i for t, i in spec["model"]["vocab"].items() if all(c in alphabet for c in t)}
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        merges = [(raw(a), raw(b)) for a, b in merges]
        self.rank = {self.ids[a] << 20 | self.ids[b]: k for k, (a, b) in enumerate(merges)}
        self.made, self.none = [self.ids[a + b] for a, b in merges], len(merges)
        self.byte_id = [self.ids[bytes([b])] for b in range(256)]
        self.lookahead = sufficient_lookahead(merges)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token = {i: t for t, i in self.ids.items()} | {i: s.encode() for s, i in self.special.items()}
        self.special_split = regex.compile("|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) or r"(?!)")
        self.hold = max(map(len, self.special), default=1) - 1
        self.split = regex.compile(SPLIT)
        self.known = _Words(self)
        self.pieces: dict[str, bytes] = {}

    def merged(self, body: bytes) -> list[int]:
        """Ids of one pretoken: the first of the highest-priority pairs is merged until none is left."""
        parts = [self.byte_id[b] for b in body]
        rank, none, made = self.rank, self.none, self.made
        ranks = [rank.get(a << 20 | b, none) for a, b in pairwise(parts)]
        while ranks:
            least = min(ranks)
            if least == none:
                break
            i = ranks.index(least)
            parts[i : i + 2] = [made[least]]
            del ranks[i]
            if i:
                ranks[i - 1] = rank.get(parts[i - 1] << 20 | parts[i], none)
            if i < len(ranks):
                ranks[i] = rank.get(parts[i] << 20 | parts[i + 1], none)
        return parts

    def _packed(self, ids: list[int]) -> bytes:
        return array("I", ids).tobytes()

    def stable(self, body: bytes, character: bool = False) -> tuple[list[int], int]:
        """The ids that further bytes of the same pretoken cannot change, and the bytes they stand for; ``character``: stop at a whole one."""
        ids, size = self.merged(body), 0
        for k, t in enumerate(ids):
            if size + len(self.token[t]) > len(body) - self.lookahead:
                break
            size += len(self.token[t])
        while character and k and (body[size] & 0xC0) == 0x80:
            k -= 1
            size -= len(self.token[ids[k]])
        return ids[:k], size

    def piece(self, text: str) -> bytes:
        """Ids of one pretoken, packed as little-endian unsigned 32-bit integers."""
        out = self.pieces.get(text)
        if out is None:
            body = text.encode("utf-8")
            if len(body) > RUN:
                return b"".join(self.run([body]))
            out = self._packed(self.merged(body))
            if len(text) < 64:
                if len(self.pieces) >= CACHED:
                    self.pieces.clear()
                self.pieces[text] = out
        return out

    def run(self, parts: Iterator[bytes]) -> Iterator[bytes]:
        """Ids of one pretoken that comes in parts: emits tokens once they are stable."""
        held = b""
        for part in parts:
            for at in range(0, len(part), RUN):
                held += part[at : at + RUN]
                if len(held) > 2 * self.lookahead:
                    ids, size = self.stable(held)
                    yield self._packed(ids)
                    held = held[size:]
        if held:
            yield self._packed(self.merged(held))

    def _words(self, text: str) -> Iterator[bytes]:
        """Ids of a text whose ends are pretoken ends. Between a visible ASCII sign and a space, or a space and such a sign, a pretoken begins."""
        first, *rest = _WORDS.split(text)
        yield b"".join(map(self.piece, self.split.findall(first)))
        yield b"".join(map(self.known.__getitem__, rest))

    def _safe(self, text: str) -> int:
        """The last place where a visible ASCII sign is followed by a space and another such sign."""
        at = len(text)
        while (at := text.rfind(" ", 1, at)) > 0:
            if "!" <= text[at - 1] <= "~" and "!" <= text[at + 1 : at + 2] <= "~":
                return at
        return 0

    def _long(self, held: str):
        """Emit what is settled of a text without a safe place. Pretokens that end well before its end are; of a longer one, the stable tokens are.

        Contractions and white space are settled two characters after they end.
        """
        at = 0
        for m in self.split.finditer(held):
            if m.end() + 4 > len(held):
                break
            yield self.piece(m.group())
            at = m.end()
        rest = held[at:]
        if len(rest) <= PART:
            return rest
        body, blank = rest[:-4].encode("utf-8"), rest[-8:].isspace()
        if blank:  # a run of white space is settled from the left like any other pretoken
            body = rest[:-8].encode("utf-8")
        done, pending = [], b""
        for i in range(0, len(body), RUN):
            pending += body[i : i + RUN]
            if len(pending) > 2 * self.lookahead + 4:
                ids, size = self.stable(pending, character=True)
                done += ids
                pending = pending[size:]
        yield self._packed(done)
        return pending.decode("utf-8") + rest[len(rest) - (8 if blank else 4) :]

    def encode(self, text: str) -> Iterator[bytes]:
        """Packed ids of a text, part by part."""
        state = Encoder(self)
        for at in range(0, len(text), PART):
            yield from state.feed(text[at : at + PART])
        yield from state.finish()

    def decode(self, ids: Iterator[int]) -> Iterator[str]:
        """Text of ids, part by part; bytes that are no UTF-8 become replacement characters."""
        state = codecs.getincrementaldecoder("utf-8")("replace")
        for part in ids:
            yield state.decode(b"".join(map(self.token.__getitem__, part)))
        yield state.decode(b"", final=True)


class Encoder:
    """The transducer's state: text whose pretokens are not settled, and an end that could begin a special token."""

    def __init__(self, bpe: ByteBpe):
        self.bpe, self.held, self.tail = bpe, "", ""

    def feed(self, part: str) -> Iterator[bytes]:
        text, start = self.tail + part, 0
        for m in self.bpe.special_split.finditer(text):
            yield from self._section(text[start : m.start()], True)
            yield array("I", [self.bpe.special[m.group()]]).tobytes()
            start = m.end()
        end = max(start, len(text) - self.bpe.hold)
        self.tail = text[end:]
        yield from self._section(text[start:end], False)

    def finish(self) -> Iterator[bytes]:
        yield from self._section(self.tail, True)
        self.tail = ""

    def _section(self, part: str, last: bool) -> Iterator[bytes]:
        """Text without special tokens; ``last`` if one, or the end, follows."""
        self.held += part
        if last:
            if len(self.held) > 2 * PART:
                self.held = yield from self.bpe._long(self.held)
            if self.held:
                yield b"".join(self.bpe._words(self.held))
            self.held = ""
            return
        at = self.bpe._safe(self.held)
        if at:
            yield b"".join(self.bpe._words(self.held[:at]))
            self.held = self.held[at:]
        if len(self.held) > 2 * PART:  # no safe place in sight
            self.held = yield from self.bpe._long(self.held)


_LOADED: dict[str, ByteBpe] = {}


def byte_bpe(path: str) -> ByteBpe:
    if path not in _LOADED:
        _LOADED[path] = ByteBpe(path)
    return _LOADED[path]


def _round_trip(tokenizer: str, keep: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(tokenizer)
        for batch in batches:
            n, digests, texts, ids = [], [], [], []
            for body in batch.column("body"):
                taken, size, kept = hashlib.sha256(), 0, []

                def numbered(text=body.as_py(), taken=taken, kept=kept) -> Iterator[memoryview]:
                    for part in bpe.encode(text):
                        taken.update(part)
                        if keep:
                            kept.append(part)
                        yield memoryview(part).cast("I")

                back = hashlib.sha256()
                count = [0]

                def counted(count=count, source=numbered()):
                    for part in source:
                        count[0] += len(part)
                        yield part

                for text in bpe.decode(counted()):
                    back.update(text.encode("utf-8"))
                size = count[0]
                n.append(size)
                digests.append(taken.hexdigest())
                texts.append(back.hexdigest())
                if keep:
                    ids.append(memoryview(b"".join(kept)).cast("I").tolist())
            columns = [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(digests, pa.string()), pa.array(texts, pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            yield pa.RecordBatch.from_arrays(columns + ([pa.array(ids, pa.list_(pa.int64()))] if keep else []), names=names + ["ids"] * keep)

    return run


def round_trip(docs: DataFrame, tokenizer: str, keep_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, n_tokens, ids_sha256, decoded_sha256 (and the ids)."""
    rows = docs.select(F.col(id_col).alias("doc_id"), filled(F.col(text_col)).alias("body"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<long>" * keep_ids
    return rows.mapInArrow(_round_trip(tokenizer, keep_ids), schema)


def encoded(docs: DataFrame, tokenizer: str, **names: str) -> DataFrame:
    return round_trip(docs, tokenizer, keep_ids=True, **names)


def _decoded(tokenizer: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(tokenizer)
        for batch in batches:
            texts = ["".join(bpe.decode([x or []])) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return run


def decoded(tokens: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, ids) -> (doc_id, text); null ids count as none."""
    kind = tokens.schema["doc_id"].dataType.simpleString()
    return tokens.select("doc_id", F.col("ids").cast("array<long>").alias("ids")).mapInArrow(_decoded(tokenizer), f"doc_id {kind}, text string")
