"""SentencePiece (BPE) encoding by a prefix table, and decoding.

Byte-pair merging has one result for every prefix of a text, so it is enough
to know each prefix's last token. An automaton over the vocabulary finds the
tokens that end at a position; of these the one is taken that is compatible
with the last token of the prefix before it: merging the two tokens' joined
text must give just the two tokens. Exactly one passes. When the table is full
the ids are read off it from the end to the beginning. The work is linear in
the text, with no queue of merges over the whole text.

Where no token of the vocabulary crosses from a character into a following
word mark (checked when a model is loaded), a text is cut there and the tables
of short stretches are kept in a bounded cache. Other vocabularies run over
the whole text at once. Results are the same.

Ids travel packed as little-endian unsigned 32-bit integers. Defined results:
a null text counts as empty; a null or empty list of ids decodes to the empty
text. Models need the BPE type, no unused pieces, and every character of a
piece as a piece of its own; others are refused with ValueError.
"""

from __future__ import annotations

import hashlib
import re
import struct
import sys
from array import array
from functools import cached_property

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .arrow import add_columns

MARK = "▁"            # stands for a space inside pieces
CACHE_STRETCHES = 150_000   # in each of two generations of the cache of a worker
CACHE_CHARS = 48            # longer stretches are not kept
CACHE_PAIRS = 400_000     # known pairs of tokens of a worker
_UNKNOWN = -1               # a character outside the vocabulary, in the prefix table


def _fields(data: bytes) -> list[tuple[int, int | bytes]]:
    """(field number, value) of a protocol buffer message."""
    out, at = [], 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            value |= (data[at] & 127) << shift
            shift, at = shift + 7, at + 1
            if data[at - 1] < 128:
                return value

    while at < len(data):
        key = number()
        kind = key & 7
        if kind == 0:
            out.append((key >> 3, number()))
        else:
            size = number() if kind == 2 else 8 if kind == 1 else 4
            out.append((key >> 3, data[at: at + size]))
            at += size
    return out


def _plain_normaliser(model: bytes) -> bool:
    """Whether normalising only puts a mark first and marks for spaces (the model's normaliser spec)."""
    spec = dict(_fields(dict(_fields(model)).get(3, b"")))
    return not spec.get(2) and spec.get(3, 1) == 1 and spec.get(4, 1) == 0 and spec.get(5, 1) == 1


class Codec:
    def __init__(self, model: bytes):
        self.sp = sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = sp.get_piece_size()
        self.pieces = [sp.id_to_piece(i) for i in range(n)]
        special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) for i in range(n)]
        if any(sp.is_unused(i) for i in range(n)):
            raise ValueError("models with unused pieces are not supported")
        self.ids = {p: i for i, p in enumerate(self.pieces) if not special[i]}
        self.score = {p: sp.get_score(i) for p, i in self.ids.items()}
        self.chars = frozenset(p for p in self.ids if len(p) == 1)
        if any(c not in self.chars for p in self.ids for c in p):
            raise ValueError("a piece has a character that is no piece")
        bytes_ = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.byte_ids = bytes_ if all(sp.is_byte(i) for i in bytes_) else None
        self.cuts = not any(re.search(f"[^{MARK}]{MARK}", p) for p in self.ids)
        self.stretch = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
        # the likeliest characters of no token: a merge never crosses them
        outside = "".join(chr(c) for c in range(1, 128) if chr(c) not in self.chars and c != 32)
        self.foreign = re.compile(f"([{re.escape(outside)}])") if outside else None
        self.plain = _plain_normaliser(model)
        self.length = {i: len(p) for p, i in self.ids.items()} | {_UNKNOWN: 1}
        self.alone: dict[int, bool] = {}
        self.split: dict[int, tuple[int, int] | None] = {}
        self.odd: set[int] = set()  # tokens not merged in the order of their scores
        self.pairs: dict[int, dict[int, bool]] = {}
        self.known_pairs = 0
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.surface = []
        for i, p in enumerate(self.pieces):
            if sp.is_byte(i):
                self.surface.append(bytes([int(p[3:-1], 16)]))
            elif sp.is_unknown(i):
                self.surface.append(" ⁇ ".encode())
            else:
                self.surface.append(b"" if special[i] else p.replace(MARK, " ").encode())
        self.special = special

    # encoding

    @cached_property
    def automaton(self) -> ahocorasick.Automaton:
        """Finds every token that ends at a position, with its id and length."""
        found = ahocorasick.Automaton()
        for p, i in self.ids.items():
            found.add_word(p, (i, len(p)))
        if self.ids:
            found.make_automaton()
        return found

    def merged(self, text: str, until: int = 1) -> list[str]:
        """The plain merges of a short text, best score first, then leftmost, down to ``until`` parts."""
        parts = list(text)
        while len(parts) > until:
            best = max(((self.score[a + b], -k) for k, (a, b) in enumerate(zip(parts, parts[1:], strict=False))
                        if a + b in self.score), default=None)
            if best is None:
                return parts
            k = -best[1]
            parts[k:k + 2] = [parts[k] + parts[k + 1]]
        return parts

    def halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes this one; None for a single character."""
        if token not in self.split:
            piece = self.pieces[token]
            if len(piece) == 1:
                self.split[token] = None
            else:
                parts = self.merged(piece, 2)
                self.split[token] = tuple(map(self.ids.get, parts)) if len(parts) == 2 else None
                if len(parts) != 2 or any(len(x) > 1 and self.score[x] < self.score[piece] for x in parts):
                    self.odd.add(token)
        return self.split[token]

    def compatible(self, left: int, right: int) -> bool:
        """Whether the two tokens' joined text is merged to just these two.

        The merges are undone from the last to the first. Between any two of
        them the tokens that meet at the joint must not merge sooner than what
        was merged next. Tokens not merged in the order of their scores are
        tested by merging.
        """
        a, b = left, right
        limit, tie = -float("inf"), False  # what was merged next; whether a tie goes to the joint
        while True:
            joined = self.score.get(self.pieces[a] + self.pieces[b])
            if joined is not None and (joined > limit or tie and joined == limit):
                return False
            x, y = self.halves(a), self.halves(b)
            if a in self.odd or b in self.odd:
                return self.merged(self.pieces[left] + self.pieces[right]) == [self.pieces[left], self.pieces[right]]
            if x is None and y is None:
                return True
            if y is None or x is not None and self.score[self.pieces[a]] < self.score[self.pieces[b]]:
                limit, tie, a = self.score[self.pieces[a]], False, x[1]
            else:
                limit, tie, b = self.score[self.pieces[b]], True, y[0]

    def tokens(self, text: str) -> list[int]:
        """Ids of a normalised text; _UNKNOWN for a character outside the vocabulary."""
        n = len(text)
        last: list[int] = [0] * (n + 1)  # of each prefix
        # of each prefix, which tokens may follow (None: no prefix of tokens ends here)
        after: list[dict[int, bool] | None] = [None] * (n + 1)
        after[0] = self.alone
        if not self.chars.issuperset(text):
            for k, c in enumerate(text, 1):
                if c not in self.chars:
                    last[k], after[k] = _UNKNOWN, self.alone
        for at, (token, size) in self.automaton.iter(text):
            at += 1
            if after[at] is None and (follows := after[at - size]) is not None:
                fits = follows.get(token)
                if fits is None:
                    fits = self.learn(last[at - size] if follows is not self.alone else _UNKNOWN, token)
                if fits:
                    last[at] = token
                    after[at] = self.pairs.get(token)
                    if after[at] is None:
                        after[at] = self.pairs[token] = {}
        out = []
        length = self.length
        while n:
            token = last[n]
            out.append(token)
            n -= length[token]
        out.reverse()
        return out

    def learn(self, before: int, token: int) -> bool:
        if before == _UNKNOWN:
            fits = self.alone[token] = len(self.merged(self.pieces[token])) == 1
            return fits
        if self.known_pairs >= CACHE_PAIRS:
            for row in self.pairs.values():
                row.clear()
            self.known_pairs = 0
        self.known_pairs += 1
        fits = self.pairs[before][token] = self.compatible(before, token)
        return fits

    def packed(self, text: str) -> bytes:
        ids = self.tokens(text)
        if _UNKNOWN in ids:
            whole, at, ids = ids, 0, []
            for k, t in enumerate(whole):
                if t != _UNKNOWN:
                    ids.append(t)
                elif self.byte_ids:
                    ids.extend(self.byte_ids[b] for b in text[at].encode())
                elif not k or whole[k - 1] != _UNKNOWN:  # neighbouring unknown characters are one id
                    ids.append(self.sp.unk_id())
                at += self.length[t]
        return array("I", ids).tobytes() if sys.byteorder == "little" else struct.pack(f"<{len(ids)}I", *ids)

    def _put(self, key: str, out: bytes) -> bytes:
        if len(key) <= CACHE_CHARS:
            if len(self.young) >= CACHE_STRETCHES:
                self.old, self.young = self.young, {}
            self.young[key] = out
        return out

    def word(self, text: str) -> bytes:
        """Packed ids of a mark and a text without marks; kept under the text."""
        out = self.young.get(text)
        if out is not None:
            return out
        out = self.old.get(text)
        if out is None:
            parts = self.foreign.split(text) if self.foreign else [text]
            if len(parts) > 1 and parts[0] != text:  # cut at characters that no token holds
                return self.word(parts[0]) + b"".join(map(self.inner, filter(None, parts[1:])))
            out = self.packed(MARK + text)
        return self._put(text, out)

    def inner(self, text: str) -> bytes:
        """Packed ids of a text that follows a character outside the vocabulary."""
        key = MARK + text
        out = self.young.get(key) or self.old.get(key)
        return self._put(key, self.packed(text)) if out is None else out

    def body(self, text: str) -> bytes:
        if not self.cuts or self.byte_ids is None:
            return self.packed(self.sp.normalize(text))
        if self.plain and text[0] != " " and "  " not in text and MARK not in text:
            parts = text.split(" ")
        else:
            norm = self.sp.normalize(text)
            stretches = self.stretch.findall(norm)
            if any(x[0] != MARK or x[1:2] == MARK for x in stretches):
                return b"".join(self.word(x[1:]) if x[0] == MARK and x[1:2] != MARK else self.packed(x)
                                for x in stretches)
            parts = [x[1:] for x in stretches]
        ids = list(map(self.young.get, parts))
        if None in ids:
            ids = [self.word(p) if x is None else x for p, x in zip(parts, ids, strict=True)]
        return b"".join(ids)

    def encode(self, text: str | None, bos: bool = True, eos: bool = True) -> bytes:
        return (struct.pack("<I", self.sp.bos_id()) if bos else b"") + (self.body(text) if text else b"") + (
            struct.pack("<I", self.sp.eos_id()) if eos else b"")

    # decoding

    def decode(self, packed: bytes | None) -> str:
        ids = np.frombuffer(packed or b"", dtype="<u4").tolist()
        parts = list(map(self.surface.__getitem__, ids))
        for k, i in enumerate(ids):  # the mark put before a text's first word goes
            if self.sp.is_byte(i) or self.sp.is_unknown(i):
                break
            if parts[k]:
                if parts[k][:1] == b" ":
                    parts[k] = parts[k][1:]
                break
        try:
            return b"".join(parts).decode()
        except UnicodeDecodeError:
            return self._decode_runs(ids, parts)

    def _decode_runs(self, ids: list[int], parts: list[bytes]) -> str:
        """Runs of byte pieces, where a byte of no valid character becomes U+FFFD."""
        out, run = [], b""
        for i, part in zip([*ids, None], [*parts, b""], strict=True):
            if i is not None and self.sp.is_byte(i):
                run += part
                continue
            while run:
                for size in (1, 2, 3, 4):
                    try:
                        char = run[:size].decode()
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    char, size = "�", 1
                out.append(char)
                run = run[size:]
            out.append(part.decode())
        return "".join(out)


_codecs: dict[bytes, Codec] = {}  # of a worker process, with its caches


def codec(model: bytes) -> Codec:
    key = hashlib.sha256(model).digest()
    if key not in _codecs:
        _codecs[key] = Codec(model)
    return _codecs[key]


def encode(docs: DataFrame, model: bytes, text_col: str = "text", ids_col: str = "ids",
           bos: bool = True, eos: bool = True, keep_text: bool = True) -> DataFrame:
    """``docs`` with the packed ids of each whole text."""
    def make():
        c = codec(model)
        return lambda cols: [pa.array([c.encode(t, bos, eos) for t in cols[0].to_pylist()], pa.binary())]

    return add_columns(docs, [text_col], [(ids_col, T.BinaryType())], make, () if keep_text else (text_col,))


def round_trip(docs: DataFrame, model: bytes, text_col: str = "text", ids_col: str = "ids",
               decoded_col: str = "decoded", bos: bool = True, eos: bool = True) -> DataFrame:
    """``docs`` without the text, with the packed ids of each whole text and the
    text decoded from them; both in one pass, so a task keeps one Python worker."""
    def make():
        c = codec(model)

        def work(cols):
            ids = [c.encode(t, bos, eos) for t in cols[0].to_pylist()]
            return [pa.array(ids, pa.binary()), pa.array([c.decode(x) for x in ids], pa.string())]
        return work

    return add_columns(docs, [text_col], [(ids_col, T.BinaryType()), (decoded_col, T.StringType())], make, (text_col,))


def decode(encoded: DataFrame, model: bytes, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``encoded`` with the text of each row's packed ids."""
    def make():
        c = codec(model)
        return lambda cols: [pa.array([c.decode(x) for x in cols[0].to_pylist()], pa.string())]

    return add_columns(encoded, [ids_col], [(text_col, T.StringType())], make)
