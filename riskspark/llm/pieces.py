"""SentencePiece encoding and decoding with an Aho-Corasick automaton and Viterbi.

The automaton over all pieces reports, at each place of a text, every piece that
ends there (its output links); each report relaxes the best score of the place.
One pass from left to right gives the segmentation of the highest score sum,
with ties going to the longer last piece.  A character no piece covers becomes
its UTF-8 bytes as byte pieces.

Spaces are written as U+2581 with one put before the text, as the model does; a
U+2581 of the text itself is kept apart as bytes, so that decoding gives back
every text exactly.
"""

from __future__ import annotations

import re
from array import array
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.llm.common import Sent

SPACE = "▁"
#: What a byte-fallback character costs below the worst piece.
UNKNOWN_COST = 10.0


@dataclass(frozen=True)
class Vocabulary:
    """Pieces with scores in id order; bytes[b] is the id of byte piece b; ``unknown`` is used where there are no byte pieces."""

    pieces: tuple[str, ...]
    scores: tuple[float, ...]
    usable: tuple[bool, ...]
    bytes: tuple[int, ...] = ()
    unknown: int = 0

    @classmethod
    def read(cls, model_file: str) -> "Vocabulary":
        """From a SentencePiece model; read on the driver, so executors need no file."""
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        ids = range(sp.get_piece_size())
        special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i) for i in ids]
        byte = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        return cls(tuple(map(sp.id_to_piece, ids)), tuple(map(sp.get_score, ids)), tuple(not s for s in special),
                   tuple(byte) if all(map(sp.is_byte, byte)) else (), sp.unk_id())


def joined_characters(pieces: list[str]) -> str:
    """The largest set of characters (U+2581 aside) that pieces chain together; no piece joins one of them to one outside."""
    above: dict[str, str] = {}

    def top(c: str) -> str:
        while above.setdefault(c, c) != c:
            above[c] = c = above[above[c]]
        return c

    for p in pieces:
        for x, y in zip(p, p[1:]):
            if SPACE not in (x, y):
                above[top(x)] = top(y)
    sets: dict[str, list[str]] = {}
    for c in list(above):
        sets.setdefault(top(c), []).append(c)
    return "".join(sorted(max(sets.values(), key=lambda s: (len(s), s), default=[])))


class Codec:
    """Encoder and decoder of one process.

    A text falls into units at places that no piece crosses, so its best
    segmentation is that of its units, one after another.  Short units are
    remembered in two generations of at most ``cache_size`` each: when the young
    one is full it becomes the old one, so frequent units stay.
    """

    def __init__(self, vocab: Vocabulary, cache_size: int = 1 << 18):
        self.vocab, self.cache_size = vocab, cache_size
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        usable = [(p, s, i) for i, (p, s, ok) in enumerate(zip(vocab.pieces, vocab.scores, vocab.usable)) if ok and p]
        self.auto = ahocorasick.Automaton()
        for p, s, i in usable:
            self.auto.add_word(p, (i, len(p), s))
        if usable:
            self.auto.make_automaton()
        self.penalty = min((s for _, s, _ in usable), default=0.0) - UNKNOWN_COST
        self.singles = frozenset(p for p, _, _ in usable if len(p) == 1)
        self.sizes = [len(p) for p in vocab.pieces]
        names = [p for p, _, _ in usable]
        self.units = None
        if not any(re.search(f"[^{SPACE}]{SPACE}", p) for p in names):
            joined = re.escape(joined_characters(names)) or "a"
            self.units = re.compile(f"{SPACE}*(?:[{joined}]+|[^{joined}{SPACE}]+)|{SPACE}+")
        byte_of = {i: bytes([b]) for b, i in enumerate(vocab.bytes)}
        self.raw = pa.array([byte_of.get(i) or p.replace(SPACE, " ").encode() for i, p in enumerate(vocab.pieces)], pa.large_binary())

    def best(self, unit: str) -> bytes:
        """Ids of the unit's best segmentation, as int32 bytes: one pass of the automaton, relaxing along its output links."""
        n, low = len(unit), float("-inf")
        score, back = [0.0] + [low] * n, [-1] * (n + 1)
        hits = self.auto.iter(unit) if len(self.auto) else ()
        if self.singles.issuperset(unit):
            # hits come by the place they end at, the longest first; a tie stays with the longer piece
            for end, (piece, size, s) in hits:
                total = score[end + 1 - size] + s
                if total > score[end + 1]:
                    score[end + 1], back[end + 1] = total, piece
        else:
            # a character that has no piece of its own is an edge of its bytes
            at = 0
            for end, (piece, size, s) in hits:
                while at < end:
                    self._unknown(unit, at, score, back)
                    at += 1
                total = score[end + 1 - size] + s
                if total > score[end + 1]:
                    score[end + 1], back[end + 1] = total, piece
            for at in range(at, n):
                self._unknown(unit, at, score, back)
        out, i = [], n
        while i:
            piece = back[i]
            if piece >= 0:
                out.append(piece)
                i -= self.sizes[piece]
            else:
                out.extend(reversed(self._bytes(unit[i - 1])) if self.vocab.bytes else [self.vocab.unknown])
                i -= 1
        return array("i", reversed(out)).tobytes()

    def _unknown(self, unit: str, at: int, score: list[float], back: list[int]) -> None:
        if unit[at] not in self.singles and score[at] + self.penalty > score[at + 1]:
            score[at + 1], back[at + 1] = score[at] + self.penalty, -1

    def encode(self, text: str) -> bytes:
        """Ids as int32 bytes; nothing for an empty text."""
        if not text:
            return b""
        # no piece holds a U+2581 of the text itself, so that one is a boundary
        first, *rest = text.split(SPACE)
        out = [self._plain(SPACE + first.replace(" ", SPACE))]
        own = array("i", self._bytes(SPACE) if self.vocab.bytes else [self.vocab.unknown]).tobytes()
        for part in rest:
            out += own, self._plain(part.replace(" ", SPACE))
        return b"".join(out)

    def _bytes(self, ch: str) -> list[int]:
        return [self.vocab.bytes[b] for b in ch.encode()]

    def _plain(self, text: str) -> bytes:
        if self.units is None:
            return self.best(text)
        units = self.units.findall(text)
        out = list(map(self.young.get, units))
        at = -1
        try:
            # index() finds the units not known at the speed of a scan
            while True:
                at = out.index(None, at + 1)
                out[at] = self._remembered(units[at])
        except ValueError:
            return b"".join(out)

    def _remembered(self, unit: str) -> bytes:
        ids = self.young.get(unit) or self.old.get(unit) or self.best(unit)
        if len(unit) <= 64:
            if len(self.young) >= self.cache_size:
                self.old, self.young = self.young, {}
            self.young[unit] = ids
        return ids

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> list[str]:
        """Texts of many id lists that lie one after another; ``ends`` are the places where lists begin and end."""
        taken = self.raw.take(pa.array(ids, pa.int32()))
        # the pieces' bytes lie one after another as well
        _, offsets, data = taken.buffers()
        data = memoryview(data) if data is not None else b""
        cuts = np.frombuffer(offsets, np.int64, len(taken) + 1)[ends].tolist()
        texts = [str(data[i:j], "utf-8", "replace") for i, j in zip(cuts, cuts[1:])]
        return [t[1:] if t[:1] == " " else t for t in texts]


class PieceColumns:
    """Column functions of one vocabulary, which is read once on the driver and sent to the workers."""

    def __init__(self, spark: SparkSession, vocab: Vocabulary | str):
        self.sent = Sent(spark, Vocabulary.read(vocab) if isinstance(vocab, str) else vocab)

    def encode(self, text: Column) -> Column:
        """``array<int>`` of piece ids; null for null, empty for empty."""
        sent = self.sent

        @F.arrow_udf("array<int>")
        def encode(v: pa.Array) -> pa.Array:
            codec = sent.built(Codec)
            parts = [codec.encode(x.as_py()) if x.is_valid else b"" for x in v]
            ends = np.cumsum([0] + [len(p) // 4 for p in parts])
            flat = pa.array(np.frombuffer(b"".join(parts), np.int32))
            return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat, mask=v.is_null())

        return encode(text)

    def decode(self, ids: Column) -> Column:
        """The text of piece ids; null for null."""
        sent = self.sent

        @F.arrow_udf("string")
        def decode(v: pa.Array) -> pa.Array:
            codec = sent.built(Codec)
            ends = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(v), 0).to_numpy(zero_copy_only=False))])
            texts = codec.decode(v.flatten().to_numpy(zero_copy_only=False), ends)
            return pa.array([t if ok else None for t, ok in zip(texts, v.is_valid().to_pylist())], pa.string())

        return decode(ids)


def encode_documents(docs: DataFrame, pieces: PieceColumns, text_col: str = "text") -> DataFrame:
    """``docs`` with ``ids`` (array<int>) and ``n_tokens`` (int).

    A null text has null ids and 0 tokens, an empty one no ids.  Every row comes
    back, repeated ones too; input columns called ids or n_tokens are replaced.
    ``pieces.decode`` gives back every text exactly where the vocabulary has byte pieces.
    """
    keep = [F.col(f"`{c}`") for c in docs.columns if c not in ("ids", "n_tokens")]
    out = docs.select(*keep, pieces.encode(F.col(text_col)).alias("ids"))
    return out.withColumn("n_tokens", F.when(F.col("ids").isNull(), 0).otherwise(F.size("ids")))
