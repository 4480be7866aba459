"""SentencePiece encoding and decoding for merge-type (BPE) models, exact, by backtracking.

A text's encoding is the one sequence of pieces in which every two neighbours, merged anew from their
characters, come out as those two again.  So no text is ever merged as a whole:

- an Aho-Corasick automaton over the vocabulary yields all pieces at all places of a unit in one pass;
- from the left the longest piece is tried that is compatible with the one before it.  Compatibility of
  a pair is decided by re-merging its characters by rank, and remembered;
- where no piece fits, the place is marked in a bitfield of failed positions, never to be entered again,
  and the piece before gives way to its next shorter one.

The encoding of what lies before a place does not depend on what follows, hence one try per place is
enough and the work is linear.  Characters the vocabulary lacks stand for themselves until the end and
then fall back to their bytes.

Texts are cut into units where no piece of the vocabulary reaches across: before the first space of
each run of spaces, and around line feeds.  Units are remembered per Python worker, in bounds.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemetry_lake.llm.common import Remembered, own_columns, per_worker

MARK = "▁"  # stands for a space inside pieces
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6  # kinds of pieces in the file
UNITS = 400_000
PAIRS = 400_000
SHORT = 48  # longer units are encoded each time


def fields(message: bytes) -> Iterator[tuple[int, object]]:
    """(number, value) of each field of a protocol-buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = message[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(message):
        number, kind = divmod(varint(), 8)
        if kind == 0:
            yield number, varint()
        else:
            size = varint() if kind == 2 else {1: 8, 5: 4}[kind]
            yield number, message[at:at + size]
            at += size


class PieceModel:
    """Encoder and decoder of one model file: BPE, identity normalisation, escaped spaces, byte fallback."""

    def __init__(self, path: str):
        import ahocorasick

        with open(path, "rb") as file:
            parts = list(fields(file.read()))
        pieces = [dict(fields(v)) for k, v in parts if k == 1]
        trainer = dict(fields(next(v for k, v in parts if k == 2)))
        normalizer = dict(fields(next(v for k, v in parts if k == 3)))
        if trainer.get(3) != 2 or normalizer.get(2) or normalizer.get(4, 1) or not normalizer.get(5, 1) or not trainer.get(35):
            raise ValueError("not a BPE model with identity normalisation, escaped spaces and byte fallback")
        self.prefix = MARK if normalizer.get(3, 1) else ""
        texts = [p[1].decode() for p in pieces]
        kinds = [p.get(3, NORMAL) for p in pieces]
        if {USER, UNUSED} & set(kinds):
            raise ValueError("user-defined and unused pieces are not supported")
        self.begin, self.end = trainer.get(41, 1), trainer.get(42, 2)
        self.id_of = {t: i for i, (t, k) in enumerate(zip(texts, kinds, strict=True)) if k == NORMAL}
        self.score = {t: struct.unpack("<f", pieces[i][2])[0] for t, i in self.id_of.items()}
        self.bytes_of = {int(t[3:5], 16): i for i, (t, k) in enumerate(zip(texts, kinds, strict=True)) if k == BYTE}
        self.controls = {i for i, k in enumerate(kinds) if k == CONTROL}
        self.leads = {i for t, i in self.id_of.items() if self.prefix and t[0] == MARK}
        unknown = bytes(trainer.get(44, b" \xe2\x81\x87 "))
        self.surface = [
            b"" if k == CONTROL else bytes([int(t[3:5], 16)]) if k == BYTE else unknown if k == UNKNOWN else t.replace(MARK, " ").encode()
            for t, k in zip(texts, kinds, strict=True)
        ]
        if any(MARK in t.lstrip(MARK) or "\n" in t for t in self.id_of):
            raise ValueError("a piece reaches across a space or a line feed")
        self.automaton = ahocorasick.Automaton()
        for t in self.id_of:
            self.automaton.add_word(t, t)
        self.automaton.make_automaton()
        self.code_of = {t: struct.pack("<I", i) for t, i in self.id_of.items()}
        self.pairs = Remembered(PAIRS)
        self.units = Remembered(UNITS)
        self.spaced = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")

    def merged(self, text: str) -> list[str]:
        """The text's symbols after merging: the best pair first, the leftmost of equals."""
        symbols, score = list(text), self.score.get
        while len(symbols) > 1:
            best, where = None, 0
            for i in range(len(symbols) - 1):
                s = score(symbols[i] + symbols[i + 1])
                if s is not None and (best is None or s > best):
                    best, where = s, i
            if best is None:
                break
            symbols[where:where + 2] = [symbols[where] + symbols[where + 1]]
        return symbols

    def compatible(self, left: str, right: str) -> bool:
        """Whether the two pieces, merged anew together, come out as themselves."""
        key = (left, right)
        known = self.pairs.get(key)
        if known is None:
            known = self.merged(left + right) == ([left, right] if left else [right])
            self.pairs.put(key, known)
        return known

    def unit_pieces(self, unit: str) -> list[str]:
        """The pieces of a unit, by backtracking over all matches of the vocabulary."""
        matches = [[c] for c in unit]  # at each place, shortest first; a character always stands for itself
        for last, piece in self.automaton.iter(unit):
            if len(piece) > 1:
                matches[last - len(piece) + 1].append(piece)
        n, known = len(unit), self.pairs.young.get
        failed = bytearray((n >> 3) + 1)
        taken: list[str] = []
        place, before = 0, ""
        while place < n:
            here = matches[place]  # a place is entered once, so what has been tried can go
            while here:
                piece = here.pop()
                after = place + len(piece)
                if failed[after >> 3] >> (after & 7) & 1:
                    continue
                fits = known((before, piece))
                if fits or fits is None and self.compatible(before, piece):
                    taken.append(piece)
                    before, place = piece, after
                    break
            else:
                failed[place >> 3] |= 1 << (place & 7)
                place -= len(taken.pop())
                before = taken[-1] if taken else ""
        return taken

    def unit(self, unit: str) -> bytes:
        """Ids of a unit as little-endian 32-bit words."""
        pieces = self.unit_pieces(unit)
        try:
            out = b"".join([self.code_of[p] for p in pieces])
        except KeyError:  # a character the vocabulary lacks
            out = b"".join([self.code_of.get(p) or b"".join([struct.pack("<I", self.bytes_of[b]) for b in p.encode()]) for p in pieces])
        if len(unit) <= SHORT:
            self.units.put(unit, out)
        return out

    def encode(self, text: str) -> bytes:
        """Ids with begin and end, as little-endian 32-bit words."""
        out = [struct.pack("<I", self.begin)]
        if text:
            lines = (self.prefix + text.replace(" ", MARK)).split("\n")
            young, known, feed = self.units.young, self.units.get, struct.pack("<I", self.bytes_of[10])
            for k, line in enumerate(lines):
                if k:
                    out.append(feed)
                for unit in self.spaced.findall(line):
                    code = young.get(unit) or known(unit)
                    out.append(code or self.unit(unit))
        out.append(struct.pack("<I", self.end))
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        """The text of ids; bytes that are no UTF-8 become U+FFFD each, one leading space goes."""
        numbers = memoryview(ids).cast("I").tolist()
        inner = numbers[numbers[:1] == [self.begin]:len(numbers) - (numbers[-1:] == [self.end])]
        raw = b"".join([self.surface[i] for i in inner])
        if next((i for i in inner if i not in self.controls), None) in self.leads:
            raw = raw[1:]
        try:
            return raw.decode()
        except UnicodeDecodeError:
            return raw.decode(errors="surrogateescape").translate(UNDECODED)


UNDECODED = {0xDC00 + b: "�" for b in range(128, 256)}  # what surrogateescape puts for a byte


def encoded(docs: DataFrame, model: str) -> DataFrame:
    """doc_id, ids (binary, little-endian unsigned 32-bit), decoded: one row per row of ``docs``.

    A null text counts as empty and has the begin and end id alone.  Whole texts are encoded, whatever
    their length or a lack of spaces.  Repeated rows, null ids and ids that occur twice are rows of
    their own; other columns are not looked at.  An empty table gives an empty result.  No shuffle.
    ``model`` is the path of the file on every executor.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = per_worker(("pieces", model), lambda: PieceModel(model))
        for batch in batches:
            ids, texts = [], []
            for value in batch.column(1):
                ids.append(kept.encode(value.as_py() or ""))
                texts.append(kept.decode(ids[-1]))
            yield pa.record_batch([batch.column(0), pa.array(ids, pa.binary()), pa.array(texts, pa.string())], ["doc_id", "ids", "decoded"])

    slim = own_columns(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text")
    return slim.mapInArrow(run, "doc_id long, ids binary, decoded string")
