"""Packing into fixed-length sequences: shortest-pack-first over the length histogram.

Documents become pieces of at most ``length`` tokens.  The histogram of piece lengths (at most one row
per length) is packed on the driver: lengths are placed longest first, each time into the open packing
pattern with the fewest tokens that they fit, and the patterns' counts are split accordingly.  Pieces
then find their place by rank: the r-th piece of a length takes the r-th slot for that length.

The packer works on counts: its work depends on the number of lengths, never on that of documents.
"""

from __future__ import annotations

import bisect
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemetry_lake.llm.bpe_count import byte_symbols
from telemetry_lake.llm.common import Remembered, in_small_batches, own_columns, per_worker, ranked
from telemetry_lake.session import settle

LENGTH = 2048
END_ID = 1
LONG = 100  # characters; longer words are encoded each time
PIECES_KEPT, WORDS_KEPT = 200_000, 1_000_000  # in tables of each Python worker
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"

# The vocabulary's own split of a text, from its public description.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# Texts with other characters go to the library whole, so that no difference of Unicode tables can show.
UNUSUAL = re.compile("[^\t\n\r\x20-\x7e¡-ſ‐-‧]")


class IdEncoder:
    """Ids of a text as little-endian 32-bit words, by the library; words are remembered, in bounds.

    A text is cut at single spaces, which the vocabulary's split never reaches across: a space goes
    with the characters after it.  Texts with two spaces in a row, or one at an end, are split whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.model = self.library.model
        self.split = regex.compile(PATTERN).findall
        self.shown = {b: ord(c) for b, c in enumerate(byte_symbols())}
        self.of_piece, self.of_word = Remembered(PIECES_KEPT), Remembered(WORDS_KEPT)

    def encode(self, text: str) -> bytes:
        return np.asarray(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def piece(self, piece: str) -> bytes:
        code = self.of_piece.get(piece)
        if code is None:
            shown = piece.encode().decode("latin-1").translate(self.shown)
            code = b"".join([t.id.to_bytes(4, "little") for t in self.model.tokenize(shown)])
            if len(piece) < LONG:
                self.of_piece.put(piece, code)
        return code

    def word(self, word: str) -> bytes:
        """Ids of a space and the word after it."""
        code = b"".join(map(self.piece, self.split(" " + word)))
        if len(word) < LONG:
            self.of_word.put(word, code)
        return code

    def ids(self, text: str) -> bytes:
        if "<|" in text or UNUSUAL.search(text):
            return self.encode(text)
        if "  " in text or text[:1] == " " or text[-1:] == " ":
            return b"".join(map(self.piece, self.split(text)))
        first, *rest = text.split(" ")
        young, known = self.of_word.young.get, self.of_word.get
        out = [b"".join(map(self.piece, self.split(first)))]
        for word in rest:
            out.append(young(word) or known(word) or self.word(word))
        return b"".join(out)


def cut_pieces(docs: DataFrame, vocabulary: str, length: int = LENGTH, end_id: int = END_ID) -> DataFrame:
    """Pieces of at most ``length`` ids of each document with ``end_id`` after its last."""
    tail = np.asarray([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = per_worker(("packing", vocabulary), lambda: IdEncoder(vocabulary))
        for batch in batches:
            rows: list[list] = [[], [], [], [], []]
            for doc, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = encoder.ids(value.as_py() or "") + tail
                for at in range(0, len(ids), 4 * length):
                    part = ids[at:at + 4 * length]
                    for column, x in zip(rows, (doc, at // 4, len(part) // 4, zlib.crc32(part), len(ids) // 4), strict=True):
                        column.append(x)
            yield pa.record_batch([pa.array(c, pa.int64()) for c in rows], ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    slim = own_columns(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text")
    return in_small_batches(slim).mapInArrow(run, PIECES)


def pack_histogram(histogram: dict[int, int], length: int = LENGTH) -> list[tuple[int, list[int]]]:
    """(count, lengths) of each packing pattern; each length is used as often as the histogram has it."""
    by_sum: dict[int, list[tuple[int, list[int]]]] = {}
    sums: list[int] = []  # of open patterns, ascending

    def put(total: int, count: int, pattern: list[int]) -> None:
        if total not in by_sum:
            by_sum[total] = []
            bisect.insort(sums, total)
        by_sum[total].append((count, pattern))

    for size in sorted((s for s, n in histogram.items() if n), reverse=True):
        left, grown = histogram[size], []
        while left and sums and sums[0] + size <= length:
            total = sums[0]
            count, pattern = by_sum[total].pop()
            used = min(count, left // max(1, (length - total) // size) or 1)
            times = min((length - total) // size, left // used)
            if count > used:
                by_sum[total].append((count - used, pattern))
            if not by_sum[total]:
                del by_sum[total], sums[0]
            left -= used * times
            grown.append((total + size * times, used, pattern + [size] * times))
        while left:
            times = min(length // size, left)
            used = left // times
            left -= used * times
            grown.append((size * times, used, [size] * times))
        for one in grown:
            put(*one)
    return [one for total in sums for one in by_sum[total]]


def slots(patterns: list[tuple[int, list[int]]]) -> np.ndarray:
    """length, first rank, first sequence, offset: a row for each pattern and place in it, sorted.

    A row holds for as many ranks as its pattern has copies, one sequence after the other.
    """
    rows, sequence, used = [], 0, {}
    for count, pattern in patterns:
        at = 0
        for size in pattern:
            rows.append((size, used.get(size, 1), sequence, at))
            used[size] = used.get(size, 1) + count
            at += size
        sequence += count
    return np.asarray(sorted(rows), np.int64).reshape(-1, 4)


def pack(docs: DataFrame, vocabulary: str, length: int = LENGTH, end_id: int = END_ID) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset: one row per piece.

    A null or empty text is one piece with the end id alone.  Repeated rows and null ids are documents
    of their own; pieces of one length and id take their slots in any order.  Other columns are not
    looked at.  An empty table gives an empty result.
    """
    pieces = settle(cut_pieces(docs, vocabulary, length, end_id), "pieces")
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    places = slots(pack_histogram(histogram, length))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = np.int64(1) << 42
        keys = places[:, 0] * step + places[:, 1]
        for batch in batches:
            size, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            row = np.searchsorted(keys, size * step + rank, "right") - 1
            sequence = places[row, 2] + rank - places[row, 1]
            kept = [batch.column(c) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")]
            yield pa.record_batch([*kept, pa.array(sequence), pa.array(places[row, 3])], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    return ranked(pieces, ["length"], "doc_id", ["start"]).mapInArrow(place, PIECES + ", sequence_id long, offset long")
