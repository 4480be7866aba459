"""Token counts by heap-and-linked-list byte-pair merging.

A word's symbols stand in a linked list; a heap holds the ranks of adjacent pairs.  The lowest rank is
popped (the leftmost of equals), its pair joined, and the two new neighbours pushed.  The count is the
number of initial symbols less the number of merges; no identifiers are made.  Counts of words are
remembered in a bounded table of each Python worker.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemetry_lake.llm.common import own_columns

REMEMBERED = 600_000


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself, or the next free one from U+0100."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    free = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(free)) for b in range(256)]


def merges_in(symbols: list[str], ranks: dict[tuple[str, str], int]) -> int:
    """How many merges the list of symbols undergoes."""
    n, done = len(symbols), 0
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(r, i, symbols[i], symbols[i + 1]) for i in range(n - 1) if (r := ranks.get((symbols[i], symbols[i + 1]))) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, left, right = heapq.heappop(heap)
        j = after[i]
        if symbols[i] != left or j >= n or symbols[j] != right:
            continue  # one of the two has been merged meanwhile
        symbols[i], symbols[j] = left + right, ""
        after[i] = k = after[j]
        done += 1
        if k < n:
            before[k] = i
            if (r := ranks.get((symbols[i], symbols[k]))) is not None:
                heapq.heappush(heap, (r, i, symbols[i], symbols[k]))
        if (h := before[i]) >= 0 and (r := ranks.get((symbols[h], symbols[i]))) is not None:
            heapq.heappush(heap, (r, h, symbols[h], symbols[i]))
    return done


class WordCounter:
    """Tokens of a text under a vocabulary file with word ends, as the file's own library counts them."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.ranks = {tuple(m.split(" ") if isinstance(m, str) else m): i for i, m in enumerate(spec["model"]["merges"])}
        self.end = spec["model"]["end_of_word_suffix"] or ""
        self.pieces = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        added = [t["content"] for t in spec["added_tokens"]]
        self.added = re.compile("|".join(map(re.escape, added)))
        self.marker = added[0][:2]
        self.alphabet = byte_symbols()
        self.of_word: dict[bytes, int] = {}
        self.of_piece: dict[str, int] = {}

    def piece(self, piece: str) -> int:
        if (n := self.of_piece.get(piece)) is None:
            symbols = [self.alphabet[b] for b in piece.encode()]
            symbols[-1] += self.end
            n = len(symbols)
            n -= merges_in(symbols, self.ranks)
            if len(self.of_piece) >= REMEMBERED:
                self.of_piece.clear()
            if len(piece) < 100:
                self.of_piece[piece] = n
        return n

    def word(self, word: bytes) -> int:
        """Pieces never reach across white space, nor does composition of characters."""
        text = unicodedata.normalize("NFC", word.decode())
        # Lower case is taken character by character: a capital sigma never becomes a final one.
        n = sum(map(self.piece, self.pieces.findall(text.replace("Σ", "σ").lower())))
        if len(self.of_word) >= REMEMBERED:
            self.of_word.clear()
        if len(word) < 100:
            self.of_word[word] = n
        return n

    def plain(self, text: str) -> int:
        known, total = self.of_word.get, 0
        for word in text.encode("utf-8", "replace").split():
            n = known(word)
            total += self.word(word) if n is None else n
        return total

    def count(self, text: str) -> int:
        """Strings of added tokens inside a text are one token each and cut it, as the library does by default."""
        if self.marker not in text:
            return self.plain(text)
        return sum(map(self.plain, self.added.split(text))) + len(self.added.findall(text))


def token_counts(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, n_bytes, n_tokens: one row per row of ``docs``; null texts count as empty (0 tokens).

    ``vocabulary`` is the path of the file on every executor.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = None
        for batch in batches:
            counter = counter or WordCounter(vocabulary)
            ids, texts = batch.columns
            sizes, counts = [], []
            for value in texts:
                text = value.as_py() or ""
                sizes.append(len(text.encode("utf-8", "replace")))
                counts.append(counter.count(text))
            yield pa.record_batch([ids, pa.array(sizes, pa.int64()), pa.array(counts, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    slim = own_columns(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text")
    return slim.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")
