"""Periodic runs by online dyadic square catching.

A run is a stretch of words with smallest period p, at least two periods long, that no neighbouring
word extends.  Every square of period p with ``2L - 1 <= p <= 4L - 2`` has a whole dyadic block of L
words, L a power of two and its start a multiple of L, inside its first half; the block comes again p
words later.  So a catcher sits on each block as soon as it is complete and waits for that echo:

- ``append`` takes the next words.  At each level every new window of L words is compared, by its
  64-bit hash, with the two blocks whose catchers wait for it: two suffix comparisons a word and level.
  Hashes of 2L words come from those of L words, so a level costs the same whatever L is.
- Echoes of neighbouring blocks at the same distance form one chain.  A chain that cannot reach a
  period is let go; the others are compared word by word, up to one block beyond either end, which is
  as far as a stretch can reach without touching another block.  Hashes only propose, words decide.
- The squares found are stretches that merge into runs: of stretches over the same words the smallest
  period holds.

The texts of a batch are appended one after the other, with a word of its own between any two, so no
stretch reaches across.  Texts come longest first: a level ends where texts are too short for it.
Memory is a few arrays of the words of a batch; a batch is cut when it holds ``BATCH_WORDS``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemetry_lake.llm.common import own_columns

LEAST_WORDS = 12
BATCH_WORDS = 300_000
RUN = "struct<start:long,length:long,period:long>"
ARROW_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def mixed(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """A 64-bit hash of two hashes in order."""
    out = left * np.uint64(0x9E3779B97F4A7C15) + (right ^ (right >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return out ^ (out >> np.uint64(32))


class SquareCatcher:
    """Maximal stretches with a period in words that are appended batch by batch.

    ``cuts``: the end, in words, of what takes part at each level, for texts sorted by length that come
    in one append; a level's texts are then a prefix.  Without it all words take part in all levels.
    """

    def __init__(self, least: int = LEAST_WORDS):
        self.least = least
        self.words = np.zeros(0, np.int64)
        self.hashes: list[np.ndarray] = []  # by level: of each window of 2^level words that is complete
        self.chains: list[list[tuple[int, int, int]]] = []  # by level: (first block, last block, distance)
        self.last: list[dict[int, int]] = []  # by level: distance -> its latest chain

    def append(self, words: np.ndarray, cuts: list[int] | None = None) -> None:
        """Take the next words; every catcher whose window they reach moves on."""
        self.words = np.concatenate([self.words, words])
        level = 0
        while (end := len(self.words) if cuts is None else cuts[level] if level < len(cuts) else 0) >= 2 * (2 << level) - 2 and end:
            size = 1 << level
            if level == len(self.hashes):
                self.hashes.append(np.zeros(0, np.uint64))
                self.chains.append([])
                self.last.append({})
            done = len(self.hashes[level])
            if level:
                below = self.hashes[level - 1]
                below = below[: max(0, end - size // 2 + 1)]
                new = mixed(below[done:-(size // 2)], below[done + size // 2:]) if len(below) > done + size // 2 else np.zeros(0, np.uint64)
            else:
                new = mixed(self.words[done:end].astype(np.uint64), np.uint64(level))
            self.hashes[level] = held = np.concatenate([self.hashes[level], new]) if done else new
            self.advance(level, held, done, cuts is not None)
            if cuts is not None and level:
                self.hashes[level - 1] = np.zeros(0, np.uint64)  # one append: nothing will ask again
            level += 1

    def advance(self, level: int, held: np.ndarray, first: int, whole: bool) -> None:
        """Windows from ``first`` on against the two blocks that wait for each."""
        size = 1 << level
        first = max(first, 2 * size - 1)
        at = np.arange(first, len(held))
        if not len(at):
            return
        near = (at - (2 * size - 1)) >> level << level
        own = held[first:]
        blocks, places = [], []
        for block in (near, near - size):
            hit = np.flatnonzero((held[np.maximum(block, 0)] == own) & (block >= 0))
            blocks.append(block[hit])
            places.append(at[hit])
        block, place = np.concatenate(blocks), np.concatenate(places)
        if not len(block):
            return
        distance = place - block
        order = np.lexsort((block, distance))
        block, distance = block[order], distance[order]
        starts = np.flatnonzero(np.concatenate([[True], (np.diff(block) != size) | (np.diff(distance) != 0)]))
        ends = np.concatenate([starts[1:], [len(block)]]) - 1
        chains, last = self.chains[level], self.last[level]
        found = zip(block[starts].tolist(), block[ends].tolist(), distance[starts].tolist(), strict=True)
        if whole:
            chains += found
            return
        for a, b, p in found:  # the last append may have ended inside a chain
            k = last.get(p)
            if k is not None and chains[k][1] + size == a:
                chains[k] = (chains[k][0], b, p)
            else:
                last[p] = len(chains)
                chains.append((a, b, p))

    def stretches(self) -> Iterator[tuple[int, int, int]]:
        """(start, end, period) of each maximal stretch with that period, at least two periods and ``least`` words long.

        A chain inside a stretch of which its distance is a multiple is that stretch again and not
        compared: a text that repeats one word has as many such chains as words.
        """
        words, n, long = self.words, len(self.words), []
        for level, found in enumerate(self.chains):
            if not found:
                continue
            size = 1 << level
            chains = np.asarray(found, np.int64)
            needed = np.maximum(chains[:, 2], self.least - chains[:, 2])
            chains = chains[chains[:, 1] - chains[:, 0] + 3 * size - 2 >= needed]
            chains = chains[np.lexsort((chains[:, 2], chains[:, 0]))]
            open_ = np.ones(len(chains), bool)
            for s, e, q in long:
                self.close(chains, open_, size, s, e, q)
            for i in np.argsort(chains[:, 2], kind="stable").tolist():
                if not open_[i]:
                    continue
                a, b, p = chains[i].tolist()
                needed = max(p, self.least - p)
                low, high = max(0, a - size), min(n - p, b + 2 * size)
                same = words[low:high] == words[low + p:high + p]
                edge = np.flatnonzero(np.diff(np.concatenate([[False], same, [False]]).view(np.int8)))
                for s, e in zip((edge[::2] + low).tolist(), (edge[1::2] + low).tolist(), strict=True):
                    if e - s >= needed and s < b + size and e > a:
                        yield s, e + p, p
                        if e - s >= 3 * p:
                            long.append((s, e + p, p))
                            self.close(chains, open_, size, s, e + p, p)

    @staticmethod
    def close(chains: np.ndarray, open_: np.ndarray, size: int, start: int, end: int, period: int) -> None:
        """Close the chains that only show the stretch (start, end, period) again."""
        i, j = np.searchsorted(chains[:, 0], (start, end))
        a, b, p = chains[i:j].T
        open_[i:j] &= ~((b + size + p <= end) & (p > period) & (p % period == 0))


def merged(stretches: Iterator[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Stretches to runs (start, length, period), sorted: over the same words the smallest period holds."""
    smallest: dict[tuple[int, int], int] = {}
    for s, e, p in stretches:
        if p < smallest.get((s, e), p + 1):
            smallest[s, e] = p
    return sorted((s, e - s, p) for (s, e), p in smallest.items())


def runs_of_texts(texts: list[list[bytes]], least: int = LEAST_WORDS) -> list[list[tuple[int, int, int]]]:
    """The runs of each list of words."""
    order = sorted((i for i, t in enumerate(texts) if len(t) >= least), key=lambda i: -len(texts[i]))
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if not order:
        return out
    number: dict[bytes, int] = {}
    codes: list[int] = []
    starts = []
    for k, i in enumerate(order):
        starts.append(len(codes))
        codes += [number.setdefault(w, len(number)) for w in texts[i]]
        codes.append(-1 - k)
    cuts, level = [], 0
    lengths = np.asarray([len(texts[i]) for i in order])
    while (part := int((lengths >= 2 * (2 * (1 << level) - 1)).sum())) > 0:
        cuts.append(starts[part - 1] + int(lengths[part - 1]) + 1)
        level += 1
    catcher = SquareCatcher(least)
    catcher.append(np.asarray(codes, np.int64), cuts)
    bounds = np.asarray(starts)
    for s, length, p in merged(catcher.stretches()):
        k = int(np.searchsorted(bounds, s, "right")) - 1
        out[order[k]].append((s - starts[k], length, p))
    return out


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The text with each run cut down to its first period; a word goes if any run has it after that."""
    if not runs:
        return b" ".join(words)
    keep = np.ones(len(words), bool)
    for start, length, period in runs:
        keep[start + period:start + length] = False
    return b" ".join([words[i] for i in np.flatnonzero(keep).tolist()])


def periodic_runs(docs: DataFrame, text: str = "text", least: int = LEAST_WORDS, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep``, n_words, runs, collapsed: one row per row of ``docs``.

    ``runs``: (start, length, period) in words, sorted; overlapping runs are all there.  ``collapsed``:
    the words that are left when each run keeps its first period, with one space between.  A null or
    empty text has no words, no runs and an empty ``collapsed``.  Repeated rows, null ids and ids that
    occur twice are rows of their own; other columns of ``docs`` are not looked at.  An empty table
    gives an empty result.  No shuffle: a text is one row's work.
    """
    names = [*keep, "n_words", "runs", "collapsed"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(len(keep)).cast(pa.binary())
            at = 0
            while at < batch.num_rows:
                first, held, texts = at, 0, []
                while at < batch.num_rows and (held < BATCH_WORDS or at == first):
                    texts.append((values[at].as_py() or b"").split())  # bytes split at ASCII white space alone
                    held += len(texts[-1])
                    at += 1
                runs = runs_of_texts(texts, least)
                yield pa.record_batch(
                    [
                        *[batch.column(i).slice(first, at - first) for i in range(len(keep))],
                        pa.array([len(t) for t in texts], pa.int64()),
                        pa.array([[{"start": s, "length": n, "period": p} for s, n, p in r] for r in runs], pa.list_(ARROW_RUN)),
                        pa.array([collapsed(t, r) for t, r in zip(texts, runs, strict=True)], pa.binary()).cast(pa.string()),
                    ],
                    names,
                )

    slim = own_columns(docs, *keep, text)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in slim.schema.fields[: len(keep)])
    return slim.mapInArrow(run, f"{kinds}, n_words long, runs array<{RUN}>, collapsed string")


def looped_words(doc_id: str = "doc_id", text: str = "text"):
    """The words of a text as one string, every tenth document (by the checksum of its id) made periodic.

    With h the checksum and g = h // 10: where h is a multiple of ten, each word from the (g mod n)-th on
    is one of the p words from there, again and again.  A null id has no checksum: its text stays.
    """
    h = F.crc32(F.col(doc_id).cast("string"))
    words = F.filter(F.split(F.col(text), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    n, g = F.size(words).cast("long"), F.floor(h / 10).cast("long")
    a = g % n
    p = F.lit(1).cast("long") + F.floor((n - a) / (F.lit(3) + g % 8)).cast("long")
    turns = F.ceil((n - a) / p).cast("int")
    head, turn = F.slice(words, F.lit(1), a.cast("int")), F.slice(words, (a + 1).cast("int"), p.cast("int"))
    looped = F.slice(F.concat(head, F.flatten(F.array_repeat(turn, turns))), F.lit(1), n.cast("int"))
    return F.when((h % 10 == 0) & (n > 0), F.array_join(looped, " ")).otherwise(F.col(text))
