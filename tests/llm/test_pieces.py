"""SentencePiece ids and texts against the library."""

import hashlib
import random
import struct

import pyarrow.parquet as pq
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from telemetry_lake.llm.common import Remembered
from telemetry_lake.llm.pieces import PieceModel, encoded
from telemetry_lake.llm.queries import QUERIES, vocabulary

from .conftest import ODD

MODEL = vocabulary("piece_bpe_32k.model")
HARD = [
    "", " ", "  ", "a", " a", "a ", "a\n", "▁a", "<s>", "</s>", "<unk>", "<0x0A>", "日本語x", "\x00a", "a  b   c", " " * 1000, "a" * 5000, "ab" * 3000,
    "\r\n" * 20, "x\t\ty", "😀👍🏽", " \n \n", "();\r\n", "\n▁", "▁" * 37, "𐍈𐍈", "é" * 400, "x y", "﻿a", "é",
]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def own():
    return PieceModel(MODEL)


def ids(code):
    return list(struct.unpack(f"<{len(code) // 4}I", code))


def agree(library, own, text):
    want = library.encode(text, add_bos=True, add_eos=True)
    code = own.encode(text)
    assert ids(code) == want
    assert own.decode(code) == library.decode(want)


def test_hard_texts(library, own):
    for text in HARD + [t or "" for _, t, *_ in ODD]:
        agree(library, own, text)


@settings(max_examples=400, deadline=None)
@given(st.text(st.sampled_from(list("abThe the  \n'éñß日😀▁\r();,.12")), max_size=60))
def test_any_text(library, own, text):
    agree(library, own, text)


def test_strings_of_pieces(library, own):
    """Pieces side by side, with and without their spaces: greedy matches that must be taken back."""
    rng, pieces = random.Random(3), list(own.id_of)
    for _ in range(4000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randrange(1, 9)))
        agree(library, own, rng.choice([text, text.replace("▁", "")]))


def test_backtracking_without_remembered_pairs_or_units(library):
    """The same results where everything remembered is thrown away again and again."""
    small = PieceModel(MODEL)
    small.pairs, small.units = Remembered(4), Remembered(4)
    for text in HARD:
        agree(library, small, text)


def test_decoding_of_broken_bytes(library, own):
    byte = own.bytes_of
    for numbers in ([byte[0xE6], byte[0x97]], [byte[0x80], 264], [264, byte[0xC3], 264, byte[0xA9]], [1, 2], [2, 264, 1], [byte[0xF0], byte[0x9F], byte[0x98], byte[0x80]]):
        assert own.decode(struct.pack(f"<{len(numbers)}I", *numbers)) == library.decode(numbers)


def test_rows(spark, odd, empty, library):
    got = sorted(((r.doc_id, ids(r.ids), r.decoded) for r in encoded(odd, MODEL).collect()), key=repr)
    want = [library.encode(t or "", add_bos=True, add_eos=True) for _, t, *_ in ODD]
    assert got == sorted(((i, w, library.decode(w)) for (i, *_), w in zip(ODD, want, strict=True)), key=repr)
    assert encoded(empty, MODEL).collect() == []


def test_query(spark, sf_dir, library):
    want = {}
    for r in pq.read_table(f"{sf_dir}/documents.parquet", columns=["doc_id", "text"]).to_pylist():
        numbers = library.encode(r["text"] or "", add_bos=True, add_eos=True)
        want[r["doc_id"]] = (len(numbers), hashlib.sha256(struct.pack(f"<{len(numbers)}I", *numbers)).hexdigest(), hashlib.sha256(library.decode(numbers).encode()).hexdigest())
    assert {r.doc_id: tuple(r)[1:] for r in QUERIES["op12_sentence_pieces"](spark, sf_dir).collect()} == want
