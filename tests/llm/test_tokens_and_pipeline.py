"""Token counts, packing and the pipeline."""

import random
import sys
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from telemetry_lake.llm import bpe_count, common, minhash, packing, toxicity
from telemetry_lake.llm.queries import QUERIES, vocabulary
from telemetry_lake.llm.sql import SQL
from verification.compare import connect, difference

from .conftest import ODD, documents
from .test_dedup import brute_components

WORDS, BYTES = vocabulary("word_bpe_49k.json"), vocabulary("byte_bpe_50k.json")
HARD = [
    "  a  b\n\n c <|endoftext|> d <|startoftext|>", "ΣΑΣ İstanbul ́e é ﬁ ½ x²\x1c\x85\xa0y 日本語 😀👍🏽 don't we'll IT'S", "\r\n\r\n\t x'S 'RE", " <| x |>",
    " a \n b\n c ", "x \n y\n\nz", "a \n", "\n a", "a" * 3000, "x \t y' s 's",
]


@pytest.fixture(scope="module")
def libraries():
    return Tokenizer.from_file(WORDS), Tokenizer.from_file(BYTES)


@pytest.fixture(scope="module")
def own():
    return bpe_count.WordCounter(WORDS), packing.IdEncoder(BYTES)


def test_path_is_the_public_one():
    assert WORDS == public_tokenizers.path("word_bpe_49k.json")


def test_counts_and_ids_of_hard_texts(libraries, own):
    for text in HARD + [t or "" for _, t, *_ in ODD]:
        assert own[0].count(text) == len(libraries[0].encode(text, add_special_tokens=False).ids)
        assert own[1].ids(text) == np.asarray(libraries[1].encode(text, add_special_tokens=False).ids, "<u4").tobytes()


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from(list("abThe '’sSrR12½éñßÉ \n\t.,!-—\xa0́日😀")), max_size=40))
def test_counts_and_ids_of_any_text(libraries, own, text):
    assert own[0].count(text) == len(libraries[0].encode(text, add_special_tokens=False).ids)
    assert own[1].ids(text) == np.asarray(libraries[1].encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def test_merges_against_a_scan_of_all_pairs():
    rng = random.Random(4)
    for _ in range(300):
        ranks = {}
        for i in range(40):
            ranks.setdefault(("".join(rng.choices("ab", k=rng.choice([1, 1, 2, 3]))), "".join(rng.choices("ab", k=rng.choice([1, 1, 2, 3])))), i)
        symbols = rng.choices("ab", k=rng.randrange(0, 25))
        list_, done = list(symbols), 0
        while pairs := [(ranks[p], i) for i, p in enumerate(zip(list_, list_[1:])) if p in ranks]:
            i = min(pairs)[1]
            list_[i:i + 2] = [list_[i] + list_[i + 1]]
            done += 1
        assert bpe_count.merges_in(list(symbols), ranks) == done


def test_token_counts_of_rows(spark, odd, empty, libraries):
    got = Counter((r.doc_id, r.n_bytes, r.n_tokens) for r in bpe_count.token_counts(odd, WORDS).collect())
    assert got == Counter((i, len((t or "").encode()), len(libraries[0].encode(t or "", add_special_tokens=False).ids)) for i, t, *_ in ODD)
    assert bpe_count.token_counts(empty, WORDS).collect() == []


def test_histogram_packing():
    for seed in range(200):
        rng = random.Random(seed)
        length = rng.choice([16, 64, 2048])
        histogram = {s: rng.choice([1, 2, 3, 50, 1000]) for s in rng.sample(range(1, length + 1), min(length, rng.randint(1, 200)))}
        patterns, used = packing.pack_histogram(histogram, length), Counter()
        for count, pattern in patterns:
            assert count > 0 and sum(pattern) <= length
            for s in pattern:
                used[s] += count
        assert used == histogram
        tokens, sequences = sum(s * n for s, n in histogram.items()), sum(c for c, _ in patterns)
        assert sequences <= 1.7 * tokens / length + 1


def packed(rows, texts, library, length):
    """Every id in exactly one piece, every sequence gapless and within its length."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    assert set(by_doc) == set(texts)
    for doc, pieces in by_doc.items():
        ids = [*library.encode(texts[doc][0] or "", add_special_tokens=False).ids, 1]
        copies = texts[doc][1]
        starts = Counter(p.start for p in pieces)
        assert set(starts.values()) == {copies} and sum(p.length for p in pieces) == copies * len(ids)
        for p in pieces:
            assert p.doc_tokens == len(ids)
            assert p.ids_crc32 == zlib.crc32(np.asarray(ids[p.start:p.start + p.length], "<u4").tobytes())
    for pieces in by_sequence.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= length


def test_pack_of_odd_rows(spark, odd, empty, libraries):
    texts = {i: (t, sum(j == i for j, *_ in ODD)) for i, t, *_ in ODD}
    packed(packing.pack(odd, BYTES).collect(), texts, libraries[1], 2048)
    packed(packing.pack(odd, BYTES, length=50).collect(), texts, libraries[1], 50)
    assert packing.pack(empty, BYTES).collect() == []


def test_padding_is_small(spark):
    rows = QUERIES["op10_packing"](spark, "/root/testdata/sf0.01").collect()
    assert len({r.sequence_id for r in rows}) * 2048 <= 1.02 * sum(r.length for r in rows) + 2048


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(spark, sf_dir, name):
    assert difference(QUERIES[name](spark, sf_dir), connect(sf_dir), SQL[name]) is None


def test_pipeline_by_stages(spark, sf_dir, libraries, tmp_path):
    """Each stage against what its input says; the last against run()."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    tables = {"documents": docs}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{tmp_path}/{name}")
        tables[name] = docs = spark.read.parquet(f"{tmp_path}/{name}")
    rows = {name: [r.asDict() for r in df.collect()] for name, df in tables.items()}
    for name in ("toxicity", "line_dedup", "near_dedup", "mixing"):
        assert tables[name].columns == tables["documents"].columns
    labels = {r["doc_id"]: r["toxic"] for r in pq.read_table(f"{sf_dir}/labels.parquet").to_pylist()}
    gone = {r["doc_id"] for r in rows["documents"]} - {r["doc_id"] for r in rows["toxicity"]}
    assert sum(labels.get(i) == 0 for i in gone) <= 0.05 * sum(y == 0 for y in labels.values())
    assert {r["doc_id"] for r in rows["line_dedup"]} == {r["doc_id"] for r in rows["toxicity"]}
    assert all(r["n_chars"] == len(r["text"]) for r in rows["line_dedup"])
    components = brute_components([(r["doc_id"], r["text"]) for r in rows["line_dedup"]], 5)
    assert {r["doc_id"] for r in rows["near_dedup"]} == {i for i, (_, _, kept) in components.items() if kept}
    copies = Counter(r["doc_id"] for r in rows["mixing"])
    assert set(copies) <= {r["doc_id"] for r in rows["near_dedup"]} and max(copies.values()) <= 2
    texts = {r["doc_id"]: (r["text"], copies[r["doc_id"]]) for r in rows["mixing"]}
    packed(tables["packing"].collect(), texts, libraries[1], 2048)
    run = corpus_pipeline.run(spark, sf_dir)
    assert Counter(map(tuple, run.drop("sequence_id", "offset").collect())) == Counter(map(tuple, tables["packing"].drop("sequence_id", "offset").collect()))


def test_stages_on_odd_rows_and_none(spark, odd, empty, sf_dir):
    for docs in (documents(spark, [(i, t, *r) for i, t, *r in ODD]), empty):
        for _, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, sf_dir)
            assert out.count() >= 0


@pytest.mark.parametrize("stage", ["toxicity", "near_dedup", "packing"])
def test_texts_reach_workers_a_few_mb_at_a_time(spark, stage):
    """Not 10,000 rows or 64 MB at once, which executor and worker hold several times over."""
    limit = "spark.sql.execution.arrow.maxBytesPerBatch"
    docs = spark.range(0, 3000, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("word "), 1000).alias("text"))
    evidence = toxicity.Evidence(*[np.zeros(0, np.int64)] * 3, 0, 0)
    model = toxicity.Model(evidence, np.zeros(len(toxicity.KINDS)), -6.0, np.zeros((2, 2)))
    use = {"toxicity": lambda: toxicity.score(docs, model), "near_dedup": lambda: minhash.signatures(docs, 5), "packing": lambda: packing.cut_pieces(docs, BYTES)}

    def sizes(batches):
        for batch in batches:
            yield pa.record_batch([pa.array([batch.num_rows]), pa.array([batch.nbytes])], ["rows", "bytes"])

    spark.conf.unset(limit)
    use[stage]()
    got = docs.mapInArrow(sizes, "rows long, bytes long").collect()
    assert sum(r.rows for r in got) == 3000 and max(r.bytes for r in got) < 2 * common.BATCH_BYTES


def test_other_steps_drop_the_word_table_of_packing(spark, monkeypatch):
    """Workers are reused: the table of an earlier packing would lie beside the tables of the next step."""
    docs = spark.range(1).select(F.col("id").alias("doc_id"), F.lit("a text").alias("text"))
    batch = pa.record_batch([pa.array([0]), pa.array(["a text"])], ["doc_id", "text"])
    model = toxicity.Model(toxicity.Evidence(*[np.zeros(0, np.int64)] * 3, 0, 0), np.zeros(len(toxicity.KINDS)), -6.0, np.zeros((2, 2)))
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, run, schema: run)
    for run in (toxicity.score(docs, model), minhash.signatures(docs, 5)):
        common.per_worker(("packing", BYTES), object)
        assert [b.num_rows for b in run(iter([batch]))] == [1]
        assert sys.modules["_telemetry_lake_kept"].key != ("packing", BYTES)


def test_copies_reach_near_dedup_whole(spark, sf_dir):
    """One host: a line on most pages, and a text with more copies than the ratio allows."""
    body = lambda i: "\n".join(f"line {k} of page {i} says something of its own" for k in range(6))
    rows = [(i, f"menu of the host\n{body(i)}", "en", "h") for i in range(100)] + [(500 + i, body("copied"), "en", "h") for i in range(20)]
    rows += [(700 + i, rows[0][1], "en", "h") for i in range(20)]  # copies of the page that keeps the menu
    docs = documents(spark, rows)
    cleaned = {r.doc_id: r.text for r in corpus_pipeline.line_stage(spark, docs, sf_dir).collect()}
    assert all(cleaned[500 + i] == body("copied") and cleaned[700 + i] == rows[0][1] for i in range(20))
    assert cleaned[0] == rows[0][1] and all(cleaned[i] == body(i) for i in range(1, 100))
    kept = {r.doc_id for r in corpus_pipeline.near_dedup_stage(spark, corpus_pipeline.line_stage(spark, docs, sf_dir), sf_dir).collect()}
    assert kept == {*range(100), 500}


def test_near_dedup_of_repeated_rows_and_null_ids(spark, sf_dir):
    """Of equal rows one stays, with or without an id; rows of one id with different texts are no copies."""
    t, u, v = ("words that say one thing about " + w for w in ("the harbour at night", "the market in spring", "a bridge nobody crosses any more"))
    rows = [(9, t), (9, t), (None, u), (None, u), (11, v), (11, "something else altogether, with other words in it"), (12, ""), (12, "")]
    got = Counter((r.doc_id, r.text) for r in corpus_pipeline.near_dedup_stage(spark, documents(spark, rows), sf_dir).collect())
    assert got == Counter({(9, t): 1, (None, u): 1, (11, v): 1, (11, rows[5][1]): 1, (12, ""): 1})


def test_stages_keep_columns_whose_names_they_use(spark, sf_dir):
    """Extra columns with working names come through with their values, in every stage but the last."""
    names = ["_gone", "_kept", "dropped_lines", "_copies", "_rows", "_copy", "_nth", "near_id", "page", "bit", "class0", "decided", "row", "class", "_score"]
    docs = documents(spark, [(i, f"menu\nline number {i} of its own kind {i % 3}", "en", "s") for i in range(12)])
    extra = docs.drop("row").withColumns({n: F.lit(f"own {n}") for n in names})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, extra, sf_dir)
        gone = {"dropped_lines"} if name == "line_dedup" else set()
        assert set(extra.columns) - gone - {"_score"} <= set(out.columns), name
        for n in set(names) - gone - {"_score"}:
            assert {r[0] for r in out.select(F.col(f"`{n}`")).distinct().collect()} <= {f"own {n}"}, (name, n)
