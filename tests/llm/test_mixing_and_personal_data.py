"""Mixing and personal data against plain Python."""

import hashlib
import re
from collections import Counter, defaultdict

import pyarrow.parquet as pq
import pytest

from telemetry_lake.llm import mixing, pii
from telemetry_lake.llm.common import counts_before, ranked
from telemetry_lake.llm.queries import QUERIES

from .conftest import ODD, documents


def brute_targets(sizes):
    """Repeat: share out by weight, cap what exceeds its ceiling."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    left, free, target = 1.5 * sum(sizes.values()), set(order), {}
    while free:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] > 2 * sizes[s]}
        if not over:
            target |= {s: level * weight[s] for s in free}
            break
        target |= {s: 2.0 * sizes[s] for s in over}
        left -= sum(2.0 * sizes[s] for s in over)
        free -= over
    return target


def checked(rows, tolerance):
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in rows:
        sizes[r.source] += r.size
        taken[r.source] += r.copies * r.size
        assert 0 <= r.copies <= 2
    want = brute_targets(sizes)
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
    for s in sizes:
        assert abs(taken[s] - want[s]) <= tolerance * max(r.size for r in rows if r.source == s) + 1


def test_mix_of_the_documents(spark, sf_dir):
    rows = mixing.mix(spark.read.parquet(f"{sf_dir}/documents.parquet")).collect()
    assert len(rows) == 200
    checked(rows, 1.0)


def test_mix_of_odd_rows(spark, odd, empty):
    rows = mixing.mix(odd).collect()
    assert Counter(r.doc_id for r in rows) == Counter(i for i, *_ in ODD)
    checked(rows, 1.0)
    assert mixing.mix(empty).collect() == []


def test_mix_twice_is_equal(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert sorted(map(str, mixing.mix(docs).collect())) == sorted(map(str, mixing.mix(docs.repartition(7)).collect()))


def test_mixed_documents(spark, odd):
    rows = [(i, f"{'w ' * (i % 40 + 1)}", "en", "ab"[i % 2]) for i in range(200)] + [(900, "r r r", "en", "a")] * 3
    docs = documents(spark, rows)
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    got = Counter(r.doc_id for r in out.collect())
    copies = Counter()
    for r in mixing.mix(docs).collect():
        copies[r.doc_id] += r.copies
    assert got == +copies
    assert mixing.mixed_documents(odd).count() == sum(r.copies for r in mixing.mix(odd).collect())


def test_ranks_and_running_counts(spark):
    rows = [("a", i * i % 5003 - 900, i % 3) for i in range(700)] + [(None, 5, 0), (None, 5, 0), ("b", 1 << 40, 1), ("b", -5, 1)]
    df = spark.createDataFrame(rows, "g string, id long, t int")
    got = sorted(((r.g is None, r.g or "", r.rank, r.id) for r in ranked(df, ["g"], "id", ["t"]).collect()))
    want, n = [], Counter()
    for g, i in sorted(((x[0], x[1]) for x in rows), key=lambda x: (x[0] is None, x[0] or "", x[1])):
        n[g] += 1
        want.append((g is None, g or "", n[g], i))
    assert got == sorted(want)
    counts = spark.createDataFrame([("a", i, 2) for i in range(-50, 300, 7)], "g string, id long, n long")
    assert all(r.before == 2 * ((r.id + 50) // 7) for r in counts_before(counts, ["g"], "id").collect())


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def valid(kind, value):
    digits = [int(c) for c in value if c in "0123456789"]
    if kind == "ip":
        return all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in value.split("."))
    if kind == "card":
        doubled = [(2 * d - 9 if d > 4 else 2 * d) if i % 2 else d for i, d in enumerate(digits[::-1])]
        return 13 <= len(digits) <= 19 and sum(doubled) % 10 == 0
    return kind != "phone" or 9 <= len(digits) <= 15


def brute_base(text):
    return [(k, m.start(), m.end()) for k, p in PATTERNS.items() for m in re.finditer(p, text or "") if valid(k, m[0])]


HARD = [
    (30, "x a@b.c_d@e.f,g@h..i j@k.l.m-n @o.p q@r"), (31, "1.2.3.4.5.6.7.8 300.1.1.1 000255.1.1.1 12.34.56.78."), (32, "4111 1111-1111 1111 4111111111111112 4111  1111 1111 1111"),
    (33, "+1 (974) 555-3436 +12 +123456789 ++1.2.3.4.5.6.7.8.9 +1 974 555 3436 12345678901"), (34, "😀 a.b+c%d@é.de a@b.de4111111111111111"),
    (35, "1 " * 30_000), (36, "a@" + "b." * 20_000 + "c"), (37, "9" * 50_000 + ".1.1.1"), (38, "z" * 50_000 + "@q.de"), (39, "m1@x.de " * 3_000),
    (40, "4111111111111111"), (41, "4-" * 15 + "1"),
]


def test_base_spans(spark, sf_dir):
    rows = [tuple(r.values()) for r in pq.read_table(f"{sf_dir}/documents.parquet", columns=["doc_id", "text"]).to_pylist()]
    rows = [(1000 + i, t) for i, t in rows] + HARD + ODD
    got = pii.personal_data(documents(spark, rows)).collect()
    want = {i: brute_base(t) for i, t, *_ in rows}
    assert len(got) == len(rows)
    for r in got:
        assert [tuple(x) for x in r.base] == want[r.doc_id], r.doc_id
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == x[0] for x in want[r.doc_id]) for k in PATTERNS]
        assert {tuple(x) for x in r.base} <= {tuple(x) for x in r.found}


def test_contexts_discover_what_the_patterns_miss(spark):
    rows = [(i, f"please ring mobile number: +49 {600 + i} 555 {1000 + i} today") for i in range(12)]
    rows += [(100, "ring Mobile number 0170-5551234, thanks"), (101, "the order number 9917055512 came"), (102, "again 0170-5551234 was there in vain")]
    got = {r.doc_id: r for r in pii.personal_data(documents(spark, rows)).collect()}
    assert [tuple(x) for x in got[100].found] == [("phone", 19, 31)] and got[100].n_phone == 0
    assert got[101].found == [] and [tuple(x) for x in got[3].found] == [("phone", 27, 43)]


def test_personal_data_query_digests(spark, sf_dir):
    texts = {r["doc_id"]: r["text"] for r in pq.read_table(f"{sf_dir}/documents.parquet").to_pylist()}
    for r in QUERIES["op6_personal_data"](spark, sf_dir).collect():
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in brute_base(texts[r.doc_id]))
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert set(filter(None, joined.split(","))) <= set(r.spans.split(","))


def test_personal_data_of_nothing(empty):
    assert pii.personal_data(empty).collect() == []


def test_discovery_reads_every_text_and_spaced_numbers(spark):
    """Texts with short digit runs teach and are searched; spaces inside a number and long words do not hide it."""
    rows = [(i, f"reach the server address 10.{i}.2.3 now") for i in range(12)] + [(50, "reach server address 12-34-56-78 now")]
    rows += [(100 + i, f"please ring mobile number: +49 {600 + i} 555 {1000 + i} today") for i in range(12)]
    rows += [(200, "ring mobile number 0170 555 1234, thanks"), (201, f"ring mobile number{'!' * 90} 0170-5551234 thanks"), (202, f"ring mobile number {'01705' * 30} thanks")]
    got = {r.doc_id: [tuple(x) for x in r.found] for r in pii.personal_data(documents(spark, rows)).collect()}
    assert got[50] == [("ip", 21, 32)]
    assert got[200] == [("phone", 19, 32)]
    assert got[201] == [("phone", 109, 121)]
    assert got[202] == [("phone", 19, 169)]
