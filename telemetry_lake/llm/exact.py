"""Exact dedup by a tree-merge of sorted digest runs.

Each partition sorts its digests into one run and keeps, per digest, the smallest doc_id and a count.
Partitions then exchange runs in rounds: the runs of 2^ROUND_BITS neighbours meet (that many binomial
rounds in one exchange), Spark's sort merges them, and equal digests shrink to one row again.  A group
of copies is one row per run after the first round, so no task ever holds the group.  Runs are cut
into 2^SEGMENT_BITS digest ranges that merge apart, so the last round is as wide as the cluster.

Two texts are held equal when SHA-256 and byte length of the normalised text agree.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemetry_lake.llm.common import SPACE, own_columns
from telemetry_lake.session import settle

ROUND_BITS = 3
SEGMENT_BITS = 12
ROW = pa.schema([("segment", pa.int32()), ("run", pa.int32()), ("digest", pa.binary()), ("n_bytes", pa.int64()), ("keep_id", pa.int64()), ("copies", pa.int64())])
RUN = "segment int, run int, digest binary, n_bytes long, keep_id long, copies long"


def merge_run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows to one row per (segment, run, digest, n_bytes): the first doc_id, the sum of copies."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_arrays(batch.columns, schema=ROW)
        rows = rows if held is None else pa.concat_tables([held, rows]).combine_chunks()
        new = np.ones(rows.num_rows, bool)
        if rows.num_rows > 1:
            changed = None
            for name in ("segment", "run", "digest", "n_bytes"):
                differs = pc.not_equal(rows[name].slice(1), rows[name].slice(0, rows.num_rows - 1))
                changed = differs if changed is None else pc.or_(changed, differs)
            new[1:] = np.asarray(changed.to_numpy(zero_copy_only=False), bool)
        first = np.flatnonzero(new)
        total = np.add.reduceat(rows["copies"].to_numpy(), first)
        rows = rows.take(pa.array(first)).set_column(5, "copies", pa.array(total, pa.int64()))
        held = rows.slice(rows.num_rows - 1)  # the next batch may go on with this digest
        yield from rows.slice(0, rows.num_rows - 1).to_batches()
    if held is not None:
        yield from held.to_batches()


def merged_runs(digests: DataFrame) -> DataFrame:
    """digest, n_bytes, keep_id, copies: one row per distinct text of (doc_id, digest, n_bytes)."""
    runs = digests.rdd.getNumPartitions()
    segment = F.conv(F.substring(F.hex("digest"), 1, 4), 16, 10).cast("int").bitwiseAND((1 << SEGMENT_BITS) - 1)
    level = digests.select(
        segment.alias("segment"), F.spark_partition_id().alias("run"), "digest", "n_bytes",
        F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("copies"),
    )
    order = ("segment", "run", "digest", "n_bytes", F.col("keep_id").asc_nulls_last())
    level = level.sortWithinPartitions(*order).mapInArrow(merge_run, RUN)
    while runs > 1:
        level = level.withColumn("run", F.shiftright("run", ROUND_BITS)).repartition("segment", "run")
        level = level.sortWithinPartitions(*order).mapInArrow(merge_run, RUN)
        runs = (runs + (1 << ROUND_BITS) - 1) >> ROUND_BITS
    return level.select("digest", "n_bytes", "keep_id", "copies")


def exact_groups(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept, digest: one row per row of ``docs``.

    Texts are equal when identical after each run of ASCII white space becomes one space; null counts
    as empty, and empty texts form a group.  Rows that repeat a doc_id with an equal text are copies
    of one another and all carry ``kept`` when their doc_id is the group's smallest; a null doc_id is
    kept only if its group has no other.  An empty table gives an empty result.
    """
    plain = F.regexp_replace(F.coalesce("text", F.lit("")), SPACE, " ")
    digests = own_columns(docs, "doc_id", "text").select("doc_id", plain.alias("plain"))
    digests = digests.select("doc_id", F.unhex(F.sha2("plain", 256)).alias("digest"), F.octet_length("plain").cast("long").alias("n_bytes"))
    digests = settle(digests, "digests")
    joined = digests.join(merged_runs(digests), ["digest", "n_bytes"])
    return joined.select(
        "doc_id", "keep_id", F.col("copies").alias("group_size"), F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "digest"
    )
