"""Exact duplicates, with the frequent texts split off.

A Misra-Gries summary of the digests names every text that holds more than a small share
of the rows.  Those few candidates are counted exactly and their winners broadcast, so
their rows are settled where they are read.  The other digests, none of them frequent,
take an ordinary shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyscape.llm.common import ascii_lower, on_workers, unused, whole
from tallyscape.session import materialise

#: Counters of the summary.  A digest in more than 2 / (COUNTERS + 1) of the rows is always found.
COUNTERS = 256


def digest_of(text: str = "text"):
    """SHA-256 of the text with A-Z lower-cased; null counts as empty."""
    return F.unhex(F.sha2(ascii_lower(whole(text)), 256))


def summarise(counts: dict[bytes, int], more: dict[bytes, int], counters: int) -> dict[bytes, int]:
    """Merge counts into a Misra-Gries summary of at most ``counters`` entries."""
    for key, n in more.items():
        counts[key] = counts.get(key, 0) + n
    if len(counts) <= counters:
        return counts
    cut = sorted(counts.values(), reverse=True)[counters]
    return {key: n - cut for key, n in counts.items() if n > cut}


def frequent(digests: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """At most ``counters`` digests, among them all that hold over 2 / (counters + 1) of the rows.

    One summary per task; summed, a count falls short by at most n / (counters + 1), and no
    more than ``counters`` sums can reach that value.
    """

    def one_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[bytes, int] = {}
        for batch in batches:
            seen = pc.value_counts(batch.column(0))
            pairs = zip(seen.field("values").to_pylist(), seen.field("counts").to_pylist(), strict=True)
            counts = summarise(counts, dict(pairs), counters)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], ["digest", "least"]
        )

    summaries = on_workers(digests.select("digest")).mapInArrow(one_task, "digest binary, least long")
    summed = summaries.groupBy("digest").agg(F.sum("least").alias("least"))
    return summed.orderBy(F.desc("least"), "digest").limit(counters).select("digest")


def copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", *, counters: int = COUNTERS) -> DataFrame:
    """Every row of ``docs`` with the row that stays for its text.

    Returns doc_id, keep_id, group_size, kept, digest.  The largest doc_id of a group stays; a
    null doc_id is smallest.  Of rows repeated with one doc_id exactly one has ``kept``.  Null
    texts equal empty ones.  Other columns are not read; an empty table gives no rows.
    """
    rows = materialise(
        docs.select(
            F.col(doc_id).alias("doc_id"), digest_of(text).alias("digest"), F.monotonically_increasing_id().alias("row")
        ),
        "digests",
    )
    found = frequent(rows, counters)

    def winners(of: DataFrame) -> DataFrame:
        return of.groupBy("digest").agg(F.max(F.struct("doc_id", "row")).alias("best"), F.count("*").alias("group_size"))

    # At most `counters` rows of 56 bytes, whatever the input: safe to broadcast.
    settled = materialise(winners(rows.join(F.broadcast(found), "digest", "left_semi")), "frequent")
    heavy = rows.join(F.broadcast(settled), "digest")
    light = rows.join(F.broadcast(settled.select("digest")), "digest", "left_anti")
    both = heavy.unionByName(light.join(winners(light), "digest"))
    return both.select(
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("best.row")).alias("kept"),
        "digest",
    )


def drop_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", *, counters: int = COUNTERS) -> DataFrame:
    """The rows of ``docs`` that stay, all columns as they were."""
    own, its_id, its_digest = (unused(docs, name) for name in ("_own", "_id", "_digest"))
    keep = copies(docs, doc_id, text, counters=counters).filter("kept").select(
        F.col("doc_id").alias(its_id), F.col("digest").alias(its_digest)
    )
    marked = docs.withColumn(own, digest_of(text))
    same = marked[doc_id].eqNullSafe(F.col(its_id)) & (F.col(own) == F.col(its_digest))
    # Rows repeated with one doc_id and text are one row of the result.
    return marked.join(keep, same, "left_semi").dropDuplicates([doc_id, own]).drop(own)
