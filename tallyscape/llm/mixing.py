"""Mixing sources to target weights by a low-discrepancy schedule.

Every source's documents are shuffled by a keyed hash and laid end to end; the stream is cut
into blocks of equal token counts.  Slot j of the schedule takes the point j * K mod M (K / M
near the golden ratio), which falls into one source's interval of the cumulative weights.  The
r-th slot of a source takes the r-th block of its stream, starting again when it ends.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyscape.llm.common import WORD, whole
from tallyscape.operators.keys import dense_keys
from tallyscape.session import materialise

#: Points lie on a lattice of M steps; K is the odd number nearest to M times the golden ratio.
M = 1 << 31
K = 1327217885

BLOCK = 64  # words in a block
MOST = 3  # no source and no document is taken more often than this
CHUNK = 1 << 16  # slots numbered in one group
WEIGHTS = (1, 2, 3)
PARTS = 1 << 20  # the part of a document that is left over is counted in so many
PHASE = 1  # of the hash that orders documents by it


def sizes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """doc_id, source, size: words in the text, 0 for null."""
    return docs.select(
        F.col(doc_id).alias("doc_id"),
        F.col(source).alias("source"),
        F.regexp_count(whole(text), F.lit(WORD)).cast("long").alias("size"),
    )


def share_out(sources: DataFrame) -> DataFrame:
    """Adds ``target``: all sizes shared by weight, at most MOST times a source's own size.

    A round finds which sources reach their limit at the present level and shares the rest
    anew; the level only rises, so it ends when no further source is at its limit.
    """
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    limit = F.col("source_size") * MOST
    level, full = 0.0, -1
    while True:
        over = limit <= F.col("weight") * F.lit(level)
        row = sources.agg(
            F.coalesce(F.sum(F.when(over, limit)), F.lit(0)).alias("used"),
            F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0)).alias("open"),
            F.count(F.when(over, 1)).alias("full"),
        ).first()
        if row["full"] == full or not row["open"]:
            break
        full, level = row["full"], (total - row["used"]) / row["open"]
    return sources.withColumn(
        "target", F.least(limit.cast("double"), F.col("weight") * F.lit(float(level))).cast("double")
    )


def source_targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """One row per source, in code point order with null last: no, source_size, weight, target."""
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    ordered = totals.withColumn("last", F.col("source").isNull())
    numbered = materialise(dense_keys(ordered, ["last", "source"], "no", start=0).drop("last"), "sources")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("no") % len(weights) + 1).cast("int"))
    return materialise(share_out(numbered.withColumn("weight", weight)), "targets")


def running(df: DataFrame, value: str, within: list[str], group: Column, order: list[str]) -> DataFrame:
    """Adds ``before``: the sum of ``value`` over earlier rows of ``within``.

    ``group`` cuts ``within`` into pieces that follow each other in ``order``; a piece is summed in one
    task and the pieces' totals in another, so no task sees a whole large source.
    """
    df = df.withColumn("piece", group)
    totals = df.groupBy(*within, "piece").agg(F.sum(value).alias("held"))
    earlier = Window.partitionBy(*within).orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*within, "piece", F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("offset"))
    inner = Window.partitionBy(*within, "piece").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    summed = df.withColumn("inside", F.coalesce(F.sum(value).over(inner), F.lit(0)))
    return summed.join(offsets, [*within, "piece"]).withColumn("before", F.col("offset") + F.col("inside"))


def shuffled(seed: int) -> Column:
    """A hash of the document that is never negative: 63 bits."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col("doc_id")), 1)


def blocks(sized: DataFrame, targets: DataFrame, seed: int, block: int = BLOCK) -> DataFrame:
    """The words of each document in each block of its source's shuffled stream."""
    n = sized.count()
    pieces = max(1, n // 4096)
    keyed = sized.join(targets.select("source", "no"), sized["source"].eqNullSafe(targets["source"])).select(
        "row", "no", "size", shuffled(seed).alias("mixed")
    )
    # The piece is the leading part of the hash, so pieces and hashes give one order, however many pieces there are.
    piece = F.floor((F.shiftrightunsigned("mixed", 32)) / F.lit((1 << 31) / pieces))
    placed = running(keyed, "size", ["no"], piece, ["mixed", "row"]).filter("size > 0")
    first, last = F.expr(f"before div {block}"), F.expr(f"(before + size - 1) div {block}")
    cut = placed.select("row", "no", "before", "size", F.explode(F.sequence(first, last)).alias("block"))
    begin = F.greatest(F.col("before"), F.col("block") * block)
    end = F.least(F.col("before") + F.col("size"), (F.col("block") + 1) * block)
    return cut.select("no", "block", "row", (begin - F.col("block") * block).alias("at"), (end - begin).alias("words"))


def schedule(spark: SparkSession, targets: DataFrame, block: int = BLOCK) -> DataFrame:
    """slot, no, epoch, block: which block each slot takes.

    A source wants its target counted in blocks of its own stream; the cumulative wants of the
    sources cut [0, M) into intervals.  Points meet intervals through cells of equal width, an
    equi-join, for any number of sources.
    """
    streams = targets.filter("source_size > 0").withColumn("blocks", F.expr(f"(source_size + {block - 1}) div {block}"))
    streams = streams.withColumn("want", F.col("target") / F.col("source_size") * F.col("blocks"))
    head = streams.agg(F.count("*"), F.sum("want")).first()
    n_sources, wanted = head[0], head[1] or 0.0
    slots = int(round(wanted))
    cells = 1 << max(10, (max(n_sources, 1) - 1).bit_length())
    width = M // cells
    cumulated = running(streams.select("no", "want", "blocks", F.lit(0).alias("all")), "want", ["all"], F.expr("no div 4096"), ["no"])
    edge = lambda x: F.round(x / F.lit(max(wanted, 1e-300)) * M).cast("long")
    intervals = cumulated.select(
        "no", "blocks", edge(F.col("before")).alias("low"), edge(F.col("before") + F.col("want")).alias("high")
    ).filter("low < high")
    intervals = intervals.withColumn("cell", F.explode(F.sequence(F.expr(f"low div {width}"), F.expr(f"(high - 1) div {width}"))))
    points = spark.range(slots).select(
        F.col("id").alias("slot"), F.pmod(F.pmod("id", F.lit(M)) * K, F.lit(M)).alias("point")
    )
    points = points.withColumn("cell", F.expr(f"point div {width}"))
    drawn = points.join(intervals, "cell").filter("point >= low and point < high").withColumn("one", F.lit(1))
    ranked = running(drawn.select("slot", "no", "blocks", "one"), "one", ["no"], F.expr(f"slot div {CHUNK}"), ["slot"])
    # A source near its limit may draw a slot or two more than it has blocks.
    return ranked.filter(F.col("before") < F.col("blocks") * MOST).select(
        "slot", "no", F.expr("before div blocks").alias("epoch"), F.expr("before % blocks").alias("block")
    )


def mix(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", *, seed: int = 7, block: int = BLOCK
) -> DataFrame:
    """Every document with what the mix takes of it: doc_id, source, size, source_size, target, taken.

    A null source is a source of its own.  Empty and null texts have size 0 and nothing taken.  Rows
    with one doc_id are separate documents.  An empty table gives no rows.
    """
    spark = docs.sparkSession
    sized = materialise(sizes(docs, doc_id, text, source).withColumn("row", F.monotonically_increasing_id()), "sizes")
    targets = source_targets(sized)
    parts = blocks(sized, targets, seed, block)
    uses = schedule(spark, targets, block).groupBy("no", "block").agg(F.count("*").alias("times"))
    taken = parts.join(uses, ["no", "block"]).groupBy("row").agg(F.sum(F.col("words") * F.col("times")).alias("taken"))
    wide = sized.join(taken, "row", "left")
    goal = targets.select("source", "source_size", "target")
    return wide.join(goal, wide["source"].eqNullSafe(goal["source"])).select(
        "doc_id", wide["source"], "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken")
    )


def mixed_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """The mix itself: rows of ``docs``, all columns as they were, as often as the mix takes them.

    A document comes as often as its taken words fill it.  The parts of documents that are left over are added up,
    through documents of like size, and one comes once more whenever they make a whole: the words of a source stay
    near its target, and one whose every word is taken comes for sure.  Rows without words are not taken.
    """
    taken = mix(docs, doc_id, text, source, **options).filter("taken > 0")
    key = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")).alias("key")
    parts = taken.select(
        "doc_id", key, F.expr("taken div size").alias("whole"), F.expr(f"(taken % size) * {PARTS} div size").alias("part"),
        F.floor(F.log2("size")).cast("long").alias("class"), shuffled(PHASE).alias("mixed"),
    )
    # Order by class of size and hash; the piece is the leading part of both.
    piece = F.col("class") * 4096 + F.shiftrightunsigned("mixed", 51)
    added = running(parts, "part", ["key"], piece, ["mixed", "doc_id"])
    times = F.col("whole") + F.expr(f"(before + part + {PARTS // 2}) div {PARTS} - (before + {PARTS // 2}) div {PARTS}")
    counts = added.select(F.col("doc_id").alias("_id"), times.cast("int").alias("_n")).groupBy("_id").agg(F.max("_n").alias("_times"))
    counts = counts.filter("_times > 0")
    found = docs.join(counts.hint("shuffle_hash"), docs[doc_id].eqNullSafe(counts["_id"]))
    return found.withColumn("_time", F.explode(F.sequence(F.lit(1), F.col("_times")))).select(*[docs[c] for c in docs.columns])
