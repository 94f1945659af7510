r"""Mixing sources to target weights along a low-discrepancy schedule.

Sources, ordered by code point with null last, weigh 1, 2, 3, repeating, and
share the words of the corpus; a target stops at ``max_repeats`` times its
source, and the excess goes to the others by weight.

Each source's documents stand in a shuffled order and are cut into blocks of
nearly equal word counts (``block_words`` at most).  Slot ``i`` of the schedule
takes the golden-ratio point of ``i``, mapped through the cumulative slot
weights to a source; the rank of a slot among its source's slots names the
block to read (ranks past the last block start over).  Slots that the points
leave open for a source are appended.  Joining slots to blocks gives the words
taken from each document, the first slot that reads it and how many do, so that
the mix can be written in the order of the schedule.

Every window over sources holds one row a source and is one task; all others are
over buckets of rows or slots.

Defined cases: null text and null counts have no words; a null source is a
source of its own; documents without words take nothing and have no slot;
repeated rows are mixed each; very long texts span several blocks; other columns
of the input are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kymo.llm.common import row_numbers
from kymo.session import cut

#: Golden ratio of 2**31, odd: ``i * GOLDEN mod 2**31`` visits every point once.
GOLDEN, POINTS = 1327217885, 2**31
WEIGHTS = (1, 2, 3)
SLOT_BUCKET = 65_536
ROWS_PER_BUCKET = 1_000


def words(text: Column) -> Column:
    r"""Number of ``[^\x20\x09-\x0D]+`` in a text."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, block_words: int, max_repeats: int, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """One row per source: number, size, rows, target, words to take and block layout."""
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    every = Window.orderBy(F.col("source").asc_nulls_last())  # one row per source
    numbered = totals.withColumn("sid", F.row_number().over(every).cast("long"))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("sid") - 1) % len(weights) + 1).cast("int"))
    cap = (F.lit(float(max_repeats)) * F.col("source_size")).alias("cap")
    t = numbered.select("*", weight.alias("weight"), cap)
    # Water level: sources sorted by cap per weight; the level of a source if all before it are full peaks where it holds.
    before = Window.orderBy(F.col("cap") / F.col("weight"), "sid").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    level = (F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / (F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    t = t.withColumn("level", level).withColumn("level", F.max("level").over(whole))
    t = t.withColumn("target", F.least("cap", F.col("level") * F.col("weight")))
    t = t.withColumn("want", F.least(F.floor(F.col("target") + 0.5), F.lit(max_repeats) * F.col("source_size")).cast("long"))
    size = F.greatest("source_size", F.lit(1))
    t = t.withColumn("n_blocks", F.greatest(F.ceil(F.col("source_size") / block_words), F.lit(1)).cast("long"))
    t = t.withColumn("base", F.greatest(F.floor(F.col("source_size") / F.col("n_blocks")), F.lit(1)).cast("long")).withColumn("extra", (size % F.col("n_blocks")).cast("long"))
    t = t.withColumn("rest", (F.col("want") % size).cast("long"))
    n_slots = (F.col("want") - F.col("rest")) / size * F.col("n_blocks") + F.when(F.col("rest") > 0, _block_of(F.col("rest") - 1) + 1).otherwise(0)
    return t.withColumn("n_slots", n_slots.cast("long")).drop("cap", "level", "rest")


def _block_of(position: Column) -> Column:
    """Block of a word position; the first ``extra`` blocks have one word more than ``base``."""
    edge = F.col("extra") * (F.col("base") + 1)
    return F.when(position < edge, F.floor(position / (F.col("base") + 1))).otherwise(F.col("extra") + F.floor((position - edge) / F.col("base"))).cast("long")


def _block_start(block: Column) -> Column:
    return block * F.col("base") + F.least(block, F.col("extra"))


def schedule(targets: DataFrame) -> DataFrame:
    """``slot, sid, rank``: every source exactly ``n_slots`` times, evenly spread."""
    spark = targets.sparkSession
    lay = targets.where("n_slots > 0").select("sid", "n_slots")
    upto = Window.orderBy("sid").rowsBetween(Window.unboundedPreceding, -1)
    lay = lay.withColumn("low", F.coalesce(F.sum("n_slots").over(upto), F.lit(0))).withColumn("high", F.col("low") + F.col("n_slots"))
    row = lay.agg(F.coalesce(F.sum("n_slots"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("s")).first()
    n, width = row["n"], max(1, row["n"] // max(4096, 4 * row["s"]))
    cells = lay.withColumn("cell", F.explode(F.sequence(F.floor(F.col("low") / width), F.floor((F.col("high") - 1) / width))))
    point = F.floor((F.col("id") % POINTS * GOLDEN % POINTS).cast("double") / float(POINTS) * float(max(n, 1))).cast("long")
    slots = spark.range(n).select(F.col("id").alias("slot"), point.alias("x")).withColumn("cell", F.floor(F.col("x") / width))
    dealt = slots.join(cells, (slots["cell"] == cells["cell"]) & (F.col("x") >= F.col("low")) & (F.col("x") < F.col("high"))).select("slot", "sid", "n_slots")
    ranked = row_numbers(dealt, ["sid"], [F.col("slot")], F.floor(F.col("slot") / SLOT_BUCKET), F.lit(1), "rank").where("rank < n_slots").select("slot", "sid", "rank")
    counted = ranked.groupBy("sid").agg(F.count(F.lit(1)).alias("have"))
    open_ = lay.join(counted, "sid", "left").withColumn("have", F.coalesce("have", F.lit(0))).where("have < n_slots")
    tail = open_.select((F.lit(n) + F.col("low")).alias("slot"), "sid", F.explode(F.sequence(F.col("have"), F.col("n_slots") - 1)).alias("rank"))
    return ranked.unionByName(tail)


def mix(df: DataFrame, block_words: int = 4096, max_repeats: int = 3, seed: int = 11) -> tuple[DataFrame, DataFrame]:
    """The schedule with the block each slot reads, and ``doc_id, size, source_size, target, taken, first_slot, n_slots`` of every document."""
    sizes = cut(df.select("doc_id", "source", words(F.col("text")).alias("size")), "sizes")
    targets = cut(source_targets(sizes, block_words, max_repeats), "targets")
    slots = schedule(targets)
    lay = targets.select("sid", "source_size", "want", "n_blocks", "base", "extra")
    size = F.greatest("source_size", F.lit(1))
    block = F.col("rank") % F.col("n_blocks")
    start = F.floor(F.col("rank") / F.col("n_blocks")) * size + _block_start(block)
    take = F.least(F.col("want") - start, F.col("base") + F.when(block < F.col("extra"), 1).otherwise(0))
    reads = slots.join(lay, "sid").select("slot", "sid", F.floor(F.col("rank") / F.col("n_blocks")).alias("pass"), block.alias("block"), take.cast("long").alias("take"))

    keyed = sizes.join(targets.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")), "left").withColumn("h", F.xxhash64(F.lit(seed), F.col("doc_id")))
    n_buckets = F.ceil(F.col("n_docs") / ROWS_PER_BUCKET)
    bucket = F.floor(F.shiftrightunsigned("h", 33) / float(2**31) * n_buckets)
    # Rows without words take nothing and share their start with others: they go past the blocks, each as it is.
    none = F.lit(None).cast("long")
    empty = keyed.where("size = 0").select("doc_id", "size", "source_size", "target", F.lit(0).cast("long").alias("taken"), none.alias("first_slot"), F.lit(0).cast("long").alias("n_slots"))
    placed = row_numbers(keyed.where("size > 0"), ["sid"], [F.col("h"), F.col("doc_id"), F.col("size")], bucket, F.col("size"), "start")
    blocks = F.sequence(_block_of(F.col("start")), _block_of(F.col("start") + F.col("size") - 1))
    parts = placed.withColumn("block", F.explode(blocks))
    low = F.greatest("start", _block_start(F.col("block")))
    high = F.least(F.col("start") + F.col("size"), _block_start(F.col("block") + 1))
    parts = parts.withColumn("low", low).withColumn("high", high).withColumn("block_start", _block_start(F.col("block")))
    joined = parts.join(reads.select("sid", "block", "take", "slot"), ["sid", "block"], "left")
    got = F.when(F.col("take").isNull(), 0).otherwise(F.greatest(F.least("high", F.col("block_start") + F.col("take")) - F.col("low"), F.lit(0)))
    joined = joined.withColumn("got", got)
    out = joined.groupBy("sid", "start", "size", "doc_id", "source_size", "target").agg(F.sum("got").cast("long").alias("taken"), F.min(F.when(F.col("got") > 0, F.col("slot"))).alias("first_slot"), F.count(F.when(F.col("got") > 0, 1)).alias("n_slots"))
    return reads, out.select(*empty.columns).unionByName(empty)
