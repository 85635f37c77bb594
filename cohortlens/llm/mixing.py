"""Mixing sources to target weights with a time-varying curriculum. DataFrame functions only.

Targets: sources share ``budget`` x all words by weight; a target stops at ``max_epochs`` x its
source's words and the excess goes to the others by weight (water-filling, in closed form over the
sources sorted by the level at which they fill up).

Positions: a source's weight over training time u in [0, 1] is w * (1 + slope * (2u - 1)). Its
integral gives the cumulative token demand target * (slope * u^2 + (1 - slope) * u), and inverting
it at the words that stand before a document in its source's stream gives the document's place in
training. Documents stand in a source in a hash order; the stream repeats for later epochs.

Defined results: a null text has size 0; a null source is a source of its own, placed last; a source
without words has target 0 and takes nothing; ties in the hash order go by id, then by text hash,
and repeated rows take their places one after another; an empty table gives no rows. The added columns
replace columns of the same names; all others are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.session import materialize

WEIGHTS = (5.0, 2.0, 1.0)  # repeating over the sources by code point, null last
SLOPES = (-0.5, 0.0, 0.5)  # of the same sources: the first fades out, the last comes in
BUDGET, MAX_EPOCHS = 1.5, 2
BUCKET_ROWS = 10_000  # documents of a source in one bucket of its stream
ADDED = ("size", "source_size", "target", "taken", "positions")


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights=WEIGHTS, slopes=SLOPES, budget: float = BUDGET, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size, ...) with target and slope. One row per source; its windows run over sources, not documents."""
    pick = lambda values: F.element_at(F.array(*[F.lit(float(v)) for v in values]), (F.col("rank") % len(values) + 1).cast("int"))
    ranked = sizes.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    ranked = ranked.withColumn("weight", pick(weights)).withColumn("slope", pick(slopes)).withColumn("cap", F.col("source_size") * F.lit(float(max_epochs)))
    by_fill = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    upto, after = by_fill.rowsBetween(Window.unboundedPreceding, 0), by_fill.rowsBetween(0, Window.unboundedFollowing)
    every = by_fill.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # A source is full if the level that its predecessors' caps leave for it and its successors reaches its own.
    left = F.sum("source_size").over(every) * F.lit(float(budget)) - (F.sum("cap").over(upto) - F.col("cap"))
    level = ranked.withColumn("level", left / F.sum("weight").over(after))
    full = F.col("level") * F.col("weight") >= F.col("cap")
    # The first source that is not full sets the level of all that follow it.
    first = F.first(F.when(~full, F.col("level")), ignorenulls=True).over(every)
    return level.withColumn("target", F.when(full, F.col("cap")).otherwise(F.least("cap", first * F.col("weight")))).select(
        *sizes.columns, "target", "slope")


def mix(df: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source", weights=WEIGHTS, slopes=SLOPES,
        budget: float = BUDGET, max_epochs: int = MAX_EPOCHS, keep_text: bool = True) -> DataFrame:
    """``df`` with size, source_size, target (of its source), taken (words, repeats counted) and positions (its
    place in training, 0 to 1, for each time that it is taken).

    Running sums are split: documents of a source fall into hash buckets, bucket totals give where
    each bucket begins, and a window runs within a bucket only, so a source with most rows is many tasks.
    """
    keep = [c for c in df.columns if c not in ADDED and (keep_text or c != text)]
    base = df.select(*keep, n_words(F.col(text)).alias("size"), F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit(""))).alias("__h"), F.xxhash64(F.col(text)).alias("__t"),
                     F.col(source).alias("__source"), F.coalesce(F.concat(F.lit("s"), F.col(source).cast("string")), F.lit("null")).alias("__s"))
    if not keep_text:
        base = materialize(base, "mix-sizes")  # narrow, and read twice
    most = base.groupBy("__s").count().agg(F.max("count")).first()[0] or 0
    # Buckets are ranges of the hash order, so their number moves no document.
    n = max(1, -(-most // BUCKET_ROWS))
    base = base.withColumn("__bucket", F.shiftright(F.conv(F.substring("__h", 1, 8), 16, 10).cast("long") * n, 32).cast("int"))
    sums = materialize(base.groupBy("__s", "__source", "__bucket").agg(F.sum("size").alias("__sum"), F.count("*").alias("rows")), "mix-sums")
    goals = targets(sums.groupBy(F.col("__s").alias("__goal"), F.col("__source").alias("source")).agg(F.sum("__sum").alias("source_size")),
                    weights, slopes, budget, max_epochs)
    before = F.sum("__sum").over(Window.partitionBy("__s").orderBy("__bucket")) - F.col("__sum")
    starts = sums.select("__s", "__bucket", before.alias("__start")).join(goals, F.col("__s") == F.col("__goal")).drop("source")
    own = Window.partitionBy("__s", "__bucket").orderBy("__h", id_col, "__t").rowsBetween(Window.unboundedPreceding, 0)
    placed = base.withColumn("__before", F.sum("size").over(own) - F.col("size")).join(starts, ["__s", "__bucket"])
    at = F.col("__start") + F.col("__before")
    # Epoch e takes a document if its middle lies within the target, so each source's words come within half a document of it.
    takes = lambda e: (F.col("size") > 0) & (at + F.col("size") / 2 + F.col("source_size") * e < F.col("target"))
    taken = sum((F.when(takes(e), F.col("size")).otherwise(0) for e in range(max_epochs)), F.lit(0))
    slope = F.col("slope")

    def position(words: Column) -> Column:
        """The time at which the source's demand reaches so many words."""
        y = F.least(F.lit(1.0), words / F.col("target"))
        return F.when(slope == 0, y).otherwise(((slope - 1) + F.sqrt((1 - slope) * (1 - slope) + 4 * slope * y)) / (2 * slope))

    each = F.array_compact(F.array(*[F.when(takes(e), position(at + F.col("source_size") * e)) for e in range(max_epochs)]))
    out = placed.withColumn("taken", taken.cast("long")).withColumn("positions", F.when(F.col("taken") > 0, each).otherwise(F.array().cast("array<double>")))
    return out.select(*keep, "size", "source_size", "target", "taken", "positions")


def curriculum(mixed: DataFrame, documents: bool = False) -> DataFrame:
    """The mix in training order: a row for each time that a document is taken, range-partitioned and sorted by position.

    ``documents``: a row for each document instead, by its first position; those that the mix leaves out come last."""
    if not documents:
        rows = mixed.withColumn("position", F.explode("positions"))
        return rows.repartitionByRange("position").sortWithinPartitions("position")
    # rows left out have no position: their hash spreads them over the last partitions
    order = [F.col("position").asc_nulls_last(), F.xxhash64(*[c for c in mixed.columns if c != "positions"])]
    return mixed.withColumn("position", F.get("positions", F.lit(0))).repartitionByRange(*order).sortWithinPartitions(*order)
