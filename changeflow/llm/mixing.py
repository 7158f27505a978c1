"""Mixing sources to target weights by thresholds of a hash.

Each row has a hash. A source whose target is r times its size is taken floor(r) times as a
whole, and once more the rows whose hash is below a threshold. The threshold is found from
sums: rows are summed by source and the upper bits of the hash, the running sum of a source
shows in which bucket its budget ends, and only rows of that bucket are summed again by the
next bits. Nothing is sorted, and the sums of a level are at most ``1 << BITS`` numbers a
source. After four levels of twelve bits a bucket is one row, or rows of equal hash.

Thresholds nest: of two budgets, all the rows the smaller takes are taken by the larger. The
hash depends on the row's id (and, where there is none, on its text), so reruns agree.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changeflow.llm.scratch import free_name, written

BITS = 12
LEVELS = 4
WEIGHTS = (5, 2, 1)
MOST = 3


def word_count(column: str | Column) -> Column:
    """Number of words of a text, separated by space, tab and line ends; null has none."""
    text = F.col(column) if isinstance(column, str) else column
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def unit_hash(*columns: Column) -> Column:
    """48 bits of a hash of a row."""
    return F.shiftrightunsigned(F.xxhash64(F.lit("mix"), *columns), 64 - BITS * LEVELS)


def targets(
    sizes: DataFrame, weights: Sequence[float] = WEIGHTS, most: float = MOST
) -> DataFrame:
    """source, source_size and target, from one row for each source.

    Sources in the order of their names, null last, get the weights in turn. All sizes
    together are shared by weight; a target stops at ``most`` times its source's size, and what
    is over goes to the others by weight, until nobody is above.

    A source stops at the share c = most * size / weight per unit of weight. In the order of c
    the stopped sources are the first ones, so running sums give the common share of the rest
    for every number of stopped sources. The first that fits, which is the largest, is the answer.
    """
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    pick = F.array(*[F.lit(float(w)) for w in weights])
    rows = sizes.withColumn("_i", F.row_number().over(by_name) - 1)
    rows = rows.withColumn("_w", F.element_at(pick, (F.col("_i") % len(weights) + 1).cast("int")))
    rows = rows.withColumn("_stop", F.col("source_size") * float(most))
    everything = Window.partitionBy()
    by_stop = Window.orderBy(F.col("_stop") / F.col("_w"), "_i").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumns(
        {
            "_all": F.sum("source_size").over(everything),
            "_weights": F.sum("_w").over(everything),
            "_stopped": F.coalesce(F.sum("_stop").over(by_stop), F.lit(0.0)),
            "_before": F.coalesce(F.sum("_w").over(by_stop), F.lit(0.0)),
        }
    )
    # The share if all sources before this one stop and this one does not.
    share = (F.col("_all") - F.col("_stopped")) / (F.col("_weights") - F.col("_before"))
    rows = rows.withColumn("_share", share)
    fits = F.when(F.col("_share") <= F.col("_stop") / F.col("_w"), F.col("_share"))
    rows = rows.withColumn("_common", F.max(fits).over(everything))
    target = F.least(F.col("_stop"), F.coalesce(F.col("_common"), F.lit(float("inf"))) * F.col("_w"))
    return rows.select("source", "source_size", target.alias("target"))


def thresholds(rows: DataFrame, budgets: DataFrame) -> DataFrame:
    """source and the threshold below which rows sum to its budget, as nearly as rows allow.

    ``rows`` has source, size and hash; ``budgets`` has source and budget, each source once.
    The sums of a level are made before the shuffle, so a source with a third of all rows is
    no hot spot. The last bucket is taken if that brings the sum nearer to the budget.
    """
    left = F.col("budget").cast("double").alias("left")
    open_ = budgets.select(F.col("source").alias("_s"), left, F.lit(0).cast("long").alias("prefix"))
    same = F.col("source").eqNullSafe(F.col("_s"))
    for level in range(1, LEVELS + 1):
        shift = BITS * (LEVELS - level)
        inside = F.shiftrightunsigned("hash", shift + BITS) == F.col("prefix")
        own = rows.join(open_, same & inside, "left_semi")
        bucket = F.shiftrightunsigned("hash", shift).alias("bucket")
        sums = own.groupBy("source", bucket).agg(F.sum("size").alias("n"))
        running = Window.partitionBy("source").orderBy("bucket")
        sums = sums.withColumn("upto", F.sum("n").over(running)).join(open_.select("_s", "left"), same)
        # The first bucket with which the budget is reached holds the threshold.
        end = F.min(F.struct("bucket", "upto", "n", "left")).alias("b")
        ends = sums.filter("upto >= left").groupBy("source").agg(end)
        rest = (F.col("b.left") - F.col("b.upto") + F.col("b.n")).alias("left")
        open_ = ends.select(F.col("source").alias("_s"), rest, F.col("b.bucket").alias("prefix"), "b.n")
        open_ = written(open_, "mix-level")
    nearer = F.col("left") * 2 >= F.col("n")
    return open_.select("_s", (F.col("prefix") + F.when(nearer, 1).otherwise(0)).alias("threshold"))


def mix(
    docs: DataFrame, source_column: str = "source", id_column: str = "doc_id", text_column: str = "text",
    weights: Sequence[float] = WEIGHTS, most: float = MOST,
) -> tuple[DataFrame, DataFrame]:
    """(rows, plan). ``rows`` has id, source, size and hash of each document, written once;
    ``plan`` has for each source its size, target, how often all of it is taken (``epochs``)
    and the threshold under which a row is taken once more.

    A null source is a source of its own, the last; a null or empty text has size 0 and is
    taken 0 words. A source of size 0 has the target 0. Rows of equal id share their fate.
    """
    ids, text = F.col(id_column), F.col(text_column)
    rows = docs.select(
        ids.alias("id"),
        F.col(source_column).alias("source"),
        word_count(text).alias("size"),
        F.when(ids.isNotNull(), unit_hash(ids)).otherwise(unit_hash(text)).alias("hash"),
    )
    rows = written(rows, "mix-rows")
    plan = targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most)
    epochs = F.floor(F.col("target") / F.greatest("source_size", F.lit(1)))
    plan = written(plan.withColumn("epochs", epochs.cast("long")), "mix-targets")
    budget = F.col("target") - F.col("epochs") * F.col("source_size")
    found = thresholds(rows, plan.select("source", budget.alias("budget")).filter("budget > 0"))
    plan = plan.join(found, F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s")
    return rows, written(plan.withColumn("threshold", F.coalesce("threshold", F.lit(0))), "mix-plan")


def copies(hash_column: str = "hash", epochs: str = "epochs", threshold: str = "threshold") -> Column:
    """How often the mix takes a row, from the columns of the plan."""
    return F.col(epochs) + (F.col(hash_column) < F.col(threshold)).cast("long")


def take(
    docs: DataFrame, source_column: str = "source", id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """The mixed documents: the columns of ``docs``, whatever their names, a row as often as the mix
    takes it."""
    _, plan = mix(docs, source_column, id_column, text_column)
    source, epochs, threshold, own, copy = (free_name(docs, f"_mix_{n}") for n in ("source", "epochs", "threshold", "hash", "copy"))
    plan = plan.select(F.col("source").alias(source), F.col("epochs").alias(epochs), F.col("threshold").alias(threshold))
    ids, text = F.col(id_column), F.col(text_column)
    hashed = docs.withColumn(own, F.when(ids.isNotNull(), unit_hash(ids)).otherwise(unit_hash(text)))
    found = hashed.join(plan, F.col(source_column).eqNullSafe(F.col(source)))
    found = found.withColumn(copy, F.explode(F.array_repeat(F.lit(1), copies(own, epochs, threshold).cast("int"))))
    return found.drop(source, epochs, threshold, own, copy)
