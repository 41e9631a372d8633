"""Mixing sources to target weights by hash-threshold histograms.

Every row has a 60-bit key (hash of its id and text). A source whose target is
T words takes each of its rows floor(T / size of the source) times, and once
more the rows with the smallest keys until the rest of T is reached. That
threshold is found without sorting: words are summed by source and the key's
first bits, the running sum finds the bucket in which the rest is reached, and
only this bucket's rows are summed again by the next bits, then by the whole key.
All rows are then filtered by comparing keys. The row at the border is taken if
that brings the source nearer to its target, so a source is off by at most half
of one document. Thresholds grow with the budget: a smaller budget's rows are
among those of a larger one (``shares``).

Texts are read once; what follows works on a staged table of four numbers a
row. One row per source and share goes through one task, the rest is dealt by
(source, bucket). Tables of one row per source are written first, so that the
planner sees their size and broadcasts them only if they are small.

Defined cases: a null or blank text has size 0 and is taken 0 words; a null
source is a source of its own, last in order; a null id is hashed as the empty
text. Rows of one id and different texts have keys of their own. Repeated rows
have one key; as many of them as fit are taken, and they are counted, not
gathered. A source without words has target 0. An empty table gives no rows.
Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitalframe.llm.common import expand_copies, staged

WEIGHTS = (5, 2, 1)
CAP = 3
KEY_BITS = 60
# bits of the key by which words are summed at the first two levels; the third takes the whole key
LEVEL_BITS = 12


def word_count(text: Column) -> Column:
    """Number of words; the text is reduced to one letter a word, so no array of words is built."""
    marks = F.regexp_replace(text, r"[^\x20\x09-\x0D]+", "w")
    return F.coalesce(F.length(F.translate(marks, " \t\n\x0b\x0c\r", "")), F.lit(0)).cast("long")


def row_key(doc_id: Column, text: Column) -> Column:
    """The first 60 bits of an md5 of id and text, as a number."""
    both = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), F.md5(F.coalesce(text, F.lit("")).cast("binary")))
    return F.conv(F.substring(F.md5(both.cast("binary")), 1, KEY_BITS // 4), 16, 10).cast("long")


def measure(docs: DataFrame) -> DataFrame:
    """doc_id, source, size, key of every row, staged."""
    return staged(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                              word_count(F.col("text")).alias("size"), row_key(F.col("doc_id"), F.col("text")).alias("key")), "mix-rows")


def targets(rows: DataFrame, weights: Sequence[int] = WEIGHTS, cap: int = CAP, shares: Sequence[float] = (1.0,)) -> DataFrame:
    """source, share_no, source_size, target: one row per source and share.

    Sources saturate in order of size / weight: one is above its cap if its part of what the earlier
    ones leave is. The rest is divided among the others by weight.
    """
    if max(shares) > cap:
        raise ValueError("a share above the cap cannot be reached")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    choice = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (place % len(weights) + 1).cast("int"))
    x = sizes.withColumn("weight", choice)
    x = x.select("*", F.posexplode(F.array(*[F.lit(float(s)) for s in shares])).alias("share_no", "share"))
    whole = Window.partitionBy("share_no")
    x = x.withColumn("budget", F.sum("source_size").over(whole) * F.col("share"))
    later = whole.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    x = (x.withColumn("_before", F.coalesce(F.sum("source_size").over(later.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
         .withColumn("_left", F.sum("weight").over(later.rowsBetween(Window.currentRow, Window.unboundedFollowing))))
    full = F.col("weight") * (F.col("budget") - F.lit(cap) * F.col("_before")) > F.lit(cap) * F.col("source_size") * F.col("_left")
    x = x.withColumn("_full", full)
    rest = F.col("budget") - F.lit(cap) * F.sum(F.when(F.col("_full"), F.col("source_size")).otherwise(0)).over(whole)
    open_weight = F.sum(F.when(F.col("_full"), 0).otherwise(F.col("weight"))).over(whole)
    target = F.when(F.col("_full"), (F.lit(cap) * F.col("source_size")).cast("double")).otherwise(F.col("weight") * rest / open_weight)
    return x.select("source", "share_no", "source_size", target.cast("double").alias("target"))


def _crossing(sums: DataFrame, goals: DataFrame, bucket: str) -> DataFrame:
    """Per source and share the first bucket at whose end the running sum is above the goal's ``rest``,
    and in ``before`` the words before it. ``sums``: source, share_no, ``bucket``, n."""
    order = Window.partitionBy("source", "share_no").orderBy(bucket)
    run = sums.withColumn("_upto", F.sum("n").over(order))
    at = run["source"].eqNullSafe(goals["source"]) & (run["share_no"] == goals["share_no"])
    x = run.join(goals.withColumnRenamed(bucket, "_old") if bucket in goals.columns else goals, at).drop(run["source"], run["share_no"])
    x = x.withColumn("_upto", F.col("_upto") + F.col("before"))
    return (x.filter((F.col("_upto") > F.col("rest")) & (F.col("_upto") - F.col("n") <= F.col("rest")))
            .select("source", "share_no", "rest", F.col(bucket), (F.col("_upto") - F.col("n")).alias("before")))


def thresholds(rows: DataFrame, goals: DataFrame) -> DataFrame:
    """source, share_no, edge, room: rows of smaller key than ``edge`` fit whole into the goal's ``rest``
    words, and ``room`` words are left for those of that key. ``goals``: source, share_no, rest."""
    shift = KEY_BITS - LEVEL_BITS
    first = rows.groupBy("source", F.shiftright("key", shift).alias("bucket")).agg(F.sum("size").alias("n"))
    start = goals.select("source", "share_no", "rest", F.lit(0).cast("long").alias("before"))
    numbers = goals.select(F.col("source").alias("_s"), "share_no")
    sums = first.join(numbers, first["source"].eqNullSafe(numbers["_s"])).drop("_s")
    found = staged(_crossing(sums, start, "bucket"), "mix-level1")
    for level in (shift - LEVEL_BITS, 0):
        inside = found.select(F.col("source").alias("_s"), "share_no", F.col("bucket").alias("_b"))
        part = rows.join(inside, rows["source"].eqNullSafe(inside["_s"]) & (F.shiftright("key", shift) == F.col("_b")))
        sums = part.groupBy("source", "share_no", F.shiftright("key", level).alias("bucket")).agg(F.sum("size").alias("n"))
        found = staged(_crossing(sums, found, "bucket"), f"mix-level{2 if level else 3}")
        shift = level
    return found.select("source", "share_no", F.col("bucket").alias("edge"), (F.col("rest") - F.col("before")).alias("room"))


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, cap: int = CAP, shares: Sequence[float] = (1.0,)) -> DataFrame:
    """doc_id, source, size, source_size and, one entry per share of all words, arrays ``targets`` and ``taken``."""
    rows = measure(docs)
    goals = staged(targets(rows, weights, cap, shares), "mix-targets")
    whole = F.coalesce(F.floor(F.try_divide(F.col("target"), F.col("source_size"))), F.lit(0))
    goals = goals.withColumn("repeats", whole).withColumn("rest", F.col("target") - F.col("repeats") * F.col("source_size"))
    edges = thresholds(rows, goals.filter("rest > 0"))
    per = goals.join(edges.withColumnRenamed("source", "_s").withColumnRenamed("share_no", "_n"),
                     goals["source"].eqNullSafe(F.col("_s")) & (goals["share_no"] == F.col("_n")), "left")
    plan = staged(per.groupBy("source").agg(
        F.first("source_size").alias("source_size"),
        F.sort_array(F.collect_list(F.struct("share_no", "target", "repeats", "edge", "room"))).alias("goals"))
        .withColumnRenamed("source", "_s"), "mix-plan")
    x = rows.join(plan, rows["source"].eqNullSafe(plan["_s"])).drop("_s")
    at_edge = F.coalesce(F.exists("goals", lambda g: g["edge"] == F.col("key")), F.lit(False))

    def taken(more) -> Column:
        """Words taken per share; ``more(goal)`` says whether the row is taken once more."""
        return F.transform("goals", lambda g: (F.col("size") * (g["repeats"] + F.when(more(g), 1).otherwise(0))).cast("long"))

    def out(df: DataFrame, more) -> DataFrame:
        return df.select("doc_id", "source", "size", "source_size", F.transform("goals", lambda g: g["target"]).alias("targets"),
                         taken(more).alias("taken"))

    plain = out(x.filter(~at_edge), lambda g: F.col("key") < g["edge"])
    # rows of a border key, told apart by size and id; equal rows are counted and numbered
    same = x.filter(at_edge).groupBy("source", "key", "size", "doc_id").agg(
        F.count("*").alias("copies"), F.first("source_size").alias("source_size"), F.first("goals").alias("goals"))
    earlier = Window.partitionBy("source", "key").orderBy("size", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    same = same.withColumn("_base", F.coalesce(F.sum(F.col("size") * F.col("copies")).over(earlier), F.lit(0)))
    border = expand_copies(same, "copies", "_copy").withColumn("_mid", F.col("_base") + F.col("_copy") * F.col("size") + F.col("size") / 2)
    return plain.unionByName(out(border, lambda g: (F.col("key") < g["edge"]) | ((F.col("key") == g["edge"]) & (F.col("_mid") <= g["room"]))))
