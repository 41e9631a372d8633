"""Consistent-hash sharding with virtual nodes and bounded loads.

Every shard owns a number of points on a 64-bit ring; a key belongs to the
first point clockwise from its hash. Shards have a bound on their rows. A
shard first keeps its own keys up to its bound, arc by arc in ring order; keys that overflow
go on clockwise to the next shard with room. Only counts per arc (shards times
points) reach the driver, which turns them into ranges of ranks; each row
takes its shard from its rank inside its arc.

With ``slack`` 0 the bounds add up to the number of rows, so counts are at
most one apart. A larger slack moves fewer keys from their first shard.

Defined cases: a null text has no bytes and checksum 0; a null key has a hash
of its own; inside an arc rows are
ordered by part, ring position, key, size and checksum, so rows of one key may go to several shards. Repeated
rows are summed up before ranking and told apart by their slot alone. An empty
table gives no rows. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vitalframe.llm.common import expand_copies, staged

POINTS = 64
# every arc is ranked in this many parts, dealt by a hash of the whole row (id, size, checksum), and the parts' counts are summed up
PARTS = 64


def ring(shards: int, points: int = POINTS) -> tuple[np.ndarray, np.ndarray]:
    """(positions, shards) of all points, in ring order."""
    spots = sorted((xxhash.xxh64_intdigest(f"{s}#{v}") - (1 << 63), s) for s in range(shards) for v in range(points))
    return np.array([p for p, _ in spots], np.int64), np.array([s for _, s in spots], np.int64)


def bounds(rows: int, shards: int, slack: float = 0.0) -> list[int]:
    """Most rows of each shard; with no slack they add up to ``rows`` and differ by one at most."""
    if slack:
        return [int(np.ceil(rows * (1 + slack) / shards))] * shards
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def flows(counts: list[int], owner: list[int], bound: list[int]) -> list[list[tuple[int, int]]]:
    """Per arc the (shard, rows) that its keys go to, in rank order."""
    room, out, rest = list(bound), [], []
    for n, shard in zip(counts, owner, strict=True):
        stay = min(n, room[shard])
        room[shard] -= stay
        out.append([(shard, stay)] if stay else [])
        rest.append(n - stay)
    for arc, left in enumerate(rest):
        at = arc
        while left:
            at = (at + 1) % len(owner)
            take = min(left, room[owner[at]])
            if take:
                room[owner[at]] -= take
                out[arc].append((owner[at], take))
                left -= take
    return out


def shard_rows(docs: DataFrame, shards: int, points: int = POINTS, slack: float = 0.0) -> DataFrame:
    """doc_id, size, text_crc32, home (the shard without bounds), shard, slot (gapless per shard) of every row."""
    position, owner = ring(shards, points)
    spark = docs.sparkSession

    @F.pandas_udf("int")
    def arc_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for x in batches:
            yield pd.Series(np.searchsorted(position, x.to_numpy(), side="left") % len(position)).astype("int32")

    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    keys = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 8).cast("long").alias("size"),
                       F.crc32(text).alias("text_crc32"))
    same = keys.groupBy("doc_id", "size", "text_crc32").agg(F.count("*").alias("copies"))
    placed = staged(same.withColumn("spot", F.xxhash64("doc_id")).withColumn("arc", arc_of("spot")), "ring")

    sizes = {r["arc"]: r["n"] for r in placed.groupBy("arc").agg(F.sum("copies").alias("n")).collect()}  # one row per point
    counts = [sizes.get(a, 0) for a in range(len(owner))]
    filled, ranges = [0] * shards, []
    for arc, parts in enumerate(flows(counts, owner.tolist(), bounds(sum(counts), shards, slack))):
        at = 0
        for shard, n in parts:
            ranges.append((arc, at, at + n, shard, filled[shard] - at, int(owner[arc])))
            at, filled[shard] = at + n, filled[shard] + n
    ranges = spark.createDataFrame(ranges, "arc int, low long, high long, shard int, shift long, home int")

    # rows of one id differ in size or checksum, so a hot id is dealt over all parts
    parted = placed.withColumn("part", F.pmod(F.xxhash64("doc_id", "size", "text_crc32"), F.lit(PARTS)).cast("int"))
    before = Window.partitionBy("arc").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offset = (parted.groupBy("arc", "part").agg(F.sum("copies").alias("n"))
              .select("arc", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")))
    earlier = Window.partitionBy("arc", "part").orderBy("spot", "doc_id", "size", "text_crc32").rowsBetween(Window.unboundedPreceding, -1)
    ranked = parted.withColumn("inner", F.coalesce(F.sum("copies").over(earlier), F.lit(0)))
    each = (ranked.join(offset, ["arc", "part"])
            .select("doc_id", "size", "text_crc32", "arc", F.col("before") + F.col("inner"), "copies")
            .toDF("doc_id", "size", "text_crc32", "arc", "base", "copies"))
    each = expand_copies(each, "copies", "copy").withColumn("rank", F.col("base") + F.col("copy"))
    # the ranges are a few per ring point, however many rows there are
    return (each.join(F.broadcast(ranges), (each["arc"] == ranges["arc"]) & (each["rank"] >= ranges["low"]) & (each["rank"] < ranges["high"]))
            .select("doc_id", "size", "text_crc32", "home", "shard", (F.col("rank") + F.col("shift")).alias("slot")))
