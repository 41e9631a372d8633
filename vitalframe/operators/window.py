"""Window operators as two-level scans.

A window partitioned by (patient, measure) would put a whole series in one
task, and one patient may hold a large share of all rows. ``locf`` and
``neighbours`` cut the ordered time axis into chunks of ``chunk`` time units,
scan per (keys, chunk) in parallel, and carry boundary values across chunks
through a small summary (one row per chunk; of a completed grid, one per span of chunks). NULL keys are a group like any
other, and rows without a time a chunk of their own. Row numbers and running sums are
taken over range partitions that are written once, so that the partitions'
offsets belong to the partitions that the rows are in.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vitalframe.operators.relational import fill_keys, restore_keys
from vitalframe.session import staged

_UNB = Window.unboundedPreceding
DAY = 1440


def chunk_of(t: str, chunk: int) -> F.Column:
    """Chunk number of a time; NULL times come first, as in an ascending order."""
    return F.coalesce(F.floor(F.col(t) / F.lit(chunk)).cast("bigint"), F.lit(-(1 << 62)))


def dealt(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows dealt by ``keys`` into as many partitions as the session has shuffle partitions. A partition is not merged with
    others for its size: for short rows that are multiplied behind, whose tasks would be few however much they make. Rows that
    are grouped by these keys already are dealt by a hash of them, as the planner would leave them where they are."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


@dataclass(frozen=True)
class Grid:
    """Of a frame that ``timegrid.complete_grid`` made (its ``_grid``): the rows that were there, and the keys, time and step
    of the points added between them. A frame made from it by anything else no longer has it."""
    rows: DataFrame
    keys: tuple[str, ...]
    t: str
    step: int


def locf(df: DataFrame, keys: Sequence[str], t: str, cols: Sequence[str],
         chunk: int = DAY, tiebreak: Sequence[str] = ()) -> DataFrame:
    """Carry the last non-NULL value forward along ``t`` within ``keys``.

    Of a completed grid only the rows that were there are dealt and scanned; the points between them, which may be many times
    as many, are added behind that, with the values carried so far."""
    given, cols = list(keys), list(cols)
    grid = df.__dict__.get("_grid")
    if grid is not None and (grid.keys, grid.t) == (tuple(given), t) and {*cols, *tiebreak} <= {*df.columns} - {*given, t}:
        return _locf_grid(grid, cols, chunk, tiebreak)
    x, keys = fill_keys(df, given)
    order = [F.col(t)] + [F.col(c) for c in tiebreak]
    x = x.withColumn("_chunk", chunk_of(t, chunk))
    # last non-NULL value of each chunk, then carried across earlier chunks; taken from the rows before they are
    # filled, so nothing is sorted for it, and ordered by the plain time where it can be, which a hash aggregate holds
    ties = [F.col(c) for c in tiebreak if c not in cols]
    at = F.struct(F.col(t), *ties) if ties else F.coalesce(F.col(t), F.lit(-(1 << 62)))
    raw = x
    wl = Window.partitionBy(*keys, "_chunk").orderBy(*order).rowsBetween(_UNB, 0)
    x = x.withColumns({c: F.last(c, ignorenulls=True).over(wl) for c in cols})
    summ = raw.groupBy(*keys, "_chunk").agg(*[
        F.max_by(F.col(c), F.when(F.col(c).isNotNull(), at)).alias(f"_last_{c}") for c in cols])
    wc = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(_UNB, -1)
    summ = summ.select(*keys, "_chunk", *[
        F.last(f"_last_{c}", ignorenulls=True).over(wc).alias(f"_in_{c}") for c in cols])
    x = x.join(summ.hint("merge"), keys + ["_chunk"], "left")
    x = x.withColumns({c: F.coalesce(F.col(c), F.col(f"_in_{c}")) for c in cols}) \
         .drop("_chunk", *[f"_in_{c}" for c in cols])
    return restore_keys(x, given)


def _locf_grid(grid: Grid, cols: list[str], chunk: int, tiebreak: Sequence[str], points: int = 4096) -> DataFrame:
    """``locf`` of a completed grid. Rows are dealt once, by spans of as many chunks as ``points`` grid points take. Values are carried
    inside chunks, then from chunk to chunk of a span, then from span to span by a summary (a span's last row), which
    also has the next span's first time; each row then makes the grid points up to the next one."""
    given, t, step = list(grid.keys), grid.t, grid.step
    x, keys = fill_keys(grid.rows.withColumn(t, F.col(t).cast("bigint")), given)
    x = x.withColumn("_chunk", chunk_of(t, chunk))
    x = dealt(x.withColumn("_span", F.floor(F.col("_chunk") / F.lit(max(points * step // chunk, 1))).cast("bigint")), [*keys, "_span"])
    w = Window.partitionBy(*keys, "_span", "_chunk").orderBy(t, *tiebreak)
    x = x.withColumns({**{c: F.last(c, ignorenulls=True).over(w.rowsBetween(_UNB, 0)) for c in cols}, "_end": F.lead(F.lit(1)).over(w).isNull()})
    ws = Window.partitionBy(*keys, "_span").orderBy("_chunk", t, *tiebreak)  # the same order
    x = x.withColumns({**{f"_in_{c}": F.last(F.when(F.col("_end"), F.col(c)), ignorenulls=True).over(ws.rowsBetween(_UNB, -1)) for c in cols},
                       "_next": F.lead(t).over(ws), "_first": F.min(t).over(ws.rowsBetween(_UNB, 0)), "_end": F.lead(F.lit(1)).over(ws).isNull()})
    x = x.withColumns({c: F.coalesce(F.col(c), F.col(f"_in_{c}")) for c in cols}).drop(*[f"_in_{c}" for c in cols])
    wk = Window.partitionBy(*keys).orderBy("_span")
    summ = x.filter("_end").select(
        *keys, "_span", *[F.last(c, ignorenulls=True).over(wk.rowsBetween(_UNB, -1)).alias(f"_in_{c}") for c in cols],
        F.lead("_first").over(wk).alias("_after"), F.first("_first", ignorenulls=True).over(wk.rowsBetween(_UNB, 0)).alias("_lo"))
    x = x.join(summ.hint("merge"), keys + ["_span"], "left")
    x = x.withColumns({**{c: F.coalesce(F.col(c), F.col(f"_in_{c}")) for c in cols}, "_next": F.coalesce("_next", "_after")})
    # the row itself (without a start), and the starts of its arrays of grid points
    lo, every = F.col("_lo"), F.lit(step).cast("bigint")
    x = x.withColumns({"_from": lo + (F.floor((F.col(t) - lo) / every).cast("bigint") + 1) * every, "_upto": F.col("_next") - 1})
    starts = F.when(F.col("_from") <= F.col("_upto"), F.sequence("_from", "_upto", every * points))
    x = x.withColumn("_start", F.explode(F.concat(F.array(F.lit(None).cast("bigint")), F.coalesce(starts, F.array().cast("array<bigint>")))))
    real = F.col("_start").isNull()
    x = x.withColumn("_t", F.explode(F.when(real, F.array(t)).otherwise(
        F.sequence("_start", F.least(F.col("_start") + every * (points - 1), F.col("_upto")), every))))
    kept = {*keys, *cols}
    return restore_keys(x.select(*[F.col("_t").alias(c) if c == t else F.col(c) if c in kept else F.when(real, F.col(c)).alias(c)
                                   for c in grid.rows.columns], keys[-1]), given)


def neighbours(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str,
               lag_name: str = "value_lag", lead_name: str = "value_lead",
               chunk: int = DAY) -> DataFrame:
    """Previous and next row's ``value`` within ``keys`` (lag(1), lead(1));
    ``order[0]`` is the numeric time axis."""
    given, order = list(keys), list(order)
    x, keys = fill_keys(df, given)
    x = x.withColumn("_chunk", chunk_of(order[0], chunk))
    w = Window.partitionBy(*keys, "_chunk").orderBy(*order)
    wall = Window.partitionBy(*keys, "_chunk")
    x = x.withColumns({"__lag": F.lag(value, 1).over(w), "__lead": F.lead(value, 1).over(w),
                       "__rn": F.row_number().over(w), "__cnt": F.count(F.lit(1)).over(wall)})
    ordkey = F.struct(*[F.col(c) for c in order])
    summ = x.groupBy(*keys, "_chunk").agg(F.min_by(value, ordkey).alias("__first"),
                                          F.max_by(value, ordkey).alias("__last"))
    wc = Window.partitionBy(*keys).orderBy("_chunk")
    summ = summ.select(*keys, "_chunk", F.lag("__last", 1).over(wc).alias("__prev"),
                       F.lead("__first", 1).over(wc).alias("__next"))
    x = x.join(summ.hint("merge"), keys + ["_chunk"], "left")
    return restore_keys(x.withColumns({
        lag_name: F.when(F.col("__rn") == 1, F.col("__prev")).otherwise(F.col("__lag")),
        lead_name: F.when(F.col("__rn") == F.col("__cnt"), F.col("__next")).otherwise(F.col("__lead")),
    }), given).drop("_chunk", "__lag", "__lead", "__rn", "__cnt", "__prev", "__next")


def next_time(df: DataFrame, keys: Sequence[str], t: str, name: str, chunk: int = DAY) -> DataFrame:
    """The next distinct row's time within ``keys``; rows are unique per (keys, t) and ``t`` is never NULL.

    A row without a successor in its chunk takes the first time of the next chunk that has rows."""
    given = list(keys)
    x, keys = fill_keys(df, given)
    x = x.withColumn("_chunk", chunk_of(t, chunk))
    x = x.withColumn("__lead", F.lead(t).over(Window.partitionBy(*keys, "_chunk").orderBy(t)))
    summ = x.groupBy(*keys, "_chunk").agg(F.min(t).alias("__first"))
    summ = summ.select(*keys, "_chunk", F.lead("__first").over(Window.partitionBy(*keys).orderBy("_chunk")).alias("__next"))
    x = x.join(summ.hint("merge"), keys + ["_chunk"], "left")
    return restore_keys(x.withColumn(name, F.coalesce("__lead", "__next")).drop("_chunk", "__lead", "__next"), given)


def rank_in_group(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "rn") -> DataFrame:
    """Row number within ``keys`` along ``order`` (``order`` should be unique
    within a group), as a running count over range partitions, so a group that
    holds a large share of the rows is numbered by many tasks."""
    x = prefix_sums(df.withColumn("_one", F.lit(1)), keys, list(order), ["_one"])
    return x.withColumn(name, F.col("cum__one").cast("int")).drop("cum__one", "_one")


def group_size(df: DataFrame, keys: Sequence[str], name: str = "n") -> DataFrame:
    """``add_count``: rows of the group on every row (aggregate + join, no window)."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
    return df.join(counts, list(keys), "left")


def attach_max(df: DataFrame, keys: Sequence[str], value: str, name: str | None = None) -> DataFrame:
    name = name or f"max_{value}"
    agg = df.groupBy(*keys).agg(F.max(value).alias(name))
    return df.join(agg, list(keys), "left")


def attach_min(df: DataFrame, keys: Sequence[str], value: str, name: str | None = None) -> DataFrame:
    name = name or f"min_{value}"
    agg = df.groupBy(*keys).agg(F.min(value).alias(name))
    return df.join(agg, list(keys), "left")


def number_patients(df: DataFrame, order: Sequence[str], name: str = "id_nr") -> DataFrame:
    """Consecutive 1..n ids for distinct keys, in ``order``."""
    keys = list(order)
    x = prefix_sums(df.select(*keys).distinct().withColumn("_one", F.lit(1)), [], keys, ["_one"])
    return x.select(*keys, F.col("cum__one").cast("bigint").alias(name))


def prefix_sums(df: DataFrame, keys: Sequence[str], order: str | Sequence[str], cols: Sequence[str],
                inclusive: bool = True, partitions: int | None = None) -> DataFrame:
    """Running sums of ``cols`` along ``order`` within ``keys``, without
    putting a whole group in one task.

    Rows are range-partitioned on (keys, order) and written once with the
    number of their partition; each partition computes local running sums,
    and a small table of per-(partition, group) totals gives every partition
    its offset. Range boundaries come from a sample that differs from run to
    run, so both reads use the one written table. Rows should be unique per
    (keys, order) (aggregate ties first).
    """
    keys, cols = list(keys), list(cols)
    order = [order] if isinstance(order, str) else list(order)
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    x = staged(df.repartitionByRange(n, *keys, *order).withColumn("_pid", F.spark_partition_id()), "ranges")
    frame = (_UNB, 0) if inclusive else (_UNB, -1)
    w = Window.partitionBy("_pid", *keys).orderBy(*order).rowsBetween(*frame)
    tot = x.groupBy("_pid", *keys).agg(*[F.sum(c).alias(f"_tot_{c}") for c in cols])
    x = x.withColumns({f"_loc_{c}": F.coalesce(F.sum(c).over(w), F.lit(0)) for c in cols})
    # one row per partition and group: a group's window spans its partitions, not its rows
    wo = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("_pid").rowsBetween(_UNB, -1)
    offs = tot.select("_pid", *[F.col(k).alias(f"_k_{k}") for k in keys],
                      *[F.coalesce(F.sum(f"_tot_{c}").over(wo), F.lit(0)).alias(f"_off_{c}") for c in cols]) \
        .withColumnRenamed("_pid", "_p")
    same = F.col("_pid") == F.col("_p")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    x = x.join(offs, same, "left")
    return x.withColumns({f"cum_{c}": F.col(f"_loc_{c}") + F.col(f"_off_{c}") for c in cols}) \
            .drop("_pid", "_p", *[f"_k_{k}" for k in keys], *[f"_loc_{c}" for c in cols], *[f"_off_{c}" for c in cols])
