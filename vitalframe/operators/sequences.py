"""Per-patient sequences in blocks, padding, drawn windows, class weights and splits.

A sequence is stored as rows (key, block, before, seq_len, steps): the steps of
one span of time, how many steps the earlier blocks hold (the directory of
prefix lengths) and the whole sequence's length. No row holds more than one
block, however long a patient's series is, and a patient with a large share
of all rows is spread over its blocks' tasks. Padding appends filler blocks; a
drawn window reads the blocks that it touches. ``whole_sequences`` gives one
array per patient, for grids that are known to be short.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vitalframe.functions.scalar import mix_hash
from vitalframe.operators.relational import fill_keys, restore_keys, with_scalars
from vitalframe.session import staged

BLOCK_SPAN = 1440
# steps of a filler block
FILL = 1440


def directory(blocks: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, block, before, seq_len): steps of the blocks before and of the whole sequence. ``blocks``: keys, block, n; one row per
    block, without its steps."""
    before = Window.partitionBy(*keys).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return blocks.select(*keys, "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"),
                         F.sum("n").over(Window.partitionBy(*keys)).alias("seq_len"))


def _block(t: str, block_span: int):
    return F.floor(F.col(t) / F.lit(block_span)).cast("bigint").alias("block")


def to_sequences(df: DataFrame, key: str, t: str, features: Sequence[str],
                 targets: Sequence[str] = (), block_span: int = BLOCK_SPAN) -> DataFrame:
    """(key, t, features...) rows -> (key, block, before, seq_len, steps ARRAY<STRUCT<t, x, y>>), one row per
    ``block_span`` time units that hold steps; steps are ordered by t, and duplicate times are averaged first. Blocks are written once; the directory is made of their lengths.
    Rows without a time are no steps; a NULL key is a sequence like any other."""
    feats, tgts = list(features), list(targets)
    x, keys = fill_keys(df.filter(F.col(t).isNotNull()), [key])
    # dealt by block at once: duplicates meet in their block, so neither grouping shuffles the steps again
    x = x.select(*keys, t, *feats, *tgts, _block(t, block_span)).repartition(*keys, "block")
    one = x.groupBy(*keys, "block", t).agg(*[F.avg(c).alias(c) for c in feats + tgts])
    step = F.struct(F.col(t).alias("t"),
                    F.array(*[F.col(c).cast("double") for c in feats]).alias("x"),
                    F.array(*[F.col(c).cast("double") for c in tgts]).alias("y"))
    blocks = one.groupBy(*keys, "block").agg(F.array_sort(F.collect_list(step)).alias("steps"))
    blocks = staged(blocks.withColumn("n", F.size("steps").cast("bigint")), "blocks")
    out = blocks.drop("n").join(directory(blocks.select(*keys, "block", "n"), keys), [*keys, "block"])
    return restore_keys(out, [key]).select(key, "block", "before", "seq_len", "steps")


def whole_sequences(seqs: DataFrame, key: str) -> DataFrame:
    """(key, seq_len, steps): each sequence as one array. Only for sequences that are known to fit into a row."""
    x = seqs.groupBy(key).agg(F.first("seq_len").alias("seq_len"), F.array_sort(F.collect_list(F.struct("before", "steps"))).alias("_b"))
    return x.select(key, "seq_len", F.flatten(F.transform("_b", lambda b: b["steps"])).alias("steps"))


def _filler(steps):
    """A step without a time: zero inputs, missing targets, as many as the first of ``steps`` has."""
    return F.struct(F.lit(None).cast("bigint").alias("t"), F.transform(steps[0]["x"], lambda v: F.lit(0.0)).alias("x"),
                    F.transform(steps[0]["y"], lambda v: F.lit(None).cast("double")).alias("y"))


def pad(seqs: DataFrame, length: int | None = None) -> DataFrame:
    """Every sequence padded to ``length`` (default: the longest): inputs with zeros, targets with NULL (missing).

    Stored blocks stay as they are; filler blocks of at most ``FILL`` steps follow a sequence's last one, numbered on."""
    if length is None:
        x = with_scalars(seqs, seqs.agg(F.max("seq_len").alias("_len")))
    else:
        x = seqs.withColumn("_len", F.lit(int(length)).cast("bigint"))
    last = x.filter((F.col("before") + F.size("steps") == F.col("seq_len")) & (F.col("seq_len") < F.col("_len")))
    fill = last.select(*[c for c in x.columns if c not in ("before", "block")], F.col("block").alias("_last"),
                       F.explode(F.sequence(F.col("seq_len"), F.col("_len") - 1, F.lit(FILL).cast("bigint"))).alias("before"))
    n = F.least(F.lit(FILL), F.col("_len") - F.col("before")).cast("int")
    fill = fill.withColumn("block", F.col("_last") + 1 + F.floor((F.col("before") - F.col("seq_len")) / FILL).cast("bigint")) \
        .withColumn("steps", F.array_repeat(_filler(F.col("steps")), n))
    return x.drop("_len").unionByName(fill.select(*seqs.columns))


def sample_block(seqs: DataFrame, size: int, seed: int = 0, key: str = "pat_id") -> DataFrame:
    """A ``size``-step block per patient: start drawn from a hash of (key,
    seed) in [0, len - size]; shorter sequences are left-padded with zero
    inputs; the target is the block's last step.

    Only blocks that the drawn window touches are kept and cut to it, so at
    most ``size`` steps per patient are gathered."""
    span = F.greatest(F.col("seq_len") - F.lit(size), F.lit(0))
    start = F.when(span > 0, F.pmod(mix_hash(key, seed), span + F.lit(1))).otherwise(F.lit(0))
    x = seqs.withColumn("start", start.cast("bigint"))
    end, n = F.col("start") + F.lit(size), F.size("steps")
    x = x.filter((F.col("before") < end) & (F.col("before") + n > F.col("start")))
    first = F.greatest(F.col("start") - F.col("before"), F.lit(0))
    part = F.slice("steps", (first + 1).cast("int"), F.least(n, (end - F.col("before")).cast("int")) - first.cast("int"))
    x = x.groupBy(key, "start", "seq_len").agg(F.array_sort(F.collect_list(F.struct(F.col("before"), part.alias("steps")))).alias("_b"))
    x = x.withColumn("_s", F.flatten(F.transform("_b", lambda b: b["steps"])))
    padn = F.greatest(F.lit(size) - F.col("seq_len"), F.lit(0)).cast("int")
    x = x.withColumn("_s", F.concat(F.array_repeat(_filler(F.col("_s")), padn), F.col("_s")))
    return x.select(key, F.col("start").cast("int").alias("start"), "seq_len", F.col("_s.x").alias("x"),
                    F.element_at("_s", -1)["y"].alias("y"))


def class_weights(df: DataFrame, targets: Sequence[str]) -> DataFrame:
    """negatives / positives per 0/1 target (one row, ``<target>_weight``)."""
    aggs = []
    for t in targets:
        neg = F.sum(F.when(F.col(t) == 0.0, 1).otherwise(0)).cast("double")
        pos = F.sum(F.when(F.col(t) == 1.0, 1).otherwise(0)).cast("double")
        aggs.append(F.try_divide(neg, pos).alias(f"{t}_weight"))
    return df.agg(*aggs)


def make_folds(patients: DataFrame, key: str = "pat_id", test_pct: int = 20, seed: int = 0) -> DataFrame:
    """Fold table: test / dev by a stable hash of the key; dev rows get a
    3-fold and a 5-fold validation id and a 'full' validation flag."""
    h = mix_hash(key, seed, 100)
    g = mix_hash(key, seed + 1, 1_000_000)
    x = patients.select(key).distinct()
    return x.select(key, F.when(h < test_pct, "test").otherwise("dev").alias("part"),
                    F.pmod(g, F.lit(3)).cast("int").alias("fold3"),
                    F.pmod(g, F.lit(5)).cast("int").alias("fold5"),
                    (F.pmod(g, F.lit(10)) < 2).alias("val_full"))


def apply_split(df: DataFrame, folds: DataFrame, mode: str = "full", fold: int = 0,
                key: str = "pat_id") -> DataFrame:
    """Tag rows train / val / test: test is fixed; val is the chosen fold of
    the dev part (``full``, ``split3`` or ``split5``); train = dev - val."""
    if mode == "full":
        is_val = F.col("val_full")
    elif mode == "split3":
        is_val = F.col("fold3") == fold
    elif mode == "split5":
        is_val = F.col("fold5") == fold
    else:
        raise ValueError("not a valid val_mode")
    split = F.when(F.col("part") == "test", "test").when(is_val, "val").otherwise("train")
    return df.join(folds.select(key, split.alias("split")), key, "inner")


def split_targets(df: DataFrame, categorical: Sequence[str], key: str = "pat_id") -> tuple[DataFrame, DataFrame]:
    """(key + categorical targets, key + the remaining columns)."""
    cat = [c for c in categorical if c in df.columns]
    rest = [c for c in df.columns if c not in cat and c != key]
    return df.select(key, *cat), df.select(key, *rest)
