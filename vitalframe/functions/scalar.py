"""Scalar conversions used across the sources (parse numbers, times, scores)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vitalframe.functions.nulls import ColumnOrName, col

MICROS_PER_MINUTE = 60_000_000
MICROS_PER_DAY = 86_400_000_000


def parse_number(c: ColumnOrName) -> Column:
    """First number in a text, grouping commas removed; NULL when there is none.
    Chart texts hold plain decimals: an exponent is not read (``1e3`` gives 1)."""
    cleaned = F.regexp_replace(col(c), ",", "")
    found = F.regexp_extract(cleaned, r"-?[0-9]*\.?[0-9]+", 0)
    return F.when(found == "", F.lit(None).cast("double")).otherwise(found.try_cast("double"))


def fix_decimal(c: ColumnOrName) -> Column:
    """Decimal comma to point; clock-like ``:00`` text counts as 0."""
    text = col(c).cast("string")
    return F.when(text.rlike(":00"), F.lit("0")).otherwise(F.regexp_replace(text, ",", "."))


def strip_bounds(c: ColumnOrName) -> Column:
    """Numeric value of texts like ``<0.3`` or ``>100``; NULL when not a number."""
    return F.regexp_replace(col(c).cast("string"), "[<>]", "").try_cast("double")


def to_double(c: ColumnOrName) -> Column:
    return col(c).try_cast("double")


def to_text(c: ColumnOrName) -> Column:
    return col(c).cast("string")


def floor_to(c: ColumnOrName, step: int) -> Column:
    """Start of the ``step``-wide bucket, as BIGINT."""
    return (F.floor(col(c) / F.lit(step)) * F.lit(step)).cast("bigint")


def to_ts(c: ColumnOrName, fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    return F.try_to_timestamp(col(c).cast("string"), F.lit(fmt)).cast("timestamp_ntz")


def floor_minute(c: ColumnOrName) -> Column:
    return F.date_trunc("minute", col(c)).cast("timestamp_ntz")


def micros_between(later: ColumnOrName, earlier: ColumnOrName) -> Column:
    """Exact microseconds from ``earlier`` to ``later``. For zone-free
    timestamps the difference is taken without any session time zone, so
    daylight-saving changes never shift it."""
    return F.timestamp_diff("MICROSECOND", col(earlier), col(later))


def minutes_between(later: ColumnOrName, earlier: ColumnOrName) -> Column:
    """Whole minutes from ``earlier`` to ``later``, floored (-20 s gives -1)."""
    return F.floor(micros_between(later, earlier) / F.lit(MICROS_PER_MINUTE)).cast("bigint")


def days_between(later: ColumnOrName, earlier: ColumnOrName) -> Column:
    return micros_between(later, earlier) / F.lit(float(MICROS_PER_DAY))


def years_between(later: ColumnOrName, earlier: ColumnOrName) -> Column:
    return days_between(later, earlier) / F.lit(365.0)


def add_minutes(c: ColumnOrName, minutes: int) -> Column:
    return col(c) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(minutes))


def minutes_to_days(c: ColumnOrName) -> Column:
    return col(c) / F.lit(60.0) / F.lit(24.0)


def sigmoid(c: ColumnOrName) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-col(c)))


def jitter(c: ColumnOrName, std: float, seed: int = 0, key: ColumnOrName | None = None) -> Column:
    """Gaussian noise augmentation ``x + std * N(0, 1)``.

    With ``key`` (an integer row identity) the normal draw is a Box-Muller
    transform of two stable hashes of (key, seed): the same noise on every
    rerun, whatever the partitioning. Without it, Spark's seeded ``randn``.
    """
    if key is None:
        return col(c) + F.lit(std) * F.randn(seed)
    return col(c) + F.lit(std) * hash_normal(key, seed)


def hash_normal(key: ColumnOrName, seed: int = 0) -> Column:
    """Standard normal draw from a key: Box-Muller on two 24-bit uniform hashes."""
    scale = float(1 << 24)
    u1 = (mix_hash(key, 2 * seed, 1 << 24).cast("double") + F.lit(0.5)) / F.lit(scale)
    u2 = (mix_hash(key, 2 * seed + 1, 1 << 24).cast("double") + F.lit(0.5)) / F.lit(scale)
    return F.sqrt(F.lit(-2.0) * F.log(u1)) * F.cos(F.lit(2.0 * 3.141592653589793) * u2)


def hash_bit(c: ColumnOrName, seed: int = 0) -> Column:
    """Deterministic 0/1 draw from an integer key, reproducible in any SQL engine."""
    return mix_hash(c, seed, 2).cast("int")


_M32 = 4294967296
_MUL = 0x45D9F3B      # 32-bit mixing multiplier: products stay below 2**59, far from BIGINT overflow
_GOLD = 0x9E3779B9    # seed spreading constant


def mix_hash(c: ColumnOrName, seed: int = 0, modulus: int = _M32) -> Column:
    """Stable integer hash of a key in [0, modulus).

    The key is reduced mod 2**32, offset by the seed, and put through two
    xor-shift / multiply rounds and a final xor-shift (mod 2**32). Only
    64-bit integer arithmetic, so any SQL engine reproduces it exactly
    (see ``mix_hash_sql``), unlike engine-specific hash functions.
    """
    h = F.pmod(F.pmod(col(c).cast("bigint"), F.lit(_M32)) + F.lit((seed * _GOLD) % _M32), F.lit(_M32))
    for _ in range(2):
        h = F.pmod(h.bitwiseXOR(F.shiftright(h, 16)) * F.lit(_MUL), F.lit(_M32))
    h = h.bitwiseXOR(F.shiftright(h, 16))
    return F.pmod(h, F.lit(modulus))


def mix_hash_sql(c: str, seed: int = 0, modulus: int = _M32) -> str:
    """The same hash as DuckDB SQL text."""
    def pm(x):
        return f"((({x}) % {_M32} + {_M32}) % {_M32})"
    h = pm(f"{pm(c)} + {(seed * _GOLD) % _M32}")
    for _ in range(2):
        h = pm(f"xor({h}, {h} >> 16) * {_MUL}")
    h = f"xor({h}, {h} >> 16)"
    return f"(({h}) % {modulus})"
