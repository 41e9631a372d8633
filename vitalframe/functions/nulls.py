"""Missing-value rules that differ between R and Spark, encoded once.

* ``ifelse(NA, a, b)`` is NA in R but ``b`` for a Spark ``when`` chain.
* base ``grepl(NA)`` is FALSE while ``str_detect(NA)`` is NA.
* ``x %in% s`` is never NA.
* ``paste(1, NA)`` gives ``"1_NA"``; ``concat_ws`` would drop the NULL.
* 0/0 is NaN in R; plain ``/`` raises under ANSI mode, so divisions are
  ``try_divide`` (NULL on a zero divisor).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def r_ifelse(cond: Column, yes, no) -> Column:
    """R ``ifelse``: a NULL condition yields NULL."""
    yes = yes if isinstance(yes, Column) else F.lit(yes)
    no = no if isinstance(no, Column) else F.lit(no)
    return F.when(cond.isNull(), F.lit(None)).when(cond, yes).otherwise(no)


def str_detect(c: ColumnOrName, pattern: str) -> Column:
    """stringr ``str_detect``: NULL in, NULL out (a filter then drops the row)."""
    return col(c).rlike(pattern)


def grepl(c: ColumnOrName, pattern: str) -> Column:
    """base ``grepl``: NULL input counts as no match."""
    return F.coalesce(col(c).rlike(pattern), F.lit(False))


def in_set(c: ColumnOrName, values: Iterable) -> Column:
    """``%in%``: never NULL."""
    return F.coalesce(col(c).isin(list(values)), F.lit(False))


def r_paste(*cols: ColumnOrName, sep: str = "_") -> Column:
    """R ``paste``: NULL parts print as ``NA``."""
    parts = []
    for i, c in enumerate(cols):
        if i:
            parts.append(F.lit(sep))
        parts.append(F.coalesce(col(c).cast("string"), F.lit("NA")))
    return F.concat(*parts)


def safe_div(a: ColumnOrName, b: ColumnOrName) -> Column:
    """Division that yields NULL for a zero or NULL divisor (R would give NaN/Inf)."""
    return F.try_divide(col(a), col(b))


def nan_to_null(c: ColumnOrName) -> Column:
    """Spark aggregates propagate NaN; R's ``na.rm`` skips it. Map NaN to NULL at ingest."""
    return F.nanvl(col(c), F.lit(None).cast("double"))
