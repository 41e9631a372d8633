"""Line dedup: windows of three consecutive lines, repeated windows found over the whole corpus.

Lines are the pieces of a text between newlines. Every three consecutive lines
of a document, at least one of them with a word, form a window. The first
occurrence of a window is the one with the smallest (doc_id, text hash, line
number); every later occurrence is removed: the lines it covers, merged over
all later windows of the row, go. Windows are judged on the input, not on what is
left. Equal windows are found by a 128-bit digest of the three lines with
their lengths, so that no other lines give the same key.

Defined cases: a null text stays null and has no lines; an empty text has one
empty line; a text of fewer than three lines has no window and stays whole.
Rows of equal doc_id and text count as one document for the order of
occurrences, so rows repeated whole do not remove each other's lines; rows of
one doc_id with different texts are different documents, and so is every row
with a null doc_id, which comes before every other. Rows are cut one by one, by
a row number in a staged copy. Other columns keep their values, whatever their
names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalframe.llm.common import numbered

WIDTH = 3


def _window_key(lines: Column, at: Column, width: int) -> Column:
    parts = []
    for k in range(width):
        line = F.get(lines, at + F.lit(k))
        parts += [F.length(line).cast("string"), line]
    return F.unhex(F.md5(F.concat_ws("\n", *parts)))


def line_windows(docs: DataFrame, row: str, width: int = WIDTH) -> DataFrame:
    """(row, occurrence, window): the key of each window that holds a word, by its row and its place in the order of occurrences."""
    null = F.col("doc_id").isNull()
    lines = docs.select(F.col(row).alias("row"), "doc_id", F.xxhash64("text").alias("text_hash"),
                        F.when(null, F.col(row)).alias("null_row"),
                        F.split("text", "\n").alias("lines")).filter(F.size("lines") >= width)

    def window(i: Column) -> Column:
        text = F.concat(*(F.get("lines", i + F.lit(k)) for k in range(width)))
        return F.when(text.rlike(r"[^\x20\x09-\x0D]"), F.struct(i.alias("at"), _window_key(F.col("lines"), i, width).alias("window")))

    windows = F.transform(F.sequence(F.lit(0), F.size("lines") - F.lit(width)), window)
    w = lines.select("row", "doc_id", "text_hash", "null_row", F.explode(windows).alias("w")).filter(F.col("w").isNotNull())
    return w.select("row", F.struct("doc_id", "text_hash", "null_row", "w.at").alias("occurrence"), "w.window")


def later_lines(docs: DataFrame, row: str, width: int = WIDTH) -> DataFrame:
    """(row, covered): per row the merged, sorted line numbers of its later occurrences.

    Windows are first summed up per key, map side first, so a very common window is one row;
    only keys that occur again are joined back, and that join's hot keys can be split."""
    w = line_windows(docs, row, width)
    first = (w.groupBy("window").agg(F.min("occurrence").alias("first"), F.count("*").alias("n"))
             .filter("n > 1").select("window", "first"))
    again = w.join(first, "window").filter(~F.col("occurrence").eqNullSafe(F.col("first")))
    reach = F.array_distinct(F.flatten(F.collect_list(F.sequence("occurrence.at", F.col("occurrence.at") + F.lit(width - 1)))))
    return again.groupBy("row").agg(F.sort_array(reach).alias("covered"))


def dedup_lines(docs: DataFrame, width: int = WIDTH, counts: bool = False) -> DataFrame:
    """``docs`` with later occurrences cut from ``text``; with ``counts`` also n_lines and n_removed."""
    columns = docs.columns
    docs, row = numbered(docs, "lines")
    cover = later_lines(docs, row, width).select(F.col("row").alias(f"{row}_cut"), F.col("covered").alias(f"{row}_covered"))
    both = docs.join(cover, docs[row] == cover[f"{row}_cut"], "left")
    covered = cover[f"{row}_covered"]
    lines = F.split(docs["text"], "\n")
    numbers = F.sequence(F.lit(0), F.size(lines) - F.lit(1))
    left = F.transform(F.array_except(numbers, covered), lambda i: F.get(lines, i))
    text = F.when(covered.isNull() | docs["text"].isNull(), docs["text"]).otherwise(F.array_join(left, "\n"))
    out = [text.alias("text") if c == "text" else docs[c] for c in columns]
    if counts:
        out += [F.when(docs["text"].isNull(), 0).otherwise(F.size(lines)).cast("long").alias("n_lines"),
                F.when(docs["text"].isNull(), 0).otherwise(F.coalesce(F.size(covered), F.lit(0))).cast("long").alias("n_removed")]
    return both.select(*out)
