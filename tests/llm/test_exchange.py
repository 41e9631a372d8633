import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import docs_of
from vitalframe.llm import exchange, lm, substring

LIMIT = "spark.sql.execution.arrow.maxRecordsPerBatch"


def most_in_a_batch(df):
    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["n"])
    return max(r.n for r in df.mapInArrow(run, "n long").collect())


def test_long_rows_come_in_small_batches(spark):
    long = spark.range(40, numPartitions=1).select(F.repeat(F.lit("x"), 1 << 20).alias("text"))
    with exchange.small_batches(spark):
        assert most_in_a_batch(long) < 2 * exchange.ARROW_BYTES
    assert spark.conf.get(exchange._BATCH, None) is None
    spark.conf.set(exchange._BATCH, "99000000")
    try:
        with exchange.small_batches(spark):
            pass
        assert spark.conf.get(exchange._BATCH) == "99000000"
    finally:
        spark.conf.unset(exchange._BATCH)


@pytest.mark.parametrize("module, result, name", [(lm, lm.score, "lm-scores"), (substring, substring.remove_repeats, "cut")])
def test_results_are_made_with_small_batches(spark, monkeypatch, module, result, name):
    names = []

    def seen(df, name="stage", *more, f=exchange.staged):
        names.append((name, df.sparkSession.conf.get(exchange._BATCH, None)))
        return f(df, name, *more)
    for m in (exchange, module):
        monkeypatch.setattr(m, "staged", seen)
    assert result(docs_of(spark, ["a b", "a", None])).count() == 3
    assert name in [n for n, _ in names] and {v for _, v in names} == {str(exchange.ARROW_BYTES)}


def test_blocks_are_read_one_by_one(spark):
    docs = docs_of(spark, [f"{i} " * 150_000 for i in range(30)]).coalesce(1)
    stored = exchange.store_blocks(docs, "b")
    assert stored.count() > 3
    for f in stored.inputFiles():
        found = pq.ParquetFile(f.removeprefix("file://")).metadata
        assert found.num_row_groups == found.num_rows


def test_blocks_are_filled_from_many_batches(spark, monkeypatch):
    texts = [None if i % 7 == 0 else f"{i} " * (i % 50) for i in range(200)]
    docs = docs_of(spark, texts).coalesce(1)
    spark.conf.set(LIMIT, "10")
    try:
        rows = exchange.store_blocks(docs, "b", lambda ids: np.array([d % 2 for d in ids], np.int32)).collect()
    finally:
        spark.conf.unset(LIMIT)
    assert sorted(r.part for r in rows) == [0, 1] and len({r.block for r in rows}) == 2
    found = {}
    for r in rows:
        b = exchange.read_block(r.asDict())
        assert r.size == len(b.buf) and all(d % 2 == r.part for d in r.doc_ids)
        found |= {d: b.bytes_of(i).decode() for i, d in enumerate(r.doc_ids)}
    assert found == {i: t or "" for i, t in enumerate(texts)}
    empty = exchange.store_blocks(spark.range(exchange.STORED_DOCS + 5).select(F.col("id").alias("doc_id"), F.lit(None).cast("string").alias("text")).coalesce(1), "b")
    assert sorted(len(r.doc_ids) for r in empty.collect()) == [5, exchange.STORED_DOCS] and exchange.stored_bytes(empty) == 0
