"""The pipeline's stages in a row against brute force on the smallest table."""

import corpus_pipeline
from tests.llm import test_decontaminate, test_linededup, test_packing, test_quality, test_simhash
from tests.llm.conftest import SF001, docs_of
from vitalframe.llm.queries import trusted_ids

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_run_against_brute_force(spark, sf001_docs):
    texts = {r.doc_id: r.text for r in sf001_docs.collect()}
    trusted = {r.doc_id for r in trusted_ids(spark, SF001).collect()}
    verdict = test_quality.brute(list(texts.items()), trusted)
    texts = {d: t for d, t in texts.items() if verdict[d][-1]}
    texts = {d: t for d, t, _, _ in test_linededup.brute(list(texts.items()))}
    docs = sorted(texts.items())
    comp = test_simhash.brute_components([test_simhash.brute_fp(t) for _, t in docs])
    texts = {d: t for i, (d, t) in enumerate(docs) if comp[i] == i}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()]
    dirty = {r[0] for r in test_decontaminate.brute(list(texts.items()), items) if r[-1]}
    texts = {d: t for d, t in texts.items() if d not in dirty}
    assert 0 < len(texts) < sf001_docs.count()
    test_packing.check(corpus_pipeline.run(spark, SF001).collect(), texts)


def test_stages_keep_columns_and_take_odd_rows(spark, tmp_path):
    good = "\n".join(" ".join(f"w{i}x{k}" for i in range(12)) for k in range(6))
    odd = docs_of(spark, [None, "", good, good, good + "\nend", "short"]).union(docs_of(spark, [good]).selectExpr("cast(null as long)", *COLUMNS[1:]))
    for table in ("labels", "benchmark"):
        spark.read.parquet(f"{SF001}/{table}.parquet").limit(0).write.parquet(f"{tmp_path}/{table}.parquet")
    odd.limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    docs, empty = odd, odd.limit(0)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs, empty = stage(spark, docs, str(tmp_path)), stage(spark, empty, str(tmp_path))
        assert docs.columns == COLUMNS and docs.schema["n_chars"].dataType.simpleString() == "bigint", name
        assert empty.count() == 0
    assert docs.count() >= 1
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_null_and_shared_ids_are_judged_row_by_row(spark, tmp_path):
    passage = " ".join(f"bench{i}" for i in range(20))
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    clean = [" ".join(f"{name}{i}" for i in range(40)) for name in "abcd"]
    rows = [(None, passage + " own"), (None, clean[0]), (5, passage), (5, clean[1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    left = corpus_pipeline.decontamination(spark, docs, str(tmp_path))
    assert left.columns == ["doc_id", "text"]
    assert sorted(r["text"] for r in left.collect()) == clean[:2]

    # 5 is the smallest of group b and a larger member of group a; c is a group of null ids only
    rows = [(1, clean[0]), (5, clean[0]), (5, clean[1]), (9, clean[1]), (None, clean[1]), (None, clean[2]), (None, clean[2]), (7, clean[3]), (7, clean[3])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    left = corpus_pipeline.near_dedup(spark, docs, str(tmp_path))
    assert sorted(((r["doc_id"], r["text"]) for r in left.collect()), key=str) == sorted(
        [(1, clean[0]), (5, clean[1]), (None, clean[2]), (7, clean[3])], key=str)


def test_rows_of_files_are_numbered_without_a_copy(spark, tmp_path):
    """A number belongs to a row, however the files are cut into tasks and whatever is filtered or projected."""
    from pyspark.sql import functions as F

    from vitalframe.llm.common import _files, numbered
    path = f"{tmp_path}/docs of %20 é"
    spark.range(5000).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), F.col("id").cast("string")).alias("text")).repartition(7).write.parquet(path)
    docs = spark.read.parquet(path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    reads = []
    for size in (before, "2000"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            rows, row = numbered(spark.read.parquet(path), "t")
            reads.append({r["doc_id"]: r[row] for r in rows.collect()})
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert reads[0] == reads[1] and len(set(reads[0].values())) == 5000
    part, row = numbered(docs.filter("doc_id % 7 = 3").select("text", "doc_id").withColumn("_row", F.lit(1)), "t")
    assert row == "__row" and part.columns == ["text", "doc_id", "_row", "__row"]
    assert {r["doc_id"]: r[row] for r in part.collect()} == {d: n for d, n in reads[0].items() if d % 7 == 3}
    for other in (docs.withColumn("k", F.explode(F.array(F.lit(1), F.lit(2)))), docs.union(docs), docs.join(docs.select("doc_id"), "doc_id"),
                  docs.filter(F.rand() < 0.5), docs.limit(10), docs_of(spark, ["a", "b"])):
        assert _files(other) == []
        rows, row = numbered(other, "t")
        assert len({r[row] for r in rows.select(row).collect()}) == rows.count()
    assert _files(docs.filter("doc_id > 3")) and _files(docs.limit(0)) == []


def test_long_texts_and_clashing_columns(spark, tmp_path):
    """A very long text, and extra columns named like the stages' own, in every stage."""
    for table in ("labels", "benchmark"):
        spark.read.parquet(f"{SF001}/{table}.parquet").limit(0).write.parquet(f"{tmp_path}/{table}.parquet")
    long = "\n".join(" ".join(f"word{i}of{k}" for i in range(20)) for k in range(20_000))
    docs = docs_of(spark, [long, long + " end", " ".join(f"x{i}" for i in range(60))])
    extra = ["_row", "row", "fp", "shard", "hits", "window", "component_id", "item"]
    for c in extra:
        docs = docs.selectExpr("*", f"concat('{c} ', doc_id) as {c}")
    docs.write.parquet(f"{tmp_path}/in")
    docs = spark.read.parquet(f"{tmp_path}/in")
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == [*COLUMNS, *extra], name
        out.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
    # the second text repeats the first one's lines but the last window, so line dedup leaves its end, and near dedup both
    left = {r["doc_id"]: r for r in docs.collect()}
    assert left[0]["text"] == long and all(r[c] == f"{c} {d}" for d, r in left.items() for c in extra)
    pieces = corpus_pipeline.pack(spark, docs, str(tmp_path)).filter("doc_id = 0").agg({"length": "sum", "doc_tokens": "max"}).first()
    assert pieces[0] == pieces[1] > 100_000
