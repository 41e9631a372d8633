from pyspark.sql import functions as F

from tests.llm.conftest import docs_of
from vitalframe.llm import linededup


def brute(docs, width=3):
    first, where = {}, []
    for d, t in docs:
        lines = [] if t is None else t.split("\n")
        for k in range(len(lines) - width + 1):
            w = tuple(lines[k:k + width])
            if any(x.strip(" \t\n\x0b\x0c\r") for x in w):
                where.append((d, k, w))
                rank = (d is not None, d or 0, k)
                first[w] = min(first.get(w, rank), rank)
    gone = {}
    for d, k, w in where:
        if first[w] != (d is not None, d or 0, k):
            gone.setdefault(d, set()).update(range(k, k + width))
    out = []
    for d, t in docs:
        lines = [] if t is None else t.split("\n")
        kept = [x for i, x in enumerate(lines) if i not in gone.get(d, ())]
        out.append((d, t if t is None else "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=str)


def got(df):
    return sorted(((r["doc_id"], r["text"], r["n_lines"], r["n_removed"]) for r in df.collect()), key=str)


def test_whole_table_against_brute_force(spark, sf001_docs):
    want = brute([(r.doc_id, r.text) for r in sf001_docs.collect()])
    assert got(linededup.dedup_lines(sf001_docs, counts=True)) == want
    assert any(r[3] for r in want)


def test_edge_cases(spark):
    block = "first line\nsecond line\nthird line"
    texts = [None, "", "\n\n\n\n", "a", "a\nb", block, "x\n" + block + "\ny", block + "\n" + block, "a\na\na\na\na", "1\n23\n4", "12\n3\n4", "q\n" * 3000,
             "first line\nsecond line \nthird line", " \n" + block]
    docs = docs_of(spark, texts).withColumn("window", F.lit(1)).withColumn("at", F.lit("x")).withColumn("covered", F.lit(2)).withColumn("lines", F.lit(0))
    out = linededup.dedup_lines(docs, counts=True)
    assert got(out) == brute(list(enumerate(texts)))
    assert linededup.dedup_lines(docs).columns == docs.columns
    twice = linededup.dedup_lines(docs.union(docs), counts=True)
    assert got(twice) == sorted(brute(list(enumerate(texts))) * 2, key=str)
    nulls = docs.limit(0).union(docs.filter("doc_id = 5").withColumn("doc_id", F.lit(None).cast("long"))).union(docs.filter("doc_id = 6"))
    assert got(linededup.dedup_lines(nulls, counts=True)) == brute([(None, block), (6, texts[6])])
    assert linededup.dedup_lines(docs.limit(0)).count() == 0


def test_rows_of_one_id_are_cut_one_by_one(spark):
    def own(name):
        return [f"{name} {i}" for i in range(12)]

    shared = ["first line", "second line", "third line"]
    a, b = own("a")[:9] + shared, own("b")
    keeper = "\n".join(shared)
    for doc_id in (7, None):
        rows = [(None if doc_id is None else 1, keeper), (doc_id, "\n".join(a)), (doc_id, "\n".join(b)), (doc_id, "\n".join(own("c")))]
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
        out = sorted(r["text"] for r in linededup.dedup_lines(docs, counts=True).collect())
        whole = [t for _, t in rows[2:]]
        assert [t for t in out if t in whole] == sorted(whole)  # lines that occur once stay
        assert "\n".join(out).count(keeper) == 1  # of the repeated window one occurrence stays


def test_repeats_at_the_same_line_are_cut_between_rows_of_one_id(spark):
    shared = "first line\nsecond line\nthird line"
    for doc_id in (7, None):
        docs = spark.createDataFrame([(doc_id, shared + f"\nend {i}") for i in range(4)], "doc_id long, text string").repartition(2)
        out = [(r["text"], r["n_removed"]) for r in linededup.dedup_lines(docs, counts=True).collect()]
        assert sorted(n for _, n in out) == [0, 3, 3, 3] and sum(shared in t for t, _ in out) == 1
    copies = linededup.dedup_lines(spark.createDataFrame([(None, shared)] * 3, "doc_id long, text string"), counts=True)
    assert sorted(r["n_removed"] for r in copies.collect()) == [0, 3, 3]
