import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.conftest import docs_of
from vitalframe.llm import packing, routing

TOKENIZER = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def ids_of(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids + [1]


def check(rows, texts):
    """Round trip: pieces give every document's ids once, and fill sequences without gaps."""
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_seq[r["sequence_id"]].append(r)
    assert sorted(by_doc) == sorted(texts)
    for d, pieces in by_doc.items():
        ids, at = ids_of(texts[d]), 0
        for r in sorted(pieces, key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            part = ids[at:at + r["length"]]
            assert r["ids"] == part and r["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())
            at += r["length"]
        assert at == len(ids)
    sizes = []
    for pieces in by_seq.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 2048
        sizes.append(at)
    return sizes


def test_round_trip_of_whole_table(spark, sf001_docs):
    rows = packing.pack(sf001_docs, with_ids=True).collect()
    sizes = check(rows, {r["doc_id"]: r["text"] for r in sf001_docs.collect()})
    assert sum(s < 2048 for s in sizes) <= sf001_docs.rdd.getNumPartitions()


def test_neighbours_share_windows(spark):
    topics = ["alpha beta gamma delta", "kilo lima mike november", "uniform victor whiskey xray"]
    texts = [topics[i % 3] + f" n{i} common words here" for i in range(30)]
    rows = packing.pack(docs_of(spark, texts).coalesce(1), window=128, with_ids=True).collect()
    order = [r["doc_id"] % 3 for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"]))]
    assert sum(a != b for a, b in zip(order, order[1:], strict=False)) <= 6


def test_edge_cases(spark):
    texts = [None, "", " \n ", "A", "It's d'or…, é ÷, H̱ <|endoftext|> x", "word " * 9000, "日本語、テスト。 Привет", "12ab34,5.6 'tis", "same", "same"]
    docs = docs_of(spark, texts).withColumn("start", F.lit(1)).withColumn("ids", F.lit("x")).coalesce(1)
    check(packing.pack(docs, with_ids=True).collect(), dict(enumerate(texts)))
    assert packing.pack(docs.limit(0)).count() == 0
    assert packing.pack(docs_of(spark, [None]).union(docs_of(spark, [None]))).count() == 2


ODD = ["\u0130", "\u0131", "\u0307", "\u0301", "\u00d7", "\u00f7", "\u00df", "\u0149", "\u01c5", "\u017f", "\u00e9", "e\u0301", "\ufb01", "\u4e2d\u6587", "\u0e01\u0e33",
       "\u0434\u0430", "\u05d0\u05b8", "\u0928\u093f", "\U0001f600\U0001f3fd", "\u200d", "\u200b", "\ufeff", "\u00ad", "\u00a0", "\u2003", "\u3000", "\u2028", "\u0085", "\t", "\n", "\x0b", "\x1c",
       "\x00", ".", ",", "!", "'", "'s", "'ll", "-", "(", ")", "<|endoftext|>", "</w>", "a", "Abc", "don't", "I", "9", "12345", "\u0664", "\u00b2", "\u00bd", "_", "\u2026", "\u201c", "\u20ac"]


def test_random_texts_of_odd_characters():
    """Pieces tokenized apart give the ids of the whole text, whatever the scripts, marks and separators."""
    rnd = random.Random(7)
    texts = ["".join(rnd.choice(ODD + [" "] * 10) for _ in range(rnd.randint(1, 12))) for _ in range(12_000)]
    encoder = packing.Encoder(None)
    for k in range(0, len(texts), 500):
        part = texts[k:k + 500]
        raw = [t.encode() for t in part]
        offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
        ids, first, _, _ = encoder.encode(np.frombuffer(b"".join(raw), np.uint8), offsets)
        for t, a, b in zip(part, first[:-1], first[1:], strict=True):
            assert ids[a:b].tolist() == ids_of(t), repr(t)


def test_scores_equal_plain_bm25(sf001_docs):
    """Every seed's scores over its shard, all its terms taken, against the formula written out; so the neighbours' order is BM25's."""
    texts = [r["text"] or "" for r in sf001_docs.orderBy("doc_id").collect()]
    raw = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    _, _, entries, owner = packing.Encoder(None).encode(np.frombuffer(b"".join(raw), np.uint8), offsets)
    index, n = packing.Neighbours(entries, owner, len(texts)), len(texts)
    tf = [Counter(entries[owner == d].tolist()) for d in range(n)]
    df = Counter(t for c in tf for t in c)
    mean = sum(sum(c.values()) for c in tf) / n
    idf = {t: math.log(1 + (n - k + 0.5) / (k + 0.5)) for t, k in df.items()}
    for seed in range(0, n, 3):
        plain = np.zeros(n)
        for d in range(n):
            size = sum(tf[d].values())
            plain[d] = sum(idf[t] * tf[d][t] * 2.2 / (tf[d][t] + 1.2 * (0.25 + 0.75 * size / mean)) for t in tf[seed] if df[t] > 1 and t in tf[d])
        assert np.allclose(index.scores(seed), plain, rtol=1e-9, atol=1e-9)
        first = [d for d, _ in zip(index.ranked(seed, np.arange(n) == seed), range(5), strict=False)]
        best = sorted((d for d in range(n) if d != seed and plain[d] > 0), key=lambda d: -plain[d])[:5]
        assert np.allclose(plain[first], plain[best], rtol=1e-9)


def filler(rnd, n):
    return " ".join(rnd.choice(["the", "of", "and", "water", "house", "river", "stone", "green", "light", "paper"]) + rnd.choice(["", "s", "ed"]) for _ in range(n))


def related(topics, members, words=40):
    """Documents of topics, each topic's members far apart: rare words shared within the topic, words of their own, common words."""
    rnd = random.Random(11)
    texts = []
    for m in range(members):
        for t in range(topics):
            letters = "".join(chr(97 + (t // 26 ** k) % 26) for k in range(3))
            own = " ".join(f"own{letters}{chr(97 + m)}{chr(97 + k)}" for k in range(6))
            texts.append(f"{filler(rnd, words)} quo{letters} {own} zim{letters} {filler(rnd, words)} vex{letters}")
    return texts


def test_related_documents_of_far_apart_files_share_windows(spark, tmp_path):
    topics, members = 400, 4
    texts = related(topics, members)
    path = str(tmp_path / "docs")
    docs_of(spark, texts).repartitionByRange(8, "doc_id").write.parquet(path)
    rows = packing.pack(spark.read.parquet(path), with_ids=True).collect()
    check(rows, dict(enumerate(texts)))
    windows = defaultdict(set)
    for r in rows:
        windows[r["doc_id"]].add(r["sequence_id"])
    together = sum(bool(windows[t + m * topics] & windows[t + k * topics]) for t in range(topics) for m in range(members) for k in range(m))
    assert together >= 0.8 * topics * members * (members - 1) / 2


def test_routes_take_the_rarest_shared_term_and_salt_hot_ones(spark, monkeypatch):
    texts = ["only here", "common pair one", "common pair two", "common three", None, ""] + ["common copy"] * 50
    rows = docs_of(spark, texts)
    monkeypatch.setattr(routing, "GROUP_DOCS", 10)
    stats = routing.corpus_stats(rows, packing._spans)
    assert (stats.n, stats.mean, int(stats.df.max())) == (56, (2 + 3 + 3 + 2 + 100) / 56, 53)
    found = {r["row"]: r for r in routing.routes(rows, "doc_id", packing._spans, stats).collect()}
    assert set(found) == {1, 2, 3, *range(6, 56)}
    assert found[1]["route"] == found[2]["route"] and found[1]["salt"] == found[2]["salt"] == 0
    assert len({found[d]["route"] for d in range(6, 56)}) == 1 and {found[d]["salt"] for d in range(6, 56)} == set(range(5))
    monkeypatch.setattr(routing, "RARE_DOCS", 40)
    monkeypatch.setattr(routing, "RARE_SHARE", 2)
    again = {r["row"] for r in routing.routes(rows, "doc_id", packing._spans, stats).collect()}
    assert again >= {1, 2}  # common words are named only by documents without rare ones


def test_index_weights_are_those_of_the_corpus(spark, sf001_docs):
    """Scores of a shard with corpus statistics against the formula with exact document frequencies of the whole table."""
    texts = [r["text"] or "" for r in sf001_docs.orderBy("doc_id").collect()]
    raw = [t.encode() for t in texts]
    encoder = packing.Encoder(None)
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    _, _, entries, owner = encoder.encode(np.frombuffer(b"".join(raw), np.uint8), offsets)
    tf = [Counter(entries[owner == d].tolist()) for d in range(len(texts))]
    df = Counter(t for c in tf for t in c)
    stats = routing.corpus_stats(sf001_docs, packing._spans)
    assert stats.n == len(texts) and math.isclose(stats.mean, len(entries) / len(texts))
    exact = np.array([stats.df[routing.bin_of(encoder.hash[[t]])[0]] - k for t, k in df.items()])
    assert (exact >= 0).all() and (exact == 0).mean() > 0.95  # bins are rarely shared by words of a small table
    part = owner < 20
    idf = stats.idf()
    index = packing.Neighbours(entries[part], owner[part], 20, lambda e: idf[routing.bin_of(encoder.hash[e])], stats.mean)
    plain = np.zeros(20)
    held = Counter(t for c in tf[:20] for t in c)
    for d in range(20):
        size = sum(tf[d].values())
        for t in tf[0]:
            if held[t] > 1 and t in tf[d]:
                weight = idf[routing.bin_of(encoder.hash[[t]])[0]]
                plain[d] += weight * tf[d][t] * 2.2 / (tf[d][t] + 1.2 * (0.25 + 0.75 * size / stats.mean))
    assert np.allclose(index.scores(0), plain, rtol=1e-6)
