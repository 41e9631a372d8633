import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import DOCS, docs_of
from vitalframe.llm import alignment
from vitalframe.llm.common import blocks

FIELDS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.fixture(scope="module")
def encoders():
    import sentencepiece
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    # the usual table of byte-level vocabularies, worked out from the vocabulary's own single-character entries
    chars = sorted((c for c in a.get_vocab() if len(c) == 1), key=ord)
    own = [c for c in chars if ord(c) < 256]
    rest = [x for x in range(256) if x not in set(map(ord, own))]
    table = {c: ord(c) for c in own} | dict(zip([c for c in chars if ord(c) > 255], rest, strict=True))
    return a, b, table


def plain_groups(text, encoders):
    """[(ids of A, ids of B)] of one text, both tokenizers over the whole text."""
    a, b, table = encoders
    if not text:
        return []
    whole = (" " + text).encode()
    x = [(i, bytes(table[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
    y = [(i, bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()) for i, p in ((i, b.id_to_piece(i)) for i in b.encode(text))]
    if b"".join(t for _, t in x) != whole or b"".join(t for _, t in y) != whole:
        return []
    groups, i, j = [], 0, 0
    while i < len(x):
        ga, gb, ea, eb = [x[i][0]], [y[j][0]], len(x[i][1]), len(y[j][1])
        i, j = i + 1, j + 1
        while ea != eb:
            if ea < eb:
                ga.append(x[i][0])
                ea, i = ea + len(x[i][1]), i + 1
            else:
                gb.append(y[j][0])
                eb, j = eb + len(y[j][1]), j + 1
        groups.append((ga, gb))
    return groups


def plain(rows, encoders):
    groups = [plain_groups(t, encoders) for _, t in rows]
    counts = Counter(p for g in groups for p in {(i, j) for ga, gb in g for i in ga for j in gb})
    highest = defaultdict(int)
    for (i, _), n in counts.items():
        highest[i] = max(highest[i], n)
    out = []
    for (doc_id, _), g in zip(rows, groups, strict=True):
        links = Counter((i, j) for ga, gb in g for i in ga for j in gb)
        text = ";".join(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)) for ga, gb in g)
        out.append((doc_id, sum(len(ga) for ga, _ in g), sum(len(gb) for _, gb in g), len(g), sum(links.values()),
                    sum(n for p, n in links.items() if counts[p] == highest[p[0]]), sum(n * counts[p] for p, n in links.items()),
                    hashlib.sha256(text.encode()).hexdigest() if g else ""))
    return out


def by_id(rows):
    return sorted(map(tuple, rows), key=lambda r: (r[0] is None, r[0] or 0, r[1:]))


def test_whole_table(spark, sf001_docs, encoders):
    rows = [(r["doc_id"], r["text"]) for r in sf001_docs.collect()]
    found = alignment.align(sf001_docs).select("doc_id", *FIELDS).collect()
    assert by_id(found) == by_id(plain(rows, encoders))
    assert sum(r["n_links"] > 0 for r in found) > 0.9 * len(found)


ODD = ["", " ", "  ", " ", " ", "　", "\u0085", " ", " ", " ", " ", "​", "\t", "\n", "\r\n", "\x0b", "\x00", "\x1c",
       "▁", "a", "Zz9", "'s", "'", "don't", "<|endoftext|>", "</s>", "<s>", "<unk>", "<0x41>", "é", "é", "́", "İ", "ﬁ",
       "中文", "\U0001f600\U0001f3fd", "‍", "กำ", "aaaaaaaaaa", "....", "---", "12345", "­", "﻿"]


def test_random_texts_of_odd_characters(encoders):
    """Splitting into words never changes what the tokenizers make of a whole text."""
    rnd = random.Random(5)
    texts = ["".join(rnd.choice(ODD + [" "] * 12) for _ in range(rnd.randint(1, 14))) for _ in range(6000)]
    tokenizers = alignment.Tokenizers(None, None)
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"])
    digests, groups = [], []
    for block in blocks(iter([batch]), 20_000):
        x = alignment.Alignment(block, tokenizers)
        digests += x.group_digests()
        groups += x.measures()["n_groups"].tolist()
    for text, digest, n in zip(texts, digests, groups, strict=True):
        g = plain_groups(text, encoders)
        whole = ";".join(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)) for ga, gb in g)
        assert (n, digest) == (len(g), hashlib.sha256(whole.encode()).hexdigest() if g else ""), repr(text)


def test_edge_cases(spark, encoders, monkeypatch):
    texts = [None, "", " ", "a", "a ", " a", "a  b\n\nc", "x▁y", "été café", "the same text"] + ["the same text"] * 30
    texts += ["=" * 5000, "漢字" * 900, "word " * 40_000, "the cat", "the cat", "The Cat"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "the cat"), (None, None), (3, "another text of id 3"), (3, "another text of id 3")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], DOCS)
    for name in ("key", "copies", "n_a", "block", "pairs", "value"):
        docs = docs.withColumn(name, F.lit("x"))
    expected = by_id(plain(rows, encoders))
    assert by_id(alignment.align(docs).select("doc_id", *FIELDS).collect()) == expected
    monkeypatch.setattr(alignment, "HOT", 2)  # hardly a text is hot
    assert by_id(alignment.align(docs.repartition(6)).select("doc_id", *FIELDS).collect()) == expected


def test_empty_table(spark):
    out = alignment.align(docs_of(spark, []))
    assert out.collect() == [] and out.columns == ["doc_id", *FIELDS]


def test_wide_groups_pair_distinct_tokens():
    rng = np.random.default_rng(2)
    a, b = rng.integers(0, 5, 300), rng.integers(0, 7, 200)
    pairs, times = alignment.wide_pairs(a, b)
    expected = Counter((x, y) for x in a.tolist() for y in b.tolist())
    assert {(p >> alignment.B_BITS, p & (2**alignment.B_BITS - 1)): n for p, n in zip(pairs.tolist(), times.tolist(), strict=True)} == dict(expected)
