"""SimHash near-dedup by deletion-variant signatures.

Fingerprints have 64 bits and link at two or fewer differing bits. Cut into
two halves, one half of a linked pair differs by at most one bit, so the pair
shares a variant of that half with one bit left out (a wildcard). The other
half then differs by at most one bit as well (or by at most two where the
first half is equal), so one of its equal-length pieces is equal: the piece is
added to the variant, which keeps the buckets of the equality join short at any
number of documents. Members of a bucket are compared in its sorted run; a run
of many members looks its one-bit neighbours up instead, so the work of a
bucket does not grow with its square.

Documents of equal fingerprint are one node; components are found over nodes
by alternating minimum steps, each written to the shared folder.

Defined cases: a null or empty text, or one without a word, has fingerprint
zero and links like any other. Repeated rows have equal fingerprints and one
component. A null doc_id is never the smallest, unless its component has no
other. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalframe.llm.common import numbered, staged

SHINGLE = 3
MAX_BITS = 2
HALF = 32
# runs of more members than this look neighbours up
LONG_RUN = 64
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """A bit is set if it is set in over half of the shingles' XXH64 (seed 42)."""
    words = (text or b"").translate(_LOWER).split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.append(np.flatnonzero(np.frombuffer(line, np.uint8) == 32), len(line))
    k = min(shingle, len(words))
    starts = np.concatenate([[0], ends[:-1] + 1])[:len(words) - k + 1]
    digest = xxhash.xxh64_digest
    raw = b"".join([digest(line[a:b], 42) for a, b in zip(starts.tolist(), ends[k - 1:].tolist(), strict=True)])
    h = np.frombuffer(raw, np.uint8).reshape(-1, 8)
    set_bits = np.zeros(64, np.int64)
    for at in range(0, len(h), 255):  # sums of at most 255 bits fit in a byte
        set_bits += np.add.reduce(np.unpackbits(h[at:at + 255], axis=1), axis=0, dtype=np.uint8)
    return int(np.packbits(2 * set_bits > len(h)).view(">u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed long of the same bits."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            fp = np.fromiter((fingerprint(x.as_py(), shingle) for x in texts), np.uint64, len(texts))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp.view(np.int64))], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, fp long")


def _pieces(bits: int, n: int) -> list[tuple[int, int]]:
    edge = [round(i * bits / n) for i in range(n + 1)]
    return [(edge[i], edge[i + 1] - edge[i]) for i in range(n)]


def _masks() -> np.ndarray:
    """The variants: the bits each keeps. Any two values within two bits agree on all bits of some variant."""
    full, out = (1 << HALF) - 1, []
    for half in range(2):
        low, other = half * HALF, (1 - half) * HALF
        for wild in range(HALF):  # one bit of this half left out, one of two pieces of the other half kept
            out += [(full << low) & ~(1 << (low + wild)) | (((1 << width) - 1) << (other + at)) for at, width in _pieces(HALF, 2)]
        # this half whole, one of three pieces of the other
        out += [(full << low) | (((1 << width) - 1) << (other + at)) for at, width in _pieces(HALF, 3)]
    return np.array(out, np.uint64)


MASKS = _masks()
_SALT = (np.arange(len(MASKS), dtype=np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)


def _first_variant(apart: np.ndarray) -> np.ndarray:
    """Number of the first variant that leaves out all the given differing bits."""
    out = np.full(len(apart), -1)
    for v in range(len(MASKS) - 1, -1, -1):
        out[(apart & MASKS[v]) == 0] = v
    return out


def _bits_apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b)


def _run_links(key: np.ndarray, fp: np.ndarray):
    """Verified pairs of equal key; key and fp sorted by (key, fp), pairs of key and fp distinct."""
    border = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1], [True]]))
    size = np.diff(border)
    left, right, keys = [], [], []
    length = np.repeat(size, size)
    at = np.flatnonzero((length > 1) & (length <= LONG_RUN))
    step = 1
    while len(at):
        at = at[at + step < len(key)]
        at = at[key[at] == key[at + step]]
        near = at[_bits_apart(fp[at], fp[at + step]) <= MAX_BITS]
        left.append(fp[near])
        right.append(fp[near + step])
        keys.append(key[near])
        step += 1
    flips = [1 << i for i in range(64)]
    for a, n in zip(border[:-1][size > LONG_RUN], size[size > LONG_RUN], strict=True):
        run = fp[a:a + n]
        free = int(np.bitwise_or.reduce(run ^ run[0]))  # only bits that vary in the run can differ
        bits = [np.uint64(f) for f in flips if f & free]
        steps = bits + [x ^ y for i, x in enumerate(bits) for y in bits[:i]]
        for s in steps:
            to = run ^ s
            there = np.minimum(np.searchsorted(run, to), n - 1)
            hit = (run[there] == to) & (run < to)
            left.append(run[hit])
            right.append(to[hit])
            keys.append(np.full(int(hit.sum()), key[a]))
    if not left:
        none = np.zeros(0, np.uint64)
        return none, none
    a, b, keys = np.concatenate(left), np.concatenate(right), np.concatenate(keys)
    first = _first_variant(a ^ b)  # a pair meets in many variants; only its first one reports it
    own = (first >= 0) & (((a & MASKS[first]) ^ _SALT[first]) == keys)
    return a[own], b[own]


def links(nodes: DataFrame) -> DataFrame:
    """(a, b): verified links between the distinct fingerprints in column ``fp``; a pair may come more than once."""
    def signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column(0).to_numpy().view(np.uint64)
            for mask, salt in zip(MASKS, _SALT, strict=True):
                key = (fp & mask) ^ salt
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(fp.view(np.int64))], ["key", "fp"])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tail_key, tail_fp = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            key = np.concatenate([tail_key, batch.column(0).to_numpy()])
            fp = np.concatenate([tail_fp, batch.column(1).to_numpy()])
            last = int(np.searchsorted(key, key[-1])) if len(key) else 0  # the last run may go on in the next batch
            tail_key, tail_fp = key[last:], fp[last:]
            if last:
                yield pairs(key[:last], fp[:last])
        if len(tail_key):
            yield pairs(tail_key, tail_fp)

    def pairs(key, fp):
        order = np.lexsort((fp.view(np.uint64), key))
        a, b = _run_links(key.view(np.uint64)[order], fp.view(np.uint64)[order])
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    keyed = nodes.select("fp").mapInArrow(signatures, "key long, fp long")
    return keyed.repartition("key").sortWithinPartitions("key").mapInArrow(verify, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable from each node that has an edge.

    Alternating large-star and small-star steps over the edges, each staged,
    until nothing changes; a step sends one row per edge, so no node's
    neighbours are gathered in one place."""
    def star(e: DataFrame, large: bool) -> DataFrame:
        if large:
            both = e.union(e.select("v", "u"))
            least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
            return (both.filter(F.col("v") > F.col("u")).join(least, "u")
                    .select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct())
        down = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        linked = down.join(least, "u")
        return (linked.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
                .union(least.select("u", F.col("m").alias("v"))).distinct())

    now = staged(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), "edges")
    seen = None
    while True:
        now = staged(star(star(now, True), False), "edges")
        state = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if state == seen:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = state


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row of ``docs``."""
    prints = staged(fingerprints(docs, shingle), "fingerprints")
    nodes = staged(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    root = components(links(nodes))
    named = nodes.join(root, nodes["fp"] == root["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    smallest = named.groupBy("root").agg(F.min("least").alias("component_id"))
    member = staged(named.join(smallest, "root").select("fp", "component_id"), "components")
    return prints.join(member, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, by_row: bool = False) -> DataFrame:
    """The rows of ``docs`` (all columns) that stand for their component: the one with the smallest doc_id (a null
    one comes last), then the smallest row number, and rows of its doc_id and fingerprint; with ``by_row`` it alone."""
    rows, row = numbered(docs, "near_dedup")
    found = near_duplicates(rows.select(F.col(row).alias("doc_id"), "text"), shingle).withColumnRenamed("doc_id", "row")
    ids = rows.select(F.col(row).alias("row"), F.col("doc_id").cast("long").alias("doc_id"))
    member = found.join(ids, "row")
    one = member.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row", "fingerprint")).alias("one"))
    if by_row:
        kept = one.select("one.row")
    else:
        same = (F.col("doc_id") == F.col("one.doc_id")) & (F.col("fingerprint") == F.col("one.fingerprint"))
        kept = member.join(one, "component_id").filter((F.col("row") == F.col("one.row")) | same).select("row")
    return rows.join(kept.select(F.col("row").alias(row)), row, "left_semi").select(*(rows[c] for c in docs.columns))
