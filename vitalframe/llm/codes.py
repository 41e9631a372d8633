"""Vector code compression: product codes whose codebooks are searched with Orchard's method.

A vector is cut into equal parts; each part position has a codebook and a part
is coded as the number of its nearest entry. All arithmetic is on integers
(components times 256, rounded down), so results do not depend on the order of
summation or on the number of tasks.

Orchard search: every entry has a list of all other entries by rising distance
from it. A query starts at some entry and walks along that entry's list; when it
meets a nearer entry it jumps to the start of that one's list, entries met before
are marked and not measured again, and it stops where the list's distance is more
than twice the distance to the present entry, because by the triangle inequality
nothing behind can be nearer. The result is the exact nearest entry, ties by the
lower index. Many queries walk at once as numpy arrays.

Codebooks (parts x entries, whatever the number of vectors) are on the driver
and in tasks; a round sends one sum and count per part and entry and task, and
the vectors themselves are never shuffled.

Defined cases: a vector that is null or holds a null or non-finite component is
dropped; a shorter vector is filled up with zeros to the longest one's length,
which is rounded up to whole parts; with fewer vectors than entries codebooks are
that much smaller. Components beyond +-2^26 count as that, so that squared
distances fit into a long. Rows of one vec_id are ordered by vector, those of a
null vec_id come last; repeated rows are coded one by one, and equal entries get
the lower index. Null labels are one group. An empty table gives no rows. Other
columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitalframe.llm.common import staged

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
LIMIT = 1 << 26
# queries (vectors x parts) that walk together
TOGETHER = 1 << 16


def integers(x: np.ndarray) -> np.ndarray:
    """floor(256 * x) as long."""
    return np.clip(np.floor(x.astype(np.float64) * SCALE), -LIMIT, LIMIT).astype(np.int64)


@dataclass
class Codebooks:
    """Entries (parts x entries x width) and, for Orchard search, every entry's list of the others."""
    entries: np.ndarray
    near: np.ndarray = field(init=False)  # parts x entries x (entries - 1): the others by rising distance
    far: np.ndarray = field(init=False)   # their squared distances

    def __post_init__(self):
        gap = ((self.entries[:, :, None, :] - self.entries[:, None, :, :]) ** 2).sum(axis=3)
        n = gap.shape[1]
        gap[:, np.arange(n), np.arange(n)] = -1  # an entry heads its own list, and is cut off
        order = np.argsort(gap, axis=2, kind="stable")
        self.near = order[:, :, 1:].astype(np.int32)
        self.far = np.take_along_axis(gap, order, axis=2)[:, :, 1:]

    @property
    def shape(self) -> tuple[int, int, int]:
        return self.entries.shape

    def nearest(self, parts: np.ndarray, measured: list | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(index, squared distance) of the nearest entry to each of ``parts`` (vectors x parts x width).
        ``measured`` collects how many distances were worked out."""
        p, n, width = self.shape
        found, least = np.empty(parts.shape[:2], np.int64), np.empty(parts.shape[:2], np.int64)
        step = max(TOGETHER // p, 1)
        for a in range(0, len(parts), step):
            block = parts[a:a + step]
            x, y = self._walk(block.reshape(-1, width), np.tile(np.arange(p), len(block)), measured)
            found[a:a + step], least[a:a + step] = x.reshape(-1, p), y.reshape(-1, p)
        return found, least

    def _walk(self, q: np.ndarray, part: np.ndarray, measured: list | None):
        n, m = self.shape[1], len(q)
        at = np.zeros(m, np.int64)                          # present entry
        best = ((q - self.entries[part, 0]) ** 2).sum(axis=1)
        place = np.zeros(m, np.int64)                       # in the present entry's list
        marked = np.zeros((m, n), bool)
        marked[:, 0] = True
        go = np.arange(m if n > 1 else 0)
        while len(go):
            p, c, k = part[go], at[go], place[go]
            go = go[self.far[p, c, k] <= 4 * best[go]]      # list distance above twice the present one: done
            p, c, k = part[go], at[go], place[go]
            other = self.near[p, c, k]
            place[go] += 1
            new = ~marked[go, other]
            look, other = go[new], other[new]
            marked[look, other] = True
            d = ((q[look] - self.entries[part[look], other]) ** 2).sum(axis=1)
            better = (d < best[look]) | ((d == best[look]) & (other < at[look]))
            jump = look[better]
            at[jump], best[jump], place[jump] = other[better], d[better], 0
            go = go[place[go] < n - 1]
            if measured is not None:
                measured.append(len(look))
        return at, best

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def kept_vectors(batch: pa.RecordBatch, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(mask of the batch's vectors that are whole, their integer components filled up to ``width``)."""
    col = batch.column(batch.schema.get_field_index("embedding"))
    length = pc.fill_null(pc.list_value_length(col), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = col.flatten()
    x = flat.to_numpy(zero_copy_only=False).astype(np.float64)  # nulls become NaN
    owner = np.repeat(np.arange(len(col)), length)
    keep = col.is_valid().to_numpy(zero_copy_only=False).copy()
    keep[owner[~np.isfinite(x)]] = False
    inside = keep[owner]
    out = np.zeros((int(keep.sum()), width), np.int64)
    row = (np.cumsum(keep) - 1)[owner[inside]]
    spot = (np.arange(len(x)) - np.repeat(np.cumsum(length) - length, length))[inside]
    out[row, spot] = integers(x[inside])
    return keep, out


def start(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES) -> Codebooks | None:
    """Codebooks made of the vectors with the smallest ids; None if there is none."""
    whole = F.col("embedding").isNotNull() & F.forall("embedding", lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    kept = vectors.select("vec_id", "embedding").filter(whole)
    longest = kept.agg(F.max(F.size("embedding"))).first()[0]
    if longest is None:
        return None
    width = max(-(-longest // parts), 1)
    first = kept.orderBy(F.col("vec_id").asc_nulls_last(), "embedding").limit(entries).collect()  # one row per entry
    x = np.zeros((len(first), parts * width), np.int64)
    for i, r in enumerate(first):
        x[i, :len(r["embedding"])] = integers(np.array(r["embedding"], np.float64))
    return Codebooks(np.ascontiguousarray(x.reshape(len(first), parts, width).transpose(1, 0, 2)))


def improved(vectors: DataFrame, books: Codebooks) -> Codebooks:
    """Every entry replaced by its parts' mean, rounded down; unused entries stay."""
    p, n, width = books.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros((p * n, width), np.int64), np.zeros(p * n, np.int64)
        for batch in batches:
            parts = kept_vectors(batch, p * width)[1].reshape(-1, p, width)
            slot = (books.nearest(parts)[0] + np.arange(p) * n).ravel()
            np.add.at(total, slot, parts.reshape(-1, width))
            count += np.bincount(slot, minlength=p * n)
        used = np.flatnonzero(count)
        values = np.concatenate([total[used], count[used, None]], axis=1)
        cell = (used[:, None] * (width + 1) + np.arange(width + 1)).ravel()
        yield pa.RecordBatch.from_arrays([pa.array(cell, pa.int64()), pa.array(values.ravel(), pa.int64())], ["cell", "value"])

    cells = vectors.select("embedding").mapInArrow(sums, "cell long, value long").groupBy("cell").agg(F.sum("value").alias("value"))
    flat = np.zeros(p * n * (width + 1), np.int64)
    for r in cells.collect():  # one row per component of the codebooks
        flat[r["cell"]] = r["value"]
    flat = flat.reshape(p * n, width + 1)
    total, count = flat[:, :-1], flat[:, -1:]
    new = np.where(count > 0, total // np.maximum(count, 1), books.entries.reshape(p * n, width))
    return Codebooks(new.reshape(p, n, width))


def fit(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks | None:
    """Codebooks over all vectors; ``vectors``: vec_id, embedding."""
    books = start(vectors, parts, entries)
    for _ in range(rounds if books is not None else 0):
        books = improved(vectors, books)
    return books


def encode(vectors: DataFrame, books: Codebooks, keep: tuple[str, ...] = ("vec_id", "label")) -> DataFrame:
    """Columns ``keep``, code (bytes, one per part) and error of every whole vector."""
    p, _, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole, x = kept_vectors(batch, p * width)
            index, distance = books.nearest(x.reshape(-1, p, width))
            raw = index.astype(np.uint8)
            rest = batch.filter(pa.array(whole))
            yield pa.RecordBatch.from_arrays(
                [rest.column(i) for i in range(len(keep))]
                + [pa.array([r.tobytes() for r in raw], pa.binary()), pa.array(distance.sum(axis=1), pa.int64())], [*keep, "code", "error"])

    kind = {f.name: f.dataType for f in vectors.select(*keep).schema}
    schema = T.StructType([T.StructField(c, kind[c]) for c in keep]
                          + [T.StructField("code", T.BinaryType()), T.StructField("error", T.LongType())])
    return vectors.select(*keep, "embedding").mapInArrow(run, schema)


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 of every whole vector. At most 256 entries (a byte a part)."""
    if not 1 <= entries <= 256:
        raise ValueError("entries must be 1 to 256: a part's code is one byte")
    books = fit(vectors, parts, entries, rounds)
    if books is None:
        kind = dict(vectors.dtypes)["vec_id"]
        return vectors.sparkSession.createDataFrame(
            [], f"vec_id {kind}, code string, error long, label_error long, codebooks_sha256 string")
    coded = staged(encode(vectors, books), "codes")
    sums = staged(coded.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error")), "code-labels")
    return (coded.join(sums, coded["label"].eqNullSafe(sums["_label"]))
            .select("vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256")))
