"""One registered query for each operator, over whole tables, with SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalframe.llm import alignment, codes, decontaminate, langid, linededup, lm, mixing, packing, quality, sharding, simhash, substring, toxicity
from vitalframe.llm.common import id_bucket, table


def trusted_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trusted target: documents labelled as of good quality."""
    return table(spark, sf_dir, "labels").filter(F.col("quality") == 1).select("doc_id")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """24 shards whose row counts are at most one apart; ``home`` is the ring's shard without bounds."""
    rows = sharding.shard_rows(table(spark, sf_dir, "documents"), 24)
    return rows.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                       F.lit(None).cast("int").alias("grown_shard"), "home")


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.judge(docs, trusted_ids(spark, sf_dir))


def op4_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.remove_repeats(table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))
    return found.select("doc_id", (id_bucket(F.col("doc_id"), 5) == 0).alias("held_out"), "score", "predicted")


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, text without later three-line repeats, n_lines, n_removed."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return linededup.dedup_lines(docs, counts=True)


def op9_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"))


def op10_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = langid.identify(docs, *langid.fit(docs))
    return found.select("doc_id", (id_bucket(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score")


def op11_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"))


def op12_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of 16 parts, 64 entries each, after 2 rounds over all vectors."""
    return codes.compress(table(spark, sf_dir, "embeddings"))


def op13_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources weigh 5, 2, 1, repeating, in code point order; all words are dealt, no document more than three times."""
    rows = mixing.mix(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "size", "source_size", rows["targets"][0].alias("target"), rows["taken"][0].alias("taken"), "source")


LINE_DEDUP_SQL = r"""
WITH l AS (
  SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents
), w AS (
  SELECT doc_id, pos, lines[pos + 1] AS a, lines[pos + 2] AS b, lines[pos + 3] AS c
  FROM (SELECT doc_id, lines, unnest(range(len(lines) - 2)) AS pos FROM l WHERE len(lines) >= 3)
), ranked AS (
  SELECT doc_id, pos, row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, pos) AS n FROM w
  WHERE regexp_matches(a || b || c, '[^\x20\x09-\x0D]')
), cover AS (
  SELECT DISTINCT doc_id, pos + k AS line FROM ranked, (VALUES (0), (1), (2)) v(k) WHERE n > 1
), numbered AS (
  SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS pos FROM l
), kept AS (
  SELECT n.doc_id, string_agg(n.line, chr(10) ORDER BY n.pos) FILTER (WHERE c.line IS NULL) AS text, count(c.line) AS n_removed
  FROM numbered n LEFT JOIN cover c ON n.doc_id = c.doc_id AND n.pos = c.line GROUP BY n.doc_id
)
SELECT l.doc_id, CASE WHEN l.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text,
       coalesce(len(l.lines), 0) AS n_lines, coalesce(k.n_removed, 0) AS n_removed
FROM l LEFT JOIN kept k ON l.doc_id = k.doc_id
"""

CONTAMINATION_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT coalesce(cast(item_id AS varchar), '') AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), bw AS (
  SELECT DISTINCT item, list_slice(w, k, k + least(13, len(w)) - 1) AS win
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS k FROM b WHERE len(w) > 0)
), dw AS (
  SELECT doc_id, k, n, list_slice(w, k, k + n - 1) AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM d, (SELECT DISTINCT len(win) AS n FROM bw) WHERE len(w) >= n)
), hits AS (
  SELECT dw.doc_id, dw.k, dw.n, bw.item FROM dw JOIN bw ON dw.win = bw.win
), words AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + n)) AS p FROM hits) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

REPEATS_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), win AS (
  SELECT doc_id, k, md5(array_to_string(list_slice(w, k, k + 49), ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS k FROM d WHERE len(w) >= 50)
), first AS (
  SELECT h, min(doc_id) AS least FROM win GROUP BY h
), cover AS (
  SELECT DISTINCT doc_id, unnest(range(k, k + 50)) AS p FROM win JOIN first USING (h) WHERE least < doc_id
), words AS (
  SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d
), kept AS (
  SELECT words.doc_id, count(cover.p) AS n_removed, string_agg(word, ' ' ORDER BY words.p) FILTER (WHERE cover.p IS NULL) AS text
  FROM words LEFT JOIN cover ON words.doc_id = cover.doc_id AND words.p = cover.p GROUP BY words.doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256 FROM d LEFT JOIN kept USING (doc_id)
"""

CODES_SQL = r"""
WITH c AS (
  SELECT vec_id, label, unnest(embedding) AS v, unnest(range(len(embedding))) AS i, len(embedding) // 16 AS width FROM embeddings
), bad AS (
  SELECT DISTINCT vec_id FROM c WHERE v IS NULL OR NOT isfinite(v)
), x AS (
  SELECT vec_id, label, i // width AS part, i % width AS pos, cast(floor(256 * cast(v AS double)) AS bigint) AS v
  FROM c WHERE vec_id NOT IN (SELECT vec_id FROM bad)
), b0 AS (
  SELECT part, entry, pos, v FROM x JOIN (
    SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM (SELECT DISTINCT vec_id FROM x) ORDER BY vec_id LIMIT 64) USING (vec_id)
), a0 AS (
  SELECT vec_id, label, part, min(struct_pack(d := d, e := entry)) AS best FROM (
    SELECT x.vec_id, x.label, x.part, b.entry, cast(sum((x.v - b.v) * (x.v - b.v)) AS bigint) AS d
    FROM x JOIN b0 b ON x.part = b.part AND x.pos = b.pos GROUP BY ALL) GROUP BY ALL
), b1 AS (
  SELECT o.part, o.entry, o.pos, coalesce((m.total - ((m.total % m.n) + m.n) % m.n) // m.n, o.v) AS v
  FROM b0 o LEFT JOIN (
    SELECT x.part, a.best.e AS entry, x.pos, cast(sum(x.v) AS bigint) AS total, count(*) AS n
    FROM x JOIN a0 a ON x.vec_id = a.vec_id AND x.part = a.part GROUP BY ALL) m
  ON o.part = m.part AND o.entry = m.entry AND o.pos = m.pos
), a1 AS (
  SELECT vec_id, label, part, min(struct_pack(d := d, e := entry)) AS best FROM (
    SELECT x.vec_id, x.label, x.part, b.entry, cast(sum((x.v - b.v) * (x.v - b.v)) AS bigint) AS d
    FROM x JOIN b1 b ON x.part = b.part AND x.pos = b.pos GROUP BY ALL) GROUP BY ALL
), b2 AS (
  SELECT o.part, o.entry, o.pos, coalesce((m.total - ((m.total % m.n) + m.n) % m.n) // m.n, o.v) AS v
  FROM b1 o LEFT JOIN (
    SELECT x.part, a.best.e AS entry, x.pos, cast(sum(x.v) AS bigint) AS total, count(*) AS n
    FROM x JOIN a1 a ON x.vec_id = a.vec_id AND x.part = a.part GROUP BY ALL) m
  ON o.part = m.part AND o.entry = m.entry AND o.pos = m.pos
), a2 AS (
  SELECT vec_id, label, part, min(struct_pack(d := d, e := entry)) AS best FROM (
    SELECT x.vec_id, x.label, x.part, b.entry, cast(sum((x.v - b.v) * (x.v - b.v)) AS bigint) AS d
    FROM x JOIN b2 b ON x.part = b.part AND x.pos = b.pos GROUP BY ALL) GROUP BY ALL
), r AS (
  SELECT vec_id, label, string_agg(format('{:02x}', best.e), '' ORDER BY part) AS code, cast(sum(best.d) AS bigint) AS error FROM a2 GROUP BY ALL
)
SELECT vec_id, code, error, cast(sum(error) OVER (PARTITION BY label) AS bigint) AS label_error,
       (SELECT sha256(string_agg(cast(v AS varchar), ',' ORDER BY part, entry, pos)) FROM b2) AS codebooks_sha256 FROM r
"""

MIX_SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         cast('0x' || left(md5(coalesce(cast(doc_id AS varchar), '') || ':' || md5(coalesce(text, ''))), 15) AS bigint) AS key
  FROM documents
), s AS (
  SELECT source, cast(sum(size) AS bigint) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place FROM d GROUP BY source
), w AS (
  SELECT source, source_size, CASE place % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight,
         cast(sum(source_size) OVER () AS double) AS budget FROM s
), f AS (
  SELECT *, weight * (budget - 3 * coalesce(sum(source_size) OVER (ORDER BY source_size / weight, source NULLS LAST
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            > 3 * source_size * sum(weight) OVER (ORDER BY source_size / weight, source NULLS LAST
                                 ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS full_up FROM w
), t AS (
  SELECT source, source_size, CASE WHEN full_up THEN cast(3 * source_size AS double)
         ELSE weight * (budget - 3 * cast(sum(CASE WHEN full_up THEN source_size ELSE 0 END) OVER () AS double))
              / cast(sum(CASE WHEN full_up THEN 0 ELSE weight END) OVER () AS double) END AS target FROM f
), g AS (
  SELECT *, CASE WHEN source_size = 0 THEN 0 ELSE cast(floor(target / source_size) AS bigint) END AS repeats FROM t
), r AS (
  SELECT d.*, g.source_size, g.target, g.repeats,
         coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY key, size, doc_id NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS earlier
  FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source
)
SELECT doc_id, size, source_size, target, source,
       cast(size * (repeats + CASE WHEN earlier + size / 2 <= target - repeats * source_size THEN 1 ELSE 0 END) AS bigint) AS taken FROM r
"""

# The others use hashes, tokenizers or trained weights that SQL lacks; tests hold them against brute force.
QUERIES = {
    "op1_decontaminate": op1_decontaminate,
    "op2_shards": op2_shards,
    "op3_quality": op3_quality,
    "op4_pack": op4_pack,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_toxicity": op6_toxicity,
    "op7_simhash": op7_simhash,
    "op8_line_dedup": op8_line_dedup,
    "op9_lm_score": op9_lm_score,
    "op10_langid": op10_langid,
    "op11_align": op11_align,
    "op12_codes": op12_codes,
    "op13_mix": op13_mix,
}
ORACLE = {"op1_decontaminate": CONTAMINATION_SQL, "op5_substring_dedup": REPEATS_SQL, "op8_line_dedup": LINE_DEDUP_SQL,
          "op12_codes": CODES_SQL, "op13_mix": MIX_SQL}
