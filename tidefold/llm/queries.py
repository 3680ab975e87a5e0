"""The registered queries of this subpackage, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import bpe_digests
from .exact_dedup import exact_dedup
from .license_scan import license_scan
from .line_dedup import drop_lines, line_bitmaps
from .minhash import near_groups
from .packing import pack
from .quality import fit_quality, score_texts
from .substring_dedup import substring_dedup
from .topk import top_k
from .toxicity import fit_toxicity
from .tokens import Vocabulary


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = exact_dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


OP1_SQL = r"""
WITH n AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS s FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY s) AS keep_id, count(*) OVER (PARTITION BY s) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY s) AS kept, s AS text_sha256
FROM n
"""


def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(table(spark, sf_dir, "documents"), shingle=5, percent=75)


OP5_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
      ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS sh FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * shared >= 75 * (x.n + y.n - shared)),
r AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, e.b FROM r JOIN e ON e.a = r.y),
c AS (SELECT x, min(y) AS component_id FROM r GROUP BY x)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d JOIN c ON c.x = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
"""


def op6_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20, scale=64)


OP6_SQL = r"""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = drop_lines(docs, line_bitmaps(docs, min_docs=10, min_key_len=1))
    sha = F.sha2(F.col("text").cast("binary"), 256)
    return out.select("doc_id", F.col("__line_n").alias("n_lines"), F.col("__line_dropped").alias("n_dropped"), sha.alias("kept_sha256"))


OP7_SQL = r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM d),
k AS (SELECT doc_id, pos, line, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
hot AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (key IN (SELECT key FROM hot)) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (key NOT IN (SELECT key FROM hot)), '')) AS kept_sha256
FROM k GROUP BY doc_id
"""

def vocabulary(name: str) -> Vocabulary:
    import public_tokenizers

    return Vocabulary(public_tokenizers.path(name), public_tokenizers.PATTERN)


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    # capacities that no set of pieces within 2048 tokens can exceed: all components take part in the choice, none costs a sequence
    return pack(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), max_tokens=2048, max_docs=2048, max_cost=2048**2, end_id=0)


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit_quality(docs, table(spark, sf_dir, "labels"), modulus=3, remainder=1)
    return score_texts(docs, model, threshold=0.5, modulus=3, remainder=1)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit_toxicity(docs, table(spark, sf_dir, "labels"), modulus=4, remainder=2)
    return score_texts(docs, model, threshold=0.3, modulus=4, remainder=2)


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digests(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.tiktoken"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_words",
        F.size("starts").cast("long").alias("n_base"),
        F.array_min("starts").alias("first_word"),
        F.array_max("starts").alias("last_word"),
        F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        "score",
    )


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup(table(spark, sf_dir, "documents"), length=50)
    return out.select("doc_id", "n_words", "n_removed", "kept_sha256")


OP10_SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
g AS (SELECT doc_id, unnest(range(1, len(ws) - 48)) AS s, ws FROM w WHERE len(ws) >= 50),
h AS (SELECT doc_id, s, md5(array_to_string(ws[s:s + 49], ' ')) AS k FROM g),
d AS (SELECT doc_id, s FROM (SELECT doc_id, s, min(doc_id) OVER (PARTITION BY k) AS lo FROM h) WHERE lo < doc_id),
c AS (SELECT DISTINCT doc_id, unnest(range(s, s + 50)) AS i FROM d),
x AS (SELECT w.doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM w),
y AS (SELECT x.doc_id, count(c.i) AS n_removed, coalesce(string_agg(word, ' ' ORDER BY x.i) FILTER (c.i IS NULL), '') AS kept
      FROM x LEFT JOIN c ON c.doc_id = x.doc_id AND c.i = x.i GROUP BY x.doc_id)
SELECT w.doc_id, len(ws) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN y ON y.doc_id = w.doc_id
"""


QUERIES = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_quality_classifier": op3_quality_classifier,
    "op4_toxicity": op4_toxicity,
    "op5_minhash_near_dedup": op5_minhash_near_dedup,
    "op6_exact_topk": op6_exact_topk,
    "op7_line_dedup": op7_line_dedup,
    "op8_byte_bpe": op8_byte_bpe,
    "op9_license_scan": op9_license_scan,
    "op10_substring_dedup": op10_substring_dedup,
}
ORACLE_SQL = {"op1_exact_dedup": OP1_SQL, "op5_minhash_near_dedup": OP5_SQL, "op6_exact_topk": OP6_SQL, "op7_line_dedup": OP7_SQL, "op10_substring_dedup": OP10_SQL}
