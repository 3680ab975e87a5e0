"""Exact dedup by an extendible-hash index on shared files (DataFrame operations only).

1. A *key table* (row, doc_id, 64-bit hash, SHA-256 of the normalised text) goes to the shared folder, and from it
   a *hash table*: each distinct hash and how many rows have it.
2. The *directory* is grown by doubling: it starts with one bucket, and while a bucket
   holds more than ``bucket_keys`` distinct hashes its prefix gets one bit more.  Hashes are counted once by a fine prefix
   (about 16 prefixes a bucket); summed up level by level, these counts say at which depth each prefix fits.  The directory is a
   table that follows the number of hashes; no part of it reaches the driver.
3. Bytes are compared where hashes meet: texts whose hash occurs more than once are grouped by (hash, text), so
   equal hashes with different bytes stay different entries.  Spark combines
   copies in the map tasks, so a text that fills a third of the corpus reaches its reducer
   as one row per map task.  Which texts these are is told by a broadcast of the repeated hashes, if there are at
   most ``broadcast_hashes`` of them; otherwise all texts are grouped, with the same result.
   A hash that occurs once is an entry without a look at the text.
4. Owner tasks get ranges of buckets (a range exchange on the bucket, which is a range of hash values), sort them, number the entries
   that share a hash (the collision chain) and write the index.  Texts are not part of the index files.
5. Each row of the key table walks the chain of its hash: it is the entry whose SHA-256, taken of the bytes compared in 3, is its own.

The number of rows per key does not load a bucket: buckets count distinct hashes.

Defined results: a null text is an empty text; an empty table gives an empty result; extra
columns are ignored and may have any name.  Rows with equal text and equal doc_id are told
apart, and exactly one of them is kept.  A null doc_id counts as larger than every other.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import WS, materialise, whole_text

#: Bits of the longest prefix.
MOST_BITS = 62


def normalised(text: Column) -> Column:
    """Each run of white space becomes one space."""
    return F.regexp_replace(text, f"{WS}+", " ")


def prefix(bits: int) -> Column:
    """The first ``bits`` bits of a hash."""
    return F.shiftrightunsigned(F.col("h"), 64 - bits) if bits else F.lit(0).cast("long")


def doubled(hashes: DataFrame, bucket_keys: int, bits: int) -> DataFrame:
    """part (prefix of ``bits`` bits), local_depth, bucket (the bucket's first such prefix), keys in the bucket.

    A prefix's bucket is the shortest prefix of it that isn't overfull, or at last the fine prefix itself.
    """
    fine = hashes.groupBy(prefix(bits).alias("part")).agg(F.count(F.lit(1)).alias("n"))
    start = F.expr(f"shiftleft(shiftrightunsigned(part, {bits} - depth), {bits} - depth)")
    levels = fine.select("part", "n", F.explode(F.sequence(F.lit(0), F.lit(bits))).alias("depth")).withColumn("bucket", start)
    held = levels.groupBy("depth", "bucket").agg(F.sum("n").alias("keys"))
    fits = held.where((F.col("keys") <= bucket_keys) | (F.col("depth") == bits))
    found = levels.join(fits, ["depth", "bucket"]).groupBy("part").agg(F.min(F.struct("depth", "bucket", "keys")).alias("least"))
    return found.select("part", F.col("least.depth").alias("local_depth"), "least.bucket", "least.keys")


def directory(hashes: DataFrame, bucket_keys: int) -> tuple[DataFrame, int]:
    """The directory of a table of distinct hashes (column h), and the bits of its prefixes.

    Where hashes are so uneven that a bucket is overfull at the finest prefix, the directory doubles on, eight bits at a time.
    """
    n = hashes.count()
    bits = min(MOST_BITS, math.ceil(math.log2(max(1.0, n / bucket_keys))) + 4) if n > bucket_keys else 0
    while True:
        table = materialise(doubled(hashes, bucket_keys, bits), "exact-directory")
        if bits == MOST_BITS or table.where(F.col("keys") > bucket_keys).isEmpty():
            return table, bits
        bits = min(MOST_BITS, bits + 8)


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    bucket_keys: int = 50_000,
    hash_of: Callable[[Column], Column] = F.xxhash64,
    broadcast_hashes: int = 4_000_000,
) -> DataFrame:
    """Return doc_id, keep_id, group_size, kept, text_sha256, bucket, chain: one row for each row of ``docs``.

    ``hash_of`` maps the normalised text to a bigint; a weak one only lengthens chains.
    """
    text = normalised(whole_text(text_col))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("norm")).withColumn("h", hash_of(F.col("norm")))
    digest = F.sha2(F.col("norm").cast("binary"), 256)
    keys = materialise(rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", "h", digest.alias("sha")), "exact-keys")
    hashes = keys.groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("lo"), F.any_value("sha").alias("sha"))
    hashes = materialise(hashes, "exact-hashes")

    repeated = hashes.where("n > 1").select("h")
    few = repeated.count() <= broadcast_hashes
    compared = rows.join(F.broadcast(repeated), "h", "left_semi") if few else rows
    compared = compared.groupBy("h", "norm").agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    entries = compared.select("h", digest.alias("sha"), "keep_id", "group_size")
    if few:
        entries = entries.union(hashes.where("n = 1").select("h", "sha", "lo", "n"))

    slots, bits = directory(hashes.select("h"), bucket_keys)
    chain = Window.partitionBy("bucket", "h").orderBy("sha")
    owned = entries.withColumn("part", prefix(bits)).join(slots.select("part", "bucket", "local_depth"), "part").drop("part")
    owned = owned.repartitionByRange("bucket").withColumn("chain", F.row_number().over(chain) - 1)
    index = materialise(owned, "exact-index")

    # rows that repeat both id and text: the first of them stands for the others
    again = keys.groupBy("h", "sha", "doc_id").agg(F.min("row").alias("first_row"), F.count(F.lit(1)).alias("times"))
    again = again.where("times > 1").select("h", "sha", F.col("doc_id").alias("same_id"), "first_row")
    k, i, a = keys.alias("k"), index.alias("i"), again.alias("a")
    joined = k.join(i, [F.col("k.h") == F.col("i.h"), F.col("k.sha") == F.col("i.sha")]).join(
        a,
        [F.col("k.h") == F.col("a.h"), F.col("k.sha") == F.col("a.sha"), F.col("k.doc_id").eqNullSafe(F.col("a.same_id"))],
        "left",
    )
    return joined.select(
        F.col("k.doc_id").alias("doc_id"),
        F.col("i.keep_id").alias("keep_id"),
        F.col("i.group_size").alias("group_size"),
        (F.col("k.doc_id").eqNullSafe(F.col("i.keep_id")) & (F.coalesce("a.first_row", "k.row") == F.col("k.row"))).alias("kept"),
        F.col("k.sha").alias("text_sha256"),
        F.col("i.bucket").alias("bucket"),
        F.col("i.chain").alias("chain"),
    )
