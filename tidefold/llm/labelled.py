"""A bounded sample of labelled documents for the two classifiers, and per-word caches for scoring."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import whole_text


def held_out(id_col: Column, modulus: int, remainder: int) -> Column:
    """True where crc32 of the id's decimal text leaves ``remainder``: such rows are never learnt from."""
    return F.coalesce(F.crc32(id_col.cast("long").cast("string").cast("binary")) % modulus == remainder, F.lit(False))


def training_rows(
    docs: DataFrame, labels: DataFrame, label_col: str, modulus: int, remainder: int, rows: int, max_bytes: int, id_col: str = "doc_id", text_col: str = "text"
) -> tuple[list[bytes], list[int]]:
    """Texts and 0/1 labels of at most ``rows`` labelled documents that aren't held out.

    The labels with the smallest hashes of their ids are taken, so the sample is the same on
    every run and cluster.  An id with several labels counts with the largest; labels other
    than 0 and 1 are ignored.  Documents over ``max_bytes`` bytes don't train (they are scored
    like all others); those two parameters bound what reaches the driver.
    """
    y = F.col(label_col).cast("int")
    usable = labels.where(y.isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(F.col(id_col), modulus, remainder))
    usable = usable.groupBy(F.col(id_col).cast("long").alias("l_id")).agg(F.max(y).alias("l_y"))
    picked = usable.orderBy(F.xxhash64("l_id"), "l_id").limit(rows)
    texts = docs.select(F.col(id_col).cast("long").alias("d_id"), whole_text(text_col).cast("binary").alias("t"))
    texts = texts.where(F.octet_length("t") <= max_bytes)
    found = texts.join(F.broadcast(picked), F.col("d_id") == F.col("l_id")).select("d_id", "t", "l_y").limit(rows)
    got = sorted((r["d_id"], bytes(r["t"]), r["l_y"]) for r in found.collect())
    return [t for _, t, _ in got], [y for _, _, y in got]
