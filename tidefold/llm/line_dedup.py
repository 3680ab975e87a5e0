"""Line dedup over range-partitioned line hashes (DataFrame operations only).

1. Every text is split at ``\\n``; a line's key (stripped, A-Z lower-cased) becomes a
   96-bit hash, kept per document as an array, so this text is read once and isn't moved.
2. Lines are range-partitioned on (hash, document) and sorted by (hash, document, position) within the partitions.  Since the
   document is part of the range, a line that stands in a third of all documents is dealt to many tasks.
3. The sorted lines are streamed: the first occurrence of a key in each document is marked, a rank over the order that the
   exchange has made, without another one.  The marked lines are counted by key with map-side sums, and
   the first of all by (document, position) is kept.  The sorted lines are an index in the shared folder.
4. Lines of repeated keys are looked up in the index; the planned join splits a hot key's rows
   (adaptive skew join).  They are folded to one bitmap per document with hits: a word of 64 lines is an
   integer, and words without a hit are left out (the compression).
5. ``drop_lines`` applies a bitmap to its text with higher-order functions.  Only there texts may move: to their bitmaps, in the join
   that Spark plans, unless it broadcasts the bitmaps.

Policies: ``drop_all`` drops every line whose key is in at least ``min_docs`` documents;
``keep_first`` keeps the first occurrence, by (doc_id, position), of such a key.

Defined results: a null or empty text is one empty line; keys shorter than ``min_key_len``
code points are never dropped; each row counts as a document, also one that repeats another;
rows with equal doc_id and equal text share a bitmap, rows with equal doc_id and other text do
not; a null doc_id is an ordinary document that sorts first.  Extra columns pass through
``drop_lines``; their names may not start with ``__line_``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import WS_CHARS, ascii_lower, materialise, whole_text


def line_keys(text: Column) -> Column:
    """The key of each line: white space stripped at both ends, A-Z lower-cased."""
    lines = F.split(ascii_lower(text), "\n", -1)
    return F.transform(lines, lambda x: F.btrim(x, F.lit(WS_CHARS)))


def _hashed(keys: Column, min_key_len: int) -> Column:
    one = lambda x: F.struct(F.xxhash64(x).alias("a"), F.hash(x).alias("b"))
    return F.transform(keys, lambda x: F.when(F.length(x) >= min_key_len, one(x)))


def row_key(text_col: str) -> Column:
    """Tells rows of one doc_id apart by their text."""
    return F.xxhash64(whole_text(text_col))


def line_index(keyed: DataFrame) -> DataFrame:
    """a, b, doc, row, pos, first: all lines, range-partitioned and sorted; ``first`` marks a key's first line in each row of the documents.

    Rows that repeat id and text have their lines side by side, and a mark each: a rank gives equal positions the same number.
    """
    lines = keyed.select("doc", "row", F.posexplode("hs").alias("pos", "k")).where("k is not null")
    lines = lines.select(F.col("k.a").alias("a"), F.col("k.b").alias("b"), "doc", "row", "pos")
    ranged = lines.repartitionByRange("a", "b", "doc", "row").sortWithinPartitions("a", "b", "doc", "row", "pos")
    return ranged.withColumn("first", F.rank().over(Window.partitionBy("a", "b", "doc", "row").orderBy("pos")) == 1)


def line_bitmaps(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_docs: int = 10,
    min_key_len: int = 1,
    policy: str = "drop_all",
) -> DataFrame:
    """Return __line_doc, __line_row, __line_bits (array<struct<word int, mask long>>, a set bit
    is a dropped line), __line_dropped long.  Only documents that lose a line have a row.
    """
    if policy not in ("drop_all", "keep_first"):
        raise ValueError(f"unknown policy {policy}")
    doc, text = F.col(id_col).cast("long"), whole_text(text_col)
    keyed = docs.select(doc.alias("doc"), row_key(text_col).alias("row"), _hashed(line_keys(text), min_key_len).alias("hs"))
    keyed = materialise(keyed, "line-keys")

    index = materialise(line_index(keyed), "line-index")
    seen = index.where("first").groupBy("a", "b").agg(F.count(F.lit(1)).alias("n_docs"), F.min(F.struct("doc", "pos", "row")).alias("least"))
    repeated = materialise(seen.where(F.col("n_docs") >= min_docs).drop("n_docs"), "line-repeated")

    hits = index.join(repeated if policy == "keep_first" else repeated.drop("least"), ["a", "b"])
    if policy == "keep_first":
        hits = hits.where(F.struct("doc", "pos", "row") != F.col("least"))
    bit = F.expr("shiftleft(1L, pos % 64)")
    masks = hits.groupBy("doc", "row", F.expr("pos div 64").cast("int").alias("word")).agg(F.bit_or(bit).alias("mask"))
    return masks.groupBy(F.col("doc").alias("__line_doc"), F.col("row").alias("__line_row")).agg(
        F.collect_list(F.struct("word", "mask")).alias("__line_bits"),
        F.sum(F.bit_count("mask")).cast("long").alias("__line_dropped"),
    )


def kept_lines(text: Column, bits: Column) -> Column:
    """The lines of ``text`` whose bit isn't set (all, where ``bits`` is null): 64 lines and their word at a time."""
    lines = F.split(text, "\n", -1)
    mask = lambda w: F.coalesce(F.get(F.transform(F.filter(bits, lambda x: x["word"] == w), lambda x: x["mask"]), F.lit(0)), F.lit(0).cast("long"))
    some = lambda part, m: F.filter(part, lambda _, i: F.getbit(m, i) == 0)
    word = lambda own, w: F.get(F.transform(F.array(mask(w)), lambda m: some(F.slice(own, w * 64 + 1, F.lit(64)), m)), F.lit(0))
    all_words = lambda own: F.flatten(F.transform(F.sequence(F.lit(0), F.floor((F.size(own) - 1) / 64).cast("int")), lambda w: word(own, w)))
    return F.when(bits.isNull(), lines).otherwise(F.get(F.transform(F.array(lines), all_words), F.lit(0)))


def drop_lines(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the text rebuilt from the kept lines, plus __line_n (lines before) and __line_dropped."""
    tagged = docs.withColumns({"__line_id": F.col(id_col).cast("long"), "__line_key": row_key(text_col)})
    same = F.col("__line_id").eqNullSafe(F.col("__line_doc")) & (F.col("__line_key") == F.col("__line_row"))
    text = whole_text(text_col)
    return (
        tagged.join(bitmaps, same, "left")
        .withColumn("__line_n", F.size(F.split(text, "\n", -1)).cast("long"))
        .withColumn(text_col, F.array_join(kept_lines(text, F.col("__line_bits")), "\n"))
        .withColumn("__line_dropped", F.coalesce("__line_dropped", F.lit(0).cast("long")))
        .drop("__line_id", "__line_key", "__line_doc", "__line_row", "__line_bits")
    )
