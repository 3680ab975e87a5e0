"""Helpers that the training-data operators share: scratch tables and word rules."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of the corpus contracts, as a Java character class.
WS = "[\\x20\\x09-\\x0D]"
WS_CHARS = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir`` of the session.

    Only where the setting is absent (a local test session) a folder of this machine is used.
    """
    where = spark.conf.get("spark.checkpoint.dir", None)
    if where:
        return where.rstrip("/")
    jsc = spark.sparkContext._jsc.sc()
    if jsc.getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tidefold-"))
    return jsc.getCheckpointDir().get().rstrip("/")


#: How scratch tables are written.  Without Hadoop's native library a local file system starts a process (chmod) for each folder, file and checksum
#: file, and the JVM's memory counts twice for the moment in which that process shares it.  Scratch needs no checksum files and no mark of success.
#: Other file systems are written as ever.
SCRATCH = {
    "fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem",
    "fs.file.impl.disable.cache": "true",
    "mapreduce.fileoutputcommitter.marksuccessfuljobs": "false",
}


def materialise(df: DataFrame, name: str, few: bool = False) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    This cuts the lineage: a lost executor costs a re-read, not a recomputation, and what
    is read twice is computed once.  Columns stay prunable, unlike with ``checkpoint()``.
    ``few``: narrow rows are dealt anew, evenly, into as few files as their bytes allow, not one for each task.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    (df.hint("rebalance") if few else df).write.options(**SCRATCH).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def whole_text(text_col: str) -> Column:
    """The text as a string, null counting as empty."""
    return F.coalesce(F.col(text_col).cast("string"), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, UPPER, UPPER.lower())


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def row_chunks(spark: SparkSession, docs: DataFrame) -> int:
    """Partitions of ``docs`` as planned, at least the shuffle width: a chunk count that follows the input."""
    return max(shuffle_width(spark), docs.rdd.getNumPartitions())


#: Rows of an Arrow batch that become Python objects at a time.
SLICE = 512


def map_texts(docs: DataFrame, columns: list[str], text_col: str, make, schema: str) -> DataFrame:
    """Run ``make(lists of the columns, list of texts as bytes)`` on Arrow batches.

    ``make`` returns a list of columns (lists or arrays) for ``schema``.  Texts arrive as UTF-8
    bytes, null as ``b""``, whole; rows stay where they are, so nothing is shuffled.
    """
    names = [f"c{i}" for i in range(len(columns))]
    picked = docs.select(*[F.col(c).alias(n) for c, n in zip(columns, names, strict=True)], whole_text(text_col).cast("binary").alias("t"))
    target = to_arrow(schema)

    def run(batches):
        import pyarrow as pa

        for whole in batches:
            for at in range(0, whole.num_rows, SLICE):  # Python objects of a slice only, however large Spark's batches
                batch = whole.slice(at, SLICE)
                out = make([batch.column(n).to_pylist() for n in names], batch.column("t").to_pylist())
                yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(out, target, strict=True)], schema=target)

    return picked.mapInArrow(run, schema)


def to_arrow(schema: str):
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(schema))
