import hashlib
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tidefold.llm.exact_dedup import directory, exact_dedup
from tidefold.llm.line_dedup import drop_lines, line_bitmaps


def rows(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


@pytest.mark.parametrize("most", [0, 10**6])
@pytest.mark.parametrize("hash_of", [F.xxhash64, lambda t: F.length(t).cast("long") % 3])
def test_exact_dedup(docs, hash_of, most):
    """Also with a hash that nearly always collides: chains keep different texts apart."""
    source = rows(docs, "doc_id", "text")
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    groups = defaultdict(list)
    for i, t in source:
        groups[norm(t)].append(i)
    got = rows(exact_dedup(docs, bucket_keys=4, hash_of=hash_of, broadcast_hashes=most), "doc_id", "keep_id", "group_size", "kept", "text_sha256")
    wanted = Counter()
    for i, t in source:
        own = groups[norm(t)]
        known = [x for x in own if x is not None]
        wanted[i, min(known) if known else None, len(own), hashlib.sha256(norm(t).encode()).hexdigest()] += 1
    assert Counter((a, b, c, e) for a, b, c, _, e in got) == wanted
    kept = Counter(e for _, _, _, k, e in got if k)
    assert set(kept.values()) == {1} and len(kept) == len(groups), "one row of each group stays, also of repeated rows"


def test_directory_doubles_until_buckets_fit(spark):
    even = spark.range(4096).select(F.shiftleft(F.col("id"), 52).alias("h"))
    slots, bits = directory(even, 100)
    found = slots.groupBy("bucket", "local_depth").agg(F.max("keys").alias("n"), F.count(F.lit(1)).alias("slots")).collect()
    assert {r["local_depth"] for r in found} == {6} and len(found) == 64 and all(r["n"] == 64 for r in found), "4,096 places, 64 a bucket"
    uneven = spark.range(100).select(F.col("id").alias("h")).union(spark.createDataFrame([(-1,)], "h long"))
    slots, bits = directory(uneven, 50)
    got = rows(slots.select("bucket", "local_depth", "keys").distinct(), "local_depth", "keys")
    assert bits == 62 and (1, 1) in got and max(n for _, n in got) <= 50, "only the overfull side is split, as deep as it takes"
    assert directory(uneven, 101)[1] == 0 and directory(uneven.where("false"), 10)[0].count() == 0


def test_owners_hold_ranges_of_buckets(spark, docs):
    """One owner per bucket, chains numbered from 0 in it; no exchange between the range exchange and the numbering."""
    got = exact_dedup(docs, bucket_keys=4, hash_of=lambda t: F.pmod(F.xxhash64(t), F.lit(7)) * 2**59)
    chains = {}
    for b, c, s in rows(got.distinct(), "bucket", "chain", "text_sha256"):
        chains.setdefault(b, []).append((c, s))
    assert len(chains) > 1 and any(c > 0 for own in chains.values() for c, _ in own)


def test_exact_dedup_of_nothing(nothing):
    assert exact_dedup(nothing).count() == 0


def line_key(line):
    return line.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)})


@pytest.mark.parametrize(("min_docs", "min_len"), [(10, 1), (2, 3), (1000, 1)])
def test_line_dedup(docs, min_docs, min_len):
    source = rows(docs, "doc_id", "text")
    seen = Counter(k for _, t in source for k in {line_key(x) for x in (t or "").split("\n")} if len(k) >= min_len)
    wanted = []
    for i, t in source:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (len(line_key(x)) >= min_len and seen[line_key(x)] >= min_docs)]
        wanted.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    got = rows(drop_lines(docs, line_bitmaps(docs, min_docs=min_docs, min_key_len=min_len)), "doc_id", "text", "__line_n", "__line_dropped")
    assert sorted(got, key=str) == sorted(wanted, key=str)


def test_line_dedup_keeps_first(spark):
    t = [(1, "a\nb"), (2, "A \nb\na\nc"), (3, "b")]
    df = spark.createDataFrame(t, "doc_id long, text string")
    got = rows(drop_lines(df, line_bitmaps(df, min_docs=2, policy="keep_first")).orderBy("doc_id"), "text")
    assert got == [("a\nb",), ("c",), ("",)]
    with pytest.raises(ValueError):
        line_bitmaps(df, policy="other")


def test_lines_are_range_partitioned_and_streamed(spark, docs):
    from tidefold.llm.line_dedup import line_index

    keyed = spark.createDataFrame([(i, 1, [(7, 7), (i, 0), (7, 7)]) for i in range(500)], "doc long, row long, hs array<struct<a:long,b:int>>")
    index = line_index(keyed)
    plan = index._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and "rangepartitioning(a#" in plan, plan
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        hot = index.withColumn("p", F.spark_partition_id()).where("a = 7 and b = 7").select("p").distinct().count()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert hot > 1, "a hot line is dealt to several tasks"
    assert index.where("first").where("a = 7 and b = 7").count() == 500


def test_long_text_that_loses_all_lines(spark):
    text = "\n".join(f"line {i % 5000}" for i in range(20_000))
    df = spark.createDataFrame([(1, text), (2, text + "\nown")], "doc_id long, text string")
    got = rows(drop_lines(df, line_bitmaps(df, min_docs=2)).orderBy("doc_id"), "text", "__line_dropped")
    assert got == [("", 20_000), ("own", 20_000)]


def test_many_lines_in_one_text(spark):
    lines = [f"l{i % 90}" if i % 3 else f"own {i}" for i in range(400)]
    df = spark.createDataFrame([(i, "\n".join(lines) if i else "own 0") for i in range(3)], "doc_id long, text string")
    got = rows(drop_lines(df, line_bitmaps(df, min_docs=2)).where("doc_id = 1"), "text", "__line_dropped")
    assert got == [("", 400)]


def test_lines_of_nothing(nothing):
    assert drop_lines(nothing, line_bitmaps(nothing)).count() == 0
