"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; one JSON line."""

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def session():
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.timeType.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def throughput(spark) -> dict[str, float]:
    from pyspark.sql import functions as F

    from tidefold.operators.envelope import changelog
    from tidefold.queries import ORDERS, new_lake, table
    from tidefold.streaming.mirror import Mirror

    rows = table(spark, SF_DIR, "orders").select(*ORDERS.names).orderBy("o_orderkey").limit(100_000).persist()
    n = rows.count()
    mirror = Mirror(new_lake(spark), "bench", lambda _: ORDERS)
    found, base = {}, 0
    for name, op, sent in (("insert", "I", rows), ("update", "U", rows.withColumn("o_totalprice", F.col("o_totalprice") + 1)), ("delete", "D", rows.where("o_orderkey % 2 = 0"))):
        log = changelog(sent, ORDERS, F.lit(op), F.col("o_orderkey") + base)
        began = time.time()
        mirror.apply(log)
        found[name] = round((n if op != "D" else sent.count()) / (time.time() - began))
        base += 10**9
    return found


def main() -> None:
    from tidefold.queries import QUERIES

    spark = session()
    names = [
        "mirror_latest", "mirror_two_batches", "mirror_key_move", "patch_unchanged", "truncate_epoch", "bootstrap_antijoin", "update_from", "segment_plan", "schema_rename",
        "schema_retype_rewrite", "multi_table_commit", "time_travel", "change_feed", "compaction_rows", "cast_decimal", "pg_array_parse", "interval_parse", "json_extract",
    ]
    QUERIES[names[0]](spark, SF_DIR).collect()  # start-up
    seconds = {}
    for name in names:
        began = time.time()
        QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - began, 3)
    rates = throughput(spark)
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "rows_per_second": rates, "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1]}))
    spark.stop()


if __name__ == "__main__":
    main()
