"""Every query of the library against its SQL, on the smallest tables."""

import os

import duckdb
import pytest

from tidefold.queries import ORACLE_SQL, QUERIES

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for f in os.listdir(DATA):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{DATA}/{f}'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    got = QUERIES[name](spark, DATA)
    columns = sorted(got.columns)
    rows = sorted(tuple(map(str, r)) for r in got.select(*columns).collect())
    if name not in ORACLE_SQL:
        assert rows
        return
    wanted = duck.execute(ORACLE_SQL[name])
    names = [d[0] for d in wanted.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    assert sorted(tuple(str(r[i]) for i in order) for r in wanted.fetchall()) == rows


def test_entry_points(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).columns == ["user_id", "event_id", "event_type", "value"]


@pytest.mark.parametrize("large", [6, 3])
def test_parts_of_more_than_a_megabyte_are_merged(spark, tmp_path, large):
    """Six parts of a customer table, all or three of them above the size that counts as small."""
    name = "case when id % 6 < {} then sha2(cast(id as string), 512) else 'x' end as c_name".format(large)
    rows = spark.range(100_000).selectExpr("id as c_custkey", name, "id * 0.25D as c_acctbal")
    rows.write.parquet(str(tmp_path / "customer.parquet"))
    got = QUERIES["compaction_rows"](spark, str(tmp_path))
    files = [os.path.getsize(f.removeprefix("file://")) for f in got.inputFiles()]
    assert len(files) == 1 and files[0] > large << 20
    assert got.count() == 100_000 and not got.exceptAll(rows).take(1)
