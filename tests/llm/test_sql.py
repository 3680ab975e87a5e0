"""The registered queries that have SQL, on the smallest tables, and that the rest of the library stands alone."""

import ast
from pathlib import Path

import duckdb
import pytest

from tidefold.llm.queries import ORACLE_SQL, QUERIES

DATA = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    got = QUERIES[name](spark, DATA)
    columns = sorted(got.columns)
    rows = sorted(tuple(map(str, r)) for r in got.select(*columns).collect())
    wanted = con.execute(ORACLE_SQL[name])
    names = [d[0] for d in wanted.description]
    assert sorted(names) == columns
    assert sorted(tuple(str(r[names.index(c)]) for c in columns) for r in wanted.fetchall()) == rows


def test_nothing_else_imports_this_subpackage():
    root = Path(__file__).resolve().parents[2]
    for path in (root / "tidefold").rglob("*.py"):
        if "llm" not in path.parts:
            for node in ast.walk(ast.parse(path.read_text())):
                names = [a.name for a in node.names] if isinstance(node, ast.Import) else [node.module or ""] if isinstance(node, ast.ImportFrom) else []
                assert not any("llm" in n.split(".") for n in names), path
