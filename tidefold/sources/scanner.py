"""Current rows and definitions of source tables over JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.types import mysql_type, pg_type
from ..operators.ddl import Definition

# Catalog queries of the two systems; each returns plain columns that ``definition`` maps.
PG_COLUMNS = """
SELECT a.attname AS column_name, pg_catalog.format_type(coalesce(nullif(e.oid, 0), b.oid, t.oid), a.atttypmod) AS declared,
       CASE WHEN t.typcategory = 'A' OR b.typcategory = 'A' THEN greatest(a.attndims, 1) ELSE 0 END AS dims,
       pg_catalog.col_description(c.oid, a.attnum) AS remark, pg_catalog.obj_description(c.oid) AS table_remark,
       coalesce(array_position(i.indkey::int2[], a.attnum), 0) AS key_place, a.attnum AS place
FROM pg_catalog.pg_class c JOIN pg_catalog.pg_namespace n ON n.oid = c.relnamespace
JOIN pg_catalog.pg_attribute a ON a.attrelid = c.oid AND a.attnum > 0 AND NOT a.attisdropped
JOIN pg_catalog.pg_type t ON t.oid = a.atttypid
LEFT JOIN pg_catalog.pg_type b ON b.oid = t.typbasetype
LEFT JOIN pg_catalog.pg_type e ON e.oid = coalesce(nullif(b.typelem, 0), t.typelem) AND t.typcategory = 'A'
LEFT JOIN pg_catalog.pg_index i ON i.indrelid = c.oid AND i.indisprimary
WHERE n.nspname = '{schema}' AND c.relname = '{table}'
"""
MYSQL_COLUMNS = """
SELECT c.COLUMN_NAME AS column_name, c.COLUMN_TYPE AS declared, 0 AS dims, c.COLUMN_COMMENT AS remark, t.TABLE_COMMENT AS table_remark,
       coalesce(k.ORDINAL_POSITION, 0) AS key_place, c.ORDINAL_POSITION AS place
FROM information_schema.COLUMNS c JOIN information_schema.TABLES t ON t.TABLE_SCHEMA = c.TABLE_SCHEMA AND t.TABLE_NAME = c.TABLE_NAME
LEFT JOIN information_schema.KEY_COLUMN_USAGE k ON k.TABLE_SCHEMA = c.TABLE_SCHEMA AND k.TABLE_NAME = c.TABLE_NAME
 AND k.COLUMN_NAME = c.COLUMN_NAME AND k.CONSTRAINT_NAME = 'PRIMARY'
WHERE c.TABLE_SCHEMA = '{schema}' AND c.TABLE_NAME = '{table}'
"""
PG_TABLES = "SELECT schemaname AS table_schema, tablename AS table_name FROM pg_catalog.pg_tables"
MYSQL_TABLES = "SELECT TABLE_SCHEMA AS table_schema, TABLE_NAME AS table_name FROM information_schema.TABLES WHERE TABLE_TYPE = 'BASE TABLE'"


class Scanner:
    """Reads a source over JDBC.  ``options`` are Spark's JDBC options; they never show in the representation."""

    def __init__(self, spark: SparkSession, dialect: str, options: dict[str, str], columns_sql: str | None = None, tables_sql: str | None = None):
        self.spark, self.dialect, self.options = spark, dialect, dict(options)
        self.columns_sql = columns_sql or (PG_COLUMNS if dialect == "pg" else MYSQL_COLUMNS)
        self.tables_sql = tables_sql or (PG_TABLES if dialect == "pg" else MYSQL_TABLES)

    def __repr__(self) -> str:
        return f"Scanner({self.dialect}, {self.options.get('url', '').split('?')[0].split(';')[0]})"

    def query(self, sql: str) -> DataFrame:
        return self.spark.read.format("jdbc").options(**self.options).option("query", sql).load()

    def table(self, name: str, partition_column: str | None = None, lower: int = 0, upper: int = 0, partitions: int = 1) -> DataFrame:
        """The rows of ``schema.table``; filters and columns are pushed to the source.  A numeric column splits the read."""
        reader = self.spark.read.format("jdbc").options(**self.options).option("dbtable", name)
        if partition_column and partitions > 1:
            reader = reader.options(partitionColumn=partition_column, lowerBound=lower, upperBound=upper, numPartitions=partitions)
        return reader.load()

    def ready(self, name: str) -> bool:
        """Whether a row of a table can be read."""
        try:
            self.table(name).limit(1).collect()
        except Exception:  # noqa: BLE001  any failure of the source means: not readable now
            return False
        return True

    def tables(self) -> list[str]:
        found = self.query(self.tables_sql).toDF("table_schema", "table_name")
        return sorted(f"{r[0]}.{r[1]}" for r in found.collect())

    def definition(self, name: str) -> Definition | None:
        """Columns in order with Spark types, key in its order, comments; None if the table is gone."""
        schema, _, table = name.partition(".")
        rows = self.query(self.columns_sql.format(schema=schema.replace("'", "''"), table=table.replace("'", "''")))
        rows = rows.toDF("column_name", "declared", "dims", "remark", "table_remark", "key_place", "place").orderBy("place").collect()
        if not rows:
            return None
        kind = (lambda r: pg_type(r["declared"], r["dims"])) if self.dialect == "pg" else (lambda r: mysql_type(r["declared"]))
        keys = [r["column_name"] for r in sorted(rows, key=lambda r: r["key_place"]) if r["key_place"]]
        comments = {r["column_name"]: r["remark"] for r in rows if r["remark"]}
        return Definition([(r["column_name"], kind(r)) for r in rows], keys, rows[0]["table_remark"] or None, comments)

    def load(self, name: str, definition: Definition) -> DataFrame:
        """Current rows cast to the definition's types; columns are matched without regard to case."""
        rows = self.table(name)
        have = {c.lower(): c for c in rows.columns}
        return rows.select(*[(F.col(have[n.lower()]) if n.lower() in have else F.lit(None)).cast(t).alias(n) for n, t in definition.columns])
