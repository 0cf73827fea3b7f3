"""Databases: table lists, queries, partitioned reads, exports."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from laurel.sources.tables import write_table

# How server databases list their tables.
LIST_TABLES = {
    "postgresql": "SELECT table_name FROM information_schema.tables WHERE table_schema = 'public'",
    "sqlite": "SELECT name AS table_name FROM sqlite_master WHERE type = 'table'",
}


class JdbcDatabase:
    """A database behind a JDBC driver. `options` holds url, driver, user and password."""

    def __init__(self, spark: SparkSession, options: Mapping[str, str], kind: str = "postgresql"):
        self.spark, self.options, self.kind = spark, dict(options), kind

    def query(self, sql: str) -> DataFrame:
        return self.spark.read.format("jdbc").options(**self.options).option("query", sql).load()

    def list_tables(self) -> list[str]:
        return sorted(r[0] for r in self.query(LIST_TABLES[self.kind]).collect())

    def read(self, table: str, partition_column: str | None = None, partitions: int = 32) -> DataFrame:
        """Whole table; with an integer `partition_column` in `partitions` parallel ranges."""
        reader = self.spark.read.format("jdbc").options(**self.options).option("dbtable", table)
        if partition_column:
            low, high = self.query(
                f"SELECT MIN({partition_column}), MAX({partition_column}) FROM {table}"
            ).first()
            if low is not None:
                reader = reader.options(
                    partitionColumn=partition_column,
                    lowerBound=low,
                    upperBound=high + 1,
                    numPartitions=partitions,
                )
        return reader.load()


class CatalogDatabase:
    """The session catalog as a database: tables and views registered in Spark."""

    def __init__(self, spark: SparkSession, database: str | None = None):
        self.spark, self.database = spark, database

    def query(self, sql: str) -> DataFrame:
        return self.spark.sql(sql)

    def list_tables(self, prefix: str = "") -> list[str]:
        names = [t.name for t in self.spark.catalog.listTables(self.database)]
        return sorted(n for n in names if n.startswith(prefix))

    def read(self, table: str) -> DataFrame:
        return self.spark.table(table)


def export_database(
    read: Callable[[str], DataFrame],
    tables: Iterable[str],
    folder: str,
    exclude: Iterable[str] = (),
    file_format: str = "csv",
) -> dict[str, str]:
    """Write each table that is not excluded below `folder`; a table that fails does not stop the rest.

    Returns a status per table: `written`, `excluded`, or the text of the failure.
    """
    skipped, status = set(exclude), {}
    for table in tables:
        if table in skipped:
            status[table] = "excluded"
            continue
        try:
            write_table(read(table), f"{folder}/{table}", "replace", file_format)
            status[table] = "written"
        except Exception as failure:  # reported per table, as one bad table must not stop an export
            status[table] = f"failed: {failure}"
    return status


def exported_counts(spark: SparkSession, folder: str, status: Mapping[str, str]) -> DataFrame:
    """Rows per exported CSV table."""
    counts = [
        spark.read.option("header", True).csv(f"{folder}/{table}").select(F.lit(table).alias("table_name"))
        for table, state in status.items()
        if state == "written"
    ]
    if not counts:
        return spark.createDataFrame([], "table_name string, rows long")
    union = counts[0]
    for c in counts[1:]:
        union = union.unionAll(c)
    return union.groupBy("table_name").agg(F.count(F.lit(1)).alias("rows"))
