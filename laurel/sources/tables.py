"""File sources and sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

MODES = {"replace": "overwrite", "append": "append", "skip": "ignore"}


def read_table(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """CSV with a header line. Values that do not fit the schema become NULL.

    The scan is split by `spark.sql.files.maxPartitionBytes`, so a file of any size is read by many
    tasks; multi-line fields would forbid that and are not read.
    """
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .option("enforceSchema", True)
        .csv(path)
    )


def read_parquet(spark: SparkSession, path: str, columns: Sequence[str] = ()) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def read_path_sql(spark: SparkSession, path: str, columns: str = "*", file_format: str = "parquet") -> DataFrame:
    """Query a file by its path inside SQL."""
    return spark.sql(f"SELECT {columns} FROM {file_format}.`{path}`")


def read_literal(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """Dimension table from rows in the program text. The rows are constants of the plan."""
    fields = T.DataType.fromDDL(schema).fields
    constants = F.array(
        *[
            F.struct(*[F.lit(x).cast(f.dataType).alias(f.name) for x, f in zip(row, fields)])
            for row in rows
        ]
    )
    return spark.range(1).select(F.inline(constants))


def write_table(df: DataFrame, path: str, mode: str = "replace", file_format: str = "parquet", **options) -> None:
    """Write a table: `replace` an old one, `append` to it, or `skip` when there is one."""
    writer = df.write.mode(MODES[mode])
    if file_format == "csv":
        writer = writer.option("header", True)
    writer.options(**options).format(file_format).save(path)


def write_gzip_csv(df: DataFrame, path: str, mode: str = "replace") -> None:
    """CSV in gzip files. Gzip cannot be split: a reader gets one task per file, so keep many files."""
    write_table(df, path, mode, "csv", compression="gzip")


def copy_through(spark: SparkSession, source: str, target: str, file_format: str = "parquet") -> None:
    """Copy a table unchanged; every task reads and writes its own splits."""
    spark.read.format(file_format).load(source).write.mode("overwrite").format(file_format).save(target)
