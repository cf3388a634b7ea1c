"""Table scans, multi-table loading and key inspection."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from viewtide.functions.missing import missing, quoted
from viewtide.schemas import JOIN_KEYS, TABLE_FILES, TABLE_SCHEMAS


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def read_csv(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """A header CSV. With a schema the file is read once and its header checked;
    without one an extra pass infers the types.
    """
    reader = spark.read.option("header", True)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    return reader.option("enforceSchema", False).schema(schema).csv(path)


REJECTED = "__rejected"


def csv_with_rejects(
    spark: SparkSession, path: str, schema: StructType, header: bool = True
) -> tuple[DataFrame, DataFrame]:
    """A CSV's rows that fit ``schema``, and the lines that do not, as (line, file).

    A line is rejected if it has more or fewer fields than the schema, or a field that is not
    of its type. Every line is in one of the two.
    """
    rescued = StructType([*schema.fields]).add(REJECTED, "string")
    reader = spark.read.option("header", header).option("mode", "PERMISSIVE")
    reader = reader.option("columnNameOfCorruptRecord", REJECTED)
    # Without this, a line's fate would depend on the columns a query uses.
    rows = reader.option("columnPruning", False).schema(rescued).csv(path)
    rows = rows.withColumn("__file", F.col("_metadata.file_path"))
    # Always true: Spark refuses to read nothing but rejected text.
    parsed = F.hash(*[quoted(f.name) for f in schema.fields]) >= F.lit(-(1 << 31))
    good = rows.filter(F.col(REJECTED).isNull() & parsed).drop(REJECTED, "__file")
    rejected = rows.filter(F.col(REJECTED).isNotNull() & parsed)
    return good, rejected.select(F.col(REJECTED).alias("line"), F.col("__file").alias("file"))


def load_tables(
    spark: SparkSession,
    base: str,
    files: Mapping[str, str] = TABLE_FILES,
    schemas: Mapping[str, StructType] | None = None,
) -> dict[str, DataFrame]:
    """Lazily open ``{name: file}`` below ``base``; any path scheme Spark knows.

    Tables with a documented schema must have its columns; the others are inferred. Other
    ``schemas``, or none, may be given.
    """
    schemas = TABLE_SCHEMAS if schemas is None else schemas
    return {
        name: read_csv(spark, f"{base.rstrip('/')}/{file}", schemas.get(name))
        for name, file in files.items()
    }


def table_shapes(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows and columns of every table, as one job."""
    return union_all(
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count", F.lit(len(df.columns)).alias("column_count")
        )
        for name, df in tables.items()
    )


def key_columns(df: DataFrame, candidates: Iterable[str] = JOIN_KEYS) -> list[str]:
    return [name for name in candidates if name in df.columns]


def key_columns_report(
    tables: Mapping[str, DataFrame], candidates: Iterable[str] = JOIN_KEYS
) -> DataFrame:
    """One row per table and join key found: type, rows, rows lacking the key."""
    reports = []
    for table, df in tables.items():
        keys = key_columns(df, candidates)
        if not keys:
            continue
        totals = df.agg(
            F.count(F.lit(1)).alias("row_count"),
            *[F.count_if(missing(df, key)).alias(f"missing_{i}") for i, key in enumerate(keys)],
        )
        rows = [
            F.struct(
                F.lit(table).alias("table_name"),
                F.lit(key).alias("key_column"),
                F.lit(df.schema[key].dataType.simpleString()).alias("data_type"),
                F.col("row_count"),
                F.col(f"missing_{i}").alias("missing_count"),
            )
            for i, key in enumerate(keys)
        ]
        reports.append(totals.select(F.inline(F.array(*rows))))
    return union_all(reports)


def sample_keys(df: DataFrame, rows: int = 3) -> DataFrame:
    """A look at the join keys of a few rows."""
    return df.select(*[quoted(key) for key in key_columns(df)]).limit(rows)


def orphan_keys(fact: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Fact keys without a dimension row, with the fact rows they stand for.

    The fact is reduced to one row per key before the anti join, so a hot key
    is counted map-side and never gathers in one join task.
    """
    counted = fact.groupBy(key).agg(F.count(F.lit(1)).alias("fact_rows"))
    return counted.join(dimension.select(key), key, "left_anti")
