"""Table loaders (S1): parquet by default, JDBC as the alternative for a relational source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


# Declared schemas of the input tables (the columns this library reads). Declaring them skips the
# schema-inference job a parquet read otherwise starts, and pins the types the code relies on.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_nationkey int",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz",
    "lineitem": ("l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                 "l_extendedprice double, l_returnflag string, l_linestatus string"),
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def read_parquet(spark: SparkSession, path: str, columns: list[str] | None = None,
                 schema: str | None = None) -> DataFrame:
    """Parquet scan; selecting ``columns`` here keeps the scan's ReadSchema narrow."""
    reader = spark.read.schema(schema) if schema else spark.read
    df = reader.parquet(path)
    return df.select(*columns) if columns else df


def read_table(spark: SparkSession, base_dir: str, name: str,
               columns: list[str] | None = None) -> DataFrame:
    """``{base_dir}/{name}.parquet`` with its declared schema when one is known."""
    return read_parquet(spark, f"{base_dir.rstrip('/')}/{name}.parquet", columns, SCHEMAS.get(name))


def read_jdbc(spark: SparkSession, url: str, table: str, partition_column: str | None = None,
              lower_bound: int | None = None, upper_bound: int | None = None,
              num_partitions: int | None = None, properties: dict | None = None) -> DataFrame:
    """Relational table through JDBC, split into ``num_partitions`` parallel range reads.

    Without a partition column the read is a single task, so large tables should always pass one
    (``batch_id`` for the landing table, a numeric surrogate for the others).
    """
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    if partition_column is not None:
        if None in (lower_bound, upper_bound, num_partitions):
            raise ValueError("partitioned JDBC reads need lower_bound, upper_bound and num_partitions")
        reader = (reader.option("partitionColumn", partition_column)
                  .option("lowerBound", str(lower_bound)).option("upperBound", str(upper_bound))
                  .option("numPartitions", str(num_partitions)))
    return reader.load()
