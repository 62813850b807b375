"""Tables the catalog knows."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Schemas that hold no data of ours.
SYSTEM_SCHEMAS = ("information_schema", "hive_metastore")


def list_tables(
    spark: SparkSession, catalog: str = "spark_catalog", excluded: Iterable[str] = SYSTEM_SCHEMAS
) -> DataFrame:
    """``table_catalog, table_schema, table_name`` of a catalog, without system schemas."""
    schemas = [r.namespace for r in spark.sql(f"SHOW SCHEMAS IN `{catalog}`").collect()]
    listings = [
        spark.sql(f"SHOW TABLES IN `{catalog}`.`{s}`").where(~F.col("isTemporary")).select(
            F.lit(catalog).alias("table_catalog"),
            F.col("namespace").alias("table_schema"),
            F.col("tableName").alias("table_name"),
        )
        for s in schemas
        if s not in set(excluded)
    ]
    if not listings:
        return spark.createDataFrame([], "table_catalog string, table_schema string, table_name string")
    return reduce(DataFrame.unionByName, listings)
