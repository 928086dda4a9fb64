"""Reading, mapping and registering the transactions table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskweave.schema import TRANSACTIONS

# Spark's CSV writer keeps only milliseconds of a zone-less timestamp unless told otherwise.
CSV_TIME_OUT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def without_nan(rows: DataFrame) -> DataFrame:
    """NaN is a missing value wherever a row comes from; it would otherwise spread through sums and averages."""
    numbers = [f.name for f in rows.schema if isinstance(f.dataType, T.DoubleType)]
    return rows.withColumns({n: F.nanvl(n, F.lit(None).cast("double")) for n in numbers})


def read_csv(spark: SparkSession, path: str, schema: T.StructType = TRANSACTIONS) -> DataFrame:
    """CSV with a header, read against a fixed schema: no inference pass over the data."""
    return without_nan(spark.read.schema(schema).option("header", True).csv(path))


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("timestampNTZFormat", CSV_TIME_OUT).csv(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return without_nan(spark.read.schema(TRANSACTIONS).parquet(path))


def load_table(df: DataFrame, name: str = "transactions", *, view: bool = False, path: str | None = None) -> DataFrame:
    """Create or replace the catalog table (or session view) and return it; ``path`` keeps the table's files there."""
    if view:
        df.createOrReplaceTempView(name)
    else:
        writer = df.write.mode("overwrite").format("parquet")
        (writer if path is None else writer.option("path", path)).saveAsTable(name)
    return df.sparkSession.table(name)


def map_columns(df: DataFrame, mapping: dict[str, str | Column]) -> DataFrame:
    """Shape a foreign table to the transactions schema.

    ``mapping`` gives an SQL text or column for every target column it can supply. Each is cast to
    the schema type; missing optional columns become null. Id, customer, amount and time are required.
    """
    names = {f.name for f in TRANSACTIONS}
    unknown = set(mapping) - names
    missing = {"transaction_id", "customer_id", "amount", "transaction_time"} - set(mapping)
    if unknown or missing:
        raise ValueError(f"unknown target columns {sorted(unknown)}, missing required {sorted(missing)}")

    def target(field: T.StructField) -> Column:
        source = mapping.get(field.name)
        column = F.expr(source) if isinstance(source, str) else F.lit(None) if source is None else source
        return column.cast(field.dataType).alias(field.name)

    return without_nan(df.select(*[target(f) for f in TRANSACTIONS]))


def _usable() -> Column:
    keys = ("transaction_id", "customer_id", "transaction_time")
    usable = F.lit(True)
    for key in keys:
        usable = usable & F.col(key).isNotNull()
    return usable


def keyed_rows(df: DataFrame) -> DataFrame:
    """Rows that have an id, a customer and a time; history features are undefined without them."""
    return df.filter(_usable())


def rejected_rows(df: DataFrame) -> DataFrame:
    """Rows ``keyed_rows`` leaves out, kept so that they can be counted and inspected."""
    return df.filter(~_usable())
