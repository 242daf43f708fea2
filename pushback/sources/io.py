"""Scans and sinks of the pipeline's stage files.

Every read passes an explicit schema (no inference); every write is a Spark
writer into a folder, so stages restart from files after a failure.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pushback import profile as P

_INT = {"YEAR", "MONTH", "DAY", "DAY_OF_WEEK", "SCHEDULED_DEPARTURE", "DEPARTURE_TIME",
        "WHEELS_OFF", "WHEELS_ON", "SCHEDULED_ARRIVAL", "ARRIVAL_TIME", "DIVERTED", "CANCELLED"}
_LONG = {"FLIGHT_NUMBER"}
_STR = set(P.STRING_COLUMNS)


def flights_schema() -> T.StructType:
    """The 31 raw flight columns; airport codes are strings (numeric ids occur)."""
    def t(c):
        if c in _INT:
            return T.IntegerType()
        if c in _LONG:
            return T.LongType()
        if c in _STR:
            return T.StringType()
        return T.DoubleType()
    return T.StructType([T.StructField(c, t(c)) for c in P.BTS_COLUMNS])


def read_flights_csv(spark: SparkSession, path: str, schema: T.StructType | None = None
                     ) -> DataFrame:
    """A1: header CSV with an explicit schema; NaN text is read as NULL."""
    return (spark.read.option("header", True).option("nanValue", "NaN")
                 .schema(schema or flights_schema()).csv(path))


def read_airport_coords(spark: SparkSession, path: str) -> DataFrame:
    """A2: airports with both coordinates, one row per code.

    The reference keeps the last duplicate of a code; files have no order in
    Spark, so a duplicate code keeps its largest (LATITUDE, LONGITUDE).
    """
    schema = "IATA_CODE string, LATITUDE double, LONGITUDE double"
    df = spark.read.option("header", True).schema(schema).csv(path)
    return (df.dropna(subset=["LATITUDE", "LONGITUDE"])
              .groupBy("IATA_CODE")
              .agg(F.max(F.struct("LATITUDE", "LONGITUDE")).alias("c"))
              .select("IATA_CODE", "c.LATITUDE", "c.LONGITUDE"))


def read_codes(spark: SparkSession, path: str, column: str = "IATA_CODE") -> DataFrame:
    """A3: distinct non-null codes of a dimension file."""
    df = spark.read.option("header", True).schema(f"{column} string").csv(path)
    return df.select(column).dropna().distinct()


def save_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Stage output (cleaned table) to a folder; CSV at the edges if asked."""
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.format(fmt).save(path)


def save_feature_artifacts(train: DataFrame, test: DataFrame, path: str) -> None:
    """Both matrices in one table partitioned by split (labels stay on the rows)."""
    both = (train.withColumn("split", F.lit("train"))
                 .unionByName(test.withColumn("split", F.lit("test")), allowMissingColumns=True))
    both.write.mode("overwrite").partitionBy("split").parquet(path)


def load_feature_artifacts(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(train, test); partition pruning reads only the requested split."""
    df = spark.read.parquet(path)
    return (df.filter(F.col("split") == "train").drop("split"),
            df.filter(F.col("split") == "test").drop("split"))
