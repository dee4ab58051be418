"""Small fixed frames."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def literal_rows(spark: SparkSession, names: list[str], rows: list[tuple]) -> DataFrame:
    """A handful of fixed rows as part of the plan, with a known small size."""
    structs = [
        F.struct(*[F.lit(value).alias(name) for name, value in zip(names, row)]) for row in rows
    ]
    return spark.range(1).select(F.inline(F.array(*structs)))
