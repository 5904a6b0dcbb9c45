"""Inline rows with named columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from basketry.schema import BEHAVIOUR_NAMES


def behaviour_names(spark: SparkSession) -> DataFrame:
    """The four behaviour codes and their names as a (tiny, fixed) table."""
    schema = T.StructType([T.StructField("behavior_type", T.IntegerType(), False), T.StructField("behavior", T.StringType(), False)])
    return spark.createDataFrame(sorted(BEHAVIOUR_NAMES.items()), schema)
