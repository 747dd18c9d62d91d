"""Endpoint lists from several places, of which some may fail."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlake.operators.pool import parse_endpoints
from postlake.session import shared_folder
from postlake.sources.readers import read_lines

_LINES = "pos bigint, line string, src_idx bigint"


def load_sources(spark: SparkSession, paths: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """``(endpoint, src_idx, pos)`` of the list files that can be read, and ``(src_idx, path, ok, reason)`` of all.

    Every source is read and stored on its own, so one that is missing or corrupt takes nothing from the
    others; an endpoint belongs to the earliest readable source that lists it. Without any readable source
    there are no endpoints.
    """
    read, status = [], []
    for i, path in enumerate(paths):
        folder = shared_folder(spark, "source-lines")
        try:
            read_lines(spark, path).withColumn("src_idx", F.lit(i).cast("bigint")).write.parquet(folder)
        except (PySparkException, Py4JJavaError) as error:
            status.append((i, path, False, str(error).strip().splitlines()[0][:500]))
        else:
            read.append(spark.read.schema(_LINES).parquet(folder))
            status.append((i, path, True, None))
    lines = reduce(DataFrame.unionByName, read, spark.createDataFrame([], _LINES))
    listed = spark.createDataFrame(status, "src_idx bigint, path string, ok boolean, reason string")
    return parse_endpoints(lines, "line", ("src_idx", "pos")), listed
