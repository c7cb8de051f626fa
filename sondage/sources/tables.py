"""Table scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def spread(scan: DataFrame) -> DataFrame:
    """Use all cores for a scan that has fewer splits than the cluster has cores.

    A file with one row group is read by one task, however many cores wait. Only
    inputs that would leave most cores idle are redistributed; a large scan is left
    as it is. ``scan`` must be a plain scan, whose number of splits is known
    without running it.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if 2 * scan.rdd.getNumPartitions() <= cores else scan


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
