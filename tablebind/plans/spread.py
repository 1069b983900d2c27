"""Work per core when the input comes in few pieces."""

from pyspark.sql import DataFrame


def spread(df: DataFrame) -> DataFrame:
    """``df`` with at least one partition per core.

    Regular expressions over long texts are bound by the processor, and a file of one row
    group is read by one task. Only inputs of fewer partitions than cores are shuffled;
    any large table has more and is returned as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.isStreaming or df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores)
