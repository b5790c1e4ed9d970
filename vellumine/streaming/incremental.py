"""Documents as they arrive: the same expressions over a stream, each document once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from vellumine.functions import dates, text as tx


def arriving(spark: SparkSession, folder: str, schema: str, files: int = 100) -> DataFrame:
    """A stream over a folder of parquet files, at most ``files`` a trigger."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(folder)


def proxies(stream: DataFrame, key: str, text: str) -> DataFrame:
    """Measures of each arriving text; stateless, so late rows need nothing."""
    return stream.select(key, *[c.alias(n) for n, c in tx.proxies(text).items()], F.size(dates.date_strings(text)).cast("bigint").alias("n_dates"))


def first_deliveries(stream: DataFrame, keys: list[str], time: str, late: str = "1 day") -> DataFrame:
    """Each key once, as long as its repetition isn't later than ``late``; state is dropped after."""
    return stream.withWatermark(time, late).dropDuplicatesWithinWatermark(keys)


def per_window(stream: DataFrame, time: str, width: str, late: str, *by: str) -> DataFrame:
    """Rows and errors by time window, given out once when the window can't change any more."""
    return (
        stream.withWatermark(time, late).groupBy(F.window(time, width).alias("w"), *by)
        .agg(F.count("*").alias("n"), F.count_if(F.col("error").isNotNull()).alias("errors"))
        .select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *by, "n", "errors")
    )


def into_table(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append to a parquet folder all that is there now; what was written before is skipped."""
    return df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
