"""Running statistics of records that arrive as files, read once each."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def arriving(spark: SparkSession, folder: str) -> DataFrame:
    """Stream of record texts below a folder, with their stage."""
    files = spark.readStream.option("wholetext", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").text(folder)
    return files.select(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2).alias("stage"), F.col("value").alias("record"))


def stage_counts(records: DataFrame) -> DataFrame:
    """Per stage: records, those that are no JSON object, and blurry pages."""
    v = F.try_parse_json("record")
    return records.groupBy("stage").agg(
        F.count("*").alias("n"), F.count_if(v.isNull()).alias("malformed"),
        F.count_if(F.coalesce(F.try_variant_get(v, "$.is_blurry", "boolean"), F.lit(False))).alias("blurry"),
    )


def run_available(counts: DataFrame, name: str, checkpoint: str) -> StreamingQuery:
    """Take in what has arrived since the last run and stop; the totals are the table ``name``, written by executors."""

    def write(batch: DataFrame, _: int) -> None:
        batch.write.mode("overwrite").saveAsTable(name)

    query = counts.writeStream.outputMode("complete").foreachBatch(write).option("checkpointLocation", checkpoint)
    started = query.trigger(availableNow=True).start()
    started.awaitTermination()
    return started
