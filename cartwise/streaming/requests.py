"""Request-driven recommendations as a Structured Streaming query.

The online look-up (one user id in, the user's products above the serving
threshold out, or "no history") becomes a stream of request rows answered from
the batch-scored recommendation table.  That table is written by
``write_answer_tables`` in ``USER_PARTS`` partitions of user ids; a micro-batch
reads only the partitions of the users it asks for (at most USER_PARTS numbers
reach the driver), so its cost follows the requests and not the table.

Every batch writes its own ``batch=<id>`` folder, replacing it: a batch that is
repeated after a failure leaves the same answers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

REQUEST_SCHEMA = T.StructType([
    T.StructField("request_id", T.LongType()),
    T.StructField("user_id", T.LongType()),
])
USER_PARTS = 256
MAX_FILES = 64


def user_part(user: str = "user_id", parts: int = USER_PARTS) -> Column:
    return F.pmod(F.xxhash64(F.col(user).cast("long")), F.lit(parts)).cast("int")


def write_answer_tables(recommendations: DataFrame, scored_users: DataFrame, recommendations_dir: str,
                        scored_users_dir: str, parts: int = USER_PARTS) -> None:
    """Write the two static tables partitioned by ``user_part``."""
    for df, path in ((recommendations, recommendations_dir), (scored_users, scored_users_dir)):
        (df.withColumn("user_part", user_part(parts=parts)).repartition("user_part")
         .write.mode("overwrite").partitionBy("user_part").parquet(path))


def answer_requests(requests: DataFrame, recommendations: DataFrame, scored_users: DataFrame) -> DataFrame:
    """Answers of a request frame: one row per recommended product, or one row
    without a product (``has_history`` tells the two empty cases apart).

    ``recommendations``: user_id, rec_rank, product_id, product_name, probability, aisle_id
    ``scored_users``: user_id, n_recommended — one row per user with history.
    """
    users = scored_users.select("user_id", F.col("n_recommended").alias("count"),
                                F.lit(True).alias("has_history"))
    recs = recommendations.select("user_id", "rec_rank", "product_id", "product_name", "probability", "aisle_id")
    return (requests.join(users, "user_id", "left")
            .join(recs, "user_id", "left")
            .select("request_id", "user_id",
                    F.coalesce("has_history", F.lit(False)).alias("has_history"),
                    F.coalesce("count", F.lit(0).cast("long")).alias("count"),
                    "rec_rank", "product_id", "product_name", "probability", "aisle_id"))


def _of_parts(spark: SparkSession, path: str, parts: list[int]) -> DataFrame:
    return spark.read.parquet(path).where(F.col("user_part").isin(parts)).drop("user_part")


def run_request_stream(spark: SparkSession, requests_dir: str, recommendations_dir: str,
                       scored_users_dir: str, sink_dir: str, checkpoint_dir: str,
                       available_now: bool = True, processing_time: str | None = None,
                       max_files: int = MAX_FILES, parts: int = USER_PARTS):
    """Start the stream: Parquet request files in, Parquet answers out
    (``read_answers``).

    With ``available_now`` the query processes every pending request file in
    micro-batches of at most ``max_files`` files and stops (the batch-style
    trigger used in tests and scheduled runs); otherwise it keeps running on
    ``processing_time``.  The static tables are read anew for each batch, so
    refreshing them changes answers without restarting the stream.
    """
    requests = spark.readStream.schema(REQUEST_SCHEMA).option("maxFilesPerTrigger", max_files).parquet(requests_dir)

    def answer(batch: DataFrame, batch_id: int) -> None:
        s = batch.sparkSession
        asked = [r["p"] for r in batch.select(user_part(parts=parts).alias("p")).distinct().collect()]  # <= parts
        out = answer_requests(batch, _of_parts(s, recommendations_dir, asked), _of_parts(s, scored_users_dir, asked))
        out.write.mode("overwrite").parquet(f"{sink_dir}/batch={batch_id}")

    writer = requests.writeStream.foreachBatch(answer).option("checkpointLocation", checkpoint_dir)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime=processing_time or "10 seconds")
    return writer.start()


def read_answers(spark: SparkSession, sink_dir: str) -> DataFrame:
    return spark.read.option("basePath", sink_dir).parquet(sink_dir).drop("batch")
