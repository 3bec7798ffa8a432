"""The row operators and the captioner on streams; both are stateless."""

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pixsieve import schema as S
from pixsieve.operators.annotate import annotate_each
from pixsieve.plans.pipeline import QualityPipeline
from pixsieve.session import scratch_path

# Fixed values of the online answer.
DEFAULT_REQUEST_ID = "online_sample"
PATH_REQUIRED = "image_path is required"


def parse_requests(lines: DataFrame) -> DataFrame:
    """``sample_id, image_path`` of JSON requests; the id has a default if its key is absent."""
    request = F.from_json("value", S.REQUEST_SCHEMA, {"mode": "FAILFAST"})
    named = F.array_contains(F.json_object_keys("value"), "sample_id")
    parsed = lines.withColumn("request", request)
    return parsed.select(
        F.when(named, F.col("request.sample_id")).otherwise(F.lit(DEFAULT_REQUEST_ID)).alias("sample_id"),
        F.col("request.image_path").alias("image_path"),
    )


def annotate_requests(lines: DataFrame, make_captioner: Callable, **options) -> DataFrame:
    """One answer per request, each a batch of its own; works on a table and on a stream.

    A request without a path is answered without the captioner; of its columns only the id,
    the status and the error are set.
    """
    return annotate_each(
        parse_requests(lines), make_captioner, path_required=PATH_REQUIRED, **options
    )


def quality_stream(samples: DataFrame, chain: QualityPipeline) -> DataFrame:
    """A chain on a stream of samples: the same column expressions, no state.

    Every micro-batch reads the image table again, so build the chain on a written one.
    """
    return chain.run(samples)


def run_to_end(stream: DataFrame, path: str | None = None, on_batch: Callable | None = None) -> DataFrame:
    """Process all data available now, append it to parquet and return the result as a table.

    With ``on_batch(df, batch_id)`` each micro-batch is written and then handed on, for
    metrics per batch; a batch that is tried again overwrites its own folder.
    """
    spark = stream.sparkSession
    path = path or scratch_path(spark, "stream")
    writer = stream.writeStream.trigger(availableNow=True).option(
        "checkpointLocation", scratch_path(spark, "stream-state")
    )
    if on_batch is None:
        query = writer.format("parquet").outputMode("append").start(path)
        query.awaitTermination()
        return spark.read.schema(stream.schema).parquet(path)

    def write(batch: DataFrame, batch_id: int) -> None:
        part = f"{path}/batch={batch_id}"
        batch.write.mode("overwrite").parquet(part)
        on_batch(batch.sparkSession.read.schema(batch.schema).parquet(part), batch_id)

    writer.foreachBatch(write).start().awaitTermination()
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stream.schema)
    return spark.read.schema(f"{fields}, batch int").parquet(path).drop("batch")
