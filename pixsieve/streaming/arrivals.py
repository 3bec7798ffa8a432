"""Verdicts on samples whose image files arrive over time."""

from collections.abc import Callable

from pyspark.ml.image import ImageSchema
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pixsieve import schema as S
from pixsieve.operators.row import resolve_image_path
from pixsieve.plans.pipeline import QualityPipeline
from pixsieve.session import scratch_path, write_table
from pixsieve.sources.images import image_features, image_rows, list_images, open_images

MakeChain = Callable[[DataFrame], QualityPipeline]


def image_stream(
    spark: SparkSession, path: str, base_dir: str = "", files_a_batch: int | None = None, listing: str | None = None
) -> DataFrame:
    """The image source as a stream of new files under ``path``.

    Spark's source keeps the names of all files it has seen on the driver. With ``listing``, a folder that lasts as long as the stream's
    progress, their names are kept there instead, and the stream is of the files that are there at this call; call again for later ones.
    Files are then opened as in ``measure_listed``.
    """
    if listing is not None:
        return _listed_stream(spark, path, base_dir, files_a_batch, listing)
    reader = spark.readStream.format("image").schema(ImageSchema.imageSchema)
    if files_a_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_a_batch)
    return image_rows(reader.load(path), base_dir)


def _listed_stream(spark: SparkSession, path: str, base_dir: str, files_a_batch: int | None, listing: str) -> DataFrame:
    """Each file of names is a micro-batch; names that are new are added, the others stay in the files they are in."""
    layout = "path string, place string"
    found = list_images(spark, path, base_dir, recursive=False).select("path", "place")
    place = spark._jvm.org.apache.hadoop.fs.Path(listing)
    seen = place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)
    if seen:
        known = spark.read.schema(layout).parquet(listing).select("place")
        found = write_table(found.join(known, "place", "left_anti").select("path", "place"), "new-files")
    if not seen or not found.isEmpty():
        writer = found.coalesce(1).write.mode("append")
        if files_a_batch is not None:
            writer = writer.option("maxRecordsPerFile", files_a_batch)
        writer.parquet(listing)
    return open_images(spark.readStream.schema(layout).option("maxFilesPerTrigger", 1).parquet(listing))


class ArrivingImages:
    """Judges samples as soon as their file is there.

    Every micro-batch measures its files and judges only the samples that wait for one of them. Measures and
    verdicts of a batch go to a folder with its number, so a batch that is tried again replaces what it
    wrote. Until its file arrives a sample counts as judged without one (``missing_image``); a later
    batch overrules an earlier one.

    ``make_chain(features)`` builds the chain; ``path`` holds the verdicts and the stream's progress between runs.
    """

    def __init__(self, samples: DataFrame, make_chain: MakeChain, path: str | None = None, image_dir: str = "outputs/images", **measuring):
        self.samples, self.make_chain, self.measuring = samples, make_chain, measuring
        self.spark, self.image_dir = samples.sparkSession, image_dir
        self.path = path or scratch_path(self.spark, "arrivals")

    def judge_batch(self, images: DataFrame, batch_id: int) -> None:
        """The work of one micro-batch; the same batch may come again."""
        spark = images.sparkSession
        place = f"{self.path}/features/batch={batch_id}"
        features = image_features(images, **self.measuring)
        if not self.measuring.get("make_encoder"):
            features = features.drop("image_embedding")
        features.write.mode("overwrite").parquet(place)
        features = spark.read.schema(features.schema).parquet(place)
        path = resolve_image_path(self.image_dir)
        waiting = self.samples.withColumn("_place", path).join(
            features.select(F.col("path").alias("_place")), "_place", "left_semi"
        ).drop("_place")
        judged = self.make_chain(features).run(waiting)
        judged.write.mode("overwrite").parquet(f"{self.path}/verdicts/batch={batch_id}")

    def run_to_end(self, stream: DataFrame) -> DataFrame:
        """Take all files there are now and return the verdicts on all samples."""
        query = stream.writeStream.trigger(availableNow=True).option(
            "checkpointLocation", f"{self.path}/progress"
        ).foreachBatch(self.judge_batch).start()
        query.awaitTermination()
        return self.verdicts()

    def verdicts(self) -> DataFrame:
        """All samples: judged by their latest file, or as without one."""
        none = self.spark.createDataFrame([], S.IMAGE_FEATURE_SCHEMA)
        if not self.measuring.get("make_encoder"):
            none = none.drop("image_embedding")
        chain = self.make_chain(none)
        layout = chain.run(self.samples).schema
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in layout)
        found = self.spark.read.schema(f"{fields}, batch int")
        try:
            judged = found.parquet(f"{self.path}/verdicts")
        except Exception as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
            return chain.run(self.samples)
        # Rows are compared as a whole by batch: one row per sample stays.
        latest = judged.groupBy(S.ROW_INDEX).agg(F.max_by(F.struct(*layout.fieldNames()), "batch").alias("row")).select("row.*")
        waiting = self.samples.join(latest.select(S.ROW_INDEX), S.ROW_INDEX, "left_anti")
        return latest.unionByName(chain.run(waiting))
