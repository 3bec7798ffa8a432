"""Build a manifest from image metadata, region descriptions and the images at hand."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pixsieve import schema as S
from pixsieve.functions import format_id, strip


def first_phrase(regions: str = "regions"):
    """Trimmed phrase of the first region; empty when it has none."""
    first = F.get(F.col(regions), F.lit(0))
    return strip(F.coalesce(first.phrase, F.lit("")))


def build_manifest(
    metadata: DataFrame,
    regions: DataFrame,
    images: DataFrame | None = None,
    image_dir: str = "data/visual_genome/images",
    limit: int | None = 1000,
) -> DataFrame:
    """The first ``limit`` usable images in metadata order, with ``pos`` to sort by.

    ``metadata``: ``pos, image_id, url, width, height``; ``regions``: ``pos, id, regions``, where
    of several rows with one id the last counts; ``images``: ``path`` of the files at hand
    (``None``: all are). An image needs a region whose first phrase is not blank.
    """
    # Only the first phrase of a list is needed: cut before the shuffle, keep the last per id.
    phrases = regions.select("id", "pos", first_phrase().alias("text")).groupBy("id").agg(
        F.max_by("text", "pos").alias("text")
    ).filter("text <> ''")
    joined = metadata.join(phrases, metadata.image_id == phrases.id).select(
        "pos",
        F.lit(S.MANIFEST_SOURCE).alias("source"), "image_id",
        F.concat(F.lit(image_dir.rstrip("/") + "/"), format_id("image_id", S.ID_PREFIX), F.lit(".jpg"))
        .alias("image_path"),
        F.col("url").alias("image_url"), "width", "height", "text",
    )
    if images is not None:
        joined = joined.join(images.select(F.col("path").alias("image_path")), "image_path", "left_semi")
    if limit is not None:
        joined = joined.orderBy("pos").limit(limit)
    return joined.select("pos", *S.MANIFEST_SCHEMA.fieldNames())
