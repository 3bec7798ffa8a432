"""Samples, images and runs derived from the given tables by plain arithmetic.

The tables hold vectors and texts but no images, so every document is a sample whose image is a
vector. Some vectors have copies, and missing values are spread over the ids.
"""

import re
import struct
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pixsieve import schema as S
from pixsieve.functions import format_id
from pixsieve.session import spread
from pixsieve.sources.images import image_features


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _nth(rule: int, value: Column) -> Column:
    """One id in 97, a different one per rule."""
    return F.when(F.col("id") % 97 == rule, value)


def _distinct_vectors(spark: SparkSession, sf_dir: str) -> int:
    """How many vectors the documents share: all, or half as many as there are documents."""
    return min(table(spark, sf_dir, "embeddings").count(), table(spark, sf_dir, "documents").count() // 2)


def sample_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``id, v, row_idx, image_embedding, text_embedding``, one row per document.

    Documents take the vectors in turn. From the second turn on, a third of them have near
    copies, a third other vectors and a third exact copies.
    """
    return _derived(_vector_pairs(spark, sf_dir))


def _vector_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``id, v, turn, x, x2``: each document with its vector and the partner of that vector, as they are stored."""
    n = _distinct_vectors(spark, sf_dir)
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("v"), F.col("embedding").alias("x"))
    partner = vectors.select(F.col("v").alias("v2"), F.col("x").alias("x2"))
    ids = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"), (F.col("doc_id") % n).alias("own"), F.floor(F.col("doc_id") / n).alias("turn")
    )
    # Vectors meet their partners before the documents, which are more.
    pairs = vectors.join(partner, (F.col("v") * 7 + 3) % n == F.col("v2"))
    return ids.join(pairs, F.col("own") == F.col("v")).select("id", "v", "turn", "x", "x2")


def _derived(rows: DataFrame, *others: str) -> DataFrame:
    rows = rows.withColumns({c: F.col(c).cast("array<double>") for c in ("x", "x2")})
    shifted = F.transform(
        "x", lambda c, p: c + (((F.col("v") * 31 + p * 17 + F.col("turn") * 7) % 11) - 5) / F.lit(100.0)
    )
    mixed = F.zip_with("x", "x2", lambda a, b: a + F.col("turn") * b)
    image = F.when((F.col("turn") == 0) | (F.col("v") % 3 == 2), F.col("x")).when(F.col("v") % 3 == 0, shifted).otherwise(mixed)
    rows = rows.withColumn("image_embedding", image)
    text = F.zip_with(
        "image_embedding", "x2", lambda a, b: a + (F.col("id") % 10) / F.lit(2.0) * b
    )
    return rows.select(
        "id", "v", (F.col("id") + 1).alias(S.ROW_INDEX), "image_embedding", text.alias("text_embedding"), *others
    )


def declared_size() -> list[Column]:
    return [
        (320 + (F.col("id") * 37) % 1200).cast("int").alias("width"),
        (240 + (F.col("id") * 53) % 1000).cast("int").alias("height"),
    ]


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``row_idx, id``, the sample columns, ``image_embedding`` and ``text_embedding``."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    # Stored vectors take a quarter of what is derived from them, so that comes after the join.
    rows = _derived(_vector_pairs(spark, sf_dir).join(documents, F.col("id") == F.col("doc_id")), "text")
    width, height = declared_size()
    none = F.lit(None)
    prompt = F.when(F.col("id") % 97 == 5, none).otherwise(
        F.coalesce(_nth(6, F.lit("")), F.col("text"))
    )
    path = F.when(F.col("id") % 97 == 8, none).otherwise(
        F.coalesce(_nth(9, F.lit("")), image_path())
    )
    upstream = F.col("id") % 97 == 11
    values = {
        "sample_id": F.coalesce(_nth(7, F.lit("")), format_id(S.ROW_INDEX)),
        "character": F.lit(S.MANIFEST_SOURCE), "scene": prompt, "dialogue": F.lit(""),
        "image_prompt": prompt, "emotion": F.lit(""), "action": F.lit(""),
        "visual_style": F.lit(S.REAL_IMAGE), "image_path": path,
        "width": F.when(F.col("id") % 97 != 10, width), "height": height,
        "blur_score": none.cast("double"), "clip_score": none.cast("double"),
        "status": F.when(upstream, F.lit(S.REJECTED)).otherwise(F.lit(S.PENDING)),
        "reject_reason": F.when(upstream, F.lit("upstream")),
    }
    return rows.select(
        S.ROW_INDEX, "id", *[values[c].alias(c) for c in S.SAMPLE_COLUMNS],
        "image_embedding", "text_embedding",
    )


def image_path() -> Column:
    return F.concat(F.lit("img/"), F.col("id").cast("string"), F.lit(".png"))


def pixels(vector: str = "image_embedding") -> Column:
    """One gray value per vector entry; ids that are multiples of 8 give a flat image."""
    strength = (F.col("id") % 8) / F.lit(8.0)
    return F.transform(
        vector,
        lambda a: F.greatest(F.lit(0), F.least(F.lit(255), F.floor(128 + a * 127 * strength))).cast("int"),
    )


def pixel_bytes(values: Column) -> Column:
    digits = F.transform(values, lambda p: F.lpad(F.hex(p), 2, "0"))
    return F.unhex(F.array_join(digits, ""))


def images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """8 x 8 gray images in the layout of the image source.

    One id in 97 has no file, another one a file that does not decode.
    """
    rows = sample_vectors(spark, sf_dir).filter("id % 97 <> 12")
    broken = F.col("id") % 97 == 13
    side = F.when(broken, F.lit(-1)).otherwise(F.lit(8))
    return rows.select(
        "id", image_path().alias("path"), side.alias("height"), side.alias("width"),
        F.when(broken, F.lit(-1)).otherwise(F.lit(1)).alias("nChannels"),
        F.when(broken, F.lit(b"")).otherwise(pixel_bytes(pixels())).alias("data"),
    )


def png_bytes(height: int, width: int, gray: bytes) -> bytes:
    """A gray PNG without line filters."""
    lines = b"".join(b"\0" + gray[y * width:(y + 1) * width] for y in range(height))
    header = struct.pack(">IIBBBBB", width, height, 8, 0, 0, 0, 0)
    chunks = ((b"IHDR", header), (b"IDAT", zlib.compress(lines)), (b"IEND", b""))
    return b"\x89PNG\r\n\x1a\n" + b"".join(
        struct.pack(">I", len(body)) + tag + body + struct.pack(">I", zlib.crc32(tag + body))
        for tag, body in chunks
    )


def image_body(row: dict) -> bytes:
    """A PNG; broken images get no PNG bytes."""
    return b"no image" if row["height"] < 0 else png_bytes(row["height"], row["width"], row["data"])


def as_uri(folder: str) -> str:
    return re.sub("^file:/+", "file:///", folder if ":" in folder else f"file://{folder}")


def write_files(rows: DataFrame, folder: str, body: Callable[[dict], bytes]) -> int:
    """One file per row (``path`` and what ``body`` needs) in a shared folder, written by the tasks.

    Files are dealt evenly over tasks. A task that is run again writes the same files. Returns the number of files.
    """
    uri = as_uri(folder)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = fs.FileSystem.from_uri(uri)
        for batch in batches:
            for row in batch.to_pylist():
                target = f"{root}/{row['path']}"
                system.create_dir(target.rsplit("/", 1)[0])
                with system.open_output_stream(target) as out:
                    out.write(body(row))
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], names=["files"])

    return spread(rows).mapInArrow(write, "files bigint").agg(F.sum("files")).first()[0]


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The image table with the size that the id declares instead of 8 x 8."""
    width, height = declared_size()
    found = image_features(images(spark, sf_dir)).drop("image_embedding")
    found = found.withColumn("id", F.regexp_extract("path", r"(\d+)", 1).cast("bigint"))
    broken = F.col("decoded_height") < 0
    return found.select(
        "path", F.when(broken, F.col("decoded_width")).otherwise(width).alias("decoded_width"),
        F.when(broken, F.col("decoded_height")).otherwise(height).alias("decoded_height"),
        "decoded_blur",
    )


def benchmark_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run per event: the event type stands for the executor."""
    size = F.element_at(F.array(F.lit(100), F.lit(500), F.lit(1000)), (F.col("user_id") % 3 + 1).cast("int"))
    accepted = (F.col("event_id") * 7) % size
    return table(spark, sf_dir, "events").select(
        size.cast("bigint").alias("samples"), F.col("event_type").alias("executor"),
        F.col("event_id").alias("run"), (F.abs("value") + F.lit(0.5)).alias("seconds"),
        accepted.alias("accepted"), (size - accepted).alias("rejected"),
    )
