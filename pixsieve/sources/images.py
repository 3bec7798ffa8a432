"""Images: decoded once, reduced to a narrow table without pixels.

``read_images`` decodes a whole folder. ``list_images`` only lists it; ``measure_listed`` then opens the files that
are wanted, inside the tasks, and no others. Folders are listed by a task into a table, since Spark's own listing
holds every file on the driver; paths with wildcards and folders of partitions still go that way.
"""

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pixsieve import schema as S
from pixsieve.files import open_listed, read_listed, walk_listed
from pixsieve.functions.decode import decode_image, plain_start
from pixsieve.functions.pixels import laplacian_variance, to_array, to_gray
from pixsieve.models import per_worker
from pixsieve.session import spread, write_table

IMAGE_COLUMNS = ["path", "height", "width", "nChannels", "data"]
IMAGE_LAYOUT = "path string, height int, width int, nChannels int, data binary"
#: What decodes rows of ``open_images`` at most holds at a time.
OPEN_ROWS, OPEN_BYTES = 256, 16 << 20
_WILDCARD = re.compile(r"[*?\[\]{}\\]")


def relative_path(origin: Column, base_dir: str = "") -> Column:
    """Undo the URI form of a file name and cut the folder in front of it."""
    plain = F.url_decode(F.replace(F.regexp_replace(origin, "^file:/+", "/"), F.lit("+"), F.lit("%2B")))
    return _inside(plain, base_dir)


def _plain(place: str) -> Column:
    """A name as a listing gives it without the scheme of local files; unlike those of the image source it has no escapes."""
    return F.regexp_replace(place, "^file:/+", "/")


def _inside(plain: Column, base_dir: str) -> Column:
    if not base_dir:
        return plain
    base = base_dir.rstrip("/") + "/"
    return F.when(plain.startswith(base), F.substring(plain, len(base) + 1, 1 << 30)).otherwise(plain)


def read_images(spark: SparkSession, path: str, base_dir: str = "") -> DataFrame:
    """``path, height, width, nChannels, data``; an undecodable file has height -1.

    Plain PNGs are opened and decoded by Python tasks, and so are files that are no images at all. The names of all others go to
    Spark's image source.
    """
    listing = _listed(spark, path, recursive=False)
    if listing is None:
        return image_rows(spark.read.format("image").load(path), base_dir)
    known = write_table(_classified(listing), "image-kinds")
    images = open_images(known.filter("plain").select(_inside(_plain("place"), base_dir).alias("path"), "place"))
    others = [row.place for row in known.filter("not plain").select("place").toLocalIterator()]
    if not others:
        return images
    source = spark.read.format("image").option("__globPaths__", "false").load(others)
    return images.unionByName(image_rows(source, base_dir))


def _listed(spark: SparkSession, path: str, recursive: bool) -> DataFrame | None:
    """``place, length`` of the files of a folder, written by the task that lists it; None if Spark's own listing is needed."""
    if _WILDCARD.search(path):
        return None
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(hadoop) or not system.getFileStatus(hadoop).isDirectory():
        return None
    root = system.makeQualified(hadoop).toString()
    names = ["place", "folder", "length"]

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for place in batch.column(0).to_pylist():
                for rows in walk_listed(place, recursive):
                    kinds = (pa.string(), pa.bool_(), pa.int64())
                    yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names=names)

    start = spark.createDataFrame([(root,)], "place string")
    found = write_table(start.mapInArrow(walk, "place string, folder boolean, length bigint"), "listing")
    if not found.filter("folder and contains(element_at(split(place, '/'), -1), '=')").isEmpty():
        return None
    # Spark's sources have no rows for empty files.
    return found.filter("not folder and length > 0").drop("folder")


def _classified(listing: DataFrame) -> DataFrame:
    """``place, plain``: whether ``decode_image`` decodes a file, or tells that it is no image, just as Spark's image source does."""
    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places, plain = [], []
            for place in batch.column(0).to_pylist():
                try:
                    with open_listed(place) as stream:
                        plain.append(plain_start(stream))
                except FileNotFoundError:
                    continue
                places.append(place)
            yield pa.RecordBatch.from_arrays([pa.array(places, pa.string()), pa.array(plain, pa.bool_())], names=["place", "plain"])

    return spread(listing.select("place")).mapInArrow(look, "place string, plain boolean")


def open_images(listing: DataFrame, load: Callable[[str], bytes] = read_listed, decode: Callable[[bytes], np.ndarray | None] = decode_image) -> DataFrame:
    """``IMAGE_COLUMNS`` of files (``path, place``), a table or a stream, opened and decoded in the tasks; files that are gone have no row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, held = [], 0
            for path, place in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                try:
                    image = decode(load(place))
                except FileNotFoundError:
                    continue
                shape, data = ((-1, -1, -1), b"") if image is None else (image.shape, image.tobytes())
                rows.append((path, *shape, data))
                held += len(data)
                if len(rows) == OPEN_ROWS or held >= OPEN_BYTES:
                    yield _image_batch(rows)
                    rows, held = [], 0
            yield _image_batch(rows)

    return spread(listing.select("path", "place")).mapInArrow(run, IMAGE_LAYOUT)


def _image_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names=IMAGE_COLUMNS)


def image_rows(images: DataFrame, base_dir: str = "") -> DataFrame:
    """``IMAGE_COLUMNS`` of rows of the image source, a table or a stream."""
    image = F.col("image")
    return images.select(
        relative_path(image.origin, base_dir).alias("path"),
        image.height.alias("height"), image.width.alias("width"),
        image.nChannels.alias("nChannels"), image.data.alias("data"),
    )


def image_features(
    images: DataFrame,
    make_encoder: Callable | None = None,
    batch_size: int = 32,
    min_width: int = 0,
    min_height: int = 0,
    min_blur: float = 0.0,
) -> DataFrame:
    """Size, sharpness and, with an encoder, the vector of every image; the pixels stay behind.

    ``make_encoder()`` returns an object with ``encode_images(list of BGR arrays)``; it is
    called once per Python worker. Images below the given minimums are measured but not encoded: give the
    thresholds of the operators that come before the alignment (``encoding_limits``), which
    reject such images without looking at a vector. Undecodable images come out with NULLs and
    height -1. Arrow batches are limited by bytes (``spark.sql.execution.arrow.maxBytesPerBatch``).
    """
    model = per_worker(make_encoder) if make_encoder else None

    def encodes(width: int, height: int, blur: float) -> bool:
        return width >= min_width and height >= min_height and not blur < min_blur

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = model() if model else None
        for batch in batches:
            for start in range(0, batch.num_rows, batch_size):
                yield _measure(batch.slice(start, batch_size), encoder, encodes)

    return images.select(*IMAGE_COLUMNS).mapInArrow(measure, S.IMAGE_FEATURE_SCHEMA)


def list_images(spark: SparkSession, path: str, base_dir: str = "", recursive: bool = True) -> DataFrame:
    """``path, place, length`` of the files under a folder, from the listing alone: no file is opened."""
    files = _listed(spark, path, recursive)
    if files is None:
        source = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).load(path)
        files = source.select(F.col("path").alias("place"), "length")
    return files.select(_inside(_plain("place"), base_dir).alias("path"), "place", "length")


def measure_listed(
    listing: DataFrame,
    wanted: DataFrame,
    make_encoder: Callable | None = None,
    batch_size: int = 32,
    min_width: int = 0,
    min_height: int = 0,
    min_blur: float = 0.0,
    load: Callable[[str], bytes] = read_listed,
    decode: Callable[[bytes], np.ndarray | None] = decode_image,
) -> DataFrame:
    """Like ``image_features`` for the files of ``listing`` whose path is in ``wanted`` (``path``).

    Only those are read, each once, next to where it is decoded; what travels before are paths. Files that
    are gone since they were listed have no row. Without an encoder there is no vector column.
    """
    model = per_worker(make_encoder) if make_encoder else None
    chosen = spread(listing.join(wanted.select("path"), "path", "left_semi").select("path", "place"))

    def encodes(width: int, height: int, blur: float) -> bool:
        return width >= min_width and height >= min_height and not blur < min_blur

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = model() if model else None
        for batch in batches:
            rows = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
            for start in range(0, len(rows), batch_size):
                paths, images = [], []
                for path, place in rows[start:start + batch_size]:
                    try:
                        data = load(place)
                    except FileNotFoundError:
                        continue
                    paths.append(path)
                    images.append(decode(data))
                yield _feature_batch(pa.array(paths, pa.string()), images, encoder, encodes)

    features = chosen.mapInArrow(measure, S.IMAGE_FEATURE_SCHEMA)
    return features if make_encoder else features.drop("image_embedding")


def _measure(batch: pa.RecordBatch, encoder, encodes: Callable) -> pa.RecordBatch:
    heights, widths, channels = (
        [-1 if v is None else v for v in batch.column(c).to_pylist()] for c in (1, 2, 3)
    )
    images = [
        to_array(height, width, channel, data.as_buffer()) if height > 0 and width > 0 else None
        for height, width, channel, data in zip(heights, widths, channels, batch.column(4))
    ]
    return _feature_batch(batch.column(0), images, encoder, encodes)


def _feature_batch(paths: pa.Array, images: list, encoder, encodes: Callable) -> pa.RecordBatch:
    """Measures of decoded images; None stands for one that does not decode."""
    heights = [-1 if image is None else image.shape[0] for image in images]
    widths = [-1 if image is None else image.shape[1] for image in images]
    blurs = [None if image is None else laplacian_variance(to_gray(image)) for image in images]
    vectors: list = [None] * len(images)
    if encoder is not None:
        places = [i for i, image in enumerate(images) if image is not None and encodes(widths[i], heights[i], blurs[i])]
        if places:
            for i, vector in zip(places, encoder.encode_images([images[i] for i in places])):
                vectors[i] = np.asarray(vector, dtype=np.float64).tolist()
    return pa.RecordBatch.from_arrays(
        [
            paths, pa.array(widths, pa.int32()), pa.array(heights, pa.int32()), pa.array(blurs, pa.float64()),
            pa.array(vectors, pa.list_(pa.float64())),
        ],
        names=S.IMAGE_FEATURE_SCHEMA.fieldNames(),
    )
