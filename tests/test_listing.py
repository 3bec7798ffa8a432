import struct
import sys
import zlib

import numpy as np
import pytest
from pyspark import cloudpickle

from pixsieve import sources
from pixsieve.files import read_listed
from pixsieve.functions.decode import NoDecoder, decode_image
from pixsieve.operators import ListedImageLoader
from pixsieve.plans import pipeline as pl

from conftest import png

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def filtered_png(pixels: np.ndarray, colour: int, kinds, palette: bytes | None = None) -> bytes:
    """A PNG whose lines take the given filters in turn."""
    height, stride = pixels.shape[0], pixels.shape[1] * pixels.shape[2]
    step, rows, above, out = pixels.shape[2], pixels.reshape(height, stride).astype(int), np.zeros(stride, int), b""
    for y, row in enumerate(rows):
        kind = kinds[y % len(kinds)]
        left = np.r_[np.zeros(step, int), row[:-step]]
        corner = np.r_[np.zeros(step, int), above[:-step]]
        near = left + above - corner
        paeth = np.where(
            (abs(near - left) <= abs(near - above)) & (abs(near - left) <= abs(near - corner)), left,
            np.where(abs(near - above) <= abs(near - corner), above, corner),
        )
        guess = [0, left, above, (left + above) // 2, paeth][kind]
        out += bytes([kind]) + ((row - guess) % 256).astype(np.uint8).tobytes()
        above = row

    def chunk(tag, body):
        return struct.pack(">I", len(body)) + tag + body + struct.pack(">I", zlib.crc32(tag + body))

    head = chunk(b"IHDR", struct.pack(">IIBBBBB", pixels.shape[1], height, 8, colour, 0, 0, 0))
    packed = zlib.compress(out)
    body = chunk(b"IDAT", packed[:20]) + chunk(b"IDAT", packed[20:])
    return b"\x89PNG\r\n\x1a\n" + head + (chunk(b"PLTE", palette) if palette else b"") + body + chunk(b"IEND", b"")


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    folder = tmp_path_factory.mktemp("images with space")
    rng = np.random.default_rng(1)
    (folder / "deep" / "er").mkdir(parents=True)
    for name, channels, colour in (("gray.png", 1, 0), ("rgb.png", 3, 2), ("deep/er/rgba.png", 4, 6)):
        pixels = rng.integers(0, 256, (9, 7, channels)).astype(np.uint8)
        (folder / name).write_bytes(filtered_png(pixels, colour, [4, 3, 2, 1, 0]))
    (folder / "flat+one.png").write_bytes(png(5, 6, 3, bytes(90)))
    (folder / "100%25.png").write_bytes(png(5, 6, 1, bytes(range(30))))
    (folder / "text.jpg").write_text("not an image")
    return folder


def test_decoding_agrees_with_the_image_source(spark, folder):
    images = sources.read_images(spark, f"{folder}/*.png").collect()
    assert len(images) == 4
    for row in images:
        name = next(p for p in folder.glob("*.png") if p.name[:3] == row.path.rsplit("/", 1)[1][:3])
        pixels = decode_image(name.read_bytes())
        assert pixels.shape == (row.height, row.width, row.nChannels)
        assert pixels.tobytes() == bytes(row.data)


def test_decoding_of_other_colours_and_of_broken_bytes():
    pixels = np.arange(24, dtype=np.uint8).reshape(3, 4, 2)
    assert (decode_image(filtered_png(pixels, 4, [1]))[:, :, [0, 3]] == pixels).all()
    index = np.array([[[0], [2]], [[1], [1]]], dtype=np.uint8)
    out = decode_image(filtered_png(index, 3, [0], palette=bytes([1, 2, 3, 4, 5, 6, 7, 8, 9])))
    assert out.tolist() == [[[3, 2, 1], [9, 8, 7]], [[6, 5, 4], [6, 5, 4]]]
    good = filtered_png(pixels, 4, [4])
    for broken in (b"", b"text", good[:40], good[:50], good.replace(b"IHDR", b"IHDX"), b"\x89PNG\r\n\x1a\n"):
        assert decode_image(broken) is None


def test_formats_without_a_decoder_are_no_broken_images():
    try:
        import PIL  # noqa: F401
    except ImportError:
        with pytest.raises(NoDecoder):
            decode_image(b"\xff\xd8\xff\xe0 the start of a JPEG")


def test_only_files_of_rows_still_alive_are_opened(spark, folder, make_samples, tmp_path):
    opened = tmp_path / "opened"
    opened.mkdir()

    def counting(place):
        import uuid

        (opened / uuid.uuid4().hex).write_text(place)
        return read_listed(place)

    listing = sources.list_images(spark, str(folder), base_dir=str(folder))
    assert {r.path for r in listing.collect()} == {
        "gray.png", "rgb.png", "deep/er/rgba.png", "flat+one.png", "100%25.png", "text.jpg",
    }
    df = make_samples(
        {"image_path": "rgb.png"}, {"image_path": "none.png"}, {"image_path": "text.jpg"}, {"image_path": "rgb.png"},
        {"image_path": "gray.png", "sample_id": ""}, {"image_path": "100%25.png"}, {"image_path": "deep/er/rgba.png", "status": "rejected", "reject_reason": "upstream"},
        {"image_path": "deep"}, {"image_path": None},
    )
    loader = ListedImageLoader(listing, lambda found, wanted: sources.measure_listed(found, wanted, load=counting))
    chain = pl.QualityPipeline([pl.SampleValidator(), loader, pl.BlurFilter(0.0)])
    out = chain.run(df).orderBy("row_idx").collect()
    assert [(r.status, r.reject_reason, r.width, r.height) for r in out] == [
        ("accepted", None, 7, 9), ("rejected", "missing_image", 640, 480), ("rejected", "invalid_image", 640, 480), ("accepted", None, 7, 9),
        ("rejected", "missing_sample_id", 640, 480), ("accepted", None, 5, 6), ("rejected", "upstream", 640, 480),
        ("rejected", "missing_image", 640, 480), ("rejected", "missing_image_path", 640, 480),
    ]
    places = sorted(p.read_text().rsplit("/", 1)[1] for p in opened.iterdir())
    assert places == ["100%25.png", "rgb.png", "text.jpg"]


def test_listed_measures_equal_those_of_the_whole_folder(spark, folder):
    whole = sources.image_features(sources.read_images(spark, str(folder), base_dir=str(folder))).drop("image_embedding")
    listing = sources.list_images(spark, str(folder), base_dir=str(folder), recursive=False)
    wanted = listing.select("path").union(listing.select("path"))
    some = sources.measure_listed(listing, wanted)
    assert some.columns == whole.columns
    plain = {tuple(r) for r in whole.collect() if not r.path.startswith("100")}
    assert {tuple(r) for r in some.collect() if not r.path.startswith("100")} == plain and len(plain) == 4


def test_an_encoder_sees_only_what_is_wanted(spark, folder):
    class Shapes:
        def encode_images(self, images):
            return [[len(images), *i.shape] for i in images]

    listing = sources.list_images(spark, str(folder), base_dir=str(folder))
    wanted = spark.createDataFrame([("rgb.png",), ("text.jpg",), ("flat+one.png",)], "path string")
    rows = {r.path: r.image_embedding for r in sources.measure_listed(listing, wanted, Shapes, min_blur=1.0).collect()}
    assert rows["rgb.png"][1:] == [9.0, 7.0, 3.0] and rows["text.jpg"] is None and rows["flat+one.png"] is None


def test_a_file_that_is_gone_counts_as_missing(spark, folder, make_samples, tmp_path):
    (tmp_path / "here.png").write_bytes(png(5, 6, 1, bytes(30)))
    listing = spark.createDataFrame([("a.png", f"file:{tmp_path}/gone.png"), ("b.png", f"file:{tmp_path}/here.png")], "path string, place string")
    chain = pl.build_pipeline(
        {"pipeline": {"operators": [{"name": "image_loader"}]}}, pl.Resources(listing=listing)
    )
    out = chain.run(make_samples({"image_path": "a.png"}, {"image_path": "b.png"})).orderBy("row_idx").collect()
    assert [(r.reject_reason, r.width) for r in out] == [("missing_image", 640), (None, 5)]


def test_streams_need_features(spark, make_samples, tmp_path):
    make_samples({}).write.parquet(str(tmp_path / "in"))
    layout = spark.read.parquet(str(tmp_path / "in")).schema
    stream = spark.readStream.schema(layout).parquet(str(tmp_path / "in"))
    listing = spark.createDataFrame([], "path string, place string")
    with pytest.raises(ValueError, match="stream"):
        ListedImageLoader(listing, sources.measure_listed).process_alive(stream)
