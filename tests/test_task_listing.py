"""Folders that a task lists: the driver never holds their files, and what comes out is what Spark's sources give."""

import struct

import numpy as np
import pytest

from pixsieve import sources, streaming
from pixsieve.sources.images import image_rows

from conftest import png
from test_arrivals import batch_result, chain_of, noise, rows
from test_listing import filtered_png


def bmp(pixels):
    """A 24-bit BMP of rows whose length in bytes is a multiple of four."""
    body = pixels[::-1].tobytes()
    header = struct.pack("<IiiHHIIiiII", 40, pixels.shape[1], pixels.shape[0], 1, 24, 0, len(body), 2835, 2835, 0, 0)
    return b"BM" + struct.pack("<IHHI", 54 + len(body), 0, 0, 54) + header + body


@pytest.fixture
def folder(tmp_path):
    folder, rng = tmp_path / "with space", np.random.default_rng(2)
    (folder / "deep" / "er").mkdir(parents=True)
    for name, channels, colour in (("gray.png", 1, 0), ("rgb.png", 3, 2), ("alpha.png", 2, 4), ("deep/er/rgba.png", 4, 6)):
        (folder / name).write_bytes(filtered_png(rng.integers(0, 256, (9, 7, channels)).astype(np.uint8), colour, [4, 3, 2, 1, 0]))
    (folder / "index.png").write_bytes(filtered_png(np.ones((3, 4, 1), np.uint8), 3, [0], palette=bytes(range(9))))
    (folder / "a.bmp").write_bytes(bmp(rng.integers(0, 256, (3, 4, 3)).astype(np.uint8)))
    (folder / "cut.png").write_bytes(png(5, 6, 1, bytes(30))[:30])
    for name, data in (("text.png", b"no image"), ("empty.png", b""), ("zero.png", bytes(8)), (".hidden.png", b"x"), ("_temporary", b"x")):
        (folder / name).write_bytes(data)
    return folder


def whole(df):
    return sorted((r.path, r.height, r.width, r.nChannels, bytes(r.data)) for r in df.collect())


def test_images_of_a_folder_are_those_of_the_image_source(spark, folder):
    own = sources.read_images(spark, str(folder), base_dir=str(folder))
    source = image_rows(spark.read.format("image").load(str(folder)), str(folder))
    assert whole(own) == whole(source) and len(whole(own)) == 8
    assert not any(f.endswith(("gray.png", "rgb.png", "text.png")) for f in own.inputFiles())


def test_a_listing_is_that_of_the_binary_source(spark, folder):
    for recursive in (False, True):
        own = sources.list_images(spark, str(folder), base_dir=str(folder), recursive=recursive)
        source = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).load(str(folder))
        assert sorted((r.place, r.length) for r in own.collect()) == sorted((r.path, r.length) for r in source.select("path", "length").collect())
        assert {r.path for r in own.collect()} >= {"gray.png", *(["deep/er/rgba.png"] if recursive else [])}
        assert not any(f.endswith("gray.png") for f in own.inputFiles())


def test_wildcards_files_and_missing_folders_as_before(spark, folder):
    assert sources.list_images(spark, f"{folder}/*.bmp").count() == 1
    assert sources.read_images(spark, f"{folder}/rgb.png").first().width == 7
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        sources.read_images(spark, f"{folder}/none")


def test_a_listed_stream_takes_every_file_once(spark, make_samples, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for name in ("a.png", "b.png", "c.png"):
        noise(folder, name)
    (folder / "flat.png").write_bytes(png(5, 5, 1, bytes(25)))
    (folder / "text.png").write_text("no image")
    samples = make_samples(*[{"image_path": n} for n in ("a.png", "b.png", "late.png", "flat.png", "text.png", None, "never.png")])

    def run():
        arriving = streaming.ArrivingImages(samples, chain_of, str(tmp_path / "out"))
        stream = streaming.image_stream(spark, str(folder), str(folder), files_a_batch=2, listing=str(tmp_path / "names"))
        return rows(arriving.run_to_end(stream))

    def batches():
        return [spark.read.parquet(str(p)).count() for p in sorted((tmp_path / "out" / "features").glob("batch=*"))]

    assert run() == batch_result(spark, folder, samples)
    assert sorted(batches()) == [1, 2, 2]
    noise(folder, "late.png", 9)
    assert run() == batch_result(spark, folder, samples)
    assert run() == batch_result(spark, folder, samples) and sum(batches()) == 6
    # What the source has to remember are files of names, not images.
    assert "names/" in "".join(p.read_text() for p in (tmp_path / "out" / "progress" / "sources" / "0").glob("[0-9]*"))
    assert "late.png" not in "".join(p.read_text() for p in (tmp_path / "out" / "progress" / "sources" / "0").glob("[0-9]*"))
