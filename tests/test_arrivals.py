import numpy as np
import pytest
from pyspark.sql import functions as F

from pixsieve import sources, streaming
from pixsieve.plans import pipeline as pl

from conftest import png

SPEC = {"pipeline": {"operators": [{"name": "validator"}, {"name": "image_loader"}, {"name": "blur_filter", "params": {"threshold": 1.0}}]}}
COLUMNS = ["row_idx", "status", "reject_reason", "width", "rejected_by"]


def chain_of(features):
    return pl.build_pipeline(SPEC, pl.Resources(features=features))


def noise(folder, name, side=6):
    pixels = np.random.default_rng(side).integers(0, 256, (side, side)).astype(np.uint8)
    (folder / name).write_bytes(png(side, side, 1, pixels.tobytes()))


def rows(df):
    return sorted(map(tuple, df.select(*COLUMNS).collect()))


@pytest.fixture
def setting(spark, make_samples, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for name in ("a.png", "b.png", "c.png"):
        noise(folder, name)
    (folder / "flat.png").write_bytes(png(5, 5, 1, bytes(25)))
    (folder / "text.png").write_text("no image")
    names = ["a.png", "b.png", "late.png", "flat.png", "text.png", "a.png", None, "never.png"]
    samples = make_samples(*[{"image_path": n} for n in names], {"image_path": "c.png", "status": "rejected", "reject_reason": "upstream"})
    return folder, samples


def batch_result(spark, folder, samples):
    features = sources.image_features(sources.read_images(spark, str(folder), str(folder))).drop("image_embedding")
    return rows(chain_of(features).run(samples))


def test_a_stream_of_files_gives_the_result_of_the_folder(spark, setting, tmp_path):
    folder, samples = setting
    arriving = streaming.ArrivingImages(samples, chain_of, str(tmp_path / "out"))
    assert rows(arriving.verdicts()) == rows(chain_of(arriving_none(spark)).run(samples))
    stream = streaming.image_stream(spark, str(folder), str(folder), files_a_batch=2)
    assert rows(arriving.run_to_end(stream)) == batch_result(spark, folder, samples)
    assert len(list((tmp_path / "out" / "verdicts").glob("batch=*"))) == 3


def arriving_none(spark):
    return spark.createDataFrame([], "path string, decoded_width int, decoded_height int, decoded_blur double")


def test_a_late_file_turns_missing_into_judged(spark, setting, tmp_path):
    folder, samples = setting
    arriving = streaming.ArrivingImages(samples, chain_of, str(tmp_path / "out"))
    first = rows(arriving.run_to_end(streaming.image_stream(spark, str(folder), str(folder))))
    assert {r[0]: r[2] for r in first}[3] == "missing_image"
    noise(folder, "late.png", 9)
    again = streaming.ArrivingImages(samples, chain_of, str(tmp_path / "out"))
    second = rows(again.run_to_end(streaming.image_stream(spark, str(folder), str(folder))))
    assert second == batch_result(spark, folder, samples)
    assert {r[0]: (r[1], r[3]) for r in second}[3] == ("accepted", 9)
    # The second run read the new file only.
    assert sum(spark.read.parquet(str(p)).count() for p in (tmp_path / "out" / "features").glob("batch=*")) == 6


def test_a_repeated_batch_replaces_itself(spark, setting, tmp_path):
    folder, samples = setting
    arriving = streaming.ArrivingImages(samples, chain_of, str(tmp_path / "out"))
    images = sources.read_images(spark, str(folder), str(folder))
    for _ in range(2):
        arriving.judge_batch(images.filter(F.col("path").isin("a.png", "flat.png")), 0)
        arriving.judge_batch(images.filter(~F.col("path").isin("a.png", "flat.png")), 1)
    assert rows(arriving.verdicts()) == batch_result(spark, folder, samples)
    assert spark.read.parquet(str(tmp_path / "out" / "verdicts")).count() == 6


def test_a_later_file_of_the_same_name_overrules(spark, setting, tmp_path):
    folder, samples = setting
    arriving = streaming.ArrivingImages(samples, chain_of, str(tmp_path / "out"))
    images = sources.read_images(spark, str(folder), str(folder)).filter("path = 'a.png'")
    arriving.judge_batch(images, 0)
    noise(folder, "a.png", 11)
    arriving.judge_batch(sources.read_images(spark, str(folder), str(folder)).filter("path = 'a.png'"), 7)
    widths = {r[0]: r[3] for r in rows(arriving.verdicts())}
    assert widths[1] == widths[6] == 11 and len(widths) == 9
