import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from pixsieve import functions as fn
from pixsieve.functions.pixels import laplacian_variance, to_gray

NAN = float("nan")


def one(spark, column, layout="x int", row=(1,)):
    return spark.createDataFrame([row], layout).select(column.alias("v")).first().v


def test_missing_is_null_or_empty_but_not_blank(spark):
    df = spark.createDataFrame([(None,), ("",), ("  ",), ("a",)], "c string")
    assert [r.m for r in df.select(fn.missing("c").alias("m")).collect()] == [True, True, False, False]


def test_strip_takes_every_kind_of_white_space(spark):
    text = "\t   \x1f a b \r\n\x85"
    assert one(spark, fn.strip("c"), "c string", (text,)) == text.strip() == "a b"


@pytest.mark.parametrize("n, expected", [(1, "vg_000001"), (999999, "vg_999999"), (1234567, "vg_1234567")])
def test_format_id_widens(spark, n, expected):
    assert one(spark, fn.format_id("n"), "n bigint", (n,)) == expected


@pytest.mark.parametrize("row, expected", [
    ((640, 480, 120.0, 0.25), 0.2 * 640 * 480 / 2073600 + 0.3 * 0.24 + 0.5 * 0.25),
    ((1920, 1080, 400.0, 0.50), 0.69),
    ((None, 1080, None, None), 0.0),
    ((60000, 60000, 9999.0, 7.0), 1.0),
    ((0, 0, 0.0, -3.0), 0.0),
])
def test_quality_score(spark, row, expected):
    layout = "width int, height int, blur_score double, clip_score double"
    assert one(spark, fn.quality_score(), layout, row) == pytest.approx(expected)


@pytest.mark.parametrize("row", [(1, 1, NAN, 0.5), (1, 1, 1.0, NAN)])
def test_quality_keeps_nan(spark, row):
    layout = "width int, height int, blur_score double, clip_score double"
    assert math.isnan(one(spark, fn.quality_score(), layout, row))


def test_cosine_of_a_zero_vector_is_nan_and_normalising_keeps_it(spark):
    layout, row = "a array<double>, b array<double>", ([0.0, 0.0], [1.0, 2.0])
    assert math.isnan(one(spark, fn.cosine("a", "b"), layout, row))
    assert one(spark, fn.l2_normalize("a"), layout, row) == [0.0, 0.0]


def test_cosine_and_norm(spark):
    layout, row = "a array<float>, b array<float>", ([3.0, 4.0], [4.0, 3.0])
    assert one(spark, fn.cosine("a", "b"), layout, row) == pytest.approx(24 / 25)
    assert one(spark, fn.l2_norm("a"), layout, row) == 5.0
    assert one(spark, F.transform(fn.l2_normalize("a"), lambda x: F.round(x, 6)), layout, row) == [0.6, 0.8]


@pytest.mark.parametrize("shape", [(8, 8), (1, 5), (5, 1), (1, 1), (2, 3), (40, 31)])
def test_laplacian_variance_matches_index_by_index(shape):
    gray = np.random.default_rng(3).integers(0, 256, shape).astype(np.uint8)
    height, width = shape

    def mirrored(i, n):
        return 0 if n == 1 else abs(i) if i < n else 2 * (n - 1) - i

    values = [
        sum(
            int(gray[mirrored(y + dy, height), mirrored(x + dx, width)]) * w
            for dy, dx, w in ((-1, 0, 1), (1, 0, 1), (0, -1, 1), (0, 1, 1), (0, 0, -4))
        )
        for y in range(height) for x in range(width)
    ]
    assert laplacian_variance(gray) == pytest.approx(np.var(values))


def test_gray_of_one_three_and_four_channels():
    rng = np.random.default_rng(0)
    bgr = rng.integers(0, 256, (5, 6, 3)).astype(np.uint8)
    expected = np.rint(bgr @ np.array([0.114, 0.587, 0.299]))
    assert np.abs(to_gray(bgr).astype(int) - expected).max() <= 1
    with_alpha = np.concatenate([bgr, rng.integers(0, 256, (5, 6, 1)).astype(np.uint8)], axis=2)
    assert (to_gray(with_alpha) == to_gray(bgr)).all()
    assert (to_gray(bgr[:, :, :1]) == bgr[:, :, 0]).all()
