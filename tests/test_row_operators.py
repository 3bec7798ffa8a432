import math

import pytest
from pyspark.sql import functions as F

from pixsieve.operators.row import FunctionOperator
from pixsieve.operators import (
    AlignmentFilter, BlurFilter, ImageLoader, ResolutionFilter, SampleValidator, resolve_image_path,
)

VECTORS = "image_embedding array<double>, text_embedding array<double>"


def verdicts(df):
    return [(r.status, r.reject_reason) for r in df.orderBy("row_idx").collect()]


@pytest.fixture(scope="module")
def features(spark):
    rows = [("ok.png", 800, 600, 150.0), ("soft.png", 800, 600, 99.0), ("edge.png", 512, 512, 100.0), ("bad.png", -1, -1, None)]
    return spark.createDataFrame(
        rows, "path string, decoded_width int, decoded_height int, decoded_blur double"
    )


def test_validator(make_samples):
    df = make_samples(
        {}, {"image_path": None}, {"image_path": ""}, {"sample_id": "", "image_path": None},
        {"image_prompt": None}, {"image_prompt": "  "}, {"status": "accepted", "reject_reason": "old"},
    )
    assert verdicts(SampleValidator().process(df)) == [
        ("validated", None), ("rejected", "missing_image_path"), ("rejected", "missing_image_path"),
        ("rejected", "missing_sample_id"), ("rejected", "missing_image_prompt"), ("validated", None),
        ("validated", None),
    ]


def test_only_validator_and_loader_look_at_rejected_rows(make_samples, features):
    df = make_samples(
        {"status": "rejected", "reject_reason": "old", "image_path": "gone.png", "width": 1,
         "image_embedding": [1.0], "text_embedding": [-1.0]}, extra=VECTORS,
    )
    assert verdicts(SampleValidator().process(df)) == [("validated", None)]
    assert verdicts(ImageLoader(features).process(df)) == [("rejected", "missing_image")]
    for operator in (ResolutionFilter(), BlurFilter(100.0, features), AlignmentFilter()):
        assert verdicts(operator.process(df)) == [("rejected", "old")]
    for operator in (SampleValidator(), ImageLoader(features)):
        assert verdicts(operator.process_alive(df)) == [("rejected", "old")]


@pytest.mark.parametrize("width, height, expected", [
    (1024, 768, ("validated", None)), (320, 240, ("rejected", "low_resolution")),
    (512, 512, ("validated", None)), (511, 4000, ("rejected", "low_resolution")),
    (None, 600, ("rejected", "missing_resolution")), (100, None, ("rejected", "missing_resolution")),
])
def test_resolution(make_samples, width, height, expected):
    df = make_samples({"width": width, "height": height, "status": "validated"})
    assert verdicts(ResolutionFilter(512, 512).process(df)) == [expected]


def test_loader(make_samples, features):
    df = make_samples({"image_path": "ok.png"}, {"image_path": "gone.png"}, {"image_path": "bad.png"})
    rows = ImageLoader(features).process(df).orderBy("row_idx").collect()
    assert [(r.status, r.reject_reason, r.width, r.height) for r in rows] == [
        ("pending", None, 800, 600), ("rejected", "missing_image", 640, 480),
        ("rejected", "invalid_image", 640, 480),
    ]


def test_loader_falls_back_to_the_id(make_samples, spark):
    features = spark.createDataFrame(
        [("dir/a.jpg", 9, 8, 1.0)], "path string, decoded_width int, decoded_height int, decoded_blur double"
    )
    df = make_samples({"sample_id": "a", "image_path": None}, {"sample_id": "b", "image_path": ""})
    rows = ImageLoader(features, "dir").process(df).orderBy("row_idx").collect()
    assert [(r.image_path, r.width, r.reject_reason) for r in rows] == [
        ("dir/a.jpg", 9, None), ("", 640, "missing_image"),
    ]
    resolved = df.select(resolve_image_path().alias("p")).collect()
    assert {r.p for r in resolved} == {"outputs/images/a.jpg", "outputs/images/b.jpg"}


def test_blur_keeps_the_score_of_a_rejected_row(make_samples, features):
    df = make_samples(*[{"image_path": p} for p in ("ok.png", "soft.png", "edge.png", "bad.png", "gone.png", "")])
    rows = BlurFilter(100.0, features).process(df).orderBy("row_idx").collect()
    assert [(r.status, r.reject_reason, r.blur_score) for r in rows] == [
        ("accepted", None, 150.0), ("rejected", "blurry_image", 99.0), ("accepted", None, 100.0),
        ("rejected", "invalid_image", None), ("rejected", "invalid_image", None),
        ("rejected", "missing_image_path", None),
    ]


def test_blur_without_pixels_is_an_error(make_samples):
    with pytest.raises(ValueError):
        BlurFilter().process(make_samples({}))


def test_alignment(make_samples):
    df = make_samples(
        {"image_embedding": [1.0, 0.0], "text_embedding": [2.0, 0.0]},
        {"image_embedding": [1.0, 0.0], "text_embedding": [0.0, 1.0]},
        {"image_embedding": [0.0, 0.0], "text_embedding": [0.0, 1.0]},
        {"image_prompt": "", "image_embedding": [1.0, 0.0], "text_embedding": [1.0, 0.0]},
        {"image_embedding": [1.0, 0.0], "text_embedding": [3.0, 4.0]}, extra=VECTORS,
    )
    rows = AlignmentFilter(threshold=0.6).process(df).orderBy("row_idx").collect()
    assert verdicts(AlignmentFilter(threshold=0.6).process(df)) == [
        ("accepted", None), ("rejected", "low_clip_alignment"), ("accepted", None),
        ("rejected", "missing_image_prompt"), ("accepted", None),
    ]
    assert rows[1].clip_score == 0.0 and math.isnan(rows[2].clip_score) and rows[3].clip_score is None


def test_alignment_without_a_vector_stops_or_rejects(make_samples):
    df = make_samples({"image_embedding": None, "text_embedding": [1.0]}, extra=VECTORS)
    assert verdicts(AlignmentFilter(on_error="reject").process(df)) == [("rejected", "invalid_image")]
    with pytest.raises(Exception, match="no image or text vector"):
        AlignmentFilter().process(df).select("status").collect()
    with pytest.raises(ValueError):
        AlignmentFilter(on_error="ignore")


def test_rejected_rows_never_reach_a_user_function(make_samples):
    """Not even one that fails on them; columns it adds are null for them."""
    def strict(df):
        check = F.when(F.col("sample_id") == "bad", F.raise_error(F.lit("saw a rejected row")).cast("int")).otherwise(F.length("image_prompt"))
        return df.withColumn("size", check).select("row_idx", "sample_id", "image_prompt", "status", "reject_reason", "size")

    df = make_samples({"sample_id": "bad", "status": "rejected", "reject_reason": "before"}, {"sample_id": "good", "image_prompt": "abc"})
    rows = {r.sample_id: r for r in FunctionOperator("Strict", strict).process_alive(df).collect()}
    assert rows["good"]["size"] == 3 and rows["good"].status == "pending"
    assert rows["bad"]["size"] is None and (rows["bad"].status, rows["bad"].reject_reason) == ("rejected", "before")
