import json
import sys

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from pixsieve import schema as S
from pixsieve import streaming
from pixsieve.operators import annotate as an
from pixsieve.operators.encode import encode_texts
from pixsieve.plans import pipeline as pl
from pixsieve.plans.curate import caption_raw, curate
from pixsieve.plans.reports import annotation_counts
from pixsieve.standins import LetterEncoder, SizeCaptioner, open_bytes

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def captioner():
    return SizeCaptioner(bad_remainder=7, modulus=50)


def captions(df, **options):
    rows = an.annotate_batches(df, captioner, payload="pixels", load=open_bytes, **options)
    return [(r.sample_id, r.caption, r.status, r.error) for r in rows.orderBy("row_idx").collect()]


@pytest.fixture(scope="module")
def pictures(make_samples):
    def make(*contents):
        rows = [{"sample_id": f"s{i}", "pixels": c} for i, c in enumerate(contents)]
        return make_samples(*rows, extra="pixels binary")

    return make


def test_a_failing_image_fails_alone_and_a_failing_model_fails_its_batch(pictures):
    df = pictures(bytes([1]), b"", bytes([57]), bytes([2]), bytes([3]), None)
    ok, broken = ("success", None), ("failed", "cannot identify image file")
    assert captions(df, batch_size=2) == [
        ("s0", "1 bytes, sum 1", *ok), ("s1", "", *broken), ("s2", "", "failed", "captioner failed"),
        ("s3", "", "failed", "captioner failed"), ("s4", "1 bytes, sum 3", *ok), ("s5", "", *broken),
    ]
    alone = captions(df, batch_size=1)
    assert alone[2][3] == "captioner failed" and alone[3][2] == "success"


@pytest.mark.parametrize("partitions", [1, 4])
def test_batches_follow_input_order(pictures, partitions):
    df = pictures(*[bytes([i]) for i in range(30)]).repartition(partitions)
    sizes = an.batch_sizes(an.number_batches(df.select("row_idx"), 4)).orderBy("batch_id").collect()
    assert [(r.batch_id, r.rows, r.first_row) for r in sizes] == [
        (b, 4 if b < 7 else 2, 4 * b + 1) for b in range(8)
    ]
    done = captions(df, batch_size=4)
    # Only row 7 has the bad sum, so exactly the batch of rows 4 to 7 fails.
    assert [i for i, r in enumerate(done) if r[2] == "failed"] == [4, 5, 6, 7]


def test_equal_ids_share_a_result_and_failures_win():
    rows = [("a", "p1", b"\1"), ("a", "p2", b""), ("b", "p3", b"\2")]
    out = an.caption_batch(rows, captioner(), "m", open_bytes)
    assert [(r["sample_id"], r["image_path"], r["status"]) for r in out] == [
        ("a", "p2", "failed"), ("a", "p2", "failed"), ("b", "p3", "success"),
    ]


def test_missing_file_and_real_file(make_samples, tmp_path):
    path = tmp_path / "a.bin"
    path.write_bytes(b"\1\2")
    df = make_samples({"image_path": str(path)}, {"image_path": str(tmp_path / "none")}, {"image_path": path.as_uri(), "sample_id": "uri"})
    out = caption_raw(df, captioner, n=3, model_name="m").orderBy("row_idx").collect()
    assert out[2].caption == "2 bytes, sum 3" and out[2].model_name == "m"
    # The first two share an id, so the failure stands for both.
    assert [r.status for r in out] == ["failed", "failed", "success"] and "No such file" in out[1].error
    assert annotation_counts(an.annotate_batches(df.filter("row_idx <> 2"), captioner)).first() == (2, 0)


def test_no_rows(pictures):
    assert captions(pictures(b"\1").filter("false")) == []
    assert annotation_counts(pictures(b"\1").filter("false")).first() == (0, 0)


def test_encoder_gets_only_wanted_texts(make_samples):
    class Counting(LetterEncoder):
        def encode_texts(self, texts):
            assert all(t and "never" not in t for t in texts) and len(texts) <= 2
            return super().encode_texts(texts)

    df = make_samples(
        {"image_prompt": "abca"}, {"image_prompt": "never", "status": "rejected"}, {"image_prompt": None},
        {"image_prompt": ""}, {"image_prompt": "hh"}, {"image_prompt": "zz"},
    ).coalesce(1)
    rows = encode_texts(df, Counting, batch_size=2).orderBy("row_idx").collect()
    assert [None if r.text_embedding is None else sum(r.text_embedding) for r in rows] == [4.0, None, None, None, 2.0, 0.0]
    assert rows[0].text_embedding[:3] == [2.0, 1.0, 1.0]


def test_curate_end_to_end(spark, make_samples, tmp_path):
    rng = np.random.default_rng(0)
    base = rng.normal(size=(4, 8))
    rows = []
    for i in range(12):
        vector = [float(x) for x in base[i % 4] * (1 + i / 10)]
        rows.append({
            "sample_id": f"s{i}", "image_path": f"{i}.png", "pixels": bytes([i + 10]),
            "image_embedding": vector, "text_embedding": vector if i != 5 else [-x for x in vector],
        })
    samples = make_samples(*rows, extra="pixels binary, image_embedding array<double>, text_embedding array<double>")
    features = spark.createDataFrame(
        [(f"{i}.png", 600, 600, 100.0 + i) for i in range(12) if i != 2],
        "path string, decoded_width int, decoded_height int, decoded_blur double",
    )
    spec = {**pl.DEFAULT_SPEC, "annotation": {"enabled": True, "max_samples": 3, "batch_size": 2}}
    done = curate(
        samples, spec, pl.Resources(features=features), captioner, {"payload": "pixels", "load": open_bytes}
    )
    status = {r.sample_id: r.reject_reason for r in done.dataset.collect()}
    # Quality grows with the blur score, so the last of each group stays.
    assert {s for s, r in status.items() if r is None} == {"s8", "s9", "s10", "s11"}
    assert status["s2"] == "missing_image" and status["s5"] == "low_clip_alignment"
    assert done.counts.first() == (4, 8) and done.dedup_metrics.first() == (10, 6, 4)
    assert [r.caption for r in done.annotations.orderBy("row_idx").collect()] == [
        "1 bytes, sum 18", "1 bytes, sum 19", "1 bytes, sum 20",
    ]
    done.save(str(tmp_path / "d"), str(tmp_path / "m"), str(tmp_path / "a"))
    back = spark.read.schema(S.SAMPLE_SCHEMA).json(str(tmp_path / "d"))
    assert back.count() == 12 and spark.read.json(str(tmp_path / "a")).count() == 3
    with pytest.raises(ValueError):
        curate(samples, spec, pl.Resources(features=features))


def test_requests_as_table_and_as_stream(spark, tmp_path):
    requests = [
        {"sample_id": "a", "image_path": "xy"}, {"image_path": "z"}, {"sample_id": None, "image_path": "z"},
        {"sample_id": "b"}, {"image_path": ""}, {"sample_id": "c", "image_path": "boom"},
    ]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "r.jsonl").write_text("\n".join(json.dumps(r) for r in requests))

    def load(path):
        if path == "boom":
            raise OSError("cannot open")
        return path.encode()

    def answers(lines):
        return streaming.annotate_requests(lines, SizeCaptioner, load=load, model_name="m")

    table = answers(spark.read.text(str(tmp_path / "in")))
    stream = answers(spark.readStream.format("text").load(str(tmp_path / "in")))
    out = [sorted((tuple(r) for r in df.collect()), key=repr) for df in (table, streaming.run_to_end(stream))]
    assert out[0] == out[1]
    assert set(out[0]) == {
        ("a", "xy", "2 bytes, sum 241", "m", "success", None),
        ("online_sample", "z", "1 bytes, sum 122", "m", "success", None),
        (None, "z", "1 bytes, sum 122", "m", "success", None),
        ("b", None, None, None, "failed", "image_path is required"),
        ("online_sample", None, None, None, "failed", "image_path is required"),
        ("c", "boom", "", "m", "failed", "cannot open"),
    }


def test_quality_stream_with_metrics_per_batch(spark, make_samples, tmp_path):
    samples = make_samples(*[{"width": 100 * i, "height": 600} for i in range(1, 11)])
    for part in range(2):
        samples.filter(F.col("row_idx") % 2 == part).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    chain = pl.build_pipeline({"pipeline": {"operators": [{"name": "validator"}, {"name": "resolution_filter"}]}})
    stream = spark.readStream.schema(samples.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    seen = []

    def on_batch(df, batch_id):
        seen.append({m.operator: (m.processed, m.rejected) for m in chain.metrics(df).collect()})

    out = streaming.run_to_end(streaming.quality_stream(stream, chain), on_batch=on_batch)
    columns = ["row_idx", "status", "reject_reason", "rejected_by"]
    batch = chain.run(samples).select(*columns)
    assert sorted(map(tuple, out.select(*columns).collect())) == sorted(map(tuple, batch.collect()))
    assert len(seen) == 2
    assert sum(b["ResolutionFilter"][1] for b in seen) == 5


def test_a_model_is_made_once_per_worker(spark, make_samples, tmp_path):
    folder = tmp_path / "made"
    folder.mkdir()

    def make():
        import os
        import uuid

        (folder / f"{os.getpid()}-{uuid.uuid4().hex}").touch()
        return LetterEncoder()

    df = make_samples(*[{"image_prompt": "abc"} for _ in range(40)]).repartition(20)
    for _ in range(2):
        encode_texts(df, make).agg(F.count("text_embedding")).collect()
    made = [p.name.split("-")[0] for p in folder.iterdir()]
    assert made and len(made) == len(set(made))


def test_a_chain_on_a_stream_of_several_batches(spark, make_samples, tmp_path):
    source = str(tmp_path / "in")
    for part in range(3):
        make_samples(*[{"sample_id": f"{part}-{i}", "image_path": f"{i}.png"} for i in range(4)]).write.mode("append").parquet(source)
    stream = spark.readStream.schema(spark.read.parquet(source).schema).option("maxFilesPerTrigger", 1).parquet(source)
    features = spark.createDataFrame([("1.png", 600, 600, 50.0)], "path string, decoded_width int, decoded_height int, decoded_blur double")
    seen = []
    spec = {"pipeline": {"operators": [{"name": "validator"}, {"name": "image_loader"}]}}
    chain = pl.build_pipeline(spec, pl.Resources(features=features))
    out = streaming.run_to_end(streaming.quality_stream(stream, chain), str(tmp_path / "out"), lambda df, n: seen.append(df.count()))
    assert len(seen) >= 3 and sum(seen) == 12
    assert out.filter("reject_reason is null").count() == 3
