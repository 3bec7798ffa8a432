import pytest
from pyspark.sql import functions as F

from pixsieve import fixtures as fx
from pixsieve.operators import FunctionOperator, ResolutionFilter, SampleValidator, judge
from pixsieve.plans import pipeline as pl

from conftest import SF_DIR


def rows(df, *columns):
    return [tuple(r[c] for c in columns) for r in df.orderBy("row_idx").collect()]


def test_short_circuit_and_attribution(make_samples):
    df = make_samples(
        {"width": 600, "height": 600}, {"image_path": None, "width": 1}, {"width": 1},
        {"status": "rejected", "reject_reason": "upstream"},
    )
    chain = pl.QualityPipeline([SampleValidator(), ResolutionFilter(512, 512), ResolutionFilter(700, 1)])
    out = chain.run(df)
    assert rows(out, "status", "reject_reason", "rejected_by", "rejected_at") == [
        ("rejected", "low_resolution", "ResolutionFilter", 2),
        ("rejected", "missing_image_path", "SampleValidator", 0),
        ("rejected", "low_resolution", "ResolutionFilter", 1),
        ("rejected", "upstream", None, None),
    ]
    # Three rows enter; operators of one class share a row of the metrics.
    metrics = chain.metrics(out).orderBy("op_pos").collect()
    assert [(m.operator, m.processed, m.rejected) for m in metrics] == [
        ("SampleValidator", 3, 1), ("ResolutionFilter", 2 + 1, 1 + 1),
    ]


def test_metrics_list_every_operator_even_without_rows(make_samples):
    chain = pl.QualityPipeline([SampleValidator(), ResolutionFilter()])
    metrics = chain.metrics(chain.run(make_samples({}).filter("false"))).collect()
    assert {(m.operator, m.processed, m.rejected) for m in metrics} == {
        ("SampleValidator", 0, 0), ("ResolutionFilter", 0, 0),
    }
    assert pl.QualityPipeline([]).metrics(chain.run(make_samples({}))).count() == 0


def test_a_user_function_cannot_revive_rejected_rows(make_samples):
    revive = FunctionOperator("Revive", lambda df: df.withColumn("status", F.lit("accepted")))
    out = pl.QualityPipeline([SampleValidator(), revive]).run(make_samples({}, {"sample_id": ""}))
    assert rows(out, "status", "reject_reason") == [("accepted", None), ("rejected", "missing_sample_id")]


def spec(*entries):
    return {"pipeline": {"operators": list(entries)}}


def test_spec_errors():
    with pytest.raises(ValueError, match="Unknown operator: nope"):
        pl.build_pipeline(spec({"name": "nope"}))
    with pytest.raises(TypeError):
        pl.build_pipeline(spec({"name": "resolution_filter", "params": {"min_depth": 1}}))
    with pytest.raises(ValueError):
        pl.build_pipeline(spec({"name": "image_loader"}))
    assert pl.build_pipeline(spec({"name": "nope", "enabled": False})).operators == []
    # The validator takes no parameters and ignores those given.
    assert len(pl.build_pipeline(spec({"name": "validator", "params": {"x": 1}})).operators) == 1


def test_registered_operator(make_samples):
    def build(params, _):
        return FunctionOperator("NoWord", lambda df: judge(df, [(F.col("scene").contains(params["word"]), "has_word")]))

    pl.register_operator("no_word", build)
    chain = pl.build_pipeline(spec({"name": "no_word", "params": {"word": "cat"}}))
    out = chain.run(make_samples({"scene": "a cat"}, {"scene": "a dog"}))
    assert rows(out, "status", "rejected_by") == [("rejected", "NoWord"), ("pending", None)]


def test_without_blur_and_alignment_nothing_is_accepted(make_samples):
    chain = pl.build_pipeline(spec({"name": "validator"}, {"name": "resolution_filter", "params": {"min_width": 1, "min_height": 1}}))
    assert pl.accepted(chain.run(make_samples({}))).count() == 0


def test_result_does_not_depend_on_the_number_of_partitions(spark):
    resources = pl.Resources(features=fx.features(spark, SF_DIR))
    chain = pl.build_pipeline(pl.DEFAULT_SPEC, resources)
    samples = fx.samples(spark, SF_DIR)
    columns = ("row_idx", "status", "reject_reason", "rejected_by")
    results = [rows(chain.run(samples.repartition(n)), *columns) for n in (1, 3, 8)]
    assert results[0] == results[1] == results[2]
    assert {r[2] for r in results[0]} >= {
        "missing_sample_id", "missing_image_path", "missing_image_prompt", "missing_image",
        "invalid_image", "low_resolution", "blurry_image", "low_clip_alignment", "upstream",
    }


def test_a_cheap_chain_is_one_narrow_stage(make_samples):
    chain = pl.QualityPipeline([SampleValidator(), ResolutionFilter()])
    plan = chain.run(make_samples({}))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_only_images_that_reach_the_alignment_are_encoded(spark):
    from pixsieve import sources
    from pixsieve.standins import LetterEncoder

    limits = pl.encoding_limits(pl.DEFAULT_SPEC)
    assert limits == {"min_width": 512, "min_height": 512, "min_blur": 100.0}
    early = spec({"name": "clip_alignment"}, {"name": "blur_filter"})
    assert pl.encoding_limits(early) == {"min_width": 0, "min_height": 0, "min_blur": 0.0}
    images = fx.images(spark, SF_DIR)
    some = sources.image_features(images, LetterEncoder, min_blur=100.0).collect()
    assert all((r.image_embedding is not None) == (r.decoded_blur is not None and r.decoded_blur >= 100) for r in some)
    small = sources.image_features(images, LetterEncoder, min_width=9).filter("image_embedding is not null")
    assert small.count() == 0


def test_texts_are_encoded_inside_the_chain_for_alive_rows(spark, make_samples):
    from pixsieve.standins import LetterEncoder

    df = make_samples(
        {"image_prompt": "aab", "image_embedding": [1.0] + [0.0] * 7},
        {"image_prompt": "hh", "image_embedding": [1.0] + [0.0] * 7},
        {"image_prompt": "aa", "sample_id": "", "image_embedding": None},
        extra="image_embedding array<double>",
    )
    chain = pl.build_pipeline(
        spec({"name": "validator"}, {"name": "clip_alignment"}), pl.Resources(make_text_encoder=LetterEncoder)
    )
    out = chain.run(df)
    assert rows(out, "status", "reject_reason") == [
        ("accepted", None), ("rejected", "low_clip_alignment"), ("rejected", "missing_sample_id"),
    ]


def jobs(spark) -> int:
    return spark._jsc.sc().statusStore().jobsList(None).size()


def test_observed_metrics_equal_counted_ones_and_scan_nothing(spark):
    from pixsieve.session import write_table

    chain = pl.build_pipeline(pl.DEFAULT_SPEC, pl.Resources(features=fx.features(spark, SF_DIR)))
    running, observed = chain.observed(fx.samples(spark, SF_DIR))
    written = write_table(running, "observed")
    before = jobs(spark)
    metrics = observed.metrics()
    seen = {tuple(r) for r in metrics.collect()}
    # The collect of one local row.
    assert jobs(spark) <= before + 1
    counted = chain.metrics(written)
    assert seen == {tuple(r) for r in counted.collect()} and metrics.dtypes == counted.dtypes
    assert jobs(spark) > before + 1


def test_observed_metrics_without_rows_or_operators(make_samples):
    chain = pl.QualityPipeline([SampleValidator(), ResolutionFilter(), ResolutionFilter(1, 1)])
    out, observed = chain.observed(make_samples({}).filter("false"))
    assert out.collect() == []
    assert {tuple(r) for r in observed.metrics().collect()} == {("SampleValidator", 0, 0, 0), ("ResolutionFilter", 1, 0, 0)}
    out, observed = pl.QualityPipeline([]).observed(make_samples({}))
    assert out.count() == 1 and observed.metrics().count() == 0


RETRY = """
import sys
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pixsieve.operators import ResolutionFilter
from pixsieve.plans.pipeline import QualityPipeline

spark = SparkSession.builder.master("local[2,3]").config("spark.ui.enabled", "false").getOrCreate()
spark.sparkContext.setLogLevel("OFF")

def fail_once(batches):
    from pyspark import TaskContext
    for batch in batches:
        yield batch
    if TaskContext.get().attemptNumber() == 0:
        raise RuntimeError("lost")

rows = spark.range(100).select(
    F.col("id").alias("row_idx"), (F.col("id") * 10).cast("int").alias("width"), F.lit(600).alias("height"),
    F.lit("pending").alias("status"), F.lit(None).cast("string").alias("reject_reason"),
)
rows = rows.repartition(4).mapInArrow(fail_once, rows.schema)
out, observed = QualityPipeline([ResolutionFilter()]).observed(rows)
out.write.parquet(sys.argv[1])
print([tuple(r) for r in observed.metrics().collect()], spark.read.parquet(sys.argv[1]).count())
"""


def test_tasks_that_are_tried_again_count_once(tmp_path):
    import os
    import subprocess
    import sys
    from pathlib import Path

    root = str(Path(pl.__file__).parents[2])
    run = subprocess.run(
        [sys.executable, "-c", RETRY, str(tmp_path / "out")], capture_output=True, text=True, timeout=240,
        env=os.environ | {"PYTHONPATH": root},
    )
    assert run.stdout.strip().endswith("[('ResolutionFilter', 0, 100, 52)] 100"), run.stdout + run.stderr[-2000:]
