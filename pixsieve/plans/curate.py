"""The whole job: filter, de-duplicate, caption, count."""

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from pixsieve import schema as S
from pixsieve import sinks
from pixsieve.operators import dedup as dd
from pixsieve.operators.annotate import annotate_batches, first_samples
from pixsieve.plans.pipeline import Resources, accepted, build_pipeline
from pixsieve.plans.reports import status_counts
from pixsieve.session import write_table


@dataclass
class Curated:
    dataset: DataFrame          # all rows with their final verdict
    before_dedup: DataFrame     # all rows as the chain left them
    survivors: DataFrame        # accepted rows that dedup kept
    found: DataFrame            # duplicates by row number
    pairs: DataFrame            # duplicates by sample id
    operator_metrics: DataFrame
    dedup_metrics: DataFrame
    counts: DataFrame
    annotations: DataFrame | None

    def metrics(self) -> DataFrame:
        return sinks.with_dedup_metrics(self.operator_metrics.drop("op_pos"), self.dedup_metrics)

    def save(self, dataset_path: str, metrics_path: str, annotations_path: str | None = None) -> None:
        sinks.save_samples(self.dataset, dataset_path)
        sinks.save_metrics(self.metrics(), metrics_path)
        if self.annotations is not None and annotations_path:
            sinks.save_annotations(self.annotations, annotations_path)


def curate(
    samples: DataFrame,
    spec: dict,
    resources: Resources | None = None,
    make_captioner: Callable | None = None,
    caption_options: dict | None = None,
) -> Curated:
    """Run a spec over samples with a unique ``row_idx``.

    The chain is evaluated once: its result is written, which also counts for the operator metrics, and
    dedup, captions and sinks read the columns they need from that table. ``spec["dedup"]`` sets the dedup threshold
    (0.95). ``spec["annotation"]`` turns captions on and sets their limit (10) and batch size.
    """
    resources = resources or Resources()
    chain = build_pipeline(spec, resources)
    running, observed = chain.observed(samples)
    processed = write_table(running, "processed")
    passed = accepted(processed)
    found = dd.find_duplicates(passed, vector=resources.image_vector, **spec.get("dedup", {}))
    dataset = dd.mark_duplicates(processed, found)
    kept = dd.survivors(passed, found)

    settings = spec.get("annotation", {})
    annotations = None
    if settings.get("enabled", False):
        if make_captioner is None:
            raise ValueError("annotation is enabled but no captioner is given")
        annotations = annotate_batches(
            first_samples(kept, settings.get("max_samples", 10)), make_captioner,
            model_name=settings.get("model_name", S.DEFAULT_CAPTION_MODEL),
            batch_size=settings.get("batch_size", 4), **(caption_options or {}),
        )
    return Curated(
        dataset=dataset, before_dedup=processed, survivors=kept, found=found,
        pairs=dd.duplicate_pairs(passed, found), operator_metrics=observed.metrics(),
        dedup_metrics=dd.dedup_metrics(passed, found), counts=status_counts(dataset),
        annotations=annotations,
    )


def caption_raw(samples: DataFrame, make_captioner: Callable, n: int = 5, **options) -> DataFrame:
    """Captions for the first ``n`` samples as read, without filters."""
    return annotate_batches(first_samples(samples, n), make_captioner, **options)
