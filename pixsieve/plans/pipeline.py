"""The operator chain, its declaration by a dictionary, and its metrics."""

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from pixsieve import schema as S
from pixsieve.functions import is_rejected
from pixsieve.operators.row import (
    AlignmentFilter, BlurFilter, ImageLoader, ListedImageLoader, Operator, ResolutionFilter, SampleValidator,
)
from pixsieve.sources.images import measure_listed


METRICS_LAYOUT = "operator string, op_pos int, processed bigint, rejected bigint"


class QualityPipeline:
    """Operators in order; a row stops at the operator that rejects it."""

    def __init__(self, operators: Sequence[Operator]):
        self.operators = list(operators)

    def run(self, df: DataFrame) -> DataFrame:
        """All rows, with the verdict and the operator it came from."""
        df = df.withColumns({
            S.REJECTED_BY: F.lit(None).cast("string"),
            S.REJECTED_AT: F.lit(None).cast("int"),
        })
        for position, operator in enumerate(self.operators):
            df = self._step(df, position, operator)
        return df

    @staticmethod
    def _step(df: DataFrame, position: int, operator: Operator) -> DataFrame:
        alive = operator.process_alive(df.withColumn("_was_rejected", is_rejected()))
        hit = ~F.col("_was_rejected") & is_rejected()
        return alive.withColumns({
            S.REJECTED_BY: F.when(hit, F.lit(operator.label)).otherwise(F.col(S.REJECTED_BY)),
            S.REJECTED_AT: F.when(hit, F.lit(position)).otherwise(F.col(S.REJECTED_AT)),
        }).drop("_was_rejected")

    def metrics(self, processed: DataFrame, by: Sequence[str] = ()) -> DataFrame:
        """``operator, op_pos, processed, rejected``, one row per operator label, zeros kept.

        ``by`` names columns to count separately for.

        One scan: every count is a conditional count of the same aggregate; operators that
        share a label share a row.
        """
        if not self.operators:
            return processed.sparkSession.createDataFrame([], METRICS_LAYOUT)
        return self._per_label(processed.groupBy(*by).agg(*self._counts()), by)

    def observed(self, df: DataFrame) -> tuple[DataFrame, "Observed"]:
        """``run``, with the metrics taken while its result is written: the rows are not scanned for them.

        Counts come in with the tasks of the stage that writes, once for each of its partitions however often one
        is tried. Write the result right away; if a later shuffle makes a lost stage run again, its rows count again.
        """
        watch = Observation()
        return self.run(df).observe(watch, F.count(F.lit(1)).alias("rows"), *self._counts()), Observed(self, watch, df.sparkSession)

    def _counts(self) -> list[Column]:
        at = F.col(S.REJECTED_AT)
        entered = ~(is_rejected() & at.isNull())
        counts = []
        for position in range(len(self.operators)):
            reached = entered & (at.isNull() | (at >= position))
            counts.append(F.count_if(reached).alias(f"p{position}"))
            counts.append(F.count_if(at == position).alias(f"r{position}"))
        return counts

    def _per_label(self, counted: DataFrame, by: Sequence[str] = ()) -> DataFrame:
        """One row per operator label from the columns of ``_counts``."""
        labels: dict[str, list[int]] = {}
        for position, operator in enumerate(self.operators):
            labels.setdefault(operator.label, []).append(position)
        rows = [
            F.struct(
                F.lit(label).alias("operator"),
                F.lit(positions[0]).alias("op_pos"),
                sum((F.col(f"p{p}") for p in positions), F.lit(0)).alias("processed"),
                sum((F.col(f"r{p}") for p in positions), F.lit(0)).alias("rejected"),
            )
            for label, positions in labels.items()
        ]
        return counted.select(*by, F.inline(F.array(*rows)))


class Observed:
    """The metrics of a chain whose result has been written; asking before waits for that."""

    def __init__(self, chain: QualityPipeline, watch: Observation, spark: SparkSession):
        self.chain, self.watch, self.spark = chain, watch, spark

    def metrics(self) -> DataFrame:
        counts = self.watch.get
        if not self.chain.operators:
            return self.spark.createDataFrame([], METRICS_LAYOUT)
        layout = ", ".join(f"{name} bigint" for name in counts)
        return self.chain._per_label(self.spark.createDataFrame([tuple(counts.values())], layout))


@dataclass
class Resources:
    """Tables and columns that operators of a spec may need."""

    features: DataFrame | None = None
    listing: DataFrame | None = None    # files that the loader opens itself, in place of features
    image_vector: str = "image_embedding"
    text_vector: str = "text_embedding"
    on_error: str = "raise"
    make_text_encoder: Callable | None = None


Factory = Callable[[dict, Resources], Operator]


def _loader(params: dict, resources: Resources) -> Operator:
    if resources.listing is not None:
        return ListedImageLoader(resources.listing, measure_listed)
    if resources.features is None:
        raise ValueError("image_loader needs a table of image features")
    return ImageLoader(resources.features)


def _alignment(params: dict, resources: Resources) -> Operator:
    given = {
        "image_vector": resources.image_vector,
        "text_vector": resources.text_vector,
        "on_error": resources.on_error,
        "make_encoder": resources.make_text_encoder,
    }
    return AlignmentFilter(**{**given, **params})


_FACTORIES: dict[str, Factory] = {
    "validator": lambda params, resources: SampleValidator(),
    "image_loader": _loader,
    "resolution_filter": lambda params, resources: ResolutionFilter(**params),
    "blur_filter": lambda params, resources: BlurFilter(
        **{"features": resources.features, **params}
    ),
    "clip_alignment": _alignment,
}


def register_operator(name: str, factory: Factory) -> None:
    """Make ``name`` usable in a spec; ``factory(params, resources)`` builds the operator."""
    _FACTORIES[name] = factory


# The standard chain with its thresholds.
DEFAULT_SPEC = {
    "pipeline": {
        "operators": [
            {"name": "validator", "enabled": True},
            {"name": "image_loader", "enabled": True},
            {"name": "resolution_filter", "enabled": True,
             "params": {"min_width": 512, "min_height": 512}},
            {"name": "blur_filter", "enabled": True, "params": {"threshold": 100.0}},
            {"name": "clip_alignment", "enabled": True, "params": {"threshold": 0.20}},
        ]
    }
}


def build_pipeline(spec: dict, resources: Resources | None = None) -> QualityPipeline:
    """The chain a spec declares; disabled entries are skipped before their name is read."""
    resources = resources or Resources()
    operators = []
    for entry in spec["pipeline"]["operators"]:
        if not entry.get("enabled", True):
            continue
        name = entry["name"]
        if name not in _FACTORIES:
            raise ValueError(f"Unknown operator: {name}")
        operators.append(_FACTORIES[name](entry.get("params", {}), resources))
    return QualityPipeline(operators)


def encoding_limits(spec: dict) -> dict[str, float]:
    """Minimums that an image must reach to get as far as the alignment of a spec."""
    limits: dict[str, float] = {"min_width": 0, "min_height": 0, "min_blur": 0.0}
    for entry in spec["pipeline"]["operators"]:
        if not entry.get("enabled", True):
            continue
        if entry["name"] == "clip_alignment":
            break
        given = entry.get("params", {})
        if entry["name"] == "resolution_filter":
            size = ResolutionFilter(**given)
            limits["min_width"] = max(limits["min_width"], size.min_width)
            limits["min_height"] = max(limits["min_height"], size.min_height)
        elif entry["name"] == "blur_filter":
            limits["min_blur"] = max(limits["min_blur"], BlurFilter(**given).threshold)
    return limits


def accepted(df: DataFrame) -> DataFrame:
    return df.filter(F.col("status") == S.ACCEPTED)
