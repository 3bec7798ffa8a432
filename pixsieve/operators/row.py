"""Row operators: each turns a DataFrame of samples into one with verdicts written on it.

A rejected row is never dropped; it carries ``status`` and ``reject_reason``. All rules are
column expressions, so a chain of operators is a single narrow stage.
"""

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pixsieve import schema as S
from pixsieve.functions import cosine, is_rejected, missing
from pixsieve.operators.encode import encode_texts
from pixsieve.session import write_table

Rule = tuple[Column, str]
_FAIL = "_fail"


def judge(
    df: DataFrame,
    rules: Sequence[Rule],
    passed: str | None = None,
    skip_rejected: bool = True,
    updates: dict[str, tuple[Column, Column]] | None = None,
) -> DataFrame:
    """Apply ``rules`` in order; the first that holds rejects the row with its reason.

    ``passed`` is the status of a row that no rule hit (``None`` leaves status and reason
    alone). ``updates`` maps a column to (condition, value), and is applied to judged rows only.
    """
    judged = ~is_rejected() if skip_rejected else F.lit(True)
    reason = F.when(judged & rules[0][0], F.lit(rules[0][1]))
    for condition, name in rules[1:]:
        reason = reason.when(judged & condition, F.lit(name))
    df = df.withColumn(_FAIL, reason)

    failed = F.col(_FAIL).isNotNull()
    status = F.when(failed, F.lit(S.REJECTED))
    why = F.when(failed, F.col(_FAIL))
    if passed is not None:
        status = status.when(judged, F.lit(passed))
        why = why.when(judged, F.lit(None).cast("string"))
    columns = {
        "status": status.otherwise(F.col("status")),
        "reject_reason": why.otherwise(F.col("reject_reason")),
    }
    for name, (condition, value) in (updates or {}).items():
        columns[name] = F.when(judged & condition, value).otherwise(F.col(name))
    return df.withColumns(columns).drop(_FAIL)


class Operator:
    """Anything with a ``label`` and ``process(df) -> df`` can stand in a chain."""

    label = "Operator"

    def process(self, df: DataFrame) -> DataFrame:
        raise NotImplementedError

    def process_alive(self, df: DataFrame) -> DataFrame:
        """``process`` for a chain: rows already rejected never reach it and come out as they are.

        The rows are written once and read by both parts; a stream is read twice instead. A
        column that ``process`` adds is NULL for rejected rows, one that it leaves out is gone.
        """
        stored = df if df.isStreaming else write_table(df, "before-operator")
        rejected = F.coalesce(is_rejected(), F.lit(False))
        out = self.process(stored.filter(~rejected))
        rest = stored.filter(rejected)
        same = [F.col(f.name) if f.name in rest.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in out.schema]
        return out.unionByName(rest.select(*same))


class FunctionOperator(Operator):
    """A user's own DataFrame function as an operator."""

    def __init__(self, label: str, function: Callable[[DataFrame], DataFrame]):
        self.label, self.function = label, function

    def process(self, df: DataFrame) -> DataFrame:
        return self.function(df)


class SampleValidator(Operator):
    """Id, image path and prompt are required, in that order."""

    label = S.VALIDATOR_LABEL

    def _judge(self, df: DataFrame, skip_rejected: bool) -> DataFrame:
        rules = [
            (missing("sample_id"), S.MISSING_SAMPLE_ID),
            (missing("image_path"), S.MISSING_IMAGE_PATH),
            (missing("image_prompt"), S.MISSING_IMAGE_PROMPT),
        ]
        return judge(df, rules, passed=S.VALIDATED, skip_rejected=skip_rejected)

    def process(self, df: DataFrame) -> DataFrame:
        return self._judge(df, skip_rejected=False)

    def process_alive(self, df: DataFrame) -> DataFrame:
        return self._judge(df, skip_rejected=True)


def resolve_image_path(image_dir: str = "outputs/images") -> Column:
    """The given path, else ``<image_dir>/<sample_id>.jpg``."""
    fallback = F.concat(
        F.lit(image_dir.rstrip("/") + "/" if image_dir else ""),
        F.coalesce("sample_id", F.lit("None")), F.lit(".jpg"),
    )
    return F.when(missing("image_path"), fallback).otherwise(F.col("image_path"))


def attach_features(df: DataFrame, features: DataFrame, path: Column) -> DataFrame:
    """Left join of samples with the narrow image table, one row per file.

    ``features`` holds no pixels. Each path occurs once on that side, so the join keeps the
    number of rows; a path shared by very many samples is split by the adaptive skew join,
    since the sample side is the one that preserves rows.
    """
    found = features.select(
        F.col("path").alias("_path"), *[c for c in features.columns if c != "path"]
    )
    joined = df.withColumn("_wanted", path)
    return joined.join(found, F.col("_wanted") == F.col("_path"), "left").drop("_wanted")


class ImageLoader(Operator):
    """Existence and decodability of the image; size comes from the pixels."""

    label = S.LOADER_LABEL

    def __init__(self, features: DataFrame, image_dir: str = "outputs/images"):
        self.features, self.image_dir = features, image_dir

    def _judge(self, df: DataFrame, skip_rejected: bool) -> DataFrame:
        decoded = F.coalesce(F.col("decoded_height"), F.lit(-1)) > 0
        rules = [
            (F.col("_path").isNull(), S.MISSING_IMAGE),
            (~decoded, S.INVALID_IMAGE),
        ]
        updates = {
            "image_path": (decoded, resolve_image_path(self.image_dir)),
            "width": (decoded, F.col("decoded_width")),
            "height": (decoded, F.col("decoded_height")),
        }
        joined = attach_features(df, self.features, resolve_image_path(self.image_dir))
        return judge(joined, rules, skip_rejected=skip_rejected, updates=updates).drop(
            "_path", "decoded_width", "decoded_height"
        )

    def process(self, df: DataFrame) -> DataFrame:
        return self._judge(df, skip_rejected=False)

    def process_alive(self, df: DataFrame) -> DataFrame:
        return self._judge(df, skip_rejected=True)


class ListedImageLoader(ImageLoader):
    """A loader that opens the files of rows still alive, and no others.

    ``listing`` has ``path, place`` of the files at hand (``sources.list_images``), ``measure(listing, wanted)`` opens and
    measures those whose path is in ``wanted``. The rows so far are written once: they say which files
    are wanted and then meet what was found in them. Not for streams.
    """

    def __init__(self, listing: DataFrame, measure: Callable[[DataFrame, DataFrame], DataFrame], image_dir: str = "outputs/images"):
        super().__init__(listing, image_dir)
        self.listing, self.measure = listing, measure

    def _judge(self, df: DataFrame, skip_rejected: bool) -> DataFrame:
        if df.isStreaming:
            raise ValueError("on a stream, give ImageLoader a table of features")
        stored = write_table(df, "before-loader")
        rows = stored.filter(~F.coalesce(is_rejected(), F.lit(False))) if skip_rejected else stored
        wanted = rows.select(resolve_image_path(self.image_dir).alias("path")).distinct()
        self.features = write_table(self.measure(self.listing, wanted), "listed-features")
        return super()._judge(stored, skip_rejected)


class ResolutionFilter(Operator):
    label = S.RESOLUTION_LABEL

    def __init__(self, min_width: int = 512, min_height: int = 512):
        self.min_width, self.min_height = min_width, min_height

    def process(self, df: DataFrame) -> DataFrame:
        width, height = F.col("width"), F.col("height")
        rules = [
            (width.isNull() | height.isNull(), S.MISSING_RESOLUTION),
            ((width < self.min_width) | (height < self.min_height), S.LOW_RESOLUTION),
        ]
        return judge(df, rules)

    process_alive = process


class BlurFilter(Operator):
    """Rejects images whose Laplacian variance is below the threshold.

    The score was taken while the image was decoded. If no loader ran before, the operator
    joins ``features`` itself.
    """

    label = S.BLUR_LABEL

    def __init__(self, threshold: float = 100.0, features: DataFrame | None = None):
        self.threshold, self.features = threshold, features

    def process(self, df: DataFrame) -> DataFrame:
        if "decoded_blur" not in df.columns:
            if self.features is None:
                raise ValueError("BlurFilter needs an image loader before it, or features")
            df = attach_features(df, self.features, F.col("image_path")).drop(
                "_path", "decoded_width", "decoded_height"
            )
        score = F.col("decoded_blur")
        usable = ~missing("image_path") & score.isNotNull()
        rules = [
            (missing("image_path"), S.MISSING_IMAGE_PATH),
            (score.isNull(), S.INVALID_IMAGE),
            (score < F.lit(float(self.threshold)), S.BLURRY_IMAGE),
        ]
        return judge(df, rules, passed=S.ACCEPTED, updates={"blur_score": (usable, score)})

    process_alive = process


class AlignmentFilter(Operator):
    """Cosine of the image and the text vector against a threshold.

    A NaN cosine is not below the threshold, so it is accepted. A sample without an image
    vector stops the run, or with ``on_error="reject"`` is rejected as an invalid image. With
    ``make_encoder`` the text vectors are made here, for the rows that are still alive.
    """

    label = S.ALIGNMENT_LABEL

    def __init__(
        self,
        threshold: float = 0.20,
        model_name: str = "openai/clip-vit-base-patch32",
        image_vector: str = "image_embedding",
        text_vector: str = "text_embedding",
        on_error: str = "raise",
        make_encoder: Callable | None = None,
    ):
        if on_error not in ("raise", "reject"):
            raise ValueError(f"on_error must be raise or reject, not {on_error}")
        self.threshold, self.model_name, self.on_error = threshold, model_name, on_error
        self.image_vector, self.text_vector = image_vector, text_vector
        self.make_encoder = make_encoder

    def process(self, df: DataFrame) -> DataFrame:
        if self.make_encoder is not None:
            df = encode_texts(df, self.make_encoder, into=self.text_vector)
        image, text = F.col(self.image_vector), F.col(self.text_vector)
        scored = ~is_rejected() & ~missing("image_prompt")
        unusable = image.isNull() | text.isNull()
        value = cosine(image, text)
        if self.on_error == "raise":
            message = F.concat(F.lit("no image or text vector for sample "), F.col("sample_id"))
            value = F.when(unusable, F.raise_error(message).cast("double")).otherwise(value)
        df = df.withColumn("_cosine", F.when(scored, value))
        rules = [(missing("image_prompt"), S.MISSING_IMAGE_PROMPT)]
        if self.on_error == "reject":
            rules.append((unusable, S.INVALID_IMAGE))
        rules.append((F.col("_cosine") < F.lit(float(self.threshold)), S.LOW_ALIGNMENT))
        updates = {"clip_score": (F.col("_cosine").isNotNull(), F.col("_cosine"))}
        return judge(df, rules, passed=S.ACCEPTED, updates=updates).drop("_cosine")

    process_alive = process
