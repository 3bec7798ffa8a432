"""Record layouts, states and reasons."""

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


_S, _I, _L, _D = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()

# Column order is the order of the keys in the written JSON.
SAMPLE_SCHEMA = _struct(
    ("sample_id", _S), ("character", _S), ("scene", _S), ("dialogue", _S),
    ("image_prompt", _S), ("emotion", _S), ("action", _S), ("visual_style", _S),
    ("image_path", _S), ("width", _I), ("height", _I),
    ("blur_score", _D), ("clip_score", _D), ("status", _S), ("reject_reason", _S),
)
SAMPLE_COLUMNS = SAMPLE_SCHEMA.fieldNames()

ANNOTATION_SCHEMA = _struct(
    ("sample_id", _S), ("image_path", _S), ("caption", _S),
    ("model_name", _S), ("status", _S), ("error", _S),
)

DUPLICATE_PAIR_SCHEMA = _struct(
    ("duplicate_sample_id", _S), ("kept_sample_id", _S), ("similarity", _D),
    ("duplicate_quality", _D), ("kept_quality", _D),
)

MANIFEST_SCHEMA = _struct(
    ("source", _S), ("image_id", _L), ("image_path", _S), ("image_url", _S),
    ("width", _I), ("height", _I), ("text", _S),
)

IMAGE_METADATA_SCHEMA = _struct(("image_id", _L), ("url", _S), ("width", _I), ("height", _I))
REGION_SCHEMA = _struct(
    ("id", _L), ("regions", T.ArrayType(_struct(("phrase", _S)))),
)
REQUEST_SCHEMA = _struct(("sample_id", _S), ("image_path", _S))

METRICS_SCHEMA = _struct(
    ("operator", _S), ("processed", _L), ("rejected", _L),
    ("input_samples", _L), ("duplicates_removed", _L), ("output_samples", _L),
)

# What an image scan leaves for the row operators: no pixels.
IMAGE_FEATURE_SCHEMA = _struct(
    ("path", _S), ("decoded_width", _I), ("decoded_height", _I), ("decoded_blur", _D),
    ("image_embedding", T.ArrayType(_D)),
)

# Input order, and the operator (name and position in the chain) that rejected a row.
ROW_INDEX = "row_idx"
REJECTED_BY = "rejected_by"
REJECTED_AT = "rejected_at"
INTERNAL_COLUMNS = (ROW_INDEX, REJECTED_BY, REJECTED_AT)

# States, reasons, operator labels and manifest constants users filter on.
PENDING, VALIDATED, ACCEPTED, REJECTED = "pending", "validated", "accepted", "rejected"
SUCCESS, FAILED = "success", "failed"
MISSING_SAMPLE_ID = "missing_sample_id"
MISSING_IMAGE_PATH = "missing_image_path"
MISSING_IMAGE_PROMPT = "missing_image_prompt"
MISSING_IMAGE = "missing_image"
INVALID_IMAGE = "invalid_image"
MISSING_RESOLUTION = "missing_resolution"
LOW_RESOLUTION = "low_resolution"
BLURRY_IMAGE = "blurry_image"
LOW_ALIGNMENT = "low_clip_alignment"
SEMANTIC_DUPLICATE = "semantic_duplicate"
VALIDATOR_LABEL = "SampleValidator"
LOADER_LABEL = "ImageLoader"
RESOLUTION_LABEL = "ResolutionFilter"
BLUR_LABEL = "BlurFilter"
ALIGNMENT_LABEL = "CLIPAlignmentOperator"
DEDUP_LABEL = "SemanticDedup"
MANIFEST_SOURCE = "visual_genome"
REAL_IMAGE = "real_image"
ID_PREFIX = "vg_"
DEFAULT_CAPTION_MODEL = "Salesforce/blip-image-captioning-base"
