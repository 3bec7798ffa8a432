from pixsieve.functions.scalars import (
    alignment_score, cosine, dot, format_id, is_rejected, l2_norm, l2_normalize, missing,
    quality_score, resolution_score, sharpness_score, strip,
)

__all__ = [
    "alignment_score", "cosine", "dot", "format_id", "is_rejected", "l2_norm", "l2_normalize", "missing",
    "quality_score", "resolution_score", "sharpness_score", "strip",
]
