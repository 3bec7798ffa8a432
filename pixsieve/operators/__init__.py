from pixsieve.operators.row import (
    AlignmentFilter, BlurFilter, FunctionOperator, ImageLoader, ListedImageLoader, Operator,
    ResolutionFilter, SampleValidator, judge, resolve_image_path,
)

__all__ = [
    "AlignmentFilter", "BlurFilter", "FunctionOperator", "ImageLoader", "ListedImageLoader",
    "Operator", "ResolutionFilter", "SampleValidator", "judge", "resolve_image_path",
]
