"""Column functions; all run inside the JVM."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from pixsieve.schema import REJECTED

NAN = float("nan")


def _col(c) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def missing(c) -> Column:
    """True for NULL and the empty string; blanks count as present."""
    return F.coalesce(_col(c), F.lit("")) == ""


def is_rejected(status="status") -> Column:
    return F.coalesce(_col(status), F.lit("")) == REJECTED


def strip(c) -> Column:
    """Trim every kind of white space, not only spaces."""
    return F.regexp_replace(_col(c), r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")


def format_id(n, prefix: str = "vg_") -> Column:
    """Six digits, zero padded; longer numbers keep all their digits."""
    return F.format_string(prefix.replace("%", "%%") + "%06d", _col(n))


def _as_double(vector) -> Column:
    return _col(vector).cast("array<double>")


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def dot(a, b) -> Column:
    return _total(F.zip_with(_as_double(a), _as_double(b), lambda x, y: x * y))


def l2_norm(vector) -> Column:
    return F.sqrt(_total(F.transform(_as_double(vector), lambda x: x * x)))


def l2_normalize(vector) -> Column:
    """Unit vector; a zero vector stays zero."""
    floor = F.greatest(l2_norm(vector), F.lit(1e-12))
    # The outer transform binds the norm, so it is computed once per row, not per element.
    scaled = F.transform(F.array(floor), lambda n: F.transform(_as_double(vector), lambda x: x / n))
    return F.element_at(scaled, 1)


def cosine(a, b) -> Column:
    """Cosine with raw norms: NaN when either vector is zero."""
    parts = F.array(dot(a, b), l2_norm(a) * l2_norm(b))
    ratio = F.transform(
        F.array(parts),
        lambda p: F.when(p[1] == 0, F.lit(NAN)).otherwise(p[0] / p[1]),
    )
    return F.element_at(ratio, 1)


def _nan_stays(value: Column, clipped: Column) -> Column:
    return F.when(F.isnan(value), F.lit(NAN)).otherwise(clipped)


def resolution_score(width="width", height="height") -> Column:
    """Area against 1920 x 1080, at most 1; an unknown side counts as 0."""
    area = F.coalesce(_col(width), F.lit(0)).cast("double") * F.coalesce(_col(height), F.lit(0))
    return F.least(area / F.lit(2073600.0), F.lit(1.0))


def sharpness_score(blur="blur_score") -> Column:
    value = F.coalesce(_col(blur).cast("double"), F.lit(0.0))
    return _nan_stays(value, F.least(value / F.lit(500.0), F.lit(1.0)))


def alignment_score(clip="clip_score") -> Column:
    value = F.coalesce(_col(clip).cast("double"), F.lit(0.0))
    return _nan_stays(value, F.least(F.greatest(value, F.lit(0.0)), F.lit(1.0)))


def quality_score(width="width", height="height", blur="blur_score", clip="clip_score") -> Column:
    return (
        F.lit(0.2) * resolution_score(width, height)
        + F.lit(0.3) * sharpness_score(blur)
        + F.lit(0.5) * alignment_score(clip)
    )
