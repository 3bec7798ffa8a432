"""NumPy helpers on one decoded image; they run inside Arrow tasks."""

import numpy as np

# 15-bit weights of the usual 8-bit BGR-to-gray conversion.
GRAY_WEIGHTS_BGR = (3735, 19235, 9798)


def to_array(height: int, width: int, channels: int, data: bytes) -> np.ndarray:
    """Row-major BGR bytes of the image source as ``height x width x channels``."""
    return np.frombuffer(data, dtype=np.uint8).reshape(height, width, channels)


def to_gray(image: np.ndarray) -> np.ndarray:
    """One channel passes through; alpha is ignored."""
    if image.shape[2] == 1:
        return image[:, :, 0]
    weights = np.array(GRAY_WEIGHTS_BGR, dtype=np.int32)
    return ((image[:, :, :3].astype(np.int32) @ weights + (1 << 14)) >> 15).astype(np.uint8)


def laplacian_variance(gray: np.ndarray) -> float:
    """Population variance of the 4-neighbour Laplacian, border mirrored without its edge."""
    g = gray.astype(np.int16)
    response = g * np.int16(-4)
    for along, source in ((response, g), (response.T, g.T)):
        mirror = 1 if len(source) > 1 else 0
        along[1:] += source[:-1]
        along[:-1] += source[1:]
        along[0] += source[mirror]
        along[-1] += source[len(source) - 1 - mirror]
    return float(response.var(dtype=np.float64))
