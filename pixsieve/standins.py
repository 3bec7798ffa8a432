"""Deterministic stand-ins for an encoder and a captioner, for tests and queries.

Real models plug in through the same methods.
"""

import numpy as np


class LetterEncoder:
    """Text vector: how often each letter a to h occurs. Image vector: mean of each channel."""

    letters = "abcdefgh"

    def encode_texts(self, texts: list[str]) -> np.ndarray:
        return np.array([[t.count(letter) for letter in self.letters] for t in texts], dtype=float)

    def encode_images(self, images: list[np.ndarray]) -> np.ndarray:
        means = [image.reshape(-1, image.shape[2]).mean(axis=0) for image in images]
        return np.array([np.resize(m, 8) for m in means])


class SizeCaptioner:
    """Caption: number and sum of the bytes. A sum with ``bad_remainder`` fails the whole batch."""

    def __init__(self, bad_remainder: int | None = None, modulus: int = 50):
        self.bad_remainder, self.modulus = bad_remainder, modulus

    def caption(self, images: list[bytes]) -> list[str]:
        sums = [sum(image) for image in images]
        if any(s % self.modulus == self.bad_remainder for s in sums):
            raise RuntimeError("captioner failed")
        return [f"  {len(image)} bytes, sum {s} \n" for image, s in zip(images, sums)]


def open_bytes(payload) -> bytes:
    """``load`` for pixel bytes that travel in a column."""
    if payload is None or len(payload) == 0:
        raise ValueError("cannot identify image file")
    return bytes(payload)
