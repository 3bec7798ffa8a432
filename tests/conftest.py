import struct
import zlib

import pytest

from pixsieve import schema as S
from pixsieve.session import local_session

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("4", "tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make_samples(spark):
    """Samples from dictionaries; what is not given has the value of a good, pending sample."""
    base = {
        "sample_id": "test_001", "character": "test", "scene": "test scene", "dialogue": "",
        "image_prompt": "a dog in a field", "emotion": "", "action": "",
        "visual_style": "real_image", "image_path": "test.jpg", "width": 640, "height": 480,
        "blur_score": None, "clip_score": None, "status": "pending", "reject_reason": None,
    }

    def make(*rows: dict, extra: str = ""):
        names = S.SAMPLE_COLUMNS
        given = [c.split()[0] for c in extra.split(", ") if c]
        data = [
            [i + 1, *[{**base, **r}[c] for c in names], *[r.get(c) for c in given]]
            for i, r in enumerate(rows)
        ]
        layout = "row_idx bigint, " + ", ".join(
            f"{f.name} {f.dataType.simpleString()}" for f in S.SAMPLE_SCHEMA
        )
        return spark.createDataFrame(data, layout + (", " + extra if extra else ""))

    return make


def png(width: int, height: int, channels: int, pixels: bytes) -> bytes:
    """An uncompressed-filter PNG: 1 gray, 3 RGB, 4 RGBA."""
    kind = {1: 0, 3: 2, 4: 6}[channels]
    stride = width * channels
    raw = b"".join(b"\0" + pixels[y * stride:(y + 1) * stride] for y in range(height))

    def chunk(tag: bytes, body: bytes) -> bytes:
        return struct.pack(">I", len(body)) + tag + body + struct.pack(">I", zlib.crc32(tag + body))

    head = struct.pack(">IIBBBBB", width, height, 8, kind, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")
