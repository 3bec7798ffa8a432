"""Image bytes to pixels inside tasks, in the layout of Spark's image source (rows of gray, BGR or BGRA)."""

import io
import struct
import zlib
from typing import BinaryIO

import numpy as np

PNG_SIGNATURE = b"\x89PNG\r\n\x1a\n"
# First bytes of formats that need an imaging library.
OTHER_SIGNATURES = (b"\xff\xd8\xff", b"GIF8", b"BM", b"RIFF", b"II*\0", b"MM\0*")
_CHANNELS = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}


class NoDecoder(ValueError):
    """The bytes may be an image, but nothing at hand can tell."""


def decode_image(data: bytes) -> np.ndarray | None:
    """Pixels as ``height x width x channels``; None for bytes that are no image.

    8-bit PNGs without interlacing are decoded here, anything else by Pillow if it is installed.
    Without it such bytes raise ``NoDecoder``: they must not pass for broken images.
    """
    if data[:8] == PNG_SIGNATURE:
        try:
            header, palette, packed = _png_chunks(data)
            if header[2] == 8 and header[6] == 0:
                return _png_pixels(header, palette, zlib.decompress(packed))
        except (struct.error, zlib.error, ValueError, KeyError, IndexError, TypeError):
            return None
    elif not data.startswith(OTHER_SIGNATURES):
        return None
    return _by_library(data)


def plain_start(stream: BinaryIO) -> bool:
    """Whether ``decode_image`` needs no library for the file that starts here, and gives what Spark's image source gives.

    That is an 8-bit PNG of gray, RGB or RGBA without interlacing and transparent colours, or no image. Bytes that start with a zero may be
    an image without a signature.
    """
    start = stream.read(8)
    if start != PNG_SIGNATURE:
        return not start.startswith((*OTHER_SIGNATURES, PNG_SIGNATURE[:4], b"\0"))
    header = None
    while len(head := stream.read(8)) == 8:
        size, kind = struct.unpack(">I4s", head)
        if kind == b"IDAT":
            return header is not None and header[2] == 8 and header[3] in (0, 2, 6) and header[6] == 0
        if kind == b"tRNS" or kind == b"IHDR" and size != 13:
            return False
        body = stream.read(size + 4)
        if kind == b"IHDR" and len(body) == 17:
            header = struct.unpack(">IIBBBBB", body[:13])
    return False


def _png_chunks(data: bytes) -> tuple[tuple, bytes | None, bytes]:
    at, header, palette, packed = 8, None, None, []
    while at + 8 <= len(data):
        size, kind = struct.unpack_from(">I4s", data, at)
        body = data[at + 8:at + 8 + size]
        if len(body) < size:
            raise ValueError("the file ends inside a chunk")
        if kind == b"IHDR":
            header = struct.unpack(">IIBBBBB", body)
        elif kind == b"PLTE":
            palette = body
        elif kind == b"IDAT":
            packed.append(body)
        elif kind == b"IEND":
            break
        at += 12 + size
    return header, palette, b"".join(packed)


def _unfilter(rows: np.ndarray, step: int) -> np.ndarray:
    """Undo the line filters; ``rows`` has the filter number in its first column."""
    out = np.zeros((len(rows), rows.shape[1] - 1), np.uint8)
    above = np.zeros(out.shape[1], np.uint8)
    for y, row in enumerate(rows):
        line, kind = row[1:].copy(), row[0]
        if kind == 1:
            columns = line.reshape(-1, step)
            line = np.cumsum(columns, axis=0, dtype=np.uint8).reshape(-1)
        elif kind == 2:
            line += above
        elif kind in (3, 4):
            line = _by_neighbours(line, above, step, kind)
        elif kind != 0:
            raise ValueError("unknown line filter")
        out[y] = above = line
    return out


def _by_neighbours(line: np.ndarray, above: np.ndarray, step: int, kind: int) -> np.ndarray:
    left_of, up_of, out = [0] * step, above.tolist(), line.tolist()
    corner_of = [0] * step + up_of[:-step]
    for x, (up, corner) in enumerate(zip(up_of, corner_of)):
        left = out[x - step] if x >= step else left_of[x]
        if kind == 3:
            guess = (left + up) // 2
        else:
            near = left + up - corner
            guess = min((left, up, corner), key=lambda v: abs(near - v))
        out[x] = (out[x] + guess) & 255
    return np.array(out, np.uint8)


def _png_pixels(header: tuple, palette: bytes | None, raw: bytes) -> np.ndarray:
    width, height, _, colour = header[:4]
    step = _CHANNELS[colour]
    if not width or not height:
        raise ValueError("no pixels")
    rows = np.frombuffer(raw, np.uint8)[:height * (width * step + 1)].reshape(height, width * step + 1)
    pixels = _unfilter(rows, step).reshape(height, width, step)
    if colour == 3:
        return np.frombuffer(palette, np.uint8).reshape(-1, 3)[pixels[:, :, 0]][:, :, ::-1].copy()
    if colour == 4:
        return pixels[:, :, [0, 0, 0, 1]]
    return pixels if colour == 0 else pixels[:, :, [2, 1, 0, 3][:step]]


def _by_library(data: bytes) -> np.ndarray | None:
    try:
        from PIL import Image, UnidentifiedImageError
    except ImportError:
        raise NoDecoder("this image format needs Pillow on the executors") from None
    try:
        image = Image.open(io.BytesIO(data))
        image.load()
    except (UnidentifiedImageError, OSError, SyntaxError):
        return None
    if image.mode in ("L", "1"):
        return np.asarray(image.convert("L"), dtype=np.uint8)[:, :, None]
    if "A" in image.mode:
        return np.asarray(image.convert("RGBA"), dtype=np.uint8)[:, :, [2, 1, 0, 3]]
    return np.asarray(image.convert("RGB"), dtype=np.uint8)[:, :, ::-1].copy()
