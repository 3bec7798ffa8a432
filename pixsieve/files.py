"""Files in storage that the executors share: what there is, and their bytes."""

import os
from collections.abc import Iterator
from typing import BinaryIO
from urllib.parse import quote

LISTED_ROWS = 10_000


def open_listed(place: str) -> BinaryIO:
    """Opens a file by the name that Spark's listing gave it: scheme and path, nothing escaped.

    Raises ``FileNotFoundError`` if it is gone.
    """
    scheme, _, rest = place.partition(":")
    if scheme == "file":
        return open("/" + rest.lstrip("/"), "rb")
    from pyarrow import fs

    system, inner = fs.FileSystem.from_uri(quote(place, safe="/:@"))
    return system.open_input_file(inner)


def shared_folder(path: str):
    """The pyarrow file system of a folder in shared storage, and the folder in there; nothing in ``path`` is escaped."""
    from pyarrow import fs

    scheme, colon, rest = path.partition(":")
    if not colon or scheme == "file":
        return fs.LocalFileSystem(), "/" + (rest if colon else path).lstrip("/")
    return fs.FileSystem.from_uri(quote(path, safe="/:@"))


def read_listed(place: str) -> bytes:
    with open_listed(place) as stream:
        return stream.read()


def _visible(name: str) -> bool:
    """Names that Spark's own listing shows."""
    return not (name.startswith(".") or name.startswith("_") and "=" not in name or name.endswith("._COPYING_"))


def _entries(place: str) -> Iterator[tuple[str, bool, int]]:
    """Name, whether it is a folder, and length of what lies in a folder; a local one is never held as a whole."""
    scheme, _, rest = place.partition(":")
    if scheme == "file":
        with os.scandir("/" + rest.lstrip("/")) as found:
            for entry in found:
                try:
                    yield entry.name, entry.is_dir(), entry.stat().st_size
                except FileNotFoundError:
                    continue
        return
    from pyarrow import fs

    system, inner = shared_folder(place)
    for entry in system.get_file_info(fs.FileSelector(inner)):
        yield entry.base_name, entry.type == fs.FileType.Directory, entry.size or 0


def walk_listed(place: str, recursive: bool) -> Iterator[list[tuple[str, bool, int]]]:
    """Place, whether it is a folder, and length of the files under a folder and, if not ``recursive``, of the folders right in it."""
    folders, out = [place.rstrip("/")], []
    while folders:
        folder = folders.pop()
        for name, is_folder, length in _entries(folder):
            if not _visible(name):
                continue
            inside = f"{folder}/{name}"
            if is_folder and recursive:
                folders.append(inside)
            else:
                out.append((inside, is_folder, length))
            if len(out) == LISTED_ROWS:
                yield out
                out = []
    yield out
