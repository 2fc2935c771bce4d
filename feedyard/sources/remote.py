"""Opening and listing files from inside tasks, wherever they lie and whatever they are called."""
from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

# Hadoop's names of stores that Arrow knows by another one.
ALIASES = {"s3a": "s3", "s3n": "s3", "wasb": "abfs", "wasbs": "abfss"}


def _locate(path: str):
    from pyarrow import fs

    if path.startswith("dbfs:/Volumes/"):
        path = path[len("dbfs:"):]
    elif path.startswith("dbfs:/"):
        path = "/dbfs/" + path[len("dbfs:/"):].lstrip("/")
    elif re.match(r"^file:/+", path):
        path = "/" + re.sub(r"^file:/+", "", path)
    if "://" in path:
        scheme, rest = path.split("://", 1)
        authority, _, inner = rest.partition("/")
        # only the root is parsed as a URI: names may hold blanks and percent signs
        filesystem, base = fs.FileSystem.from_uri(f"{ALIASES.get(scheme.lower(), scheme)}://{authority}/")
        return filesystem, f"{base.rstrip('/')}/{inner}"
    return fs.LocalFileSystem(), path


def open_input(path: str):
    """Seekable binary input for local, mounted and object-store paths."""
    filesystem, where = _locate(path)
    return filesystem.open_input_file(where)


def read_bytes(path: str) -> bytes:
    with open_input(path) as f:
        return f.read()


def write_bytes(path: str, data: bytes) -> None:
    """Write under a temporary name first, so that a repeated task never leaves half a file."""
    import uuid

    filesystem, where = _locate(path)
    folder, name = where.rsplit("/", 1)
    # unfinished files stand in a folder of their own: any name directly in the folder may be a delivery
    filesystem.create_dir(f"{folder}/.drafts", recursive=True)
    draft = f"{folder}/.drafts/{name}.{uuid.uuid4().hex}"
    with filesystem.open_output_stream(draft) as out:
        out.write(data)
    filesystem.move(draft, where)


@dataclass(frozen=True)
class Entry:
    """One name in a folder."""
    name: str
    is_file: bool
    size: int
    modified_ms: int


def entries(folder: str, missing_ok: bool = False) -> Iterator[Entry]:
    """Everything directly in a folder, names that begin with ``_`` or ``.`` included."""
    from pyarrow import fs

    filesystem, where = _locate(folder)
    for found in filesystem.get_file_info(fs.FileSelector(where.rstrip("/") or "/", allow_not_found=missing_ok)):
        is_file = found.type == fs.FileType.File
        yield Entry(found.base_name, is_file, found.size if is_file else 0, (found.mtime_ns or 0) // 1_000_000)
