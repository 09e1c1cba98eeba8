"""Files in the shared folder, read and written by tasks."""

from __future__ import annotations

import mmap
import os
import uuid

import pyarrow as pa
from pyarrow import fs


def _local(uri: str) -> str | None:
    if uri.startswith("file:"):
        return "/" + uri[5:].lstrip("/")
    return uri if "://" not in uri else None


def _remote(uri: str):
    """(file system, path); Hadoop's name for S3 paths is not pyarrow's."""
    return fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


def write_file(uri: str, data: bytes) -> None:
    """Write one file. Names carry the task attempt, so a repeated task never
    touches a file that another attempt has announced."""
    path = _local(uri)
    if path is not None:
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "wb") as f:
            f.write(data)
        return
    system, path = _remote(uri)
    system.create_dir(os.path.dirname(path), recursive=True)
    with system.open_output_stream(path) as f:
        f.write(data)


def publish_file(uri: str, data: bytes) -> None:
    """Write one file whose content does not depend on the attempt: readers see a
    whole file, also while a repeated task replaces it."""
    path = _local(uri)
    if path is None:
        write_file(uri, data)
        return
    aside = f"{path}.{uuid.uuid4().hex}"
    write_file(aside, data)
    os.replace(aside, path)


def read_file(uri: str) -> memoryview:
    """A file's bytes: memory-mapped where the shared folder is mounted, else read."""
    path = _local(uri)
    if path is not None:
        with open(path, "rb") as f:
            if os.fstat(f.fileno()).st_size == 0:
                return memoryview(b"")
            return memoryview(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ))
    system, path = _remote(uri)
    with system.open_input_file(path) as f:
        return memoryview(pa.py_buffer(f.read()))


def read_spans(uri: str, spans: list[tuple[int, int]]) -> list[memoryview]:
    """Parts (offset, length) of a file; nothing else of it is read."""
    if _local(uri) is not None:
        whole = read_file(uri)
        return [whole[at:at + n] for at, n in spans]
    system, path = _remote(uri)
    with system.open_input_file(path) as f:
        return [memoryview(f.read_at(n, at)) for at, n in spans]
