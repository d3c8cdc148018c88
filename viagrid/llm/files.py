"""Binary files in the shared work folder, on any file system that Arrow opens.

Each task attempt writes files under names of its own; a file counts once its
name stands in a table that Spark has committed. What a lost or repeated attempt
leaves is never read.
"""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyarrow import fs


def located(uri: str) -> tuple[fs.FileSystem, str]:
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    if "://" in uri:
        return fs.FileSystem.from_uri(uri)
    return fs.LocalFileSystem(), uri


def new_name(folder: str, label: str, suffix: str) -> str:
    return f"{folder}/{label}-{uuid.uuid4().hex}{suffix}"


def create(uri: str) -> pa.NativeFile:
    system, path = located(uri)
    system.create_dir(path.rpartition("/")[0], recursive=True)
    return system.open_output_stream(path, compression=None)


def opened(uri: str) -> pa.NativeFile:
    """A file for reads at any place."""
    system, path = located(uri)
    return system.open_input_file(path)
