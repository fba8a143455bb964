"""Files that tasks write into the shared folder and later tasks read.

Every attempt of a task writes a file of its own name and reports it in its
output row; only reported files are read, so a lost executor or a second
attempt leaves at most an unread file.
"""

from __future__ import annotations

import uuid
from typing import IO

from pyarrow import fs
from pyspark import TaskContext


def locate(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a URI (a plain absolute path is local)."""
    return fs.FileSystem.from_uri(path)


def new_path(folder: str, suffix: str) -> str:
    context = TaskContext.get()
    return f"{folder}/part-{context.partitionId() if context else 0:06d}-{uuid.uuid4().hex[:12]}{suffix}"


def create(path: str) -> IO[bytes]:
    where, name = locate(path)
    where.create_dir(name.rsplit("/", 1)[0], recursive=True)
    return where.open_output_stream(name, compression=None)


def open_stream(path: str) -> IO[bytes]:
    where, name = locate(path)
    return where.open_input_stream(name, compression=None)


def open_file(path: str) -> IO[bytes]:
    where, name = locate(path)
    return where.open_input_file(name)
