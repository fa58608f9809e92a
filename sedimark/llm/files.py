"""Binary files that tasks write into and read from the shared folder."""

from __future__ import annotations

import uuid
from typing import BinaryIO

from pyarrow import fs


def place(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system and path of a folder given as URI or absolute path."""
    return fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)


def fresh_name(kind: str, suffix: str) -> str:
    """A name no other attempt of the task uses; what counts is the list of files in the manifest."""
    return f"{kind}-{uuid.uuid4().hex}{suffix}"


def create(folder: str, name: str) -> BinaryIO:
    system, path = place(folder)
    system.create_dir(path, recursive=True)
    return system.open_output_stream(f"{path}/{name}", compression=None)


def read(folder: str, name: str, start: int = 0, length: int | None = None) -> bytes:
    """The file, or `length` bytes of it from `start`."""
    system, path = place(folder)
    with system.open_input_file(f"{path}/{name}") as file:
        size = file.size()
        start = size + start if start < 0 else start
        return file.read_at(size - start if length is None else length, start)
