"""Whole files in a folder that all executors share, written by tasks."""

from __future__ import annotations

import uuid

from pyarrow.fs import FileSystem


def new_name(suffix: str) -> str:
    return f"{uuid.uuid4().hex}{suffix}"


def put(folder: str, name: str, data: bytes) -> str:
    """Write a file under a new name in ``folder`` (a path or URI) and return its name.

    The name is to be new for every attempt of a task and the file appears whole; a file counts only when the manifest,
    which Spark commits, has its name. So attempts that were lost leave no more than files that nobody reads.
    """
    fs, path = FileSystem.from_uri(folder)
    fs.create_dir(path, recursive=True)
    with fs.open_output_stream(f"{path}/.{name}.part") as f:
        f.write(data)
    fs.move(f"{path}/.{name}.part", f"{path}/{name}")
    return name
