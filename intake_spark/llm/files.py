"""Files that tasks write to and read from the shared folder, by its URI."""

from __future__ import annotations

import uuid

import pyarrow.fs


def folder(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(uri if "://" in uri or not uri.startswith("/") else f"file://{uri}") if not uri.startswith("file:/") or uri.startswith("file://") else pyarrow.fs.FileSystem.from_uri("file://" + uri[5:])


def new_name(part: int, number: int, ending: str) -> str:
    """A name that no other attempt of the task uses; what a lost attempt has written is never listed in a manifest."""
    return f"part-{part:05d}-{number:04d}-{uuid.uuid4().hex}{ending}"
