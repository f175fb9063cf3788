"""Byte files in the shared folder, written by tasks and listed by what Spark commits."""

from __future__ import annotations

import uuid

from pyarrow import fs


def filesystem(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path within it."""
    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


class PartFile:
    """A file under a name no other attempt of the task uses, so a lost attempt leaves no half of it to read."""

    def __init__(self, folder: str, suffix: str):
        self.uri = f"{folder}/part-{uuid.uuid4().hex}{suffix}"
        system, path = filesystem(self.uri)
        system.create_dir(path.rpartition("/")[0], recursive=True)
        self.stream, self.size = system.open_output_stream(path, compression=None), 0

    def write(self, data: bytes) -> None:
        self.stream.write(data)
        self.size += len(data)

    def close(self) -> None:
        self.stream.close()
