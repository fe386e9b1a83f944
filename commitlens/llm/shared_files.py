"""Binary files in the shared folder, written and read by tasks.

Spark's own sinks write rows, not byte layouts. A task writes a file under a name
of its own and returns that name in its rows; only files named by rows of
committed tasks are ever read, so a lost or repeated attempt does no harm.
"""

import os
import uuid
from typing import BinaryIO

from pyarrow import fs


def _located(uri: str) -> tuple[fs.FileSystem, str]:
    if uri.startswith("file:"):
        uri = "/" + uri.removeprefix("file:").lstrip("/")
    if uri.startswith("/"):
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


def attempt_path(folder: str, name: str, suffix: str) -> str:
    """A path no other attempt of the same task uses."""
    return f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}{suffix}"


def open_output(uri: str) -> BinaryIO:
    """A binary stream to `uri`; its folder is made when missing."""
    system, path = _located(uri)
    system.create_dir(os.path.dirname(path), recursive=True)
    return system.open_output_stream(path, compression=None)


def open_input(uri: str) -> BinaryIO:
    """A seekable binary stream from `uri`."""
    system, path = _located(uri)
    return system.open_input_file(path)
