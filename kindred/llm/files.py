"""Binary files in a shared folder, written and read by tasks.

Paths are URIs of any file system that Arrow knows (local, hdfs, s3, ...).  A task gives each
file a fresh name and reports it only when it is closed; readers follow what a committed
table of reports names, so files of failed or repeated attempts are never read.
"""

from __future__ import annotations

import uuid

from pyarrow import fs


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


def new_name(folder: str, stem: str, suffix: str) -> str:
    return f"{folder}/{stem}-{uuid.uuid4().hex}{suffix}"


def writer(uri: str):
    """Stream to a new file; its folder is made."""
    system, path = _open(uri)
    system.create_dir(path.rpartition("/")[0], recursive=True)
    return system.open_output_stream(path, compression=None)


def reader(uri: str):
    """File with ``size()`` and ``read_at(n, offset)``."""
    system, path = _open(uri)
    return system.open_input_file(path)
