"""Files that tasks write and read in the shared folder, by URI (local, S3, GCS, HDFS)."""

from __future__ import annotations

import uuid

from pyarrow import fs


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


def write_file(uri: str, parts) -> None:
    """Writes under a name of its own, then renames: a file is there whole or not, and a repeated task replaces it."""
    system, path = opened(uri)
    folder, _, name = path.rpartition("/")
    system.create_dir(folder, recursive=True)
    draft = f"{folder}/.{name}.{uuid.uuid4().hex}"
    with system.open_output_stream(draft) as out:
        for part in parts:
            out.write(part)
    system.move(draft, path)


def read_range(uri: str, start: int, length: int) -> bytes:
    system, path = opened(uri)
    with system.open_input_file(path) as f:
        f.seek(start)
        return f.read(length)
