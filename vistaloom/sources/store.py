"""Single files of a store by URI, for tasks that read by position or write a named file.

Stores are those of ``pyarrow.fs``: local and shared file systems, HDFS and object
stores. A file is written under another name and moved, so a task that is lost
leaves no half file, and one that runs again writes the same file again.
"""

from __future__ import annotations

import re
import uuid

from pyarrow import fs


def _at(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri if "://" in uri or not uri.startswith("file:") else uri.replace("file:", "file://", 1))


def opened(uri: str):
    """A file for reading, with ``seek``."""
    store, path = _at(uri)
    return store.open_input_file(path)


def slice_of(uri: str, offset: int, size: int) -> bytes:
    """``size`` bytes from ``offset``; a short read is an error."""
    with opened(uri) as file:
        if offset > file.size():
            raise ValueError(f"{uri}: 0 of {size} bytes at {offset}")
        file.seek(offset)
        data = file.read(size)
    if len(data) != size:
        raise ValueError(f"{uri}: {len(data)} of {size} bytes at {offset}")
    return data


def write(uri: str, data: bytes) -> None:
    store, path = _at(uri)
    folder = path.rsplit("/", 1)[0]
    store.create_dir(folder, recursive=True)
    part = f"{folder}/.{uuid.uuid4().hex}"
    with store.open_output_stream(part) as file:
        file.write(data)
    store.move(part, path)


def names(uri: str, pattern: str = "") -> list[str]:
    """The names of a folder's files that match a pattern, sorted; none if there is no such folder."""
    store, path = _at(uri)
    found = store.get_file_info(fs.FileSelector(path, allow_not_found=True))
    return sorted(f.base_name for f in found if f.is_file and re.search(pattern, f.base_name) and not f.base_name.startswith("."))


def remove(uri: str) -> None:
    store, path = _at(uri)
    store.delete_file(path)
