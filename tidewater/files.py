"""Files that Python tasks and the driver read and write themselves, on any shared file system."""

from __future__ import annotations

import json
import sys

from pyarrow import fs as pafs
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def open_fs(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and plain path of ``path``: a local (shared) folder, ``file:``, ``hdfs:``, ``s3:`` ..."""
    if path.startswith("file:"):
        path = "/" + path[len("file:"):].lstrip("/")
    return pafs.FileSystem.from_uri(path)


def exists(fs: pafs.FileSystem, path: str) -> bool:
    return fs.get_file_info(path).type != pafs.FileType.NotFound


def names(fs: pafs.FileSystem, folder: str, recursive: bool = False) -> list[str]:
    """Paths of the files in ``folder`` (none if it is missing), sorted."""
    found = fs.get_file_info(pafs.FileSelector(folder, allow_not_found=True, recursive=recursive))
    return sorted(i.path for i in found if i.type == pafs.FileType.File)


def read_json(fs: pafs.FileSystem, path: str, default=None):
    if not exists(fs, path):
        return default
    with fs.open_input_stream(path) as f:
        return json.loads(f.read())


def write_json(fs: pafs.FileSystem, path: str, value) -> None:
    """Written aside and moved into place: a reader sees the old file or the new one, whole."""
    folder, _, name = path.rpartition("/")
    fs.create_dir(folder, recursive=True)
    aside = f"{folder}/.{name}.part"
    with fs.open_output_stream(aside) as f:
        f.write(json.dumps(value).encode())
    fs.move(aside, path)


def delete(fs: pafs.FileSystem, path: str) -> None:
    if exists(fs, path):
        fs.delete_file(path)
