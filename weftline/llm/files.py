"""Files of own formats in the shared folder, for Python data sources."""

from __future__ import annotations

import io

import pyarrow.fs as pafs
from pyspark.sql.datasource import InputPartition

from weftline.llm.common import ship

#: Files are packed into partitions up to this size; a larger file is one partition.
PARTITION_BYTES = 64 << 20


class FilePack(InputPartition):
    """Paths that one task reads."""

    def __init__(self, paths: list[str]) -> None:
        self.paths = paths


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    if "://" not in path and not path.startswith("file:"):
        return pafs.LocalFileSystem(), path
    return pafs.FileSystem.from_uri(path)


def pack_files(path: str, most: int = PARTITION_BYTES) -> list[FilePack]:
    """The data files below ``path`` (or ``path`` itself), small ones together up to ``most``
    bytes."""
    fs, root = file_system(path)
    info = fs.get_file_info(root)
    if info.type == pafs.FileType.File:
        found = [info]
    else:
        found = fs.get_file_info(pafs.FileSelector(root, recursive=True))
    files = sorted(
        (x.path, x.size)
        for x in found
        if x.type == pafs.FileType.File and x.size and not x.base_name.startswith(("_", "."))
    )
    packs: list[list[str]] = []
    room = 0
    for name, size in files:
        if not packs or size > room:
            packs.append([])
            room = most
        packs[-1].append(name)
        room -= size
    return [FilePack(p) for p in packs] or [FilePack([])]


def open_file(root: str, path: str) -> io.BufferedReader:
    """A buffered file that can seek, ``path`` as :func:`pack_files` gave it."""
    fs, _ = file_system(root)
    return io.BufferedReader(fs.open_input_file(path), 1 << 20)


ship(__name__)
