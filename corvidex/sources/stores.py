"""Folders and files as tasks see them: mounts by the system's calls, object stores and HDFS by Arrow's file systems."""

from __future__ import annotations

import contextlib
import os
import re
import shutil
from collections.abc import Iterator
from typing import BinaryIO, NamedTuple


class Child(NamedTuple):
    path: str
    name: str
    is_folder: bool
    length: int
    modified: int  #: nanoseconds since the epoch


_SUFFIX = re.compile(r"(?s)^.+(\.[^.]+)$")


def suffix(name: str) -> str:
    """As ``functions.paths.suffix``."""
    found = _SUFFIX.match(name)
    return found[1].lower() if found else ""


class Mounted:
    """A folder that every executor mounts. Links to folders aren't followed, links to files are."""

    def children(self, folder: str) -> Iterator[Child]:
        try:
            with os.scandir(folder) as found:
                for x in found:
                    try:
                        if x.is_dir(follow_symlinks=False):
                            yield Child(x.path, x.name, True, 0, 0)
                        elif x.is_file():
                            s = x.stat()
                            yield Child(x.path, x.name, False, s.st_size, s.st_mtime_ns)
                    except OSError:  # it went meanwhile
                        continue
        except OSError:  # a folder that can't be read has no children, as for a walk
            return

    def open(self, path: str) -> BinaryIO:
        return open(path, "rb")

    def make(self, folder: str) -> None:
        os.makedirs(folder, exist_ok=True)

    def put(self, path: str, data: bytes) -> None:
        with open(path, "wb") as f:
            f.write(data)

    def move(self, path: str, to: str) -> None:
        if os.path.exists(path):  # a name that the task had twice is moved already
            os.replace(path, to)

    def remove(self, folder: str) -> None:
        shutil.rmtree(folder, ignore_errors=True)


class Arrow:
    """Any address that Arrow opens, ``s3://``, ``gs://`` and ``hdfs://`` among them; paths keep its scheme."""

    def __init__(self, address: str):
        from pyarrow import fs

        self.files, base = fs.FileSystem.from_uri(address)
        self.prefix = address[: len(address) - len(base)] if address.endswith(base) else ""

    def children(self, folder: str) -> Iterator[Child]:
        from pyarrow import fs

        for x in self.files.get_file_info(fs.FileSelector(folder[len(self.prefix) :], recursive=False, allow_not_found=True)):
            if x.type in (fs.FileType.Directory, fs.FileType.File):
                folder_too = x.type == fs.FileType.Directory
                yield Child(self.prefix + x.path, x.base_name, folder_too, 0 if folder_too else x.size, 0 if folder_too else x.mtime_ns or 0)

    def open(self, path: str) -> BinaryIO:
        return self.files.open_input_stream(path[len(self.prefix) :])

    def make(self, folder: str) -> None:
        self.files.create_dir(folder[len(self.prefix) :])

    def put(self, path: str, data: bytes) -> None:
        with self.files.open_output_stream(path[len(self.prefix) :]) as f:
            f.write(data)

    def move(self, path: str, to: str) -> None:
        with contextlib.suppress(FileNotFoundError):
            self.files.move(path[len(self.prefix) :], to[len(self.prefix) :])

    def remove(self, folder: str) -> None:
        with contextlib.suppress(FileNotFoundError):
            self.files.delete_dir(folder[len(self.prefix) :])


def of(address: str) -> Mounted | Arrow:
    return Arrow(address) if re.match(r"[a-z][a-z0-9+.-]+://", address) else Mounted()


def local_name(address: str) -> str:
    """``file:`` addresses are mounts."""
    return re.sub(r"^file:/+", "/", address)
