"""Binary files in the cluster's shared store, written by tasks.

A task writes under a temporary name of its own and moves the finished file
to its final name, so a reader never sees half a file and a repeated attempt
replaces a file by the same bytes.  Which files count is said by a manifest
table that Spark commits after all of them are in place.
"""

from __future__ import annotations

import hashlib
import posixpath
import uuid

from pyarrow import fs as arrow_fs


def locate(uri: str) -> tuple[arrow_fs.FileSystem, str]:
    """File system and path of a folder or file (any scheme that Arrow's
    file systems know; plain paths are local)."""
    if uri.startswith("file:"):
        return arrow_fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    if "://" not in uri:
        return arrow_fs.LocalFileSystem(), uri
    scheme, rest = uri.split("://", 1)
    return arrow_fs.FileSystem.from_uri(f"{'s3' if scheme in ('s3a', 's3n') else scheme}://{rest}")


class StoredFile:
    """One file being written: ``write`` appends, ``close`` moves it to its
    final name and tells size and checksum."""

    def __init__(self, folder: str, name: str):
        self.fs, root = locate(folder)
        self.name = name
        self._temporary = posixpath.join(root, "_temporary", f"{uuid.uuid4().hex}-{name}")
        self._final = posixpath.join(root, name)
        self.fs.create_dir(posixpath.dirname(self._temporary), recursive=True)
        self._out = self.fs.open_output_stream(self._temporary, compression=None)
        self._sha = hashlib.sha256()
        self.size = 0

    def write(self, data: bytes) -> None:
        self._out.write(data)
        self._sha.update(data)
        self.size += len(data)

    def close(self) -> str:
        self._out.close()
        self.fs.move(self._temporary, self._final)
        return self._sha.hexdigest()


def open_stored(folder: str, name: str):
    """A finished file, for random access."""
    fs, root = locate(folder)
    return fs.open_input_file(posixpath.join(root, name))


def clear_temporary(folder: str) -> None:
    """Remove what lost attempts left behind; called once all is committed."""
    fs, root = locate(folder)
    path = posixpath.join(root, "_temporary")
    if fs.get_file_info(path).type == arrow_fs.FileType.Directory:
        fs.delete_dir(path)
