"""Files by path or URI, for the data sources' Python processes (Spark's own readers do not come here)."""

from __future__ import annotations

import json
import re

from pyarrow import fs as arrow_fs


class Rejected(ValueError):
    """Input or output that breaks a rule; ``code`` names the rule."""

    def __init__(self, code: str, subject: str):
        super().__init__(f"{code}: {subject}")
        self.code, self.subject = code, subject

    def __reduce__(self):
        return Rejected, (self.code, self.subject)


def place(path: str) -> tuple[arrow_fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    if re.match(r"[a-z][a-z0-9+.-]*:", path):
        system, inner = arrow_fs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", path))
    else:
        system, inner = arrow_fs.LocalFileSystem(), path
    return system, inner.rstrip("/") or "/"


def kind(system: arrow_fs.FileSystem, path: str) -> arrow_fs.FileType:
    return system.get_file_info(path).type


def exists(system: arrow_fs.FileSystem, path: str) -> bool:
    return kind(system, path) != arrow_fs.FileType.NotFound


def read_bytes(system: arrow_fs.FileSystem, path: str) -> bytes:
    with system.open_input_stream(path, compression=None) as stream:
        return stream.read()


def read_json(system: arrow_fs.FileSystem, path: str):
    return json.loads(read_bytes(system, path))


def remove(system: arrow_fs.FileSystem, path: str) -> None:
    """Remove a folder, if it is there."""
    if exists(system, path):
        system.delete_dir(path)


def unsafe(relative: str) -> bool:
    """Absolute, of another drive, with a backslash, or with an empty, ``.`` or ``..`` segment."""
    return relative.startswith("/") or "\\" in relative or bool(re.match("[A-Za-z]:", relative)) or any(p in ("", ".", "..") for p in relative.split("/"))
