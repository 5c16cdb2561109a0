"""Files as tasks open them, without Spark's readers."""

from __future__ import annotations

from pyarrow import fs


def stored(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a location; Hadoop writes ``file:/x`` where others write ``file:///x``."""
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path)
