"""File systems for Python workers, by the URIs that Spark's own file systems go by."""

from __future__ import annotations

from pyarrow import fs


def open_store(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system and path of a URI. s3a:, s3n: and dbfs: are what Spark calls s3: and a mounted folder."""
    scheme, sep, rest = uri.partition(":")
    if sep and scheme in ("s3a", "s3n"):
        uri = f"s3:{rest}"
    elif sep and scheme == "dbfs":
        uri = f"file:///dbfs/{rest.lstrip('/')}"
    return fs.FileSystem.from_uri(uri)
