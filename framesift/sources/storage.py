"""Opening and listing assets by URI inside tasks."""

from __future__ import annotations

import os
from collections.abc import Iterator
from urllib.parse import unquote

from pyarrow import fs

_CLOUD_ALIASES = {"s3a": "s3", "s3n": "s3"}


def resolve(uri: str) -> tuple[fs.FileSystem, str, str]:
    """File system, path in it, and what to put before such paths to get URIs."""
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + unquote(uri[len("file:"):]).lstrip("/"), ""
    scheme, separator, rest = uri.partition("://")
    if not separator:
        return fs.LocalFileSystem(), uri, ""
    filesystem, path = fs.FileSystem.from_uri(f"{_CLOUD_ALIASES.get(scheme, scheme)}://{rest}")
    prefix = uri[: len(uri) - len(path)] if uri.endswith(path) else f"{scheme}://"
    return filesystem, path, prefix


def open_uri(uri: str):
    """Binary stream of an asset, in which can be sought; ``.gz`` and ``.bz2`` are
    decompressed on the fly and can only be read on."""
    filesystem, path, _ = resolve(uri)
    if path.lower().endswith((".gz", ".bz2")):
        return filesystem.open_input_stream(path)
    return filesystem.open_input_file(path)


def open_raw(uri: str):
    """Binary stream of an asset's stored bytes."""
    filesystem, path, _ = resolve(uri)
    return filesystem.open_input_stream(path, compression=None)


def list_folder(uri: str) -> Iterator[tuple[str, int | None, bool]]:
    """Direct children as (uri, length, is folder). Of a local folder they come one by one;
    other storage answers with all children of the folder at once."""
    filesystem, path, prefix = resolve(uri)
    if isinstance(filesystem, fs.LocalFileSystem):
        with os.scandir(path) as children:
            for child in children:
                folder = child.is_dir()
                yield f"{prefix}{path.rstrip('/')}/{child.name}", None if folder else child.stat().st_size, folder
        return
    for info in filesystem.get_file_info(fs.FileSelector(path, recursive=False)):
        yield prefix + info.path, info.size, info.type == fs.FileType.Directory
