"""Byte-range access to files for Python data sources and sinks.

Local paths and ``file:`` addresses, and the stores that ``pyarrow.fs``
knows by address (object stores, HDFS).
"""

from __future__ import annotations

import os

import pyarrow.fs as pafs


def open_store(address: str) -> tuple[pafs.FileSystem, str, str]:
    """(file system, path inside it, prefix that makes a path an address again)."""
    if address.startswith("file:"):
        return pafs.LocalFileSystem(), os.path.abspath("/" + address[5:].lstrip("/")), "file:"
    if "://" not in address:
        return pafs.LocalFileSystem(), os.path.abspath(address), "file:"
    store, path = pafs.FileSystem.from_uri(address)
    return store, path, address.split("://", 1)[0] + "://"


def list_files(address: str) -> tuple[pafs.FileSystem, list[tuple[str, str, int]]]:
    """The files at or under an address as (address, path, size), by path.

    Hidden files, named with a leading ``.`` or ``_``, are left out.
    """
    store, path, prefix = open_store(address)
    info = store.get_file_info(path)
    if info.type == pafs.FileType.NotFound:
        raise FileNotFoundError(address)
    found = [info] if info.is_file else store.get_file_info(pafs.FileSelector(path, recursive=True))
    return store, sorted((prefix + f.path, f.path, f.size) for f in found
                         if f.is_file and not f.base_name.startswith((".", "_")))
