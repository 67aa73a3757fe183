"""Files that tasks write and read by themselves, in any store that pyarrow opens."""

from __future__ import annotations

import uuid

from pyarrow import fs


def locate(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


def attempt(folder: str, name: str) -> str:
    """A path that no other attempt of the same task uses; only a manifest makes a file count."""
    return f"{folder}/{name}-{uuid.uuid4().hex[:12]}"


def create(path: str):
    """A stream to a new file; its folder is made where stores have folders."""
    store, place = locate(path)
    store.create_dir(place.rpartition("/")[0], recursive=True)
    return store.open_output_stream(place)


def open_file(path: str):
    store, place = locate(path)
    return store.open_input_file(place)


def open_stream(path: str):
    store, place = locate(path)
    return store.open_input_stream(place)
