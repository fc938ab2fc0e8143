"""Arrays in files of the shared folder, memory-mapped where that folder is a mounted path."""

from __future__ import annotations

import io
import os
import uuid
from functools import lru_cache
from urllib.parse import unquote, urlparse

import numpy as np
import pyarrow.fs


def _mounted(uri: str) -> str | None:
    parts = urlparse(uri)
    return unquote(parts.path) if parts.scheme in ("", "file") else None


def save(uri: str, array: np.ndarray) -> None:
    """Write an array; a second attempt replaces the first as a whole."""
    path = _mounted(uri)
    if path is None:
        system, place = pyarrow.fs.FileSystem.from_uri(uri)
        buffer = io.BytesIO()
        np.save(buffer, array)
        with system.open_output_stream(place) as out:
            out.write(buffer.getbuffer())
        return
    os.makedirs(os.path.dirname(path), exist_ok=True)
    attempt = f"{path}.{uuid.uuid4().hex}"
    with open(attempt, "wb") as out:
        np.save(out, array)
    os.replace(attempt, path)


@lru_cache(maxsize=512)
def load(uri: str) -> np.ndarray | None:
    """The array, mapped and not read where the path is mounted; None if there is none."""
    path = _mounted(uri)
    if path is not None:
        return np.load(path, mmap_mode="r") if os.path.exists(path) else None
    system, place = pyarrow.fs.FileSystem.from_uri(uri)
    if system.get_file_info(place).type == pyarrow.fs.FileType.NotFound:
        return None
    with system.open_input_file(place) as source:
        return np.load(io.BytesIO(source.read()))
