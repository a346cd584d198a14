"""Files in the shared scratch folder that tasks write once and map into memory."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

import numpy as np
from pyarrow import fs


def _system(uri: str) -> tuple[fs.FileSystem, str]:
    if "://" in uri or uri.startswith("file:"):
        return fs.FileSystem.from_uri(uri)
    return fs.LocalFileSystem(), uri


def write(folder: str, name: str, parts: list[bytes]) -> str:
    """Write byte sections to a new file; a task that runs twice writes two files, of which one is named in its result."""
    system, path = _system(folder)
    system.create_dir(path, recursive=True)
    name = f"{name}-{uuid.uuid4().hex}"
    sizes = np.array([len(parts), *map(len, parts)], np.uint64)
    with system.open_output_stream(f"{path}/{name}") as out:
        out.write(sizes.tobytes())
        for part in parts:
            out.write(part + bytes(-len(part) % 8))
    return f"{folder.rstrip('/')}/{name}"


def read(uri: str) -> list[np.ndarray]:
    """The sections of a file as arrays over its memory map; a remote file is first copied to an unnamed local one."""
    system, path = _system(uri)
    if isinstance(system, fs.LocalFileSystem):
        buf = np.memmap(path, np.uint8, "r").view(np.ndarray)
    else:
        with tempfile.TemporaryFile() as local, system.open_input_stream(path) as remote:
            shutil.copyfileobj(remote, local)
            local.flush()
            os.fsync(local.fileno())
            buf = np.memmap(local, np.uint8, "r").view(np.ndarray)
    count = int(buf[:8].view(np.uint64)[0])
    sizes = buf[8: 8 + 8 * count].view(np.uint64).astype(np.int64)
    out, at = [], 8 + 8 * count
    for n in sizes:
        out.append(buf[at: at + n])
        at += n + -n % 8
    return out
