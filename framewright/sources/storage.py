"""Sinks for artifacts: atomic writes below a local root or through a Hadoop or Arrow file system."""

from __future__ import annotations

import errno
import os
import posixpath
import random
import re
import tempfile
import time
from collections.abc import Callable
from pathlib import PurePosixPath
from typing import Protocol


def check_path(path: str) -> PurePosixPath:
    """The parsed path; an error unless it names an object below its root."""
    parsed = PurePosixPath(path or "")
    if not path or path.endswith("/") or parsed.is_absolute() or ".." in parsed.parts or not parsed.name:
        raise ValueError(f"unsafe relative path: {path!r}")
    return parsed


class Storage(Protocol):
    root: str

    def exists(self, path: str) -> bool: ...

    def write(self, path: str, data: bytes) -> str:
        """Where the bytes went."""


class LocalStorage:
    """Files appear whole, by a rename, or not at all."""

    def __init__(self, root: str):
        self.root = root

    def exists(self, path: str) -> bool:
        return os.path.isfile(os.path.join(self.root, check_path(path)))

    def write(self, path: str, data: bytes) -> str:
        target = os.path.join(self.root, check_path(path))
        atomic_write(target, data)
        return target


class ArrowStorage:
    """Any store that Arrow opens by URI; writes that fail for a passing reason are tried again with growing pauses, absence is told by the store and other errors are raised."""

    def __init__(self, uri: str, tries: int = 4, pause: float = 0.5):
        self.root, self.tries, self.pause = uri, tries, pause

    def _open(self, path: str):
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(self.root)
        return store, posixpath.join(base, str(check_path(path)))

    def exists(self, path: str) -> bool:
        from pyarrow import fs

        store, target = self._open(path)
        return store.get_file_info(target).type == fs.FileType.File

    def write(self, path: str, data: bytes) -> str:
        store, target = self._open(path)

        def put():
            store.create_dir(posixpath.dirname(target), recursive=True)
            with store.open_output_stream(target) as out:
                out.write(data)

        retried(put, self.tries, self.pause)
        return f"{self.root.rstrip('/')}/{path}"


#: Errors that no further try mends: denied, absent, in the way, wrong, or no room.
LASTING = frozenset((errno.EACCES, errno.EPERM, errno.ENOENT, errno.EEXIST, errno.EISDIR, errno.ENOTDIR, errno.EINVAL, errno.ENAMETOOLONG, errno.EROFS, errno.ENOSPC, errno.EDQUOT))


def is_passing(error: OSError) -> bool:
    """Whether a failure may mend itself: connections and the store's own faults (status 5xx, or none told)."""
    if isinstance(error, (PermissionError, FileNotFoundError, FileExistsError, IsADirectoryError, NotADirectoryError)) or error.errno in LASTING:
        return False
    told = re.search(r"(?i)\bhttp[^0-9]{0,20}([1-5][0-9][0-9])\b", str(error))
    return (told is None or told[1][0] == "5") and not re.search(r"(?i)access ?denied|forbidden", str(error))


def retried(action: Callable[[], None], tries: int, pause: float) -> None:
    for turn in range(tries):
        try:
            return action()
        except OSError as error:
            if turn == tries - 1 or not is_passing(error):
                raise
            time.sleep(pause * 2**turn * (1 + random.random() / 4))


def atomic_write(target: str, data: bytes) -> None:
    """Write beside the target, flush to disk, rename; nothing is left behind on failure."""
    folder = os.path.dirname(target) or "."
    os.makedirs(folder, exist_ok=True)
    handle, name = tempfile.mkstemp(prefix=f".{os.path.basename(target)}.", dir=folder)
    try:
        with os.fdopen(handle, "wb") as f:
            f.write(data)
            f.flush()
            os.fsync(f.fileno())
        os.chmod(name, 0o644)
        os.replace(name, target)
    except BaseException:
        if os.path.exists(name):
            os.unlink(name)
        raise


def storage(kind: str, root: str) -> Storage:
    kinds = {"local": LocalStorage, "arrow": ArrowStorage}
    if kind not in kinds:
        raise ValueError(f"unknown storage {kind!r}; known: {', '.join(kinds)}")
    return kinds[kind](root)
