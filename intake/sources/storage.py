"""Opening files from Python tasks: local paths by the operating system, the
stores that Arrow knows by its file systems.  Other stores are left to Spark's
own readers (:func:`openable` tells)."""

from __future__ import annotations

import os
import re
import shutil

_SCHEME = re.compile(r"^([A-Za-z][A-Za-z0-9+.-]*):")
# scheme in Hadoop's spelling -> Arrow's
ARROW_SCHEMES = {"hdfs": "hdfs", "s3": "s3", "s3a": "s3", "s3n": "s3", "gs": "gs", "gcs": "gs", "abfs": "abfs", "abfss": "abfss"}


def scheme(path: str) -> str:
    """Scheme of a path, ``file`` if it has none."""
    m = _SCHEME.match(path)
    return m.group(1).lower() if m else "file"


def openable(path: str) -> bool:
    """Whether Python tasks can open ``path`` themselves."""
    return scheme(path) == "file" or scheme(path) in ARROW_SCHEMES


def local_path(path: str) -> str:
    """A ``file:`` path without scheme (spelled as a file listing does: not URL-encoded)."""
    return re.sub("^file:/+", "/", path)


def _arrow(path: str):
    from pyarrow import fs

    old = scheme(path)
    return fs.FileSystem.from_uri(ARROW_SCHEMES[old] + path[len(old):])


def open_input(path: str):
    """A seekable binary stream."""
    if scheme(path) == "file":
        return open(local_path(path), "rb")
    store, where = _arrow(path)
    return store.open_input_file(where)


def open_output(path: str):
    if scheme(path) == "file":
        os.makedirs(os.path.dirname(local_path(path)), exist_ok=True)
        return open(local_path(path), "wb")
    store, where = _arrow(path)
    return store.open_output_stream(where)


def move(source: str, target: str) -> None:
    if scheme(source) == "file":
        os.makedirs(os.path.dirname(local_path(target)), exist_ok=True)
        os.replace(local_path(source), local_path(target))
    else:
        store, where = _arrow(source)
        store.move(where, _arrow(target)[1])


def remove(path: str) -> None:
    """Delete a file if it is there."""
    if scheme(path) == "file":
        if os.path.exists(local_path(path)):
            os.unlink(local_path(path))
    else:
        from pyarrow import fs

        store, where = _arrow(path)
        if store.get_file_info(where).type == fs.FileType.File:
            store.delete_file(where)


def entries(folder: str):
    """(name, path, is a folder, length, modification time in microseconds) of what lies in ``folder``,
    names starting with ``_`` or ``.`` included.  Links to files are files, links to folders and what vanishes
    meanwhile are left out."""
    base = folder.rstrip("/")
    if scheme(folder) == "file":
        with os.scandir(local_path(base) or "/") as found:
            for e in found:
                try:
                    st = e.stat()
                except FileNotFoundError:
                    continue
                if not (e.is_symlink() and e.is_dir()):
                    yield e.name, f"{base}/{e.name}", e.is_dir(), st.st_size, st.st_mtime_ns // 1000
        return
    from pyarrow import fs

    store, where = _arrow(base)
    for i in store.get_file_info(fs.FileSelector(where)):
        folder_ = i.type == fs.FileType.Directory
        yield i.base_name, f"{base}/{i.base_name}", folder_, i.size or 0, (i.mtime_ns or 0) // 1000


def remove_folder(path: str) -> None:
    """Delete a folder and what lies in it, if it is there."""
    if scheme(path) == "file":
        shutil.rmtree(local_path(path), ignore_errors=True)
    else:
        from pyarrow import fs

        store, where = _arrow(path)
        if store.get_file_info(where).type == fs.FileType.Directory:
            store.delete_dir(where)
