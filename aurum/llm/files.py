"""Files of a shared store for the subpackage's Python data sources.

Paths may carry any scheme that ``pyarrow.fs`` knows (file, hdfs, s3, gs); a bare path is local.
"""

from __future__ import annotations

import json

from pyarrow import fs

MANIFEST = "_manifest.json"


def opened(path: str) -> tuple[fs.FileSystem, str]:
    if path.startswith("file:/"):
        path = "/" + path[5:].lstrip("/")
    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def write_manifest(path: str, entries: list[dict]) -> None:
    """Names the files of a finished write.  Readers see only these, so what failed attempts left doesn't count."""
    store, base = opened(path)
    store.create_dir(base, recursive=True)
    with store.open_output_stream(f"{base}/{MANIFEST}.tmp") as f:
        f.write(json.dumps(entries).encode())
    store.move(f"{base}/{MANIFEST}.tmp", f"{base}/{MANIFEST}")


def read_manifest(path: str) -> list[dict] | None:
    store, base = opened(path)
    if store.get_file_info(f"{base}/{MANIFEST}").type == fs.FileType.NotFound:
        return None
    with store.open_input_stream(f"{base}/{MANIFEST}") as f:
        return json.loads(f.read())


def listed(path: str, suffixes: tuple[str, ...]) -> list[dict]:
    """The files under a path, or the file that it names."""
    store, base = opened(path)
    info = store.get_file_info(base)
    found = [info] if info.is_file else store.get_file_info(fs.FileSelector(base, recursive=True))
    return sorted(({"file": x.path, "bytes": x.size} for x in found if x.is_file and x.path.endswith(suffixes)), key=lambda x: x["file"])
