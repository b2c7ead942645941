"""The file system of a shared folder, for code that runs in tasks and in data sources."""

from __future__ import annotations

import re

from pyarrow import fs


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder that pyarrow opens: a local path, ``file:``, ``hdfs:``, ``s3:`` or ``gs:``."""
    return fs.FileSystem.from_uri(re.sub("^s3a:", "s3:", re.sub("^file:/+", "/", path)))


def names(store: fs.FileSystem, folder: str, kind: fs.FileType = fs.FileType.File) -> list[str]:
    """Paths below a folder of that kind, hidden ones left out; none where there is no folder."""
    found = store.get_file_info(fs.FileSelector(folder, allow_not_found=True))
    return sorted(f.path for f in found if f.type == kind and not f.base_name.startswith((".", "_temporary", "_SUCCESS")))


def write_whole(store: fs.FileSystem, path: str, data: bytes) -> None:
    """A small file that readers see whole or not at all."""
    store.create_dir(path.rsplit("/", 1)[0], recursive=True)
    with store.open_output_stream(f"{path}.writing", compression=None) as out:
        out.write(data)
    store.move(f"{path}.writing", path)


def content(store: fs.FileSystem, path: str) -> bytes | None:
    if store.get_file_info(path).type != fs.FileType.File:
        return None
    with store.open_input_stream(path, compression=None) as f:
        return f.read()
