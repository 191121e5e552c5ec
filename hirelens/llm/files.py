"""Binary files written by tasks to a shared folder, each complete or absent."""

import uuid
from functools import lru_cache

import pyarrow.fs as pafs


@lru_cache(maxsize=8)
def _store(folder: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder; all schemes that Arrow knows, and plain paths."""
    if folder.startswith("file:"):  # Hadoop writes it with one slash or three
        return pafs.LocalFileSystem(), "/" + folder[len("file:") :].lstrip("/")
    return pafs.FileSystem.from_uri(folder) if "://" in folder else (pafs.LocalFileSystem(), folder)


def make_folder(folder: str) -> None:
    """Create ``folder``, so that a folder without files can be read."""
    fs, path = _store(folder)
    fs.create_dir(path, recursive=True)


def write_file(folder: str, name: str, parts) -> None:
    """Write the byte strings ``parts`` to ``folder/name``.

    The bytes go to a name of their own first; moving the whole file to its name is one step, so a task that is
    lost or runs twice leaves one whole file, and a reader never sees half of one.
    """
    fs, path = _store(folder)
    fs.create_dir(f"{path}/_temporary", recursive=True)
    partial = f"{path}/_temporary/{uuid.uuid4().hex}"
    with fs.open_output_stream(partial) as out:
        for part in parts:
            out.write(part)
    fs.move(partial, f"{path}/{name}")
