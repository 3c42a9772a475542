"""Files by path or URI, for code that runs inside tasks."""

from __future__ import annotations

import hashlib

CHUNK = 1 << 20


def filesystem(uri: str):
    """(file system, path in it) of a local path or a URI."""
    from pyarrow import fs
    if "://" in uri or uri.startswith("file:"):
        return fs.FileSystem.from_uri(uri)
    return fs.LocalFileSystem(), uri


def read_bytes(uri: str) -> bytes:
    system, path = filesystem(uri)
    with system.open_input_stream(path, compression=None) as src:
        return src.read()


def write_bytes(uri: str, data: bytes) -> None:
    system, path = filesystem(uri)
    if "/" in path.strip("/"):
        system.create_dir(path.rsplit("/", 1)[0], recursive=True)
    with system.open_output_stream(path, compression=None) as out:
        out.write(data)


def md5_of(uri: str) -> str | None:
    """MD5 of a file, read in chunks; None if there is none."""
    from pyarrow import fs
    system, path = filesystem(uri)
    if system.get_file_info(path).type != fs.FileType.File:
        return None
    digest = hashlib.md5()
    with system.open_input_stream(path, compression=None) as src:
        while chunk := src.read(CHUNK):
            digest.update(chunk)
    return digest.hexdigest()


def move(source: str, destination: str) -> None:
    system, path = filesystem(source)
    system.move(path, filesystem(destination)[1])
