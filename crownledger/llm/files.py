"""Binary files in the shared folder, written by tasks and committed by a manifest.

Every attempt of a task writes files of its own names and returns them as rows; the table of these rows is written
by Spark, which keeps one attempt's rows. Files of attempts that were lost are in no manifest and never read.
"""

from __future__ import annotations

import uuid
from typing import BinaryIO

from pyarrow import fs

ROLL_BYTES = 64 << 20  # a task begins a new file beyond this size


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder or file (file://, hdfs://, s3://, gs:// or a plain path), and the path in it."""
    return fs.FileSystem.from_uri(uri)


class Roller:
    """Appends pieces to files of about ``ROLL_BYTES`` each; ``closed`` lists (uri, bytes, pieces)."""

    def __init__(self, folder: str, suffix: str, limit: int = ROLL_BYTES):
        self.folder, self.suffix, self.limit = folder, suffix, limit
        self.closed: list[tuple[str, int, int]] = []
        self.out: BinaryIO | None = None

    def write(self, piece: bytes) -> None:
        if self.out is None:
            system, path = opened(self.folder)
            system.create_dir(path, recursive=True)
            name = f"{uuid.uuid4().hex}{self.suffix}"
            self.uri, self.bytes, self.pieces = f"{self.folder}/{name}", 0, 0
            self.out = system.open_output_stream(f"{path}/{name}", compression=None)  # else a name in .gz is packed again
        self.out.write(piece)
        self.bytes += len(piece)
        self.pieces += 1
        if self.bytes >= self.limit:
            self.close()

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.closed.append((self.uri, self.bytes, self.pieces))
            self.out = None
