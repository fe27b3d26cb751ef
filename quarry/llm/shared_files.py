"""Binary files in the shared folder, written and read by tasks.

Tasks reach the folder through Arrow's file systems (local, HDFS, S3, GCS by
the path's scheme). A task writes under a name of its own; only names that a
committed table lists are ever read, so repeated or lost task attempts leave
nothing but an unlisted file.
"""

from __future__ import annotations

import re
import uuid

import pyarrow.fs as pafs


def open_folder(uri: str):
    """``(file system, path)`` of a folder URI or absolute path."""
    return pafs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri))


def new_name(prefix: str, part: int, suffix: str) -> str:
    return f"{prefix}-{part:08d}-{uuid.uuid4().hex}{suffix}"
