"""Binary files in the shared folder, written and read by tasks.

Paths are URLs of any store that pyarrow's file systems know, or plain local
paths. Writers choose names of their own; the manifest a writing job returns says
which files count, so leftovers of failed or repeated tasks are never read.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from textlake.session import locate, materialize, open_file, scratch_path


def create(folder: str, suffix: str):
    """(URL, output stream) of a new file below ``folder``."""
    system, path = locate(folder)
    system.create_dir(path, recursive=True)
    name = f"{uuid.uuid4().hex}{suffix}"
    return f"{folder}/{name}", system.open_output_stream(f"{path}/{name}", compression=None)


def open_stream(url: str):
    system, path = locate(url)
    return system.open_input_stream(path, compression=None)


def one_each(manifest: DataFrame) -> DataFrame:
    """The rows of a manifest dealt over tasks, so that each reads few files."""
    return manifest.repartition(max(1, manifest.count()))


__all__ = ["create", "locate", "materialize", "one_each", "open_file", "open_stream", "scratch_path"]
