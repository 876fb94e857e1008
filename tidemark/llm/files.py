"""Binary files in the shared folder: written by tasks under names of their own, read in streams.

Only Spark's tables say which files count.  A task that is run again writes another file, and the row that names the
first one is lost with the failed attempt, so nothing has to be cleaned up for results to be right.
"""

from __future__ import annotations

from pyarrow import fs


def open_output(uri: str):
    system, path = fs.FileSystem.from_uri(uri)
    system.create_dir(path.rsplit("/", 1)[0], recursive=True)
    return system.open_output_stream(path)


def open_input(uri: str, seekable: bool = False):
    system, path = fs.FileSystem.from_uri(uri)
    return system.open_input_file(path) if seekable else system.open_input_stream(path, buffer_size=1 << 20)
