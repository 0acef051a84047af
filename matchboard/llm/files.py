"""Binary files in the shared folder, written and read by tasks."""

from __future__ import annotations

import uuid

from pyarrow import fs


def place(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


def new_name(folder: str, label: str, suffix: str) -> str:
    """A name no other attempt of the task uses; only files that a finished task reports are ever read."""
    return f"{folder.rstrip('/')}/{label}-{uuid.uuid4().hex}{suffix}"


def create(uri: str):
    system, path = place(uri)
    system.create_dir(path.rsplit("/", 1)[0], recursive=True)
    return system.open_output_stream(path, compression=None)  # the name's suffix must not add a compression


class Readers:
    """The files read last, kept open; no more than ``most`` of them."""

    def __init__(self, most: int = 16):
        self.most, self.open = most, {}

    def read(self, uri: str, offset: int, length: int) -> bytes:
        if uri in self.open:
            file = self.open.pop(uri)
        else:
            system, path = place(uri)
            file = system.open_input_file(path)
            if len(self.open) >= self.most:
                self.open.pop(next(iter(self.open))).close()
        self.open[uri] = file
        return file.read_at(length, offset)

    def close(self) -> None:
        for file in self.open.values():
            file.close()
        self.open.clear()


def read_all(uri: str) -> bytes:
    system, path = place(uri)
    with system.open_input_file(path) as file:
        return file.read()
