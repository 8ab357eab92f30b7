"""The exported restart position: a small JSON file that readers only ever see whole."""

from __future__ import annotations

import json
import os
import tempfile
from dataclasses import dataclass
from pathlib import Path


@dataclass(frozen=True)
class Position:
    file: str
    pos: int

    def __str__(self) -> str:
        return f"{self.file}:{self.pos}"


def load(path: str | Path) -> Position | None:
    """The saved position; None if there is no file, an error if it isn't one of ours."""
    try:
        text = Path(path).read_text(encoding="utf-8")
    except FileNotFoundError:
        return None
    found = json.loads(text)["binlog"]
    return Position(str(found["file"]), int(found["pos"]))


def save(path: str | Path, position: Position) -> None:
    """Written beside the target, synced, and put in its place; a failure leaves the old file and nothing else."""
    target = Path(path).absolute()
    handle, temporary = tempfile.mkstemp(dir=target.parent, prefix=f".{target.name}.")
    try:
        with os.fdopen(handle, "w", encoding="utf-8") as out:
            json.dump({"binlog": {"file": position.file, "pos": position.pos}}, out)
            out.flush()
            os.fsync(out.fileno())
        os.replace(temporary, target)
    except BaseException:
        Path(temporary).unlink(missing_ok=True)
        raise
    folder = os.open(target.parent, os.O_RDONLY)
    try:
        os.fsync(folder)
    finally:
        os.close(folder)


def start_position(file: str | None, pos: int | None, saved: Position | None, current: Position) -> Position:
    """Where to start: the position that is asked for, else the saved one, else the source's current one."""
    if (file is None) != (pos is None):
        raise ValueError("give both a file and a position, or neither")
    if file is not None and pos is not None:
        return Position(file, pos)
    return saved or current
