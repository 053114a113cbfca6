"""A small keyed store in a folder, a JSON file per key: a stand-in for a service, for tests and local runs."""

from __future__ import annotations

import json
import os
from collections.abc import Callable, Iterator
from datetime import date
from pathlib import Path
from uuid import uuid4


def _plain(value):
    return {"date": value.isoformat()} if isinstance(value, date) else value


def _typed(value):
    return date.fromisoformat(value["date"]) if isinstance(value, dict) else value


class FolderStore:
    """Rows of JSON values and dates. A row is replaced in one step, so a reader never sees half of it."""

    def __init__(self, folder: str, key: str):
        self.folder, self.key = Path(folder), key
        self.folder.mkdir(parents=True, exist_ok=True)

    def _keys(self) -> Iterator[int]:
        return (int(p.name[:-5]) for p in self.folder.iterdir() if p.name.endswith(".json"))

    def bounds(self) -> tuple[int, int] | None:
        keys = list(self._keys())
        return (min(keys), max(keys)) if keys else None

    def scan(self, low: int, high: int) -> Iterator[dict]:
        for key in self._keys():
            if low <= key <= high:
                row = json.loads((self.folder / f"{key}.json").read_text())
                yield {name: _typed(value) for name, value in row.items()}

    def put_many(self, rows: list[dict]) -> None:
        for row in rows:
            half = self.folder / f"{uuid4().hex}.tmp"
            half.write_text(json.dumps({name: _plain(value) for name, value in row.items()}))
            os.replace(half, self.folder / f"{row[self.key]}.json")

    def delete_many(self, keys: list) -> None:
        for key in keys:
            (self.folder / f"{key}.json").unlink(missing_ok=True)

    def finished(self, puts: int, deletes: int, whole: bool) -> None:
        (self.folder / "last_write").write_text(f"{puts} {deletes} {'whole' if whole else 'aborted'}")

    def close(self) -> None:
        pass


def folder_store(folder: str, key: str) -> Callable[[], FolderStore]:
    """What ``register_store`` and ``push_plan`` take; it opens the folder in the task."""
    return lambda: FolderStore(folder, key)
