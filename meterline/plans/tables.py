"""Named tables that are built when first asked for."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import DataFrame


class Tables(Mapping):
    """Frames by name, as items or attributes. A builder runs once; `replace` swaps in stored data."""

    def __init__(self, **builders: DataFrame | Callable[[], DataFrame]):
        self._entries = dict(builders)

    def __getitem__(self, name: str) -> DataFrame:
        entry = self._entries[name]
        if not isinstance(entry, DataFrame):
            entry = entry()
            self._entries[name] = entry
        return entry

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        try:
            return self[name]
        except KeyError:
            raise AttributeError(f"no table {name}") from None

    def __iter__(self) -> Iterator[str]:
        return iter(self._entries)

    def __len__(self) -> int:
        return len(self._entries)

    def replace(self, **frames: DataFrame) -> Tables:
        return Tables(**{**self._entries, **frames})

    def settle(self, name: str, frame: DataFrame) -> None:
        """Let later builders read a table where it was written instead of recomputing it."""
        self._entries[name] = frame
