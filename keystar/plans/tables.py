"""Named relations that are built on first use."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import DataFrame

Builder = Callable[[], DataFrame]


class Tables(Mapping[str, DataFrame]):
    """Relations by name; a query that needs three of them plans only those three."""

    def __init__(self, builders: Mapping[str, Builder]) -> None:
        self._builders = dict(builders)
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._builders[name]()
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)

    def extended(self, builders: Mapping[str, Builder]) -> Tables:
        """The same relations with some added or replaced."""
        names = {name: (lambda name=name: self[name]) for name in self._builders}
        return Tables({**names, **builders})
