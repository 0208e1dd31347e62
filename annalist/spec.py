"""Description of a snapshot feed: which columns identify, date and track an entity."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the end date of a version that is still open.
OPEN_END = "9999-12-31"


@dataclass(frozen=True)
class EntitySpec:
    """One snapshot feed.

    ``tie_break`` decides which row survives when a feed delivers several rows for the same
    entity and day; a leading ``-`` sorts that column newest first.  List enough columns to
    make the order total, otherwise the winner is arbitrary.

    ``null_safe`` selects the change test.  Off: rows are compared by the text of their
    tracked columns joined with ``separator``, which skips NULLs unless ``missing`` gives the
    text that stands for them.  On: rows are compared column by column with NULL as an
    ordinary value.
    """

    key: str
    date: str
    tracked: tuple[str, ...]
    tie_break: tuple[str, ...] = ()
    separator: str = "|"
    null_safe: bool = False
    missing: str | None = None

    def tie_order(self) -> list[Column]:
        return [
            F.col(c[1:]).desc_nulls_last() if c.startswith("-") else F.col(c).asc_nulls_last()
            for c in self.tie_break
        ]

    def with_(self, **changes) -> "EntitySpec":
        return replace(self, **changes)


def open_end() -> Column:
    return F.lit(OPEN_END).cast("date")
