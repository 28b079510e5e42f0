"""A mapping table that is read again while a stream runs."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable

from pyspark.sql import DataFrame

from goldthread.operators.mapping import MappingColumns, MappingRow, compile_mapping, latest_per_column

LOG = logging.getLogger(__name__)


class MappingRefresh:
    """The newest mapping row per column, re-read once it is older than ``interval`` seconds.

    A read that fails keeps the last good rows; with none yet the failure is passed on.
    """

    def __init__(
        self,
        read: Callable[[], DataFrame],
        columns: MappingColumns = MappingColumns(),
        interval: float = 60.0,
        clock: Callable[[], float] = time.monotonic,
    ) -> None:
        self.read, self.columns, self.interval, self.clock = read, columns, interval, clock
        self.rows: list[MappingRow] | None = None
        self.read_at = 0.0

    def current(self) -> list[MappingRow]:
        now = self.clock()
        if self.rows is None or now - self.read_at >= self.interval:
            try:
                self.rows = compile_mapping(latest_per_column(self.read(), self.columns), self.columns)
                self.read_at = now
            except Exception:
                if self.rows is None:
                    raise
                LOG.warning("the mapping could not be read again; the last one stays", exc_info=True)
        return self.rows
