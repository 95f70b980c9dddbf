"""What the caller declares about a table and its columns."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, replace
from datetime import datetime, timedelta

from tidemark.functions.text import safe_name

# Rows that a bucket of the first load holds, and the fewest and most buckets chosen for a table.
BUCKET_ROWS = 500_000
LEAST_BUCKETS = 8
MAX_BUCKETS = 8_192

_LOOKBACK_UNITS = {"d": "days", "h": "hours", "m": "minutes"}


def parse_lookback(text: str | None) -> timedelta:
    """`2d`, `12h` or `30m` (minutes) as a time span; nothing means no lookback."""
    if not text:
        return timedelta(0)
    found = re.fullmatch(r"(-?\d+)([dhm])", text)
    if not found:
        raise KeyError(f"lookback must look like 2d, 12h or 30m, got {text!r}")
    return timedelta(**{_LOOKBACK_UNITS[found[2]]: int(found[1])})


def _present(value) -> bool:
    return value is not None and value == value and str(value).strip() not in ("", "nan", "NaT")


@dataclass(frozen=True)
class ColumnSpec:
    """One declared column: where it comes from and what type it is to have."""

    name: str
    data_type: str = "varchar"
    width: int | None = None
    scale: int | None = None
    nullable: bool = True
    source_expr: str | None = None
    excluded: bool = False

    @property
    def sql_name(self) -> str:
        return safe_name(self.name)

    @property
    def expression(self) -> str:
        return self.source_expr or f"`{self.name}`"

    # Fixed values in both `from_row`: the column names of catalogue and registry.
    @classmethod
    def from_row(cls, row: Mapping) -> ColumnSpec:
        """From a catalogue row (`ColumnName`, `DataType`, `Width`, `Scale`, `NullFlag`, ...)."""

        def whole(key):
            return int(float(row[key])) if _present(row.get(key)) else None

        return cls(
            name=row["ColumnName"],
            data_type=str(row.get("DataType") or "varchar"),
            width=whole("Width"),
            scale=whole("Scale"),
            nullable=str(row.get("NullFlag", "Y")).upper() == "Y",
            source_expr=row.get("SourceExpression"),
            excluded=bool(row.get("IsExcluded", 0)),
        )


@dataclass(frozen=True)
class TableSpec:
    """One replicated table: its key, its change timestamp and how to read it."""

    name: str
    primary_key: tuple[str, ...]
    destination: str | None = None
    modified_col: str | None = None
    has_timestamps: bool = True
    filter_clause: str | None = None
    last_success: datetime | None = None
    precision: str = "datetime"
    lookback: str | None = None
    partition_expr: str | None = None
    #: A key never changes its part although `partition_expr` names other columns than the key
    #: (such as the day a row was created): a load then looks only into the parts of its batch.
    stable_parts: bool = False
    #: Buckets of the key where no expression is given; None: by the rows of the first load.
    buckets: int | None = None

    @classmethod
    def from_row(cls, row: Mapping) -> TableSpec:
        """From a registry row (`TableName`, `PrimaryKeyCols`, `DateModifCol`, ...)."""

        def optional(key):
            return row[key] if _present(row.get(key)) else None

        keys = tuple(k.strip() for k in str(row["PrimaryKeyCols"]).split(",") if k.strip())
        return cls(
            name=row["TableName"],
            primary_key=keys,
            destination=optional("DestinationTable"),
            modified_col=optional("DateModifCol"),
            has_timestamps=bool(row.get("HasTimestamps")),
            filter_clause=optional("FilterClause"),
            last_success=optional("LastSuccessTs"),
            precision=optional("DateModifPrecision") or "datetime",
            lookback=optional("LookbackInterval"),
        )

    def part_expr(self, rows: int) -> str:
        """What a row's part follows from, for a table of so many rows: the declared expression,
        else a bucket of the key. A changed row costs the rewriting of its part, so a bucket is to
        hold about BUCKET_ROWS rows. The table keeps the expression of its first load."""
        if self.partition_expr:
            return self.partition_expr
        keys = ", ".join(f"`{k}`" for k in self.primary_key)
        buckets = self.buckets or min(MAX_BUCKETS, max(LEAST_BUCKETS, -(-rows // BUCKET_ROWS)))
        return f"pmod(xxhash64({keys}), {buckets})"

    @property
    def parts_follow_key(self) -> bool:
        """True where a key has one part for good, so that a batch names all parts it can touch."""
        return self.partition_expr is None or self.stable_parts

    @property
    def is_incremental(self) -> bool:
        """False when the table has no change timestamp, so it is always read in full."""
        return bool(self.has_timestamps and self.modified_col)

    def lower_bound(self) -> datetime | None:
        """Oldest change to read again: last success less lookback, cut to the precision."""
        if self.last_success is None:
            return None
        bound = (self.last_success - parse_lookback(self.lookback)).replace(microsecond=0)
        if self.precision == "date":
            bound = bound.replace(hour=0, minute=0, second=0)
        return bound

    def with_last_success(self, moment: datetime | None) -> TableSpec:
        return replace(self, last_success=moment)


def included(columns: Iterable[ColumnSpec]) -> list[ColumnSpec]:
    """Columns to read, in the order of their source names."""
    kept = sorted((c for c in columns if not c.excluded), key=lambda c: c.name)
    if not kept:
        raise ValueError("no column left to read")
    return kept
