"""Typed run parameters: what a caller states about a contract, a layout or a measure."""

from __future__ import annotations

from dataclasses import dataclass, field

MEASURES_PER_LINE = 20
MAX_MEASURES = 100
# Columns that a table of measures may have.
MAX_COLUMNS = 2000
MAX_LEVELS = 9
MAX_ATTRIBUTE_CODES = 11
FIRST_KEY = 1_000_001
DEFAULT_CONTRACT = 101

# Legal period classes.
PERIOD_CLASSES = ("wk", "mth", "bimth", "qtr", "custm")


@dataclass(frozen=True)
class ContractSpec:
    """The scalar facts of one contract that operators attach to rows."""

    run_id: int
    contract_id: int
    source_id: int
    category_id: str | None = None
    structure: str | None = None
    vendor_id: int | None = None
    country: str | None = None
    currency: str | None = None
    retention_periods: int = 0


@dataclass(frozen=True)
class Field:
    """One fixed-width field: 1-based start and length."""

    name: str
    start: int
    length: int


@dataclass(frozen=True)
class FixedLayout:
    """Fields of a text line, the record test, and an optional measure block."""

    name: str
    fields: tuple[Field, ...]
    record: str
    slot_start: int | None = None
    slot_width: int | None = None
    tail: Field | None = None
    prefix_field: str | None = None

    def all_fields(self) -> tuple[Field, ...]:
        slots: tuple[Field, ...] = ()
        if self.slot_start is not None:
            slots = tuple(
                Field(f"slot_{i + 1}", self.slot_start + i * self.slot_width, self.slot_width)
                for i in range(MEASURES_PER_LINE)
            )
        return self.fields + slots + ((self.tail,) if self.tail else ())

    def overlaps(self) -> list[tuple[str, str]]:
        """Pairs of fields that share a character."""
        ordered = sorted(self.all_fields(), key=lambda f: f.start)
        return [(a.name, b.name) for a, b in zip(ordered, ordered[1:]) if a.start + a.length > b.start]


@dataclass(frozen=True)
class DelimitedLayout:
    """Source column -> output column of a headered delimited file; `order` None generates an order."""

    name: str
    code: str
    long_name: str
    attributes: str | None = None
    order: str | None = None


@dataclass(frozen=True)
class PeriodPolicy:
    """Which sides of the period indexes are scaled by the five-week-month factor."""

    scale_previous: bool = True
    scale_year_ago: bool = False


@dataclass(frozen=True)
class ExpressionSet:
    """Named target-column expressions of one contract (UDX-2)."""

    contract_id: int
    name: str
    columns: dict[str, str] = field(default_factory=dict)
