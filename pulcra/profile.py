"""What the columns of a registry mean.

A profile is plain data. Operators read roles, patterns, domains, maps and
thresholds from it; nothing else in the package knows a column by name. The
catalogue of legal (parent, child) pairs is not part of it: catalogues grow,
so they travel as DataFrames.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pulcra.functions.text import MISSING_MARKERS

# Check ids, in reporting order.
CHECKS = (
    "exact_duplicates", "text_spaces", "phone_format", "official_places",
    "schema_and_types", "category_variants", "invalid_values",
)


@dataclass(frozen=True)
class ReviewLabels:
    """Words written into the duplicate review. Fixed values."""

    keep: str = "CONSERVAR"
    fix: str = "CORREGIR"
    merge: str = "FUSIONAR"
    drop: str = "ELIMINAR"
    very_high: str = "MUY ALTA"
    high: str = "ALTA"
    no_difference: str = "NINGUNO"


# The blocking of the registry's published review.
PUBLISHED_REVIEW = {"block_prefix": 18, "title_block_limit": 80, "phone_block_limit": 40}


@dataclass(frozen=True)
class Zone:
    """A sub-place stored in the child column of one parent."""

    column: str
    capital: str          # parent value whose children are zones
    derive_pattern: str   # shape worth keeping
    valid_pattern: str    # shape and range of a legal value
    parent: str           # where a zone belongs after the repair
    child: str


@dataclass(frozen=True)
class Profile:
    name: str
    columns: tuple[str, ...]                 # raw columns, contractual order
    code: str
    code_patterns: tuple[str, ...]
    parent: str
    child: str
    title: str                               # column compared for near duplicates
    address: str
    phone: str
    identifiers: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    free_text: tuple[str, ...] = ()
    dashed: str | None = None                # free text with decorative dashes
    categories: tuple[str, ...] = ()         # made ASCII by the cleaning
    reported_categories: tuple[str, ...] = ()  # with a line among the corrections
    variant_columns: tuple[str, ...] = ()    # checked for equivalent spellings
    domains: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    required: tuple[str, ...] = ()
    label: str | None = None                 # column that must fit the parent
    zone: Zone | None = None
    parent_map: Mapping[str, str] = field(default_factory=dict)
    child_map: Mapping[str, str] = field(default_factory=dict)
    unit: tuple[str, ...] = ()               # columns that make one registry unit
    compared: tuple[str, ...] = ()           # columns listed when they differ
    title_at_least: float = 94.0
    address_at_least: float = 85.0
    # None: whole titles, and blocks of any size. Numbers restrict the review.
    block_prefix: int | None = None
    title_block_limit: int | None = None
    phone_block_limit: int | None = None
    markers: tuple[str, ...] = MISSING_MARKERS
    labels: ReviewLabels = ReviewLabels()
    check_names: Mapping[str, str] = field(default_factory=dict)
    row_id: str = "row_id"

    @property
    def clean_columns(self) -> tuple[str, ...]:
        """Contractual columns after cleaning: the zone follows the child."""
        if self.zone is None:
            return self.columns
        at = self.columns.index(self.child) + 1
        return (*self.columns[:at], self.zone.column, *self.columns[at:])

    def shown(self, check: str) -> str:
        return self.check_names.get(check, check)
