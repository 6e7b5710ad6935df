"""Limits that reject a request instead of letting it degrade. Callers may lower them within the bounds."""

from __future__ import annotations

from dataclasses import dataclass, fields

from tidemark.engine.errors import ConfigurationError

#: The default of each limit and its bounds (fixed values).
BOUNDS = {
    "page_size": (500, 1, 500),
    "query_bytes": (16_384, 1, 1 << 20),
    "facets": (32, 0, 100),
    "highlights": (32, 0, 100),
    "filter_clauses": (128, 1, 1_024),
    "bulk_actions": (1_000, 1, 10_000),
    "bulk_bytes": (8 << 20, 1 << 10, 100 << 20),
    "facet_buckets": (100, 1, 10_000),
    "highlight_fragments": (5, 1, 100),
}
MEMBERS = 10_000
FRAGMENT_CHARS = 256
FRAGMENT_BYTES = 4_096
CURSOR_SECONDS = 900
LEASE_SECONDS = 120
KEYWORD_CHARS = 32_766


@dataclass(frozen=True)
class Limits:
    page_size: int = 500
    query_bytes: int = 16_384
    facets: int = 32
    highlights: int = 32
    filter_clauses: int = 128
    bulk_actions: int = 1_000
    bulk_bytes: int = 8 << 20
    facet_buckets: int = 100
    highlight_fragments: int = 5

    def __post_init__(self) -> None:
        for f in fields(self):
            value, (_, low, high) = getattr(self, f.name), BOUNDS[f.name]
            if isinstance(value, bool) or not isinstance(value, int) or not low <= value <= high:
                raise ConfigurationError(f"{f.name} must lie between {low} and {high}")
