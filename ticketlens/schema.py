"""Field definitions and data rules of the ticket model.

The stage holds eleven text columns. The clean table has the same columns with types; the star
splits it into customers, agents and a nine-column fact.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import date
from types import MappingProxyType

from pyspark.sql import types as T

# ---- fixed values -----------------------------------------------------------------------------
CHANNELS = ("Chat", "Email", "Phone", "Social Media", "Web Form")
REQUIRED_FIELDS = (
    "agent_id",
    "channel",
    "first_response_minutes",
    "resolution_hours",
    "csat_score",
)
THRESHOLD_HOURS = 24
BUCKET_LABELS = ("<= {} hrs", "> {} hrs")
EXPORT_TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
# ------------------------------------------------------------------------------------------------


def bucket_labels(threshold=THRESHOLD_HOURS) -> tuple[str, str]:
    """Labels of the buckets within and after the threshold."""
    within, after = BUCKET_LABELS
    return within.format(f"{threshold:g}"), after.format(f"{threshold:g}")


def _text(name: str, length: int, description: str) -> T.StructField:
    meta = {"label": "Text", "max_length": length, "description": description}
    return T.StructField(name, T.StringType(), True, meta)


def _typed(name: str, dtype: T.DataType, label: str, description: str) -> T.StructField:
    return T.StructField(name, dtype, True, {"label": label, "description": description})


# Names, lengths and type labels of the fields are fixed values; the descriptions are not.
CLEAN_SCHEMA = T.StructType(
    [
        _text("ticket_id", 12, "Identifier of the ticket, unique after cleaning"),
        _text("customer_id", 10, "Customer who opened the ticket"),
        _text("customer_region", 20, "Sales region of that customer"),
        _text("agent_id", 10, "Agent who handled the ticket"),
        _text("agent_name", 60, "Name of that agent"),
        _text("channel", 20, "Way the ticket came in"),
        _text("category", 30, "Kind of problem reported"),
        _typed("created_at", T.TimestampNTZType(), "Datetime", "Moment the ticket was opened"),
        _typed(
            "first_response_minutes",
            T.DecimalType(7, 1),
            "Numeric",
            "Minutes until an agent first answered",
        ),
        _typed(
            "resolution_hours",
            T.DecimalType(6, 1),
            "Numeric",
            "Hours until the ticket was resolved",
        ),
        _typed("csat_score", T.ShortType(), "Integer 1-5", "Satisfaction score given afterwards"),
    ]
)
STAGE_COLUMNS = tuple(f.name for f in CLEAN_SCHEMA)
STAGE_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in STAGE_COLUMNS])

CUSTOMER_COLUMNS = ("customer_id", "customer_region")
AGENT_COLUMNS = ("agent_id", "agent_name")
TICKET_COLUMNS = tuple(c for c in STAGE_COLUMNS if c not in ("customer_region", "agent_name"))


@dataclass(frozen=True)
class Range:
    """Allowed values: from ``low`` (left out when ``open_low``) up to ``high``."""

    low: int | float | date
    high: int | float | date | None = None
    open_low: bool = False

    def __str__(self) -> str:
        if self.high is None:
            return f"> {self.low}" if self.open_low else f">= {self.low}"
        return f"between {self.low} and {self.high}"


def _frozen(**items) -> Mapping:
    return MappingProxyType(items)


@dataclass(frozen=True)
class Rules:
    """What a row must satisfy to be loaded. The defaults are the model's own rules."""

    required: tuple[str, ...] = REQUIRED_FIELDS
    domains: Mapping[str, tuple[str, ...]] = field(
        default_factory=lambda: _frozen(channel=CHANNELS)
    )
    ranges: Mapping[str, Range] = field(
        default_factory=lambda: _frozen(
            first_response_minutes=Range(0, open_low=True),
            resolution_hours=Range(0, open_low=True),
            csat_score=Range(1, 5),
            # keeps a mistyped year out of the calendar
            created_at=Range(date(1900, 1, 1), date(2199, 12, 31)),
        )
    )
    max_lengths: Mapping[str, int] = field(
        default_factory=lambda: MappingProxyType(
            {f.name: f.metadata["max_length"] for f in CLEAN_SCHEMA if "max_length" in f.metadata}
        )
    )
