"""Contract constants and thresholds, passed to operators as plain arguments."""

from __future__ import annotations

import os
from dataclasses import dataclass
from datetime import datetime, timezone

# The corpus contract and its alert thresholds.
DEFAULT_NOW = "2026-02-10T14:35:00+00:00"
NOW_ENV = "LAB_NOW"
ISO_DATE_PATTERN = r"^\d{4}-\d{2}-\d{2}$"
REPLACEMENT_CHAR = "�"
PREVIEW_CHARS = 120
SOURCES = ("postgres", "jira", "file")
KNOWLEDGE_SOURCE = "file"
NO_ANSWER_TEXT = "Không tìm thấy thông tin trong cơ sở tri thức."
NO_ANSWER_DOC = "-"


@dataclass(frozen=True)
class Thresholds:
    freshness_sla_hours: float = 4.0
    freshness_warn_ratio: float = 0.5
    volume_change_warn_pct: float = 20.0
    null_rate_warn_pct: float = 10.0
    min_ocr_confidence: float = 0.60
    low_ocr_warn: float = 0.85


def parse_now(text: str | None = None) -> datetime:
    """The run's clock. Naive input is UTC; operators never read the wall clock."""
    now = datetime.fromisoformat(text or os.environ.get(NOW_ENV, DEFAULT_NOW))
    return now if now.tzinfo else now.replace(tzinfo=timezone.utc)


def run_id_of(now: datetime) -> str:
    return now.strftime("%Y-%m-%dT%H:%M")
