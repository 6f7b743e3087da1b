"""Project settings shared by every builder."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

# Funnel step names in funnel order (step number = position).
FUNNEL_STEPS = ("session_start", "view_item", "add_to_cart", "begin_checkout", "purchase")

# Fixed value: feature adoption counts days 0 to 7, whatever the activation window is.
ADOPTION_WINDOW_DAYS = 7


@dataclass(frozen=True)
class EngineConfig:
    """Observation window and the thresholds the metrics depend on.

    With ``every_row`` the scan has no window: rows of any day and rows without one are read. The bounds then only
    say what is censored or open.
    """

    window_start: date = date(2020, 11, 1)
    window_end: date = date(2021, 1, 31)
    activation_window_days: int = 7
    session_gap_minutes: int = 30
    engaged_min_seconds: int = 10
    engaged_min_page_views: int = 2
    enable_partitioning: bool = True
    every_row: bool = False
    funnel_steps: tuple[str, ...] = FUNNEL_STEPS

    @property
    def window_start_text(self) -> str:
        return self.window_start.strftime("%Y%m%d")

    @property
    def window_end_text(self) -> str:
        return self.window_end.strftime("%Y%m%d")
