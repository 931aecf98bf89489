"""Parameters of one weekly report run."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timedelta

# They decide which rows count, so they must stay as they are for results to agree.
LOYAL_NETWORK = 66
INFERRED_NETWORK = 301
OWNER = 38
MIN_GROUP = 28
LOYALTY_CODE = "LOYL"
OWN_CODES = (4119000000, 4119099999)
LISTED_STORES = (415, 432, 438, 441, 448, 456, 459, 144, 145, 146, 147)
TWO_LEVEL_PRODUCT = "Milk"
YEAR_DAYS = 364
INFERRED_YEAR_DAYS = 365
PRE_LAUNCH_DAYS = 182


@dataclass(frozen=True)
class ReportParams:
    """What one run needs to know besides its tables.

    ``broadcast_rows`` is the most rows a lookup may have to be broadcast. All broadcast lookups hold
    fixed-width columns only (keys, dates, flags, a code of at most 20 digits), under 128 bytes a row,
    so the default bounds a broadcast at about 128 MB. Beyond it the same join runs shuffled, with
    ``salts`` slots per hot key. An order header of more than ``filter_rows`` rows is cut to the matched lines' orders
    by a filter of ``filter_bytes`` at most before it is shuffled.
    """

    stop_date: date
    loyal_network: int = LOYAL_NETWORK
    inferred_network: int = INFERRED_NETWORK
    owner: int = OWNER
    own_codes: tuple[int, int] = OWN_CODES
    loyalty_code: str = LOYALTY_CODE
    min_group: int = MIN_GROUP
    brand_flag: str | None = "b"
    source_label: str = "POS"
    broadcast_rows: int = 1_000_000
    salts: int = 16
    filter_rows: int = 10_000_000
    filter_bytes: int = 64 << 20

    @classmethod
    def for_week(cls, text: str, **overrides) -> "ReportParams":
        """Parameters for the week ending on ``text``, a ``yyyymmdd`` date."""
        return cls(stop_date=datetime.strptime(text, "%Y%m%d").date(), **overrides)

    @property
    def stop_yago(self) -> date:
        """The same Saturday one year (52 weeks) earlier."""
        return self.stop_date - timedelta(days=YEAR_DAYS)
