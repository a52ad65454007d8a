"""Fixed parameters of the catalogue queries (the oracle SQL states its own)."""

from __future__ import annotations

# Region used for the weekend question (the reference asks about one region).
WEEKEND_REGION = "AFRICA"

# Dashboard selections.  The API form treats missing/empty lists as "all";
# the strict form treats an empty list as "nothing".
SELECTION = {"years": [1996, 1997], "regions": ["ASIA", "EUROPE"], "channels": None}
STRICT_SELECTION = {
    "years": [1996, 1997],
    "regions": ["ASIA", "EUROPE"],
    "channels": ["AUTOMOBILE", "BUILDING"],
}
NO_SELECTION = {"years": None, "regions": None, "channels": None}
EMPTY_SELECTION = {"years": [1990], "regions": None, "channels": None}

# Event page request: batch size, cursor (rows consumed) and look-back batches.
PAGE = {"batch_size": 30, "stream_cursor": 5000, "lookback_batches": 4}
# Deep: past any report-sized head; default: no cursor; clamped: every parameter out of bounds.
PAGE_DEEP = {"batch_size": 60, "stream_cursor": 55_000, "lookback_batches": 5}
PAGE_DEFAULT = {"batch_size": 30, "stream_cursor": None, "lookback_batches": 4}
PAGE_CLAMPED = {"batch_size": 500, "stream_cursor": 10**12, "lookback_batches": 0}
