"""Named queries over the driver's tables and the SQL that checks them."""

from __future__ import annotations

from skein.plans import boundary, cutting, framing, recording, sessions, similarity, staging, storage, timing

QUERIES: dict = {}
ORACLES: dict = {}
for part in (cutting, sessions, similarity, timing, framing, recording, staging, storage, boundary):
    QUERIES |= part.QUERIES
    ORACLES |= part.ORACLES
