"""Row identity and row fingerprints."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The separators under which stored hashes were computed.
KEY_SEPARATOR = " "
ROW_SEPARATOR = "|"


def fingerprint(columns: Sequence[str | Column], separator: str = ROW_SEPARATOR) -> Column:
    """SHA-256 over the columns' text.

    Null parts are skipped, not marked, so the result is never null and always comparable; ``(a, null, b)`` and
    ``(a, b)`` share a fingerprint.
    """
    parts = [F.col(c) if isinstance(c, str) else c for c in columns]
    return F.sha2(F.concat_ws(separator, *[part.cast("string") for part in parts]), 256)


def source_key(keys: Sequence[str], host: str | Column) -> Column:
    """Identity of a row across servers: its business key followed by the host it came from."""
    owner = F.lit(host) if isinstance(host, str) else host
    return fingerprint([*keys, owner], KEY_SEPARATOR)


def joined_id(columns: Sequence[str]) -> Column:
    """Parts run together without a separator; null when any part is null."""
    return F.concat(*[F.col(c).cast("string") for c in columns])
