"""Load specifications: what to read from which server, how rows are identified and how far the last run got."""

from __future__ import annotations

import json
from collections.abc import Iterable
from dataclasses import dataclass, field, replace
from datetime import datetime, timezone
from enum import Enum

# Names of the system columns every layer after landing carries.
PARTITION_DATE = "__PartitionDateUTC"
HASH_KEY = "__hash_key"
CREATED_UTC = "__record_created_datetime_utc"
CREATED_CENTRAL = "__record_created_datetime_cst"
SOURCE_SERVER = "__source_server"
SOURCE_DATABASE = "__source_database"
SOURCE_TABLE = "__source_table"

LINEAGE_COLUMNS = (SOURCE_SERVER, SOURCE_DATABASE, SOURCE_TABLE)
SYSTEM_COLUMNS = (PARTITION_DATE, HASH_KEY, CREATED_UTC, CREATED_CENTRAL, *LINEAGE_COLUMNS)

# The watermark of a source that has never been loaded; early enough, yet valid for every database's date types.
NEVER_LOADED = datetime(1900, 1, 1, tzinfo=timezone.utc)


class LoadType(str, Enum):
    FULL = "full"
    INCREMENTAL = "incremental"


@dataclass(frozen=True)
class TableSpec:
    """One source table on one server."""

    host: str
    database: str
    schema: str
    table: str
    keys: tuple[str, ...]
    watermark: str | None = None
    load_type: LoadType = LoadType.INCREMENTAL
    last_loaded: datetime = field(default=NEVER_LOADED)
    # True promises that a row's watermark date never changes, so that no upsert looks for it in other partitions.
    stable_partition: bool = False
    # (name, boolean SQL expression) pairs; bronze keeps rows that break one apart.
    rules: tuple[tuple[str, str], ...] = ()

    def __post_init__(self) -> None:
        if not self.keys:
            raise ValueError(f"{self.table}: at least one key column is needed")
        if self.incremental and not self.watermark:
            raise ValueError(f"{self.table}: an incremental load needs a watermark column")

    @property
    def incremental(self) -> bool:
        return self.load_type is LoadType.INCREMENTAL

    @property
    def qualified_table(self) -> str:
        return f"{self.schema}.{self.table}"

    @property
    def relative_path(self) -> str:
        return f"{self.host}/{self.database}/{self.table}"

    def since(self, watermark: datetime | None) -> TableSpec:
        """The same source with another starting point."""
        return self if watermark is None else replace(self, last_loaded=as_utc(watermark))


def as_utc(value: datetime) -> datetime:
    """Naive datetimes are taken as UTC, never as the driver machine's zone."""
    return value.replace(tzinfo=timezone.utc) if value.tzinfo is None else value.astimezone(timezone.utc)


def parse_instant(text: str) -> datetime:
    return as_utc(datetime.fromisoformat(text.strip().replace("Z", "+00:00")))


def specs_from_json(text: str) -> list[TableSpec]:
    """Read ``{table: [{host_name, database_name, ...}, ...]}`` documents; unknown fields are ignored."""
    entries: Iterable[dict] = (entry for group in json.loads(text).values() for entry in group)
    return [
        TableSpec(
            host=entry["host_name"],
            database=entry["database_name"],
            schema=entry["schema_name"],
            table=entry["sql_table"],
            keys=tuple(entry["hash_key_column_list"]),
            watermark=(entry.get("watermark_column") or "").strip() or None,
            load_type=LoadType(entry["load_type"].lower()),
            last_loaded=parse_instant(entry["last_inserted_datetime"]),
            rules=tuple((entry.get("rules") or {}).items()),
        )
        for entry in entries
    ]
