"""Target tables: types, keys, NOT NULL, defaults and lengths.

A ``ColumnRule`` says how a parsed (text) column becomes a stored column.
``default`` applies only when the source lacks the column, as a column
default applies only to columns left out of an INSERT; an explicit NULL in a
NOT NULL column is a reject.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class ColumnRule:
    name: str
    type: str                     # Spark SQL type name
    nullable: bool = True
    max_len: int | None = None    # characters, for text columns
    default: object = None        # used when the source has no such column
    source: str | None = None     # source column name when it differs


@dataclass(frozen=True)
class TargetSpec:
    name: str
    columns: tuple[ColumnRule, ...]
    keys: tuple[str, ...]         # unique key (first write wins)

    @property
    def column_names(self) -> list[str]:
        return [c.name for c in self.columns]


BRAND = TargetSpec("brand", (
    ColumnRule("third_id", "int"),
    ColumnRule("name", "string", max_len=30),
    ColumnRule("remote_logo", "string", max_len=255),
    ColumnRule("logo", "string", max_len=255),
), keys=("third_id",))

CAR = TargetSpec("car", (
    ColumnRule("third_id", "int", nullable=False, default=0),
    ColumnRule("name", "string", max_len=100),
    ColumnRule("show_name", "string", max_len=200),
    ColumnRule("en_name", "string", max_len=60),
    ColumnRule("brand_third_id", "int", nullable=False, default=0),
    ColumnRule("factory_third_id", "int", nullable=False, default=0),
    ColumnRule("factory_name", "string", nullable=False, max_len=200),
    # parsed but never stored: the stored value is always the default
    ColumnRule("sale_state", "tinyint", nullable=False, default=0),
), keys=("third_id",))

VERSION = TargetSpec("version", (
    ColumnRule("car_third_id", "int", nullable=False, default=0),
    ColumnRule("third_id", "int", nullable=False),
    ColumnRule("name", "string", max_len=200),
    ColumnRule("refer_price", "string", max_len=20),
    ColumnRule("year_type", "string", max_len=10),
    ColumnRule("sale_state", "string", max_len=20),
    ColumnRule("tt", "string", max_len=60),
), keys=("third_id",))

VERSION_ATTR = TargetSpec("version_attr", (
    ColumnRule("car_version_third_id", "int", nullable=False),
    ColumnRule("content", "string", nullable=False),
), keys=("car_version_third_id",))

CAR2LEVEL = TargetSpec("car2level", (
    ColumnRule("car_third_id", "int", nullable=False),
    ColumnRule("level_id", "smallint", nullable=False),
), keys=("car_third_id", "level_id"))

CHANGE_LOG = TargetSpec("change_log", (
    ColumnRule("page_name", "string", max_len=100),
    ColumnRule("page_uid", "string", max_len=64),
    ColumnRule("page_url", "string", max_len=4000),
    ColumnRule("data_uid", "string", max_len=64),
), keys=())

TARGETS = {t.name: t for t in (BRAND, CAR, VERSION, VERSION_ATTR, CAR2LEVEL, CHANGE_LOG)}
