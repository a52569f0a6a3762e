"""The table registry: name to :class:`TableSpec`."""

from tickloom.specs.base import TableSpec, as_schema, conform  # noqa: F401
from tickloom.specs.fundamentals import fundamental_tables
from tickloom.specs.markets import market_tables
from tickloom.specs.reference import reference_tables
from tickloom.specs.vendors import vendor_tables

TABLES: dict[str, TableSpec] = {
    table.name: table
    for family in (market_tables, reference_tables, fundamental_tables, vendor_tables)
    for table in family()
}
