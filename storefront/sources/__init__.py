"""Sources and sinks: Parquet tables, the domain views bound onto them, and
table writes."""

from storefront.sources.tables import TABLE_NAMES, read_table  # noqa: F401
