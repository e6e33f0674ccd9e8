"""Sources and sinks: parquet / JDBC tables, the region-map document, archive JSON, table writes."""

from faresight.sources.region_map import read_region_map, write_region_map
from faresight.sources.sinks import overwrite_partitions, publish_snapshot, read_archive, read_listing, write_archive, write_listing
from faresight.sources.tables import read_jdbc, read_parquet, read_table

__all__ = ["overwrite_partitions", "read_archive", "read_jdbc", "read_parquet", "read_region_map",
           "read_table", "publish_snapshot", "read_listing", "write_archive", "write_listing", "write_region_map"]
