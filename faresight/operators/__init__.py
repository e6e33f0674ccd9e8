"""Operators: routes, archive documents, daily aggregate, table changes."""

from faresight.operators.aggregate import fare_daily_agg
from faresight.operators.archive import (archive_documents, archive_flights, archive_offers, archived_flights,
                                         expired_fares, flights_in_window, frame_max,
                                         layover_doc, layover_segments, price_history, price_history_doc)
from faresight.operators.merge import (agg_upsert, batch_bounds, delete_departed, fare_latest,
                                       landing_range, latest_per_key, migrate_day, migrate_landing, purge_landing,
                                       retain_recent, upsert, upsert_partitions)
from faresight.operators.routes import routes

__all__ = [
    "agg_upsert", "archive_documents", "archive_flights", "archive_offers", "archived_flights",
    "batch_bounds", "delete_departed", "expired_fares",
    "fare_daily_agg", "fare_latest", "flights_in_window", "frame_max", "landing_range", "latest_per_key", "layover_doc",
    "layover_segments", "migrate_day", "migrate_landing", "price_history", "price_history_doc",
    "purge_landing", "retain_recent", "routes", "upsert", "upsert_partitions",
]
