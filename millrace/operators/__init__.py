from millrace.operators.aggregates import (
    added_partials,
    finished_stats,
    latest_hours,
    zone_partials,
    zone_stats,
)
from millrace.operators.changes import (
    bronze_change_rejects,
    change_rejects,
    change_state,
    current_state,
    latest_per_key,
    live_rows,
    merge_state,
    parse_change_events,
    state_as_of,
    with_change_key,
)
from millrace.operators.history import change_history, rows_at, versions_at
from millrace.operators.ingest import (
    beyond_high_water,
    broadcast_if_small,
    drop_replayed,
    high_water_marks,
    new_records,
    undecodable,
)
from millrace.operators.offsets import (
    among,
    merged_intervals,
    offset_intervals,
    outside,
    read_spans,
    starting_offsets,
)
from millrace.operators.quality import (
    duplicate_keys,
    fingerprint_difference,
    freshness,
    multiset_difference,
    reconcile,
    reconcile_by_buckets,
    reconcile_counts,
    table_counts,
    table_fingerprint,
)
from millrace.operators.trips import clean_trips, parse_trips, trip_rejects
from millrace.operators.zones import (
    DimensionFacts,
    dimension_facts,
    enrich_zones,
    heavy_places,
)

__all__ = [
    "among",
    "DimensionFacts",
    "added_partials",
    "beyond_high_water",
    "broadcast_if_small",
    "bronze_change_rejects",
    "change_history",
    "change_rejects",
    "change_state",
    "clean_trips",
    "current_state",
    "dimension_facts",
    "drop_replayed",
    "duplicate_keys",
    "enrich_zones",
    "fingerprint_difference",
    "finished_stats",
    "freshness",
    "heavy_places",
    "high_water_marks",
    "latest_hours",
    "latest_per_key",
    "live_rows",
    "merge_state",
    "merged_intervals",
    "multiset_difference",
    "new_records",
    "offset_intervals",
    "outside",
    "parse_change_events",
    "parse_trips",
    "read_spans",
    "reconcile",
    "reconcile_by_buckets",
    "reconcile_counts",
    "rows_at",
    "starting_offsets",
    "state_as_of",
    "table_counts",
    "table_fingerprint",
    "trip_rejects",
    "undecodable",
    "versions_at",
    "with_change_key",
    "zone_partials",
    "zone_stats",
]
