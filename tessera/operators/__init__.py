"""Modelling pipelines: DataFrame(s) + parameters -> DataFrame."""

from tessera.operators.chunks import chunk_backfill, chunk_step, whole_history
from tessera.operators.cumulative import (cumulate_backfill, cumulate_step, cumulate_step_multi,
                                          cumulate_step_rows, history_ratio,
                                          rows_summary_as_of, snapshot_multi_as_of, unnest_history)
from tessera.operators.datelist import (active_on, activity_flags, activity_mask_from_events,
                                        datelist_as_of, datelist_history, datelist_step,
                                        event_range)
from tessera.operators.devices import device_datelist, device_datelist_int, explode_map
from tessera.operators.facts import absence_report, build_fact, minutes_from_text
from tessera.operators.graph import (edge_property_max, edge_ratio_report, edges_from_rows,
                                     variant_properties, vertex_counts, vertices_dedup,
                                     vertices_from_agg, vertices_from_rows)
from tessera.operators.keys import check_keys, check_values, dedup, duplicate_keys
from tessera.operators.month_arrays import (host_month_as_of, host_month_step,
                                            host_visitor_bitmaps_as_of, host_visitor_bitmaps_of_day,
                                            host_visitors_as_of, host_visitors_of_day,
                                            merge_visitor_bitmaps, month_array_step,
                                            month_arrays_as_of, month_visitor_counts,
                                            month_visitors, unpack_month_arrays)
from tessera.operators.reports import (match_view, match_view_hot, top_by_avg, top_by_count,
                                       top_by_distinct, top_for_label, top_k)
from tessera.operators.scd2 import scd2_backfill, scd2_increment
from tessera.operators.upsert import upsert, write_upsert

__all__ = [
    "absence_report", "active_on", "activity_flags", "activity_mask_from_events", "build_fact",
    "check_keys", "check_values", "chunk_backfill", "chunk_step", "cumulate_backfill", "cumulate_step", "cumulate_step_multi",
    "cumulate_step_rows", "rows_summary_as_of",
    "datelist_as_of", "datelist_history", "datelist_step", "dedup", "device_datelist",
    "device_datelist_int", "duplicate_keys", "edge_property_max", "edge_ratio_report",
    "edges_from_rows", "event_range", "explode_map", "history_ratio", "host_month_as_of",
    "host_month_step", "host_visitor_bitmaps_as_of", "host_visitor_bitmaps_of_day", "host_visitors_as_of",
    "host_visitors_of_day", "match_view", "match_view_hot", "merge_visitor_bitmaps", "minutes_from_text", "month_array_step",
    "month_arrays_as_of", "month_visitor_counts", "month_visitors", "scd2_backfill", "scd2_increment", "snapshot_multi_as_of",
    "top_by_avg", "top_by_count", "top_by_distinct", "top_for_label", "top_k",
    "unnest_history", "unpack_month_arrays", "upsert", "variant_properties", "vertex_counts", "vertices_dedup",
    "vertices_from_agg", "vertices_from_rows", "whole_history", "write_upsert",
]
