"""Physical-layout helpers: joins with a small side, bucketing, layout reports, footers, versioned tables."""

from tessera.plans.footers import column_report, parquet_footers, skipped
from tessera.plans.joins import broadcast_if_small, enrich, measured_bytes
from tessera.plans.layout import (bucket_count, bucket_id, file_histogram, file_stats, layout_report,
                                  rows_per_file, write_bucketed, write_partitioned)

__all__ = ["broadcast_if_small", "bucket_count", "bucket_id", "column_report", "enrich", "file_histogram", "file_stats",
           "layout_report", "measured_bytes", "parquet_footers", "rows_per_file", "skipped", "write_bucketed",
           "write_partitioned"]
