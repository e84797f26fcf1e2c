"""Scans and writers."""

from trendspark.sources.readers import (day_globs, normalise_posts, partition_date_filter,
                                        read_dimension, read_fact_day, read_fact_range,
                                        read_items, read_metrics, read_posts)
from trendspark.sources.sinks import (land_daily, land_hourly, write_dimension, write_fact,
                                      write_partitioned)

__all__ = ["day_globs", "normalise_posts", "partition_date_filter", "read_dimension",
           "read_fact_day", "read_fact_range", "read_items", "read_metrics", "read_posts",
           "land_daily", "land_hourly", "write_dimension", "write_fact", "write_partitioned"]
