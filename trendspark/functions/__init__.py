"""Scalar functions: native Spark expressions only."""

from trendspark.functions.text import (alternate_keyword, blank_to_null, channel_name,
                                       drop_fields, final_text, json_field,
                                       simple_text, to_json_row, token_end_mask,
                                       token_start_mask, unify_keyword)
from trendspark.functions.timeutil import (calendar, date_from_parts, date_parts,
                                           epoch_to_date, epoch_to_text, format_date,
                                           hour_floor, hour_grid, in_interval, iso_weekday,
                                           past_hour_interval, path_parts, text_to_date,
                                           ts_to_epoch)

__all__ = [
    "alternate_keyword", "blank_to_null", "channel_name", "drop_fields", "final_text",
    "json_field", "simple_text", "to_json_row", "token_end_mask",
    "token_start_mask", "unify_keyword",
    "calendar", "date_from_parts", "date_parts", "epoch_to_date", "epoch_to_text",
    "format_date", "hour_floor", "hour_grid", "in_interval", "iso_weekday",
    "past_hour_interval", "path_parts", "text_to_date", "ts_to_epoch",
]
