"""Readers and incremental loading (``tierline.sources.incremental``)."""

from tierline.sources.incremental import (high_watermark, new_rows, slice_window, table_counts,
                                          watermark_frame)
from tierline.sources.readers import read_landing, read_options, read_source, read_table

__all__ = ["high_watermark", "new_rows", "slice_window", "table_counts", "watermark_frame",
           "read_landing", "read_options", "read_source", "read_table"]
