"""Writers."""

from tierline.sinks.writers import audit_row, evolve_append, save_mode, write_csv, write_table

__all__ = ["audit_row", "evolve_append", "save_mode", "write_csv", "write_table"]
