from vitrina.sinks.writers import export_csv, overwrite, overwrite_jdbc, reread_csv

__all__ = ["export_csv", "overwrite", "overwrite_jdbc", "reread_csv"]
