"""Writers: appends, reject logs, CSV reports, versioned layers, merges into stored parts, key registries, databases."""

from .append import append, append_rejects, read_rejects, write_partitioned
from .databases import save_database
from .parts import merge_parts, touched_rows, write_parts
from .report import write_csv_report
from .surrogates import stable_keys
from .versions import Load, VersionedLayer

__all__ = ["Load", "VersionedLayer", "append", "append_rejects", "merge_parts", "read_rejects", "save_database", "stable_keys",
           "touched_rows", "write_csv_report", "write_partitioned", "write_parts"]
