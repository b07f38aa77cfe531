from tallyspan.sources.sinks import run_folder, shared_folder, write_shared, write_table
from tallyspan.sources.tables import SCHEMAS, read_table, stream_files, stream_table

__all__ = ["SCHEMAS", "read_table", "run_folder", "shared_folder", "stream_files",
           "stream_table",            "write_shared", "write_table"]
