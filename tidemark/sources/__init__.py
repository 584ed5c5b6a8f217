from tidemark.sources.commits import CommitConflict, CommitLog
from tidemark.sources.current import CurrentState
from tidemark.sources.keyed import KeyedSnapshots
from tidemark.sources.sinks import (
    clustered,
    with_partition_columns,
    write_clustered,
    write_overwrite,
    write_partitioned,
    write_zordered,
    zordered,
)
from tidemark.sources.snapshots import Snapshots, upsert
from tidemark.sources.tables import (
    is_first_load,
    load_settings,
    project_output,
    read_if_there,
    read_merged,
    read_pair,
    read_tables,
)

__all__ = [
    "CommitConflict", "CommitLog", "CurrentState", "KeyedSnapshots", "Snapshots", "clustered", "is_first_load", "load_settings", "project_output",
    "read_if_there", "read_merged", "read_pair", "read_tables", "upsert",
    "with_partition_columns", "write_clustered", "write_overwrite", "write_partitioned", "write_zordered", "zordered",
]
