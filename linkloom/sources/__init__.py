"""Sources and sinks. Thin: operators never read or write files themselves."""

from linkloom.sources.json_files import (
    authority_dump_entries,
    harvest_metadata_entries,
    read_authority_dump,
    read_harvest_metadata,
    read_source_list,
    with_times,
)
from linkloom.sources.link_dumps import read_lines, source_file
from linkloom.sources.listing import STATE, STATE_IN_FOLDERS, changed_files, list_files, literal_path
from linkloom.sources.staging import (
    BROADCAST_BYTES,
    broadcast_if_small,
    split_rejects,
    stage,
    staged_bytes,
    staging_area,
    staging_dir,
)
from linkloom.sources.tables import (
    latest_stored_run,
    read_latest_run,
    read_tables,
    samples_path,
    write_records,
    write_report,
    write_samples,
    write_slice_samples,
    write_slices,
    write_table,
)

__all__ = [
    "BROADCAST_BYTES",
    "STATE",
    "STATE_IN_FOLDERS",
    "authority_dump_entries",
    "broadcast_if_small",
    "changed_files",
    "harvest_metadata_entries",
    "latest_stored_run",
    "list_files",
    "literal_path",
    "read_authority_dump",
    "read_harvest_metadata",
    "read_latest_run",
    "read_lines",
    "read_source_list",
    "read_tables",
    "samples_path",
    "source_file",
    "split_rejects",
    "stage",
    "staged_bytes",
    "staging_area",
    "staging_dir",
    "with_times",
    "write_records",
    "write_report",
    "write_samples",
    "write_slice_samples",
    "write_slices",
    "write_table",
]
