from tierstone.sources.arrivals import FileChanged, file_ledger, new_files, note_files
from tierstone.sources.files import (
    SchemaChanged,
    check_header,
    count_lines,
    header_names,
    infer_schema,
    landing_inventory,
    lock_schema,
    scan_csv,
    schema_by_header,
    with_ingest_audit,
)
from tierstone.sources.snapshots import (
    Commit,
    ConflictingVersions,
    VersionNotFound,
    all_commits,
    expire_snapshots,
    latest_commit,
    read_commit,
    read_commits,
    read_snapshot,
    read_source_lines,
    settle_conflicts,
    snapshot_history,
    write_snapshot,
)
from tierstone.sources.workspace import scratch_path, shuffles_removed, stage

__all__ = [
    "Commit",
    "ConflictingVersions",
    "FileChanged",
    "SchemaChanged",
    "VersionNotFound",
    "all_commits",
    "check_header",
    "count_lines",
    "expire_snapshots",
    "file_ledger",
    "header_names",
    "infer_schema",
    "landing_inventory",
    "latest_commit",
    "lock_schema",
    "new_files",
    "note_files",
    "read_commit",
    "read_commits",
    "read_snapshot",
    "read_source_lines",
    "scan_csv",
    "schema_by_header",
    "scratch_path",
    "settle_conflicts",
    "shuffles_removed",
    "snapshot_history",
    "stage",
    "with_ingest_audit",
    "write_snapshot",
]
