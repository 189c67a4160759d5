"""Readers, writers and code lists."""

from portolan.sources.codelists import (
    OTHER_STATE,
    STATE_CODES,
    TRAVEL_MODES,
    VISA_PURPOSES,
    code_list,
    read_code_list,
    read_format_statement,
)
from portolan.sources.fingerprints import fingerprint
from portolan.sources.readers import materialize_if_missing, read_delimited, read_parquet, refreshed_copy
from portolan.sources.scratch import ensure_checkpoint_dir, new_scratch_path, store
from portolan.sources.versions import CommitConflict, VersionedTable, read_table
from portolan.sources.writers import write_partitioned, write_table

__all__ = [
    "OTHER_STATE",
    "STATE_CODES",
    "CommitConflict",
    "TRAVEL_MODES",
    "VISA_PURPOSES",
    "VersionedTable",
    "code_list",
    "ensure_checkpoint_dir",
    "fingerprint",
    "materialize_if_missing",
    "new_scratch_path",
    "read_code_list",
    "read_delimited",
    "read_format_statement",
    "read_parquet",
    "read_table",
    "refreshed_copy",
    "store",
    "write_partitioned",
    "write_table",
]
