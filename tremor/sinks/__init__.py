"""Writing landing documents, silver files, tables and text, and the journal of loads."""

from tremor.sinks.files import (
    write_landing,
    write_pairs_text,
    write_rejects,
    write_silver,
    write_tagged_pairs,
)
from tremor.sinks.journal import ConcurrentLoadError, Journal, Record, zones
from tremor.sinks.scratch import (
    exists,
    move_folder,
    move_folders,
    noted,
    remove,
    remove_others,
    scratch,
    scratch_path,
    settled,
    shared_folder,
    stored,
)
from tremor.sinks.tables import drop_partition, write_table

__all__ = [
    "ConcurrentLoadError",
    "Journal",
    "Record",
    "drop_partition",
    "exists",
    "move_folder",
    "move_folders",
    "noted",
    "remove",
    "remove_others",
    "scratch",
    "scratch_path",
    "settled",
    "shared_folder",
    "stored",
    "write_landing",
    "write_pairs_text",
    "write_rejects",
    "write_silver",
    "write_table",
    "write_tagged_pairs",
    "zones",
]
