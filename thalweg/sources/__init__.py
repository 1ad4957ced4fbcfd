from thalweg.sources.eventstore import create_event_view, read_events, stored_events_with, write_events
from thalweg.sources.readers import (
    read_observations,
    read_species,
    read_stream_xref,
    read_streams,
    read_waterbodies,
    read_waterbody_dictionary,
    read_waterbody_xref,
)
from thalweg.sources.writers import (
    PublishConflict,
    check_lengths,
    export_events,
    export_observations,
    read_published,
    write_duplicates,
    write_observations,
)

__all__ = [
    "PublishConflict",
    "check_lengths",
    "create_event_view",
    "export_events",
    "export_observations",
    "read_events",
    "read_observations",
    "read_published",
    "read_species",
    "read_stream_xref",
    "read_streams",
    "read_waterbodies",
    "read_waterbody_dictionary",
    "read_waterbody_xref",
    "stored_events_with",
    "write_duplicates",
    "write_events",
    "write_observations",
]
