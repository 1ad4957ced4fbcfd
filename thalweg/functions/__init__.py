from thalweg.functions.codes import (
    is_descendant_or_self,
    joined_code,
    path_label_after,
    path_order,
    path_prefixes,
    strip_dashes,
    strip_leading_zeros,
)
from thalweg.functions.geometry import (
    edges_of,
    explode_edges,
    force_3d,
    measure_on_edge,
    positions_at_measure,
    squared_distance_to_edge,
)
from thalweg.functions.keys import KEY_COLUMNS, event_id, hashed_key
from thalweg.functions.measures import clamp_measure

__all__ = [
    "KEY_COLUMNS",
    "clamp_measure",
    "edges_of",
    "event_id",
    "explode_edges",
    "force_3d",
    "hashed_key",
    "is_descendant_or_self",
    "joined_code",
    "measure_on_edge",
    "path_label_after",
    "path_order",
    "path_prefixes",
    "positions_at_measure",
    "squared_distance_to_edge",
    "strip_dashes",
    "strip_leading_zeros",
]
