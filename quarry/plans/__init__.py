"""Plan-level building blocks and composite jobs."""

from quarry.plans.joins import (
    DEFAULT_BROADCAST_BYTES,
    DEFAULT_BROADCAST_ROWS,
    bounded_sides,
    has_at_most,
    join_bounded,
    row_bytes,
)
from quarry.plans.ranking import DEFAULT_GROUP_ROWS, exact_median, global_row_number, groups_at_most, range_checkpoint
from quarry.plans.storage import ensure_checkpoint_dir, scratch_path, shared_dir

__all__ = [
    "DEFAULT_BROADCAST_BYTES",
    "DEFAULT_BROADCAST_ROWS",
    "DEFAULT_GROUP_ROWS",
    "bounded_sides",
    "ensure_checkpoint_dir",
    "exact_median",
    "global_row_number",
    "groups_at_most",
    "has_at_most",
    "join_bounded",
    "range_checkpoint",
    "row_bytes",
    "scratch_path",
    "shared_dir",
]
