"""Multi-step jobs: frames and incremental frames."""

from .frame import frame_documents
from .incremental import PendingRound, begin_increment, committed_versions, compute_frames_increment, increment_plan, read_state

__all__ = [
    "PendingRound", "begin_increment", "committed_versions", "compute_frames_increment", "frame_documents", "increment_plan", "read_state",
]
