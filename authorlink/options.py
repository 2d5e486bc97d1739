"""Parameters of a run. The defaults give the documented standard result."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from authorlink.schemas import TRANSFORMATION_ID


@dataclass(frozen=True)
class Options:
    """Run parameters.

    The first group labels the output, the second changes results on purpose
    (all off by default).
    """

    transformation_id: int = TRANSFORMATION_ID
    run_ts: datetime | None = None
    """Time stamped on updated rows; the time of the query when None."""
    audit: dict[str, str] | None = None
    """Extra constant columns for the staged table, such as a run id."""

    id_floor: int | None = None
    """Number ids from here when no id exists yet; without it a first run stages nothing."""
    null_safe_keys: bool = False
    """Treat NULL as an ordinary key value when already linked credits are left out."""
    keep_placeholder_rows: bool = False
    """Incremental run: load credits without an ISNI, with the placeholder cleared."""
    strict_merge: bool = False
    """Fail when two staged rows meet on one merge key; otherwise the lowest name wins."""
    null_safe_merge: bool = False
    """Let NULL equal NULL in the merge key, so such rows are not inserted again."""
