"""Identity resolution for book contributors, as Spark DataFrame jobs."""

from authorlink.options import Options
from authorlink.plans.bootstrap import run_bootstrap
from authorlink.plans.full_refresh import run_full_refresh
from authorlink.plans.incremental import run_incremental
from authorlink.plans.prepare import prepare_matching
from authorlink.sources.store import MasterStore
from authorlink.sources.tables import Inputs
from authorlink.sources.workspace import Workspace

__all__ = [
    "Inputs",
    "MasterStore",
    "Options",
    "Workspace",
    "prepare_matching",
    "run_bootstrap",
    "run_full_refresh",
    "run_incremental",
]
