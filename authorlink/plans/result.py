"""What a run returns."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame


class Result(NamedTuple):
    """The next version of the master, and the staged rows that were merged into it.

    ``master`` is not yet written; write it to a new place while the workspace
    of the run exists.
    """

    master: DataFrame
    stage: DataFrame
