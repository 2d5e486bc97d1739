"""What the matcher needs before a run: the names to match and the ISNI holders."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame

from authorlink.operators.delta import delta_work, feed_credits
from authorlink.operators.matching import isni_match_input_full, isni_match_input_incremental, match_input_names
from authorlink.plans.full_refresh import unseen_credits
from authorlink.sources.tables import Inputs
from authorlink.sources.workspace import Workspace


class MatcherInput(NamedTuple):
    names: DataFrame
    holders: DataFrame
    work: DataFrame
    """The work set, which the run after the matcher can start from."""


def prepare_matching(inputs: Inputs, workspace: Workspace, incremental: bool) -> MatcherInput:
    """Tables for the matcher; its output is not needed yet.

    Placeholder names are not worth matching, and the incremental run leaves them out.
    """
    if incremental:
        work = delta_work(feed_credits(inputs.trade_contributors), inputs.matched_author_isbn13)
        holders = isni_match_input_incremental(inputs.isni_authors)
    else:
        work = unseen_credits(inputs)
        holders = isni_match_input_full(inputs.isni_authors)
    work = workspace.stage(work, "work")
    return MatcherInput(match_input_names(work, skip_placeholders=incremental), holders, work)
