"""The common middle of both runs: every credit of the work set gets its link."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame

from authorlink.operators.delta import COPIES
from authorlink.operators.keys import mark_taken, residual_marked, stacked
from authorlink.operators.matching import (
    BOOK_AND_NAME,
    ambiguous_matches,
    bucket_isni,
    bucket_tradedb,
    bucket_tradedb_isni,
    confirmed_names,
    mark_prefilled,
    unique_isni_per_contributor,
    unique_matches,
)
from authorlink.options import Options
from authorlink.sources.tables import Inputs
from authorlink.sources.workspace import Workspace

_LINKED, _TAKEN = "ref_to IS NOT NULL", "_taken"


def link_credits(
    work: DataFrame,
    inputs: Inputs,
    pairs_known: Callable[[DataFrame], DataFrame],
    key: Sequence[str],
    key_has_contributor: bool,
    options: Options,
    workspace: Workspace,
    dealt: tuple[Sequence[str], int] | None = None,
) -> DataFrame:
    """Buckets by name, by name and book, by contributor, and the rest.

    ``work`` has distinct credits and how many copies each stands for. ``key``
    tells which credits a link takes out of the later buckets; every bucket marks them as it
    is filled, so that no bucket is joined with another. ``pairs_known``
    gets the links of the first two buckets and returns all known pairs of
    contributor and ISNI. The rows returned are distinct. Work that is ``dealt`` into so
    many buckets of a part of the key stays there.
    """

    def kept(rows: DataFrame, name: str) -> DataFrame:
        return workspace.stage_dealt(rows, name, *dealt) if dealt else workspace.stage(rows, name)

    engine, safe, evidence = inputs.engine_output, options.null_safe_keys, ["matched_isni", "ref_to"]
    # The matcher returns few equal rows; one shuffle makes them distinct and joins them.
    unique = unique_matches(engine).filter("matched_isni IS NOT NULL").repartition("author_nm").distinct()
    named = kept(bucket_isni(work, unique), "named")

    # A name is linked or not as a whole, and it is part of every key.
    unnamed = residual_marked(named, key, safe).drop(*evidence)
    confirmed = confirmed_names(inputs.isni_isbns, inputs.isni_authors, ambiguous_matches(engine))
    if dealt and set(dealt[0]) <= set(BOOK_AND_NAME):
        confirmed = confirmed.repartition(dealt[1], *dealt[0])  # to the credits, not they to it
    prefilled = kept(mark_prefilled(unnamed, confirmed, key, COPIES, _TAKEN), "prefilled")

    linked = stacked(named.filter(_LINKED), prefilled.filter(_LINKED).drop(_TAKEN))
    rest = residual_marked(prefilled, key, safe, _TAKEN).drop(*evidence)
    known = unique_isni_per_contributor(pairs_known(linked))
    # Of a table Catalyst knows the size, and takes no row out of its bucket to meet a small one.
    found = bucket_tradedb_isni(rest, workspace.stage(known, "unique_isni") if dealt else known)
    # A contributor is linked or not as a whole, which decides only a key that the contributor is part of.
    found = found if key_has_contributor else mark_taken(found, key, _TAKEN)
    by_contributor = kept(found, "by_contributor")
    rest = residual_marked(by_contributor, key, safe, None if key_has_contributor else _TAKEN)
    rest = bucket_tradedb(rest.drop(*evidence, _TAKEN))
    linked = stacked(linked, by_contributor.filter(_LINKED).drop(_TAKEN))
    return stacked(linked, rest).drop(COPIES)
