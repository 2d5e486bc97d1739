"""The runs, one operator at a time.

The plans fuse operators where that moves less data. Here each operator is
applied as it is defined, so that its own result can be looked at and compared,
and the fused plans can be tested against the plain ones.

Credits and master are dealt to buckets once, of what they have in common in every join with
each other, and all steps leave their rows there. What is looked up for authors, contributors and names is written first: of
a table Catalyst knows the size, and moves no credits to meet a small one.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame

from authorlink import schemas as S
from authorlink.operators import canonical, delta, ids, load, matching
from authorlink.operators.keys import residual_after
from authorlink.options import Options
from authorlink.sources.buckets import buckets_of
from authorlink.sources.tables import Inputs, conform
from authorlink.sources.workspace import Workspace


class _Steps:
    """Buckets one to four; ``work`` and ``_pairs`` differ between the runs."""

    _key: list[str]
    _sources: tuple[str, ...]
    _dealt_by: list[str]
    _incremental: bool

    def __init__(self, inputs: Inputs, workspace: Workspace, options: Options = Options()):
        self.inputs = inputs
        self._workspace = workspace
        self._options = options

    def _residual(self, rows: DataFrame, bucket: DataFrame) -> DataFrame:
        linked = bucket.filter("ref_to IS NOT NULL")
        return residual_after(rows, linked, self._key, self._options.null_safe_keys, split=False, hashed=True)

    @cached_property
    def _buckets(self) -> int:
        raise NotImplementedError

    def _kept(self, rows: DataFrame, name: str) -> DataFrame:
        """Credits as a table in the buckets of the run."""
        return self._workspace.stage_dealt(rows, name, self._dealt_by, self._buckets)

    def _kept_master(self, rows: DataFrame, name: str) -> DataFrame:
        """The same in the words of the master."""
        return self._workspace.stage_dealt(rows, name, [S.CREDIT_TO_MASTER.get(c, c) for c in self._dealt_by], self._buckets)

    @cached_property
    def master(self) -> DataFrame:
        return self.inputs.matched_author_isbn13

    @cached_property
    def work(self) -> DataFrame:
        raise NotImplementedError

    @cached_property
    def names(self) -> DataFrame:
        return matching.match_input_names(self.work, skip_placeholders=self._incremental)

    @cached_property
    def unique(self) -> DataFrame:
        return matching.unique_matches(self.inputs.engine_output)

    @cached_property
    def ambiguous(self) -> DataFrame:
        return matching.ambiguous_matches(self.inputs.engine_output)

    @cached_property
    def by_name(self) -> DataFrame:
        return self._kept(matching.bucket_isni(self.work, self.unique), "by_name")

    @cached_property
    def residual_1(self) -> DataFrame:
        return self._kept(self._residual(self.work, self.by_name), "residual_1")

    @cached_property
    def full_names(self) -> DataFrame:
        return matching.isni_full_names(self.inputs.isni_authors)

    @cached_property
    def book_authors(self) -> DataFrame:
        return matching.isni_book_authors(self.inputs.isni_isbns, self.full_names)

    @cached_property
    def status(self) -> DataFrame:
        books = self.book_authors
        if self._dealt_by == S.BOOK:
            books = books.repartition(self._buckets, *S.BOOK)  # to the credits, not they to it
        return matching.match_status(self.residual_1, books, self.ambiguous, self._incremental)

    @cached_property
    def prefilled(self) -> DataFrame:
        return matching.bucket_prefilled(self.status)

    @cached_property
    def prefilled_single(self) -> DataFrame:
        return self._kept(matching.single_candidates(self.prefilled), "prefilled_single")

    @cached_property
    def residual_2(self) -> DataFrame:
        return self._kept(self._residual(self.residual_1, self.prefilled_single), "residual_2")

    @cached_property
    def combined_1(self) -> DataFrame:
        return self._kept(matching.combine_isni(self.by_name, self.prefilled_single), "combined_1")

    @cached_property
    def master_for_pairs(self) -> DataFrame:
        return self.master

    @cached_property
    def pairs(self) -> DataFrame:
        return matching.known_isni_pairs(
            self.combined_1, self.master_for_pairs, self._sources, only_new=self._incremental
        )

    @cached_property
    def unique_isni(self) -> DataFrame:
        return self._workspace.stage(matching.unique_isni_per_contributor(self.pairs), "unique_isni")

    @cached_property
    def by_contributor(self) -> DataFrame:
        found = matching.bucket_tradedb_isni(self.residual_2, self.unique_isni)
        return self._kept(found, "by_contributor")

    @cached_property
    def residual_3(self) -> DataFrame:
        return self._residual(self.residual_2, self.by_contributor)

    @cached_property
    def combined_2(self) -> DataFrame:
        return matching.combine_linked(self.combined_1, self.by_contributor)

    @cached_property
    def fallback(self) -> DataFrame:
        return matching.bucket_tradedb(self.residual_3)

    @cached_property
    def combined_3(self) -> DataFrame:
        return self._kept(matching.combine_linked(self.combined_2, self.fallback), "combined_3")


class IncrementalSteps(_Steps):
    """The operators of ``run_incremental``."""

    _key = S.CREDIT
    _dealt_by = S.SLOT
    _sources = (S.BY_NAME, S.BY_NAME_AND_ISBN, S.BY_CONTRIBUTOR)
    _incremental = True

    @cached_property
    def master(self) -> DataFrame:
        return self._workspace.in_buckets(
            self.inputs.matched_author_isbn13, "master", S.MASTER_SLOT, self.inputs.trade_contributors.count()
        )

    @cached_property
    def _buckets(self) -> int:
        return buckets_of(self.master, S.MASTER_SLOT)

    @cached_property
    def classified(self) -> DataFrame:
        return delta.delta_classify(delta.feed_credits(self.inputs.trade_contributors), self.master)

    @cached_property
    def work(self) -> DataFrame:
        return self._kept(delta.delta_filter(self.classified), "work")

    @cached_property
    def collapsed(self) -> DataFrame:
        """What the run starts with, in place of the last two."""
        return delta.delta_work(delta.feed_credits(self.inputs.trade_contributors), self.master)

    @cached_property
    def master_1(self) -> DataFrame:
        return load.apply_changed(self.master, self.combined_1)

    @cached_property
    def master_for_pairs(self) -> DataFrame:
        return self.master_1

    @cached_property
    def master_2(self) -> DataFrame:
        return self._kept_master(load.apply_changed(self.master_1, self.combined_3), "master_2")

    @cached_property
    def authors(self) -> DataFrame:
        return self._workspace.stage(ids.known_authors(self.master_2), "authors")

    @cached_property
    def master_3(self) -> DataFrame:
        return self._kept_master(ids.backfill_master_ids(self.master_2, self.authors), "master_3")

    @cached_property
    def _known_ids(self) -> DataFrame:
        return self._workspace.stage(ids.lowest_ids(self.master_3), "known_ids")

    @cached_property
    def fresh(self) -> DataFrame:
        return load.stage_rows_new(self.combined_3)

    @cached_property
    def fresh_known(self) -> DataFrame:
        return ids.backfill_ids(self.fresh, self.master_3, self._known_ids)

    @cached_property
    def combined(self) -> DataFrame:
        return load.combine_master_and_new(self.master_3, self.fresh_known)

    @cached_property
    def combined_known(self) -> DataFrame:
        return ids.backfill_ids(self.combined, self.master_3, self._known_ids)

    @cached_property
    def allocated(self) -> DataFrame:
        rows = self._kept(self.combined_known, "combined")
        return ids.allocate_ids(
            rows, self.master_3, self._workspace, "indigo_contr_id", self._options.id_floor
        )

    @cached_property
    def without_placeholders(self) -> DataFrame:
        return self._kept(canonical.null_placeholder_names(self.allocated), "identified")

    @cached_property
    def named(self) -> DataFrame:
        rows = self.without_placeholders
        names = self._workspace.stage(canonical.canonical_names(rows, "indigo_contr_id", "author_nm"), "names")
        return canonical.add_canonical_name(rows, names, "indigo_contr_id", "indigo_contr_nm")

    @cached_property
    def stage(self) -> DataFrame:
        rows = load.stage_resolved(self.named, self._options, self._buckets)
        return self._kept_master(rows, "stage")

    @cached_property
    def old_hashes(self) -> DataFrame:
        return load.snapshot_hashes(self.master_3)

    @cached_property
    def merged(self) -> DataFrame:
        return conform(load.merge_upsert(self.master_3, self.stage, self._options), S.MASTER)

    @cached_property
    def marked(self) -> DataFrame:
        return load.mark_new_hashes(self.stage, self.master_3, self._workspace)

    @cached_property
    def flagged(self) -> DataFrame:
        return conform(load.merge_upsert(self.master_3, self.marked, self._options, "_unseen"), S.MASTER)


class FullRefreshSteps(_Steps):
    """The operators of ``run_full_refresh``."""

    _key = matching.BOOK_AND_NAME
    _dealt_by = S.BOOK
    _sources = (S.BY_NAME, S.BY_NAME_AND_ISBN)
    _incremental = False

    @cached_property
    def master(self) -> DataFrame:
        feed = self.inputs.trade_contributors
        return self._workspace.in_buckets(self.inputs.matched_author_isbn13, "master", S.BOOK, feed.count())

    @cached_property
    def _buckets(self) -> int:
        return buckets_of(self.master, S.BOOK)

    @cached_property
    def cleansed(self) -> DataFrame:
        return delta.cleanse_name_parts(self.inputs.trade_contributors)

    @cached_property
    def credits(self) -> DataFrame:
        return delta.guarded_credits(self.cleansed)

    @cached_property
    def work(self) -> DataFrame:
        # Dealt before they are made distinct, which then moves nothing.
        feed = self.inputs.trade_contributors.repartition(self._buckets, *S.BOOK)
        credits = delta.guarded_credits(delta.cleanse_name_parts(feed))
        return self._kept(delta.new_by_existence(credits, self.master), "work")

    @cached_property
    def staged(self) -> DataFrame:
        return load.stage_rows_full(self.combined_3, self._options)

    @cached_property
    def known(self) -> DataFrame:
        lowest = self._workspace.stage(ids.lowest_stage_ids_full(self.master), "known_ids")
        return self._kept(ids.backfill_stage_ids_full(self.staged, self.master, lowest), "known")

    @cached_property
    def allocated(self) -> DataFrame:
        rows = ids.allocate_ids(
            self.known, self.master, self._workspace, "indigo_author_id", self._options.id_floor
        )
        return self._kept(rows, "allocated")

    @cached_property
    def named(self) -> DataFrame:
        names = canonical.canonical_names(self.allocated, "indigo_author_id", "trade_db_author_name")
        names = self._workspace.stage(names, "names")
        return canonical.add_canonical_name(
            self.allocated, names, "indigo_author_id", "normailized_author_name"
        )

    @cached_property
    def hashed(self) -> DataFrame:
        return load.add_change_hash(self.named)

    @cached_property
    def cleared(self) -> DataFrame:
        return load.clear_isni_placeholders(self.hashed)

    @cached_property
    def resolved(self) -> DataFrame:
        return load.drop_unresolved(self.cleared)

    @cached_property
    def old_hashes(self) -> DataFrame:
        return load.snapshot_hashes(self.master)

    @cached_property
    def merged(self) -> DataFrame:
        return conform(load.merge_upsert(self.master, self.resolved, self._options), S.MASTER)

    @cached_property
    def flagged(self) -> DataFrame:
        stage = self._kept(self.resolved, "resolved")
        marked = load.mark_new_hashes(stage, self.master, self._workspace)
        return conform(load.merge_upsert(self.master, marked, self._options, "_unseen"), S.MASTER)
