"""Small tables and comparisons for the tests."""

from __future__ import annotations

from collections import Counter

from authorlink import schemas as S
from authorlink.sources.tables import Inputs


def table(spark, layout, *rows, **constants):
    """Rows as dicts, absent columns NULL; ``layout`` is a schema or a DDL string."""
    if isinstance(layout, str):
        layout = spark.createDataFrame([], layout).schema
    full = [{**{f.name: None for f in layout}, **constants, **row} for row in rows]
    return spark.createDataFrame([tuple(r[f.name] for f in layout) for r in full], layout)


def bag(df, *columns):
    return Counter(tuple(r) for r in df.select(*(columns or sorted(df.columns))).collect())


def credit(cid, isbn, role, order, first, last):
    return {
        "trade_db_contributor_id": cid,
        "isbn13": isbn,
        "contributor_role": role,
        "contributor_order": order,
        "contributor_first_name": first,
        "contributor_last_name": last,
    }


def master_row(isbn, author_id, cid, role="A", order=1, isni=None, name=None, source=None, hash_=None, canonical=None):
    return {
        "isbn13": isbn,
        "indigo_author_id": author_id,
        "trade_db_contributor_id": cid,
        "trade_db_contributor_role": role,
        "trade_db_contributor_order": order,
        "matched_isni": isni,
        "normailized_author_name": canonical if canonical is not None else name,
        "trade_db_author_name": name,
        "id_source": source,
        "dmc_sync_hash_id": hash_,
        "dmc_synced": True,
        "transformation_id": 42,
    }


def inputs(spark, feed=(), master=(), authors=(), isbns=(), engine=()):
    return Inputs(
        trade_contributors=table(spark, S.FEED, *feed),
        matched_author_isbn13=table(spark, S.MASTER, *master),
        isni_authors=table(spark, S.ISNI_AUTHORS, *authors),
        isni_isbns=table(spark, S.ISNI_ISBNS, *isbns),
        engine_output=table(spark, S.ENGINE_OUTPUT, *engine),
    )
