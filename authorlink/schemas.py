"""Table layouts and the fixed vocabulary of the data."""

from __future__ import annotations

from pyspark.sql import types as T

_LONG, _STR, _BOOL, _TS = T.LongType(), T.StringType(), T.BooleanType(), T.TimestampNTZType()


def _layout(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns.items()])


# Table columns, as exchanged with the systems on either side.
FEED = _layout(
    trade_db_contributor_id=_LONG,
    isbn13=_STR,
    contributor_role=_STR,
    contributor_order=_LONG,
    contributor_first_name=_STR,
    contributor_last_name=_STR,
)
ISNI_AUTHORS = _layout(isni=_STR, first_name=_STR, last_name=_STR)
ISNI_ISBNS = _layout(isbn13=_STR, isni=_STR)
ENGINE_OUTPUT = _layout(author_nm=_STR, matched_isni=_STR, dup_name_flag=_STR)
MASTER = _layout(
    isbn13=_STR,
    indigo_author_id=_LONG,
    trade_db_contributor_id=_LONG,
    trade_db_contributor_role=_STR,
    trade_db_contributor_order=_LONG,
    matched_isni=_STR,
    normailized_author_name=_STR,
    trade_db_author_name=_STR,
    id_source=_STR,
    dmc_sync_hash_id=_STR,
    dmc_synced=_BOOL,
    transformation_id=_LONG,
    etl_updated_date=_TS,
)
PRIOR_DELIVERY = _layout(
    isbn13=_STR,
    indigo_contr_id=_LONG,
    trade_db_contributor_id=_LONG,
    contributor_role=_STR,
    contributor_order=_LONG,
    matched_isni=_STR,
    indigo_contr_nm=_STR,
    author_nm=_STR,
    ref_to=_STR,
)

# Delta flags, evidence labels (strongest first) and match statuses.
NEW, CHANGED, SAME = "NEW", "CHANGED", "SAME"
BY_NAME, BY_NAME_AND_ISBN, BY_CONTRIBUTOR, FALLBACK = (
    "ISNI",
    "ISNI&PREFILLISNI",
    "TRADEDBID&ISNI",
    "TRADEDBID",
)
UNIQUE_MATCH, CONFLICT, NO_MATCH, UNDETERMINED = (
    "Unique Match",
    "Conflict",
    "No Match Found",
    "Undetermined",
)
# Placeholders for a missing ISNI and for missing names.
ISNI_PLACEHOLDER_PREFIX = "trdb"
UNIDENTIFIED = "UNIDENTIFIED"
NAME_PARTS_BLANKED = ("%(not %)%", "unknown", "author")
NAMES_NOT_MATCHED = ("UNIDENTIFIED", "UNKNOWN")
NAMES_WITHOUT_IDENTITY = ("UNIDENTIFIED", "UNKNOWN", "ANONYMOUS")
AMBIGUOUS_FLAG = "Y"
TRANSFORMATION_ID = 42

# A credit is one contributor named in one slot of one book.
SLOT = ["isbn13", "contributor_role", "contributor_order"]
BOOK = ["isbn13"]
CREDIT = ["trade_db_contributor_id", *SLOT, "author_nm"]
LINK = [*CREDIT, "matched_isni", "ref_to"]
# The key on which a staged row meets a master row.
MERGE_KEY = [
    "isbn13",
    "indigo_author_id",
    "trade_db_contributor_id",
    "trade_db_contributor_order",
    "trade_db_contributor_role",
]
# What the same fact is called in a credit, and in the master.
CREDIT_TO_MASTER = {
    "contributor_role": "trade_db_contributor_role",
    "contributor_order": "trade_db_contributor_order",
    "author_nm": "trade_db_author_name",
    "ref_to": "id_source",
}
MASTER_TO_CREDIT = {master: credit for credit, master in CREDIT_TO_MASTER.items()}
MASTER_SLOT = [CREDIT_TO_MASTER.get(c, c) for c in SLOT]
