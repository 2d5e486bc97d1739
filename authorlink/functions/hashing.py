"""The change hash of a master row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SEPARATOR, _NULL_MARK = "\x1f", "\\N"


def change_hash(contributor_id: Column, author_id: Column, name: Column, isni: Column) -> Column:
    """Hash over the values a consumer synchronises; NULL differs from any text."""
    parts = [
        F.coalesce(c.cast("string"), F.lit(_NULL_MARK))
        for c in (contributor_id, author_id, name, isni)
    ]
    return F.md5(F.concat_ws(_SEPARATOR, *parts))
