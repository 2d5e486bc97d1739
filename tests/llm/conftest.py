from __future__ import annotations

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

DOCUMENTS = pa.schema(
    [("doc_id", pa.int64()), ("text", pa.string()), ("lang", pa.string()), ("source", pa.string()), ("n_chars", pa.int64())]
)
#: Names that operators use for columns of their own.
CLASHING = ("size", "target", "row", "fp", "bucket", "pii", "bytes", "start", "length", "gram", "score", "copies", "place", "guest", "source_size", "_id", "_row", "_n", "_copy", "_place", "key", "root")


@pytest.fixture()
def folder(tmp_path):
    """Writes documents ``(doc_id, text[, lang[, source]])`` as the table ``documents`` of a folder."""

    def write(rows, extra=False):
        full = [(*row, *([None] * (4 - len(row)))) for row in rows]
        columns = [list(c) for c in zip(*full)] or [[], [], [], []]
        columns.append([None if t is None else len(t) for t in columns[1]])
        table = pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, DOCUMENTS)], schema=DOCUMENTS)
        if extra:
            for name in CLASHING:
                table = table.append_column(name, pa.array(["x"] * len(full), pa.string()))
        pq.write_table(table, tmp_path / "documents.parquet")
        return str(tmp_path)

    return write


def rows_of(df):
    return [tuple(r) for r in df.collect()]
