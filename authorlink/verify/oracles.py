"""Independent statements of each operator's result, in DuckDB's SQL.

They are worded for plainness, not for speed, and differ from the Spark jobs on
purpose: subqueries for joins, windows for aggregates, string keys for column
keys. Each query is put together from the named parts it needs.
"""

from __future__ import annotations

import re

_SEP = "chr(31)"


def _joined(first: str, last: str) -> str:
    return f"CASE WHEN {first} <> {last} THEN {first} || ' ' || {last} ELSE coalesce({first}, {last}, 'UNIDENTIFIED') END"


def _guarded(first: str, last: str) -> str:
    f, l = f"coalesce({first}, '')", f"coalesce({last}, '')"
    return f"CASE WHEN {f} = {l} THEN {first} ELSE trim({f} || ' ' || {l}) END"


def _norm(name: str) -> str:
    return rf"trim(regexp_replace(upper(regexp_replace({name}, '[\r\n\t]+', ' ', 'g')), ' +', ' ', 'g'))"


def _md5(*values: str) -> str:
    return f"md5(concat_ws({_SEP}, {', '.join(rf"coalesce(CAST({v} AS VARCHAR), '\N')" for v in values)}))"


def _key(*columns: str) -> str:
    return f" || {_SEP} || ".join(f"CAST({c} AS VARCHAR)" for c in columns)


def _isni(k: str) -> str:
    return f"'0000' || lpad(CAST({k} AS VARCHAR), 12, '0')"


_KEY_5 = _key("trade_db_contributor_id", "isbn13", "contributor_role", "contributor_order", "author_nm")
_KEY_2 = _key("isbn13", "author_nm")
_CREDIT = "trade_db_contributor_id, isbn13, contributor_role, contributor_order, author_nm"
_LINK = f"{_CREDIT}, matched_isni, ref_to"
_SLOT = "isbn13, contributor_role, contributor_order"
_MASTER = """isbn13, indigo_author_id, trade_db_contributor_id, trade_db_contributor_role,
  trade_db_contributor_order, matched_isni, normailized_author_name, trade_db_author_name, id_source,
  dmc_sync_hash_id, dmc_synced, transformation_id"""
_HASHED = ("trade_db_contributor_id", "indigo_author_id", "normailized_author_name", "matched_isni")

_NAME_PARTS = """
  CASE WHEN k % 17 = 0 THEN 'Unknown' WHEN k % 19 = 0 THEN '(Not Supplied)' WHEN k % 23 = 0 THEN NULL
       ELSE 'F' || (k % 2) END AS fn,
  CASE WHEN k % 17 = 0 THEN 'Author' WHEN k % 29 = 0 THEN NULL WHEN k % 7 = 0 THEN 'F' || (k % 2)
       ELSE 'L' || (k % (SELECT greatest(2, count(*) * 18 // 25) FROM supplier)) END AS ln"""


def _not_linked(rows: str, key: str, *buckets: str) -> str:
    conditions = [f"{key} NOT IN (SELECT {key} FROM {b} WHERE ref_to IS NOT NULL)" for b in buckets]
    return f"SELECT * FROM {rows} WHERE {' AND '.join(conditions)}"


def _by_name(work: str) -> str:
    return f"""SELECT w.*, e.matched_isni, CASE WHEN e.matched_isni IS NOT NULL THEN 'ISNI' END AS ref_to
      FROM {work} w LEFT JOIN engine e ON e.author_nm = w.author_nm AND e.dup_name_flag IS NULL"""


def _status(rest: str, extra: str) -> str:
    return f"""SELECT r.*, {extra} coalesce(s.isni, d.matched_isni) AS final_isni,
        CASE WHEN s.isni IS NULL THEN 'No Match Found' WHEN d.matched_isni IS NULL THEN 'Undetermined'
             WHEN s.isni = d.matched_isni THEN 'Unique Match' ELSE 'Conflict' END AS match_status
      FROM {rest} r
      LEFT JOIN shelf s ON s.full_name = r.author_nm AND s.isbn13 = r.isbn13
      LEFT JOIN (SELECT * FROM engine WHERE dup_name_flag = 'Y') d
        ON d.matched_isni = s.isni AND d.author_nm = r.author_nm"""


def _confirmed(status: str, flag: str) -> str:
    return f"""SELECT {_CREDIT}, {flag} final_isni, 'ISNI&PREFILLISNI' AS ref_to
      FROM {status} WHERE match_status = 'Unique Match'"""


def _single(candidates: str) -> str:
    return f"""SELECT * FROM {candidates}
      WHERE isbn13 IS NOT NULL AND contributor_role IS NOT NULL AND contributor_order IS NOT NULL
        AND author_nm IS NOT NULL
      QUALIFY count(*) OVER (PARTITION BY {_SLOT}, author_nm) = 1"""


def _union(first: str, second: str, flag: str, isni: str = "matched_isni") -> str:
    return f"""SELECT {_LINK} {flag} FROM {first} WHERE ref_to IS NOT NULL
      UNION SELECT {_CREDIT}, {isni}, ref_to {flag} FROM {second} WHERE ref_to IS NOT NULL"""


def _pairs(linked: str, master: str, sources: str) -> str:
    return f"""SELECT {_LINK} FROM {linked}
      UNION SELECT trade_db_contributor_id, isbn13, trade_db_contributor_role, trade_db_contributor_order,
        trade_db_author_name, matched_isni, id_source FROM {master} WHERE id_source IN ({sources})"""


def _sure(pairs: str) -> str:
    return f"""SELECT trade_db_contributor_id, min(matched_isni) AS matched_isni FROM {pairs}
      GROUP BY trade_db_contributor_id HAVING min(matched_isni) = max(matched_isni)"""


def _by_contributor(rest: str, sure: str) -> str:
    return f"""SELECT r.*, s.matched_isni,
        CASE WHEN s.matched_isni IS NOT NULL THEN 'TRADEDBID&ISNI' END AS ref_to
      FROM {rest} r LEFT JOIN {sure} s USING (trade_db_contributor_id)"""


def _fallback(rest: str) -> str:
    return f"SELECT *, 'trdb' || trade_db_contributor_id AS matched_isni, 'TRADEDBID' AS ref_to FROM {rest}"


def _overwritten(master: str, linked: str) -> str:
    return f"""SELECT m.* REPLACE (
        CASE WHEN c.ref_to IS NULL THEN m.trade_db_contributor_id ELSE c.trade_db_contributor_id END
          AS trade_db_contributor_id,
        coalesce(c.author_nm, m.trade_db_author_name) AS trade_db_author_name,
        coalesce(c.matched_isni, m.matched_isni) AS matched_isni,
        coalesce(c.ref_to, m.id_source) AS id_source,
        CASE WHEN c.ref_to IS NULL THEN m.indigo_author_id END AS indigo_author_id,
        CASE WHEN c.ref_to IS NULL THEN m.normailized_author_name END AS normailized_author_name)
      FROM {master} m LEFT JOIN (
        SELECT DISTINCT ON ({_SLOT}) * FROM {linked} WHERE delta_flag = 'CHANGED'
        ORDER BY trade_db_contributor_id, author_nm, matched_isni, ref_to) c
      ON c.isbn13 = m.isbn13 AND c.contributor_role = m.trade_db_contributor_role
        AND c.contributor_order = m.trade_db_contributor_order"""


def _numbered(rows: str, id_column: str, master: str) -> str:
    return f"""SELECT r.* REPLACE (coalesce(r.{id_column}, n.id) AS {id_column}) FROM {rows} r LEFT JOIN (
        SELECT DISTINCT matched_isni, dense_rank() OVER (ORDER BY matched_isni) + greatest(
          (SELECT max(indigo_author_id) FROM {master}), (SELECT max({id_column}) FROM {rows})) AS id
        FROM {rows} WHERE {id_column} IS NULL AND matched_isni IS NOT NULL) n
      ON n.matched_isni = r.matched_isni"""


def _canonical(rows: str, id_column: str, name: str) -> str:
    return f"""SELECT DISTINCT ON (id) id, name FROM (
        SELECT {id_column} AS id, {name} AS name, count(*) AS n FROM {rows}
        WHERE {id_column} IS NOT NULL AND {name} IS NOT NULL GROUP BY 1, 2)
      ORDER BY n DESC, length(name) DESC, name"""


def _merged(master: str, stage: str) -> str:
    key = [
        "isbn13",
        "indigo_author_id",
        "trade_db_contributor_id",
        "trade_db_contributor_order",
        "trade_db_contributor_role",
    ]
    same = " AND ".join(f"m.{c} = s.{c}" for c in key)
    taken = ("matched_isni", "normailized_author_name", "trade_db_author_name", "id_source", "dmc_sync_hash_id")
    replaced = ", ".join(f"CASE WHEN s.isbn13 IS NULL THEN m.{c} ELSE s.{c} END AS {c}" for c in taken)
    gap = " OR ".join(f"{c} IS NULL" for c in key)
    chosen = f"""SELECT * FROM {stage} QUALIFY {gap} OR row_number() OVER (
        PARTITION BY {', '.join(key)} ORDER BY trade_db_author_name, matched_isni, id_source) = 1"""
    inserted = _MASTER.replace("dmc_synced", "CAST(NULL AS BOOLEAN)").replace("transformation_id", "42")
    return f"""SELECT m.* REPLACE ({replaced}) FROM {master} m LEFT JOIN ({chosen}) s ON {same}
      UNION ALL SELECT {inserted} FROM ({chosen}) s WHERE NOT EXISTS (SELECT 1 FROM {master} m WHERE {same})"""


def _flagged(merged: str, old: str) -> str:
    return f"""SELECT * REPLACE (dmc_synced AND coalesce(dmc_sync_hash_id IN (SELECT h FROM {old}), false)
        AS dmc_synced) FROM {merged} WHERE dmc_synced IS NOT NULL
      UNION ALL SELECT * REPLACE (CASE WHEN dmc_sync_hash_id IN (SELECT h FROM {old}) THEN NULL ELSE false END
        AS dmc_synced) FROM {merged} WHERE dmc_synced IS NULL"""


_BLANK = "CASE WHEN regexp_matches(lower({0}), '.*[(]not .*[)].*|^unknown$|^author$', 's') THEN NULL ELSE {0} END"

_PARTS: dict[str, str] = {
    # --- derived input tables
    "line": f"""SELECT *, {_joined("fn", "ln")} AS nm FROM (
        SELECT l_suppkey AS k, l_orderkey AS o, l_partkey AS p, lpad(CAST(l_orderkey AS VARCHAR), 13, '0') AS isbn13,
          l_returnflag AS role, CAST(l_linenumber AS BIGINT) AS pos, {_NAME_PARTS}
        FROM (SELECT *, l_suppkey AS k FROM lineitem))""",
    "feed": """SELECT k AS trade_db_contributor_id, isbn13, role AS contributor_role, pos AS contributor_order,
        CASE WHEN p % 101 <> 0 THEN fn END AS contributor_first_name,
        CASE WHEN p % 101 <> 0 THEN ln END AS contributor_last_name FROM line""",
    "known": f"""SELECT o, isbn13, k, role, pos, nm,
        k + CASE WHEN k % 15 = 0 AND o % 7 = 3 THEN 5000 ELSE 1000 END AS id,
        CASE WHEN k % 3 <> 0 THEN NULL WHEN k % 12 = 0 AND o % 50 = 0 THEN {_isni("(k + 1)")} ELSE {_isni("k")} END AS isni,
        CASE o % 10 WHEN 1 THEN upper(nm) || ' ' WHEN 2 THEN nm || ' Jr' ELSE nm END AS variant,
        CASE WHEN k % 9 = 0 THEN 'TRADEDBID&ISNI' WHEN k % 3 = 0 THEN 'ISNI' ELSE 'TRADEDBID' END AS source
      FROM line""",
    "master": f"""SELECT DISTINCT isbn13, id AS indigo_author_id, k AS trade_db_contributor_id,
        role AS trade_db_contributor_role, pos AS trade_db_contributor_order, isni AS matched_isni,
        nm AS normailized_author_name, variant AS trade_db_author_name, source AS id_source,
        CASE WHEN o % 10 <> 5 THEN {_md5("k", "id", "nm", "isni")} END AS dmc_sync_hash_id,
        true AS dmc_synced, CAST(42 AS BIGINT) AS transformation_id FROM known WHERE o % 10 < 7 AND pos <= 5""",
    "prior": """SELECT isbn13, CASE WHEN o % 10 <> 6 THEN id END AS author_id, k, role, pos,
        coalesce(isni, 'trdb' || k) AS isni, nullif(nm, 'UNIDENTIFIED') AS canonical, variant, source FROM known""",
    "holder": f"""SELECT k, {_isni("k")} AS isni, fn, ln, {_joined("fn", "ln")} AS nm FROM (
        SELECT k, {_NAME_PARTS} FROM (SELECT s_suppkey AS k FROM supplier)) WHERE k % 2 = 0""",
    "books": f"SELECT DISTINCT isbn13, {_isni('k')} AS isni FROM line WHERE k % 2 = 0 AND o % 3 = 0",
    "engine": """SELECT author_nm, matched_isni, dup_name_flag FROM (
        SELECT k, nm AS author_nm, isni AS matched_isni,
          CASE WHEN count(*) OVER (PARTITION BY nm) > 1 THEN 'Y' END AS dup_name_flag
        FROM holder WHERE nm <> 'UNIDENTIFIED') WHERE dup_name_flag IS NULL OR k % 10 <> 4""",
    "shelf": f"""SELECT b.isbn13, b.isni, h.full_name FROM books b
      JOIN (SELECT DISTINCT isni, {_joined("fn", "ln")} AS full_name FROM holder) h ON h.isni = b.isni""",
    # --- incremental run
    "credit": f"""SELECT trade_db_contributor_id, isbn13, contributor_role, contributor_order,
        {_joined("contributor_first_name", "contributor_last_name")} AS author_nm FROM feed""",
    "delta": f"""SELECT *, CASE
          WHEN NOT EXISTS (SELECT 1 FROM master m WHERE m.isbn13 = c.isbn13
            AND m.trade_db_contributor_role = c.contributor_role
            AND m.trade_db_contributor_order = c.contributor_order) THEN 'NEW'
          WHEN NOT EXISTS (SELECT 1 FROM master m WHERE m.isbn13 = c.isbn13
            AND m.trade_db_contributor_role = c.contributor_role
            AND m.trade_db_contributor_order = c.contributor_order
            AND m.trade_db_contributor_id = c.trade_db_contributor_id
            AND {_norm("m.trade_db_author_name")} = {_norm("c.author_nm")}) THEN 'CHANGED'
          ELSE 'SAME' END AS delta_flag FROM credit c""",
    "work": "SELECT * FROM delta WHERE delta_flag <> 'SAME'",
    "by_name": _by_name("work"),
    "rest_1": _not_linked("work", _KEY_5, "by_name"),
    "status": _status("rest_1", "s.isni, d.matched_isni AS engine_matched_isni,"),
    "confirmed": _confirmed("status", "delta_flag,"),
    "single": _single("confirmed"),
    "rest_2": _not_linked("work", _KEY_5, "by_name", "single"),
    "linked_1": _union("by_name", "single", ", delta_flag", "final_isni"),
    "master_1": _overwritten("master", "linked_1"),
    "pairs": _pairs(
        "(SELECT * FROM linked_1 WHERE delta_flag = 'NEW')", "master_1", "'ISNI', 'ISNI&PREFILLISNI', 'TRADEDBID&ISNI'"
    ),
    "sure": _sure("pairs"),
    "by_contributor": _by_contributor("rest_2", "sure"),
    "rest_3": _not_linked("work", _KEY_5, "by_name", "single", "by_contributor"),
    "linked_2": _union("linked_1", "by_contributor", ", delta_flag"),
    "fallback": _fallback("rest_3"),
    "linked_3": _union("linked_2", "fallback", ", delta_flag"),
    "master_2": _overwritten("master_1", "linked_3"),
    "master_3": """SELECT m.* REPLACE (coalesce(m.indigo_author_id, b.id) AS indigo_author_id,
        CASE WHEN m.indigo_author_id IS NULL AND b.id IS NOT NULL THEN b.name ELSE m.normailized_author_name END
          AS normailized_author_name)
      FROM master_2 m LEFT JOIN (SELECT matched_isni, max(indigo_author_id) AS id, max(normailized_author_name) AS name
        FROM master_2 WHERE indigo_author_id IS NOT NULL GROUP BY matched_isni) b ON b.matched_isni = m.matched_isni""",
    "fresh": "SELECT *, CAST(NULL AS BIGINT) AS indigo_contr_id FROM linked_3 WHERE delta_flag = 'NEW'",
    "fresh_known": """SELECT f.* REPLACE ((SELECT min(indigo_author_id) FROM master_3 m
        WHERE m.matched_isni = f.matched_isni) AS indigo_contr_id) FROM fresh f""",
    "pool": f"""SELECT trade_db_contributor_id, isbn13, trade_db_contributor_role AS contributor_role,
        trade_db_contributor_order AS contributor_order, trade_db_author_name AS author_nm, matched_isni,
        id_source AS ref_to, indigo_author_id AS indigo_contr_id FROM master_3
      UNION ALL SELECT {_LINK}, indigo_contr_id FROM fresh_known""",
    "pool_known": """SELECT p.* REPLACE (coalesce(p.indigo_contr_id, (SELECT min(indigo_author_id) FROM master_3 m
        WHERE m.matched_isni = p.matched_isni)) AS indigo_contr_id) FROM pool p""",
    "numbered": _numbered("pool_known", "indigo_contr_id", "master_3"),
    "tidy": """SELECT * EXCLUDE (nobody) REPLACE (CASE WHEN nobody THEN NULL ELSE matched_isni END AS matched_isni,
        CASE WHEN nobody THEN NULL ELSE ref_to END AS ref_to,
        CASE WHEN nobody THEN NULL ELSE indigo_contr_id END AS indigo_contr_id)
      FROM (SELECT *, coalesce(upper(author_nm) IN ('UNIDENTIFIED', 'UNKNOWN', 'ANONYMOUS'), false) AS nobody
        FROM numbered)""",
    "canon": _canonical("tidy", "indigo_contr_id", "author_nm"),
    "named": "SELECT t.*, c.name AS indigo_contr_nm FROM tidy t LEFT JOIN canon c ON c.id = t.indigo_contr_id",
    "unmarked": "SELECT * FROM named WHERE matched_isni IS NULL OR lower(matched_isni) NOT LIKE 'trdb%'",
    "stage": f"""SELECT DISTINCT isbn13, indigo_contr_id AS indigo_author_id, trade_db_contributor_id,
        contributor_role AS trade_db_contributor_role, contributor_order AS trade_db_contributor_order, matched_isni,
        indigo_contr_nm AS normailized_author_name, author_nm AS trade_db_author_name, ref_to AS id_source,
        {_md5("trade_db_contributor_id", "indigo_contr_id", "indigo_contr_nm", "matched_isni")} AS dmc_sync_hash_id,
        true AS dmc_synced, CAST(42 AS BIGINT) AS transformation_id
      FROM unmarked WHERE indigo_contr_id IS NOT NULL AND indigo_contr_nm IS NOT NULL""",
    "old": "SELECT DISTINCT dmc_sync_hash_id AS h FROM master WHERE dmc_sync_hash_id IS NOT NULL",
    "merged": _merged("master_3", "stage"),
    "flagged": _flagged("merged", "old"),
    # --- full refresh
    "f_clean": f"""SELECT DISTINCT * REPLACE ({_BLANK.format("contributor_first_name")} AS contributor_first_name,
        {_BLANK.format("contributor_last_name")} AS contributor_last_name) FROM feed""",
    "f_credit": f"""SELECT DISTINCT {_CREDIT} FROM (SELECT *,
        {_guarded("contributor_first_name", "contributor_last_name")} AS author_nm FROM f_clean)
      WHERE author_nm IS NOT NULL""",
    "f_work": """SELECT c.* FROM f_credit c LEFT JOIN (
        SELECT DISTINCT isbn13, trade_db_contributor_id, trade_db_author_name, true AS seen FROM master) m
      ON m.isbn13 = c.isbn13 AND m.trade_db_contributor_id = c.trade_db_contributor_id
        AND m.trade_db_author_name = c.author_nm WHERE m.seen IS NULL""",
    "f_by_name": _by_name("f_work"),
    "f_rest_1": _not_linked("f_work", _KEY_2, "f_by_name"),
    "f_status": _status("f_rest_1", ""),
    "f_confirmed": _confirmed("f_status", ""),
    "f_single": _single("f_confirmed"),
    "f_rest_2": _not_linked("f_work", _KEY_2, "f_by_name", "f_single"),
    "f_linked_1": _union("f_by_name", "f_single", "", "final_isni"),
    "f_pairs": _pairs("f_linked_1", "master", "'ISNI', 'ISNI&PREFILLISNI'"),
    "f_sure": _sure("f_pairs"),
    "f_by_contributor": _by_contributor("f_rest_2", "f_sure"),
    "f_rest_3": _not_linked("f_work", _KEY_2, "f_by_name", "f_single", "f_by_contributor"),
    "f_linked_2": _union("f_linked_1", "f_by_contributor", ""),
    "f_fallback": _fallback("f_rest_3"),
    "f_linked_3": _union("f_linked_2", "f_fallback", ""),
    "f_staged": """SELECT DISTINCT isbn13, CAST(NULL AS BIGINT) AS indigo_author_id, trade_db_contributor_id,
        contributor_role AS trade_db_contributor_role, contributor_order AS trade_db_contributor_order, matched_isni,
        CAST(NULL AS VARCHAR) AS normailized_author_name, author_nm AS trade_db_author_name, ref_to AS id_source,
        CAST(42 AS BIGINT) AS transformation_id FROM f_linked_3""",
    "f_known": """SELECT s.* REPLACE (m.id AS indigo_author_id) FROM f_staged s LEFT JOIN (
        SELECT coalesce(matched_isni, 'trdb' || trade_db_contributor_id) AS isni, min(indigo_author_id) AS id
        FROM master GROUP BY 1) m ON m.isni = s.matched_isni""",
    "f_numbered": _numbered("f_known", "indigo_author_id", "master"),
    "f_canon": _canonical("f_numbered", "indigo_author_id", "trade_db_author_name"),
    "f_named": """SELECT n.* REPLACE (c.name AS normailized_author_name) FROM f_numbered n
      LEFT JOIN f_canon c ON c.id = n.indigo_author_id""",
    "f_hashed": f"SELECT *, {_md5(*_HASHED)} AS dmc_sync_hash_id FROM f_named",
    "f_cleared": """SELECT * REPLACE (CASE WHEN lower(matched_isni) LIKE 'trdb%' THEN NULL ELSE matched_isni END
        AS matched_isni) FROM f_hashed""",
    "f_resolved": """SELECT * FROM f_cleared
      WHERE indigo_author_id IS NOT NULL AND normailized_author_name IS NOT NULL""",
    "f_stage": "SELECT *, CAST(NULL AS BOOLEAN) AS dmc_synced FROM f_resolved",
    "f_merged": _merged("master", "f_stage"),
    "f_flagged": _flagged("f_merged", "old"),
    # --- first load
    "loaded": f"""SELECT DISTINCT isbn13, author_id AS indigo_author_id, k AS trade_db_contributor_id,
        role AS trade_db_contributor_role, pos AS trade_db_contributor_order,
        CASE WHEN lower(isni) LIKE 'trdb%' THEN NULL ELSE isni END AS matched_isni, canonical AS normailized_author_name,
        variant AS trade_db_author_name, source AS id_source,
        {_md5("k", "author_id", "canonical", "isni")} AS dmc_sync_hash_id,
        true AS dmc_synced, CAST(42 AS BIGINT) AS transformation_id FROM prior
      WHERE author_id IS NOT NULL AND canonical IS NOT NULL""",
    # --- results that no other part needs
    "names": "SELECT DISTINCT author_nm FROM work WHERE upper(author_nm) NOT IN ('UNIDENTIFIED', 'UNKNOWN')",
    "f_names": "SELECT DISTINCT author_nm FROM f_work",
    "norms": f"""SELECT isbn13, author_nm, {_norm("author_nm")} AS author_nm_norm FROM (
        SELECT isbn13, author_nm FROM credit UNION ALL SELECT isbn13, trade_db_author_name FROM master)""",
    "holder_names": f"SELECT isni, {_joined('fn', 'ln')} AS full_name FROM holder",
    "full_names": "SELECT DISTINCT * FROM holder_names",
    "f_match_input": f"""SELECT DISTINCT isni, fn AS first_name, ln AS last_name, {_guarded("fn", "ln")} AS author
      FROM holder""",
    "match_input": "SELECT DISTINCT isni, fn || ' ' || ln AS author FROM holder",
    "engine_unique": "SELECT * FROM engine WHERE dup_name_flag IS NULL",
    "engine_ambiguous": "SELECT * FROM engine WHERE dup_name_flag = 'Y'",
    "collapsed": f"SELECT {_CREDIT}, count(*) AS _copies, delta_flag FROM work GROUP BY ALL",
    "authors": """SELECT matched_isni, min(indigo_author_id) AS _low_id, max(indigo_author_id) AS _high_id,
        max(normailized_author_name) AS _name FROM master_2
      WHERE matched_isni IS NOT NULL AND indigo_author_id IS NOT NULL GROUP BY matched_isni""",
    "marked": "SELECT *, dmc_sync_hash_id NOT IN (SELECT h FROM old) AS _unseen FROM stage",
    "hashes": "SELECT DISTINCT dmc_sync_hash_id FROM master",
}

_ODD_NAME_PARTS = _NAME_PARTS.replace(
    "CASE WHEN k % 17 = 0 THEN 'Unknown'",
    "CASE WHEN k % 31 = 0 THEN chr(9) || 'Mary  Ann ' WHEN k % 41 = 0 THEN 'Anonymous' WHEN k % 43 = 0 THEN NULL WHEN k % 17 = 0 THEN 'Unknown'",
).replace(
    "CASE WHEN k % 17 = 0 THEN 'Author'",
    "CASE WHEN k % 31 = 0 THEN 'O''Neil ' || chr(13) || chr(10) || ' Jr' WHEN k % 41 = 0 THEN NULL WHEN k % 43 = 0 THEN 'unknown' WHEN k % 17 = 0 THEN 'Author'",
)
_GAP = "k % 2 = 1 AND k % 3 <> 0 AND p"
# The same tables with rare cases.
_ODD_PARTS = {
    name: sql.replace(_NAME_PARTS, _ODD_NAME_PARTS) for name, sql in _PARTS.items() if _NAME_PARTS in sql
}
_ODD_PARTS["line"] = f"""SELECT * REPLACE (CASE WHEN {_GAP} % 83 = 0 THEN NULL ELSE isbn13 END AS isbn13,
    CASE WHEN {_GAP} % 89 = 0 THEN NULL ELSE role END AS role, CASE WHEN {_GAP} % 97 = 0 THEN NULL ELSE pos END AS pos)
  FROM ({_ODD_PARTS["line"]})"""
_ODD_PARTS["known"] = f"""SELECT * EXCLUDE (p) REPLACE (CASE WHEN p % 5 = 0 THEN nm || ' II' ELSE variant END AS variant,
    CASE WHEN k % 47 = 0 THEN 'TRDB' || k ELSE isni END AS isni)
  FROM ({_PARTS["known"].replace("SELECT o,", "SELECT o, p,")})"""

_RESULTS = {
    "p01_cleanse_name_parts": "f_clean",
    "p02_full_name_guarded": "f_credit",
    "p03_full_name_feed": "credit",
    "p03_full_name_isni": "holder_names",
    "p04_normalise_name": "norms",
    "p04_normalise_name_odd": "norms",
    "p05_detect_new_by_existence": "f_work",
    "p06_delta_classify": "delta",
    "p07_delta_filter": "work",
    "p07_delta_work": "collapsed",
    "p08_match_input_names": "names",
    "p08_match_input_names_full": "f_names",
    "p09_isni_match_input": "match_input",
    "p09_isni_match_input_full": "f_match_input",
    "p10_split_ambiguous": "engine_ambiguous",
    "p10_split_unique": "engine_unique",
    "p11_bucket_isni": "by_name",
    "p12_residual_after_isni": "rest_1",
    "p12_residual_after_isni_full": "f_rest_1",
    "p13_isni_full_names": "full_names",
    "p14_isni_book_authors": "shelf",
    "p15_match_status": "status",
    "p15_match_status_full": "f_status",
    "p16_bucket_prefilled": "confirmed",
    "p17_singletons": "single",
    "p18_residual_after_prefilled": "rest_2",
    "p18_residual_after_prefilled_full": "f_rest_2",
    "p19_combine_isni": "linked_1",
    "p20_apply_changed_early": "master_1",
    "p21_known_isni_pairs": "pairs",
    "p21_known_isni_pairs_full": "f_pairs",
    "p22_unique_isni_per_contributor": "sure",
    "p23_bucket_tradedb_isni": "by_contributor",
    "p24_residual_after_contributor": "rest_3",
    "p24_residual_after_contributor_full": "f_rest_3",
    "p25_combine_2": "linked_2",
    "p26_bucket_tradedb": "fallback",
    "p27_combine_3": "linked_3",
    "p28_apply_changed_final": "master_2",
    "p29_backfill_master_ids": "master_3",
    "p29_known_authors": "authors",
    "p30_stage_rows_full": "f_staged",
    "p30_stage_rows_new": "fresh",
    "p31_backfill_combined_ids": "pool_known",
    "p31_backfill_new_ids": "fresh_known",
    "p31_backfill_stage_ids_full": "f_known",
    "p32_combine_base_and_new": "pool",
    "p33_allocate_ids": "numbered",
    "p33_allocate_ids_full": "f_numbered",
    "p34_null_placeholder_names": "tidy",
    "p35_canonical_name": "named",
    "p35_canonical_name_full": "f_named",
    "p36_change_hash": "f_hashed",
    "p37_clear_isni_placeholders": "f_cleared",
    "p37_drop_isni_placeholders": "unmarked",
    "p38_drop_unresolved": "f_resolved",
    "p39_publish_stage": "stage",
    "p40_snapshot_hashes": "hashes",
    "p41_merge_upsert": "merged",
    "p41_merge_upsert_full": "f_merged",
    "p42_flag_unsynced": "flagged",
    "p42_flag_unsynced_full": "f_flagged",
    "p42_mark_new_hashes": "marked",
    "p43_bootstrap_load": "loaded",
    "p43_run_bootstrap": "loaded",
    "p43_run_bootstrap_odd": "loaded",
    "p44_run_full_refresh_base": "f_flagged",
    "p44_run_full_refresh_odd_base": "f_flagged",
    "p44_run_full_refresh_odd_stage": "f_stage",
    "p44_run_full_refresh_published": "f_flagged",
    "p44_run_full_refresh_stage": "f_stage",
    "p45_run_incremental_base": "flagged",
    "p45_run_incremental_odd_base": "flagged",
    "p45_run_incremental_odd_stage": "stage",
    "p45_run_incremental_published": "flagged",
    "p45_run_incremental_stage": "stage",
}


def _statement(result: str, parts: dict[str, str]) -> str:
    needed, waiting = {result}, [result]
    while waiting:
        part = waiting.pop()
        more = {word for word in re.findall(r"\w+", parts[part]) if word in parts and word != part} - needed
        needed |= more
        waiting += more
    chosen = [f"{name} AS MATERIALIZED ({sql})" for name, sql in parts.items() if name in needed]
    return f"WITH {', '.join(chosen)} SELECT * FROM {result}"


def oracle_sql() -> dict[str, str]:
    odd = _PARTS | _ODD_PARTS
    return {key: _statement(part, odd if "_odd" in key else _PARTS) for key, part in _RESULTS.items()}
