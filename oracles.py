"""DuckDB SQL for the registered queries.

The expectation comes from the statement templates, not from reading SQL text:
``tpl`` lists by hand what each template assigns, ``rd`` what it reads.
"""

from __future__ import annotations

from workload import SCOPES, TEMPLATES, WIDE


def _quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_BODY = "CASE m " + " ".join(
    f"WHEN {i} THEN {_quote(t)}" for i, t in enumerate(TEMPLATES)
) + " END"

# m, clause, unit, branch, ord, target, expression, item, aliased, qualifier, column
_TPL = [
    (0, "insert_select", 0, 0, 0, "CA", "s.XA", "s.XA", False, "S", "XA"),
    (0, "insert_select", 0, 0, 1, "CB", "COALESCE(s.XB, {N})", "COALESCE(s.XB, {N})", False, "S", "XB"),
    (0, "insert_select", 0, 0, 2, "CC", "TRIM(s.XC)", "TRIM(s.XC)", False, "S", "XC"),
    (1, "values", 0, 0, 0, "CA", "{N}", "{N}", False, "", ""),
    (1, "values", 0, 0, 1, "CB", "'N, A'", "'N, A'", False, "", ""),
    (1, "values", 0, 0, 2, "CC", "CURRENT_DATE", "CURRENT_DATE", False, "", ""),
    (2, "set", 0, 0, 0, "CA", "{N}", "CA = {N}", False, "", ""),
    (2, "set", 0, 0, 1, "CB", "TRIM(XB)", "CB = TRIM(XB)", False, "", ""),
    (3, "merge_set", 0, 0, 0, "CB", "s.XB", "CB = s.XB", False, "S", "XB"),
    (3, "merge_insert", 1, 1, 0, "CA", "s.XA", "s.XA", False, "S", "XA"),
    (3, "merge_insert", 1, 1, 1, "CB", "s.XB", "s.XB", False, "S", "XB"),
    (4, "select", 0, 0, 0, "CA", "s.XA", "s.XA AS CA", True, "S", "XA"),
    (4, "select", 0, 0, 1, "CB", "SUM(s.XB)", "SUM(s.XB) AS CB", True, "S", "XB"),
    (5, "select", 0, 0, 0, "CA", "XA", "XA AS CA", True, "", ""),
    (5, "select", 0, 0, 1, "CB", "XB + {N}", "XB + {N} AS CB", True, "", ""),
    (7, "select", 0, 0, 0, "", "s.*", "s.*", False, "", ""),
    (8, "insert_select", 0, 0, 0, "CA", "XA", "XA", False, "", ""),
    (8, "insert_select", 0, 0, 1, "CB", "'Y'", "'Y'", False, "", ""),
    (8, "insert_select", 1, 1, 0, "CA", "XC", "XC", False, "", ""),
    (8, "insert_select", 1, 1, 1, "CB", "'N'", "'N'", False, "", ""),
]

# m, rank, pos, column, text of the concat rules
_READS = [
    (0, 1, 0, "XA", "Read in SELECT projection: s.XA"),
    (0, 1, 1, "XB", "Read in SELECT projection: COALESCE(s.XB, {N})"),
    (0, 1, 2, "XC", "Read in SELECT projection: TRIM(s.XC)"),
    (0, 3, 0, "XD", "Read in WHERE filter: s.XD = {N}"),
    (2, 3, 0, "CC", "Read in WHERE filter: CC = 'Y'"),
    (2, 6, 1, "CA", "Read as input column"),
    (2, 6, 1, "CB", "Read as input column"),
    (2, 6, 1, "XB", "Read as input column"),
    (3, 6, 0, "CA", "Read as input column"),
    (3, 6, 0, "XA", "Read as input column"),
    (3, 6, 1, "CB", "Read as input column"),
    (3, 6, 1, "XB", "Read as input column"),
    (4, 1, 0, "XA", "Read in SELECT (aliased as CA): s.XA"),
    (4, 1, 1, "XB", "Read in SELECT (aliased as CB): SUM(s.XB)"),
    (4, 4, 0, "XA", "Read in GROUP BY clause"),
    (5, 1, 0, "XA", "Read in SELECT (aliased as CA): XA"),
    (5, 1, 1, "XB", "Read in SELECT (aliased as CB): XB + {N}"),
    (7, 2, 0, "XA", "Read in JOIN ON condition: s.XA = t.CA"),
    (7, 2, 0, "CA", "Read in JOIN ON condition: s.XA = t.CA"),
    (7, 5, 1, "XB", "Read in ORDER BY clause"),
    (8, 1, 0, "XA", "Read in SELECT projection: XA"),
    (8, 1, 1, "XC", "Read in SELECT projection: XC"),
]

# m, rank, searched text, text of the rows rules; select items are added from tpl
_CONTEXTS = [
    (2, 3, "WHERE CC = 'Y'", "Read in WHERE filter: WHERE CC = 'Y'"),
    (4, 4, "GROUP BY s.XA", "Read in GROUP BY clause"),
    (7, 2, "s.XA = t.CA", "Read in JOIN ON condition: s.XA = t.CA"),
    (7, 5, "ORDER BY s.XB", "Read in ORDER BY clause"),
]


def _values(rows: list[tuple]) -> str:
    def cell(v) -> str:
        if isinstance(v, bool):
            return "true" if v else "false"
        return str(v) if isinstance(v, int) else _quote(v)

    return ", ".join("(" + ", ".join(cell(v) for v in r) + ")" for r in rows)


_ST = f"""g AS (SELECT p_partkey AS k, p_name, p_type, p_brand, CAST(p_size AS varchar) AS nn,
  CAST(p_partkey % 3 AS varchar) AS tt, CAST(p_partkey % 4 AS varchar) AS ss, CAST(p_partkey % 10 AS int) AS m,
  'jobs/f' || CAST(CAST((p_partkey - p_partkey % 5) / 5 AS bigint) AS varchar) || '.sql' AS parent,
  CAST(p_partkey % 5 AS int) AS stmt_no FROM part),
b AS (SELECT *, replace(replace(replace({_BODY}, '{{N}}', nn), '{{T}}', tt), '{{S}}', ss) AS body FROM g),
st AS (SELECT *, '/* ' || p_name || '; ' || p_type || ' */ ' || body || ' -- ' || p_brand AS stmt,
  md5(parent || '|' || CAST(stmt_no AS varchar) || '|' || body) AS query_id,
  ['INSERT','INSERT','UPDATE','MERGE','CTAS','VIEW','DDL','SELECT','INSERT','SELECT'][m + 1] AS kind,
  CASE WHEN m IN (6, 7, 9) THEN '' ELSE 'TGT_' || tt END AS target_table,
  CASE m WHEN 6 THEN 'PURE_DDL_SKIPPED' WHEN 9 THEN 'UNBALANCED' ELSE '' END AS parse_error,
  CASE WHEN m IN (6, 9) THEN 'PARSE_FAILED' ELSE 'OK' END AS parse_status FROM b)"""

_ASG = f"""tpl AS (SELECT * FROM (VALUES {_values(_TPL)})
  t(tm, clause, unit_no, branch_no, ord, target_col, x, y, aliased, rq, rc)),
asg AS (SELECT st.*, tpl.* EXCLUDE (x, y), replace(x, '{{N}}', nn) AS expr, replace(y, '{{N}}', nn) AS item
  FROM st JOIN tpl ON tm = m)"""

_RD = f"""rd AS (SELECT st.query_id, st.parent, st.stmt_no, rank, pos, cname, replace(x, '{{N}}', nn) AS shown
  FROM st JOIN (VALUES {_values(_READS)}) t(tm, rank, pos, cname, x) ON tm = m)"""

_CTX = f"""ctx AS (SELECT query_id, parent, stmt_no, 1 AS rank, item AS match, 'Read in SELECT projection: ' || item AS shown
  FROM asg WHERE clause IN ('select', 'insert_select')
  UNION ALL SELECT st.query_id, st.parent, st.stmt_no, rank, match, shown
  FROM st JOIN (VALUES {_values(_CONTEXTS)}) t(tm, rank, match, shown) ON tm = m)"""

_ED = """ed AS (SELECT o_orderkey AS row_id, 'DB.SRC_' || CAST(o_orderkey % 4 AS varchar) AS source_table,
  CASE CAST(o_orderkey % 11 AS int) WHEN 0 THEN 'XA' WHEN 1 THEN 'XB' WHEN 2 THEN 's.XC' WHEN 3 THEN 'XD'
    WHEN 4 THEN 'xa' WHEN 5 THEN 'NULL' WHEN 6 THEN '' WHEN 7 THEN 'STATIC VALUE' WHEN 8 THEN '*'
    WHEN 9 THEN 'n/a' ELSE 'XB' END AS source_column,
  '$DWDB.TGT_' || CAST(o_orderkey % 3 AS varchar) AS target_table,
  CASE CAST(o_orderkey % 13 AS int) WHEN 0 THEN 'CA' WHEN 1 THEN 'CB' WHEN 2 THEN 'CC' WHEN 3 THEN 'ca'
    WHEN 4 THEN '' WHEN 5 THEN 'NULL' WHEN 6 THEN '*' WHEN 7 THEN 'CD' WHEN 8 THEN 'CA' WHEN 9 THEN 'CB'
    WHEN 10 THEN '' ELSE 'CB' END AS target_column,
  CASE WHEN o_orderstatus = 'F' THEN 'READ' ELSE 'WRITE' END AS relation,
  'jobs/f' || CAST(CAST((o_custkey - o_custkey % 3) / 3 AS bigint) AS varchar) || '.sql' AS parent,
  'FILE' AS parent_type FROM orders)"""

_NE = """ne AS (SELECT ed.*,
  CASE WHEN lower(source_column) IN ('', 'n/a') THEN '' ELSE upper(source_column) END AS src_name,
  CASE WHEN target_column = '' THEN '' ELSE upper(target_column) END AS tgt_name,
  substr(source_table, 4) AS src_tbl, substr(target_table, 7) AS tgt_tbl FROM ed)"""


def _gate(source: str) -> str:
    return f"""ga AS (SELECT *, CASE WHEN src_name = 'NULL' OR tgt_name = 'NULL' THEN 'null'
  WHEN src_name = '*' OR tgt_name = '*' THEN 'wildcard'
  WHEN relation = 'READ' AND src_name <> '' AND tgt_name = '' THEN 'read'
  WHEN src_name = '' AND tgt_name = '' THEN 'missing_both' WHEN src_name = '' THEN 'missing_source'
  WHEN tgt_name = '' THEN 'missing_target' WHEN src_name = 'STATIC VALUE' THEN 'static' ELSE 'normal' END AS gate,
  CASE src_name WHEN 'S.XC' THEN 'XC' ELSE src_name END AS src_col FROM {source})"""


_DEDUP = """dd AS (SELECT * FROM ne QUALIFY row_number() OVER (PARTITION BY source_table, source_column,
  target_table, target_column, parent ORDER BY row_id) = 1)"""

# Facts of a statement's file.
_FI = """fi AS (SELECT parent, arg_min(query_id, stmt_no) FILTER (parse_status = 'OK') AS ok_id,
  arg_min(query_id, stmt_no) AS any_id, arg_min(query_id, stmt_no) FILTER (parse_status <> 'OK') AS failed_id,
  arg_min(query_id, stmt_no) FILTER (m = 1) AS values_id FROM st GROUP BY parent)"""

# Alias of the edge's source table in a statement, and whether S. is another table's alias.
_ALIAS = """CASE WHEN src_tbl <> 'SRC_' || ss THEN '' WHEN m IN (0, 3, 4, 7) THEN 'S'
  WHEN m IN (5, 8) THEN src_tbl ELSE '' END"""

_LIT = """(regexp_matches(expr, '^[0-9]+$') OR expr IN ('''N, A''', '''Y''', '''N''', 'CURRENT_DATE'))"""

_CAND_B = f"""cb0 AS (SELECT DISTINCT ga.row_id, ga.src_tbl, ga.tgt_tbl, ga.src_col, a.query_id, a.expr, a.target_table,
    a.rq, a.rc, a.ss, a.m, a.stmt_no FROM ga JOIN asg a ON a.parent = ga.parent
    AND (a.target_col = ga.tgt_name OR (a.clause IN ('select', 'insert_select') AND contains(upper(a.item), ga.src_col)))
  WHERE gate IN ('normal', 'static')),
cb1 AS (SELECT *, {_ALIAS} AS alias, target_table <> '' AND target_table = tgt_tbl AS tm FROM cb0),
cb2 AS (SELECT *, CASE WHEN rq <> '' THEN (CASE WHEN rc <> src_col THEN 0
    WHEN alias = 'S' THEN (CASE WHEN tm THEN 3 ELSE 1 END) WHEN alias = '' THEN 0 ELSE 0 END)
  ELSE (CASE WHEN tm THEN 2 ELSE 1 END) END AS score,
  CASE WHEN expr = src_col OR (expr = 's.' || src_col AND alias IN ('', 'S')) THEN 'DIRECT_PASS_THROUGH' ELSE expr END AS logic FROM cb1),
cb AS (SELECT DISTINCT row_id, query_id, logic, score, {_LIT} AS is_literal, stmt_no AS ord FROM cb2 WHERE score > 0)"""

_CONFIRMED = f"""CASE WHEN {_LIT.replace('expr', 'logic')} THEN is_static
  WHEN logic = 'Direct pass through' OR rq = '' THEN true ELSE alias = 'S' END"""


def _cand_a(all_hits: bool) -> str:
    """Statement candidates of the concat rules; MERGE into CB writes s.XB in both branches."""
    first = "" if all_hits else "AND branch_no = 0 OR clause LIKE 'merge%'"
    usable = f"(clause <> 'values' AND (true {first}))" if not all_hits else "clause <> 'values'"
    static = "true" if all_hits else "(branch_no = 0 OR clause = 'merge_insert')"
    check = (
        """WHERE is_static AND rq = '' OR logic = 'Direct pass through' OR NOT starts_with(logic, 's.') OR alias = 'S'"""
        if all_hits
        else ""
    )
    return f"""ca0 AS (SELECT DISTINCT ga.row_id, ga.src_tbl, ga.tgt_tbl, ga.src_name, gate = 'static' AS is_static,
    a.query_id, a.expr, a.target_table, a.rq, a.ss, a.m, a.stmt_no, min(a.unit_no * 10 + a.ord) AS seq
  FROM ga JOIN asg a ON a.parent = ga.parent AND a.target_col = ga.tgt_name
  WHERE gate IN ('normal', 'static') AND CASE WHEN gate = 'static' THEN {static} ELSE {usable} END GROUP BY ALL),
ca1 AS (SELECT *, {_ALIAS} AS alias FROM ca0),
ca2 AS (SELECT *, CASE WHEN NOT is_static AND (expr = src_name OR (expr = 's.' || src_name AND alias IN ('', 'S')))
  THEN 'Direct pass through' ELSE expr END AS logic FROM ca1),
ca3 AS (SELECT * FROM ca2 {check}),
ca AS (SELECT row_id, query_id, logic, CASE WHEN (target_table = '' OR target_table = tgt_tbl)
    THEN (CASE WHEN {_CONFIRMED} THEN 3 ELSE 2 END) ELSE 1 END AS score,
  {_LIT.replace('expr', 'logic')} AS is_literal, stmt_no AS ord, seq, is_static FROM ca3)"""


_TIER_A = """ta AS (SELECT * FROM ca QUALIFY score = max(score) OVER (PARTITION BY row_id)),
tb AS (SELECT * FROM ta QUALIFY NOT is_static OR is_literal OR NOT max(is_literal) OVER (PARTITION BY row_id)),
tc AS (SELECT row_id, logic, min(ord * 1000 + seq) AS o FROM tb GROUP BY row_id, logic),
td AS (SELECT row_id, arg_min(query_id, ord * 1000 + seq) AS query_uuid FROM tb GROUP BY row_id),
te AS (SELECT row_id, string_agg(logic, ' | ' ORDER BY o) AS logic FROM tc GROUP BY row_id)"""

_SEVEN = "source_table, source_column, target_table, target_column, relation, parent, parent_type"


def _seven(alias: str) -> str:
    return ", ".join(f"{alias}.{c}" for c in _SEVEN.split(", "))


_FACT_B = f"""dflt AS (SELECT ga.*, coalesce(ok_id, any_id, md5(ga.parent || '|0|')) AS did,
    CASE WHEN any_id IS NULL THEN md5(ga.parent || '|0|') ELSE failed_id END AS fid, values_id
  FROM ga LEFT JOIN fi ON fi.parent = ga.parent),
nul AS (SELECT parent, target_col, arg_min(query_id, stmt_no) AS id FROM asg WHERE target_col <> '' GROUP BY ALL),
wld AS (SELECT parent, target_table AS tbl, arg_min(query_id, stmt_no) AS id FROM st WHERE target_table <> '' GROUP BY ALL),
rdb AS (SELECT DISTINCT d.row_id, c.shown AS logic, c.query_id FROM dflt d JOIN ctx c ON c.parent = d.parent
  AND contains(upper(c.match), d.src_col) WHERE gate = 'read'),
sta AS (SELECT DISTINCT d.row_id, a.expr AS logic, a.query_id, {_LIT} AS lit FROM dflt d
  JOIN asg a ON a.parent = d.parent AND a.target_col = d.tgt_name WHERE gate = 'static'),
stb AS (SELECT * FROM sta QUALIFY lit OR NOT max(lit) OVER (PARTITION BY row_id)),
tier AS (SELECT DISTINCT row_id, logic, query_id FROM (SELECT * FROM cb WHERE row_id NOT IN (SELECT row_id FROM stb)
  QUALIFY score = max(score) OVER (PARTITION BY row_id))),
found AS (SELECT row_id, logic, query_id FROM rdb UNION ALL SELECT row_id, logic, query_id FROM stb UNION ALL SELECT * FROM tier),
rest AS (SELECT row_id, CASE gate WHEN 'null' THEN 'NULL' WHEN 'wildcard' THEN 'Wildcard SELECT * - all source columns'
    WHEN 'missing_both' THEN 'MISSING_BOTH_COLUMNS' WHEN 'missing_source' THEN 'MISSING_SOURCE_COLUMN'
    WHEN 'missing_target' THEN 'MISSING_TARGET_COLUMN' WHEN 'read' THEN 'MISSING_TARGET_COLUMN' WHEN 'static' THEN 'STATIC_VALUE'
    ELSE CASE WHEN fid IS NOT NULL THEN 'PARSE_FAILED' ELSE 'TRANSFORM_NOT_FOUND' END END AS logic,
  CASE gate WHEN 'null' THEN CASE WHEN tgt_name = '' THEN coalesce(values_id, did) ELSE coalesce(nul.id, did) END
    WHEN 'wildcard' THEN coalesce(wld.id, did) WHEN 'normal' THEN coalesce(fid, did) ELSE did END AS query_id
  FROM dflt LEFT JOIN nul ON nul.parent = dflt.parent AND nul.target_col = dflt.tgt_name
  LEFT JOIN wld ON wld.parent = dflt.parent AND wld.tbl = dflt.tgt_tbl WHERE row_id NOT IN (SELECT row_id FROM found)),
fact AS (SELECT {_seven('ga')}, logic AS transformation_logic, query_id AS query_uuid, ga.row_id, ga.gate
  FROM (SELECT * FROM found UNION ALL SELECT * FROM rest) r JOIN ga ON ga.row_id = r.row_id)"""

_FACT_A = f"""dflt AS (SELECT ga.*, any_id IS NOT NULL AS has_file, coalesce(ok_id, any_id) AS did, failed_id AS fid
  FROM ga LEFT JOIN fi ON fi.parent = ga.parent),
nul AS (SELECT parent, target_col, arg_min(query_id, stmt_no) AS id FROM asg WHERE target_col <> ''
  AND (branch_no = 0 OR clause = 'merge_insert') GROUP BY ALL),
rda AS (SELECT parent, cname, arg_min(struct_pack(query_id := query_id, shown := shown), stmt_no * 10000 + rank * 100 + pos) AS r
  FROM rd GROUP BY ALL),
sr AS (SELECT parent, query_id FROM st WHERE m = 7),
outc AS (SELECT d.row_id, CASE WHEN NOT has_file THEN 'TRANSFORM_NOT_FOUND' WHEN gate = 'null' THEN 'NULL'
   WHEN gate = 'wildcard' THEN CASE WHEN sr.query_id IS NOT NULL THEN 'Wildcard SELECT s.* — all columns from s' ELSE
     'Wildcard (' || CASE WHEN source_column <> '' THEN source_column ELSE target_column END || ') — all columns from ' || source_table END
   WHEN gate = 'read' THEN coalesce(rda.r.shown, 'Read column ''' || source_column || ''' (context not extracted)')
   WHEN gate = 'missing_both' THEN 'MISSING_BOTH_COLUMNS' WHEN gate = 'missing_source' THEN 'MISSING_SOURCE_COLUMN'
   WHEN gate = 'missing_target' THEN 'MISSING_TARGET_COLUMN' WHEN te.logic IS NOT NULL THEN te.logic
   WHEN gate = 'static' THEN 'STATIC' WHEN fid IS NOT NULL THEN 'PARSE_FAILED' ELSE 'TRANSFORM_NOT_FOUND' END AS logic,
  CASE WHEN NOT has_file THEN '' WHEN gate = 'null' THEN coalesce(nul.id, did)
   WHEN gate = 'wildcard' THEN coalesce(sr.query_id, did) WHEN gate = 'read' THEN coalesce(rda.r.query_id, did)
   WHEN gate IN ('missing_both', 'missing_source', 'missing_target') THEN did WHEN td.query_uuid IS NOT NULL THEN td.query_uuid
   WHEN gate = 'static' THEN did ELSE coalesce(fid, did) END AS query_id
  FROM dflt d LEFT JOIN nul ON nul.parent = d.parent AND nul.target_col = d.tgt_name AND d.tgt_name <> 'NULL'
  LEFT JOIN rda ON rda.parent = d.parent AND rda.cname = d.src_name LEFT JOIN sr ON sr.parent = d.parent
  LEFT JOIN te ON te.row_id = d.row_id LEFT JOIN td ON td.row_id = d.row_id),
fact AS (SELECT {_seven('ga')}, logic AS transformation_logic, query_id AS query_uuid, ga.row_id, ga.gate
  FROM outc JOIN ga ON ga.row_id = outc.row_id)"""


def _sql(select: str, *ctes: str) -> str:
    return ("WITH " + ",\n".join(ctes) + "\n" if ctes else "") + select


_B = [_ST, _ASG, _CTX, _ED, _NE, _DEDUP, _gate("dd"), _FI, _CAND_B, _FACT_B]
_A = [_ST, _ASG, _RD, _ED, _NE, _gate("ne"), _FI, _cand_a(False), _TIER_A, _FACT_A]
_P = [_ST, _ASG, _RD, _ED, _NE, _gate("ne"), _FI, _cand_a(True), _TIER_A, _FACT_A]
_NINE = _SEVEN + ", transformation_logic, query_uuid"

_BLOCK = r"/\*[^*]*\*+([^*/][^*]*\*+)*/"
_FILES = "fl AS (SELECT parent, string_agg(stmt, chr(10) || ';' || chr(10) ORDER BY stmt_no) AS sql_text FROM st GROUP BY parent)"
_ASG_COLS = "query_id, clause, unit_no, branch_no, ord, target_col, expr"


def _assign(where: str) -> str:
    return _sql(f"SELECT {_ASG_COLS} FROM asg WHERE {where}", _ST, _ASG)


_DIM = """dim AS (SELECT query_id AS query_uuid, body AS sql_query, parent AS file_path, parse_status, parse_error FROM st
  WHERE parent IN (SELECT parent FROM ed)
  UNION ALL SELECT DISTINCT md5(parent || '|0|'), '', parent, 'PARSE_FAILED', 'FILE_NOT_FOUND' FROM ed
  WHERE parent NOT IN (SELECT parent FROM st))"""



def _wide(rows: list[tuple[int, str]]) -> str:
    return (
        "SELECT p_partkey AS row_id, replace(x, '{N}', CAST(p_size AS varchar)) AS transformation_logic "
        f"FROM part JOIN (VALUES {_values(rows)}) t(c, x) ON c = p_partkey % {len(WIDE)}"
    )


def _scope_sources() -> str:
    rows = []
    for number, (text, names) in enumerate(SCOPES):
        for name, tables in names.items():
            cte = f"{name} AS (" in text.upper() or f"{name} (" in text.upper()
            kind = "statement" if not name else "cte" if cte else "named"
            rows += [(number, kind, name, t) for t in tables]
    return (
        "SELECT DISTINCT p_partkey AS k, kind, name, replace(x, '{N}', CAST(p_size AS varchar)) AS base_table "
        f"FROM part JOIN (VALUES {_values(rows)}) t(c, kind, name, x) ON c = p_partkey % {len(SCOPES)}"
    )


ORACLES = {
    "wide_rows": _wide([(i, x) for i, case in enumerate(WIDE) for x in case[2]]),
    "wide_concat": _wide([(i, case[3]) for i, case in enumerate(WIDE)]),
    "edges_normalized": _sql(
        "SELECT row_id, src_name, tgt_name, CASE src_name WHEN 'S.XC' THEN 'XC' ELSE src_name END AS src_col, "
        "tgt_name AS tgt_col, src_tbl, tgt_tbl, src_name IN ('*', 'STATIC VALUE') AS is_static FROM ne",
        _ED,
        _NE,
    ),
    "edges_dedup": _sql(f"SELECT row_id, {_SEVEN} FROM dd", _ED, _NE, _DEDUP),
    "name_bare_table": "SELECT p_partkey AS k, 'TGT_' || CAST(p_size AS varchar) AS bare, "
    "'TGT_' || CAST(p_size AS varchar) AS bare_ident, p_partkey % 6 <> 5 AS same_table FROM part",
    "literal_flags": _sql(
        f"SELECT query_id, unit_no, ord, expr, {_LIT} AS is_literal, {_LIT} AS is_literal_wide FROM asg",
        _ST,
        _ASG,
    ),
    "passthrough_flags": _sql(
        "SELECT o_orderkey AS row_id, query_id, unit_no, ord, expr = 's.' || src OR expr = src AS direct, "
        "(expr = 's.' || src AND ss = sk) OR expr = src AS direct_aliased FROM "
        "(SELECT o_orderkey, 'jobs/f' || CAST(CAST((o_custkey - o_custkey % 3) / 3 AS bigint) AS varchar) || '.sql' AS p, "
        "['XA', 'XB', 'XC'][CAST(o_orderkey % 3 AS int) + 1] AS src, CAST(o_orderkey % 4 AS varchar) AS sk FROM orders) o "
        "JOIN asg ON asg.parent = o.p",
        _ST,
        _ASG,
    ),
    "clean_logic": _sql(
        "SELECT query_id, unit_no, ord, '(' || expr || ', ' || expr || ')' AS cleaned, "
        "expr || ' AS other' AS other_alias FROM asg",
        _ST,
        _ASG,
    ),
    "qualified_refs": _sql(
        "SELECT query_id, unit_no, ord, rq AS q, rc AS c FROM asg WHERE rq <> ''", _ST, _ASG
    ),
    "comment_strip": _sql(
        f"SELECT parent, regexp_replace(regexp_replace(sql_text, '{_BLOCK}', ' ', 'g'), '--[^\\n]*', ' ', 'g') AS block_first, "
        f"regexp_replace(regexp_replace(sql_text, '--[^\\n]*', '', 'g'), '{_BLOCK}', '', 'g') AS line_first FROM fl",
        _ST,
        _FILES,
    ),
    "statement_split": _sql("SELECT parent, stmt_no, body AS stmt FROM st", _ST),
    "shell_var_tokens": _sql(
        "SELECT query_id, CAST(pos - 1 AS int) AS pos, tok AS token FROM (SELECT query_id, "
        "unnest(regexp_extract_all(body, '\\$\\{?[A-Za-z_][A-Za-z0-9_]*\\}?')) AS tok, "
        "generate_subscripts(regexp_extract_all(body, '\\$\\{?[A-Za-z_][A-Za-z0-9_]*\\}?'), 1) AS pos FROM st)",
        _ST,
    ),
    "statement_kind": _sql("SELECT query_id, kind, m = 6 AS pure_ddl FROM st", _ST),
    "ctas_body": _sql(
        "SELECT query_id, CASE m WHEN 4 THEN 'SELECT s.XA AS CA, SUM(s.XB) AS CB FROM $STG.SRC_' || ss || ' s GROUP BY s.XA' "
        "ELSE 'SELECT XA AS CA, XB + ' || nn || ' AS CB FROM SRC_' || ss END AS body, "
        "CASE m WHEN 4 THEN body ELSE 'SELECT XA AS CA, XB + ' || nn || ' AS CB FROM SRC_' || ss END AS stripped "
        "FROM st WHERE m IN (4, 5)",
        _ST,
    ),
    "statement_target": _sql("SELECT query_id, target_table FROM st", _ST),
    "statement_catalog": _sql(
        "SELECT query_id, parent, stmt_no, body AS sql_query, parse_status, parse_error FROM st", _ST
    ),
    "statement_tables": _sql(
        "SELECT query_id, CAST(ref_no AS int) AS ref_no, replace(replace(name, 'T', 'TGT_' || tt), 'S', 'SRC_' || ss) AS name, alias "
        "FROM st JOIN (VALUES (0, 0, 'T', ''), (0, 1, 'S', 'S'), (1, 0, 'T', ''), (2, 0, 'T', ''), (3, 0, 'T', 'T'), (3, 1, 'S', 'S'), "
        "(4, 0, 'S', 'S'), (5, 0, 'S', ''), (7, 0, 'S', 'S'), (7, 1, 'T', 'T'), (8, 0, 'T', ''), (8, 1, 'S', ''), (8, 2, 'S', '')) "
        "t(tm, ref_no, name, alias) ON tm = m",
        _ST,
    ),
    "other_table_aliases": _sql(
        "SELECT query_id, unnest(CASE WHEN m = 3 OR m = 7 THEN ['TGT_' || tt, 'T'] ELSE ['TGT_' || tt] END) AS other_alias "
        "FROM st WHERE m IN (0, 3, 7, 8)",
        _ST,
    ),
    "default_statement": _sql(
        "SELECT parent, coalesce(ok_id, any_id) AS default_id FROM fi", _ST, _FI
    ),
    "failed_statement": _sql("SELECT parent, failed_id FROM fi WHERE failed_id IS NOT NULL", _ST, _FI),
    "missing_files": _sql(
        "SELECT DISTINCT parent FROM ed WHERE parent NOT IN (SELECT parent FROM st)", _ST, _ED
    ),
    "missing_file_count": _sql(
        "SELECT count(DISTINCT parent) AS n FROM ed WHERE parent NOT IN (SELECT parent FROM st)", _ST, _ED
    ),
    "split_top": """WITH t AS (SELECT p_partkey AS k, p_name || ', f(' || p_type || ', (' || p_brand || ', ''a,b('')), x' AS s FROM part),
ch AS (SELECT k, unnest(range(1, length(s) + 1)) AS i, s FROM t),
c1 AS (SELECT k, i, substr(s, i, 1) AS c, sum(CASE WHEN substr(s, i, 1) = '''' THEN 1 ELSE 0 END) OVER (PARTITION BY k ORDER BY i) % 2 = 1 AS q FROM ch),
c2 AS (SELECT k, i, c, sum(CASE WHEN q THEN 0 WHEN c = '(' THEN 1 WHEN c = ')' THEN -1 ELSE 0 END) OVER (PARTITION BY k ORDER BY i) AS d, q FROM c1),
c3 AS (SELECT k, i, c, c = ',' AND d = 0 AND NOT q AS cut, sum(CASE WHEN c = ',' AND d = 0 AND NOT q THEN 1 ELSE 0 END) OVER (PARTITION BY k ORDER BY i) AS grp FROM c2)
SELECT k, CAST(grp AS int) AS pos, trim(string_agg(CASE WHEN cut THEN '' ELSE c END, '' ORDER BY i)) AS item FROM c3 GROUP BY k, grp""",
    "assign_insert_select": _assign("clause = 'insert_select'"),
    "assign_values": _assign("clause = 'values'"),
    "assign_update": _assign("clause = 'set'"),
    "assign_merge": _assign("clause IN ('merge_set', 'merge_insert')"),
    "assign_select": _assign("clause = 'select'"),
    "assign_union": _assign("clause = 'insert_select' AND m = 8"),
    "static_values": _sql(
        "SELECT row_id, transformation_logic, query_uuid FROM fact WHERE gate = 'static'", *_B
    ),
    "read_contexts": _sql("SELECT query_id, rank, match, shown FROM ctx", _ST, _ASG, _CTX),
    "column_reads": _sql("SELECT query_id, rank, cname AS column_name, shown FROM rd", _ST, _RD),
    "wildcard_contexts": _sql(
        "SELECT query_id, 'Wildcard SELECT s.* — all columns from s' AS description FROM st WHERE m = 7", _ST
    ),
    "candidates_scored_a": _sql(
        "SELECT row_id, query_id, logic, score, is_literal, ord FROM ca", *_A[:-2]
    ),
    "candidates_scored_b": _sql("SELECT row_id, query_id, logic, score, is_literal, ord FROM cb", *_B[:-1]),
    "candidates_alias_checked": _sql(
        "SELECT DISTINCT row_id, query_id, logic, score, is_literal, ord FROM ca", *_P[:-2]
    ),
    "best_tier": _sql(
        "SELECT row_id, query_id, logic, score FROM cb QUALIFY score = max(score) OVER (PARTITION BY row_id)",
        *_B[:-1],
    ),
    "scope_sources": _scope_sources(),
    "extract_errors": _sql(
        f"""SELECT {_NINE} FROM fact
        UNION ALL SELECT {_seven('ed')}, 'EXTRACT_ERROR', coalesce(ok_id, any_id, md5(ed.parent || '|0|'))
        FROM ed LEFT JOIN fi ON fi.parent = ed.parent WHERE row_id % 16 = 5
        UNION ALL SELECT DISTINCT source_table, source_column, target_table, target_column, '', '', '',
        'PROCESSING_ERROR', '' FROM ed WHERE row_id % 16 = 9""",
        *_B,
    ),
    "fact_rows": _sql(f"SELECT {_NINE} FROM fact", *_B),
    "fact_concat": _sql(f"SELECT {_NINE} FROM fact", *_A),
    "fact_patched": _sql(f"SELECT {_NINE} FROM fact", *_P),
    "null_gate": _sql("SELECT row_id, transformation_logic, query_uuid FROM fact WHERE gate = 'null'", *_B),
    "wildcard_gate": _sql(
        "SELECT row_id, transformation_logic, query_uuid FROM fact WHERE gate = 'wildcard'", *_A
    ),
    "read_gate": _sql("SELECT row_id, transformation_logic, query_uuid FROM fact WHERE gate = 'read'", *_A),
    "missing_gate": _sql(
        "SELECT row_id, transformation_logic, query_uuid FROM fact WHERE gate LIKE 'missing%'", *_B
    ),
    "summary_metrics": _sql(
        """SELECT category, CAST(n AS bigint) AS n FROM (SELECT unnest(['Total Records', 'Transformations Found', 'Direct Pass Through',
  'Static Value', 'Parse Failed (manual)', 'Missing Source Column', 'Missing Target Column', 'Missing Both Columns',
  'Transform Not Found']) AS category, unnest([count(*), count(*) FILTER (l NOT IN ('TRANSFORM_NOT_FOUND', 'PARSE_FAILED',
  'MISSING_BOTH_COLUMNS', 'MISSING_SOURCE_COLUMN', 'MISSING_TARGET_COLUMN')), count(*) FILTER (l = 'Direct pass through'),
  count(*) FILTER (starts_with(upper(l), 'STATIC')), count(*) FILTER (l = 'PARSE_FAILED'), count(*) FILTER (l = 'MISSING_SOURCE_COLUMN'),
  count(*) FILTER (l = 'MISSING_TARGET_COLUMN'), count(*) FILTER (l = 'MISSING_BOTH_COLUMNS'),
  count(*) FILTER (l = 'TRANSFORM_NOT_FOUND')]) AS n FROM (SELECT transformation_logic AS l FROM fact))""",
        *_A,
    ),
    "logic_counts": _sql(
        "SELECT transformation_logic AS category, count(*) AS n FROM fact GROUP BY 1", *_B
    ),
    "row_class": _sql(
        """SELECT CASE WHEN l = 'DIRECT_PASS_THROUGH' THEN 'DIRECT_PASSTHRU' WHEN l = 'PARSE_FAILED' THEN l
  WHEN starts_with(l, 'MISSING') THEN 'MISSING' WHEN l = 'NULL' THEN 'NULL_LITERAL' WHEN contains(l, 'STATIC') THEN 'STATIC'
  WHEN l = 'TRANSFORM_NOT_FOUND' THEN 'NF' ELSE 'FOUND' END AS row_class, count(*) AS n
  FROM (SELECT upper(transformation_logic) AS l FROM fact) GROUP BY 1""",
        *_B,
    ),
    "parse_status_counts": _sql(
        "SELECT parse_status, count(*) AS n FROM dim GROUP BY 1", _ST, _ED, _DIM
    ),
    "dim_rows": _sql("SELECT * FROM dim", _ST, _ED, _DIM),
    "dim_dedup": _sql("SELECT query_id AS query_uuid, parent AS file_path FROM st", _ST),
    "edges_per_file": _sql("SELECT parent, count(*) AS n FROM ed GROUP BY parent", _ED),
    "fact_dim_join": _sql(
        "SELECT parse_status, parse_error, count(*) AS n FROM fact JOIN dim USING (query_uuid) GROUP BY 1, 2",
        *_B,
        _DIM,
    ),
    "warnings": _sql(
        "SELECT DISTINCT parent, 'READ_ERROR' AS code, 'Missing SQL file: ' || parent AS message FROM ed "
        "WHERE parent NOT IN (SELECT parent FROM st) UNION ALL "
        "SELECT parent, 'PARSE_WARN', 'statement ' || CAST(stmt_no AS varchar) || ' ' || parse_error FROM st "
        "WHERE parse_error <> '' AND parent IN (SELECT parent FROM ed)",
        _ST,
        _ED,
    ),
}
ORACLES["published_fact"] = ORACLES["fact_rows"]
ORACLES["published_summary"] = ORACLES["summary_metrics"]
