"""Costs that must not grow faster than the input."""

import re
import time

from pyspark.sql import functions as F

from weftline.constants import EDGE_COLUMNS, get_profile
from weftline.functions import names as N
from weftline.functions import shape as S
from weftline.operators import candidates as C
from weftline.operators import edges as E
from weftline.operators import scopes as SC
from weftline.operators import statements as ST
from weftline.plans.lineage import extract_lineage, prepare_edges


def test_folding_computes_its_marks_once_for_a_text(spark):
    depth = 700
    sql = "SELECT " + "f(" * depth + "s.XA" + ")" * depth + " FROM SRC s"
    rows = spark.createDataFrame([(sql,)], "sql string")
    folded, _ = S.fold(F.col("sql"))
    began = time.monotonic()
    text, again = rows.select(folded.alias("f"), S.unfold(folded).alias("u")).head()
    assert time.monotonic() - began < 60
    assert again == sql
    assert text.count("(") == S.MAX_DEPTH and text.count(")") == S.MAX_DEPTH


def _plan(rows):
    return rows._jdf.queryExecution().executedPlan().toString()


def test_equal_outcomes_merge_in_a_hash_table(spark):
    rows = spark.createDataFrame(
        [("c", "q", "x", 1, False, 0, 0), ("c", "q", "x", 1, False, 0, 0), ("c", "q", "y", 1, False, 0, 0),
         ("c", "q", "x", 2, False, 0, 0), ("c", "q", None, 1, False, 0, 0), ("d", "q", "x", 1, False, 0, 0)],
        "case_id string, query_id string, logic string, score int, is_literal boolean, ord int, seq int",
    )
    found = C.distinct_logic(rows, "score")
    assert found.columns == rows.columns
    assert sorted(map(str, found.collect())) == sorted(set(map(str, rows.collect())))
    assert "SortAggregate" not in _plan(found)
    narrow = C.distinct_logic(rows.select("case_id", "logic", "query_id"))
    assert narrow.count() == 4


def test_case_ids_are_sixteen_bytes(spark):
    edge = ("S", "XA", "T", "CA", "WRITE", "f.sql", "FILE")
    edges = spark.createDataFrame([(0, *edge), (1, *edge), (2, *edge[:3], "CB", *edge[4:])], ["row_id", *EDGE_COLUMNS])
    prepared = prepare_edges(E.with_file_key(edges), get_profile("concat"))
    ids = [bytes(r.case_id) for r in prepared.orderBy("row_id").collect()]
    assert ids[0] == ids[1] != ids[2] and {len(x) for x in ids} == {16}


def test_repeated_edges_are_sorted_by_file_first(spark):
    edge = ("S", "XA", "T", "CA", "WRITE", "f.sql", "FILE")
    rows = [(2, *edge), (1, *edge[:4], "READ", *edge[5:]), (3, *edge[:5], None, "FILE"), (4, *edge[:5], None, "FILE")]
    edges = spark.createDataFrame(rows, ["row_id", *EDGE_COLUMNS])
    first = E.dedup_edges(edges)
    assert sorted((r.row_id, r.relation) for r in first.collect()) == [(1, "READ"), (3, "WRITE")]
    assert re.search(r"SortAggregate\(key=\[parent#", _plan(first))


def test_reads_of_scopes_are_cut_out_once(spark, tmp_path):
    sql = "WITH a AS (SELECT x FROM T1), b AS (SELECT x FROM a) INSERT INTO TGT (CA) SELECT x FROM b"
    files = spark.createDataFrame([("f.sql", sql)], "parent string, sql_text string")
    found = SC.scope_sources(SC.scopes(ST.statement_catalog(files), str(tmp_path)), str(tmp_path))
    assert {(r["name"], r["table"]) for r in found.collect()} == {("A", "T1"), ("B", "T1"), ("", "T1")}
    assert len(list(tmp_path.glob("scope-reads-*"))) == 1


def test_mentions_of_small_files_need_no_pieces(spark, tmp_path, monkeypatch):
    """Small files by names, large ones by pieces: the same rows either way."""
    texts = [("large", i, f"f(Col_{i}, CO{i}) + x") for i in range(40)]
    texts += [("small", 1, "COL_1"), ("small", 1, "COL_1"), ("small", 2, None), (None, 3, "COL_1")]
    names = [(p, n) for p in ("large", "small", "none", None) for n in ("COL_1", "O1", "(", "Z", "L_1, C")]
    kind = F.lit(C.MENTIONED).alias("kind")
    asked = spark.createDataFrame(names, "parent string, source string").select("parent", kind, "source")
    offered = spark.createDataFrame(texts, "parent string, tid int, match string").select(
        "parent", kind, "tid", "match"
    )
    want = {(p, n, i) for p, n in names for q, i, t in texts if p and p == q and t and n in t.upper()}
    for chars, folder, pieces in ((4_000_000, "a", 0), (2_000, "b", 1), (0, "c", 1)):
        monkeypatch.setattr(C, "DIRECT_CHARS", chars)
        rows = C.find_mentions(asked, offered, str(tmp_path / folder)).distinct().collect()
        assert {(r["parent"], r["source"], r["tid"]) for r in rows} == want
        assert len(list((tmp_path / folder).glob("tokens-*"))) == pieces


def test_statement_logic_is_computed_once(spark, tmp_path):
    edge = (0, "SRC", "XA", "TGT", "CA", "WRITE", "f.sql", "FILE")
    edges = spark.createDataFrame([edge], ["row_id", *EDGE_COLUMNS])
    sql = "INSERT INTO TGT (CA) SELECT s.XA + 1 FROM SRC s"
    files = spark.createDataFrame([("f.sql", sql)], "parent string, sql_text string")
    fact = extract_lineage(edges, files, "concat", str(tmp_path)).fact
    assert [r["transformation_logic"] for r in fact.collect()] == ["s.XA + 1"]
    assert len(list(tmp_path.glob("logic-*"))) == 1


def test_texts_are_named_once(spark):
    text = str(S.union_branches(F.col("t")))
    assert text.count("ALL|DISTINCT") == 1
    assert str(N.sanitize(F.col("t"))).count("coalesce") == 1
    odd = [" a", "a ", "a  b", "a\tb", "( a", "a )", "a ,b", "a,b", "a,  b", "a, b", "f(a, b)", "", "a\n", ",", "a,", ", a"]
    rows = spark.createDataFrame([(t,) for t in odd], "t string")
    same = rows.select((N.collapse_spaces(F.col("t")) == N._collapsed(F.col("t"))).alias("same"))
    assert all(r["same"] for r in same.collect())
    words = spark.createDataFrame([("nan",), ("NaN",), ("nan\x01",), ("a\x00b\tc",), (None,)], "t string")
    assert [r[0] for r in words.select(N.sanitize(F.col("t"))).collect()] == ["", "", "nan", "ab\tc", ""]
