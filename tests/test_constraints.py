"""The report over all constraints in one scan a table, against one query a constraint."""

import datetime as dt
import io
import contextlib
import random
import re

from airdata import schema as S
from airdata.operators import constraints as V
from airdata.operators.quality import pk_fk_issue_list


def tables(spark, n=300, seed=1):
    r = random.Random(seed)
    pick = lambda *v: r.choice([None, *v])
    a = [(pick(*range(40)), pick("x", "y|z", "x|y", "z", "1", "Ä"), pick("z", "y|z", "", "1"), pick(*(dt.date(2024, 1, d) for d in range(1, 9))), pick(1.5, 2.0, -1.0)) for _ in range(n)]
    b = [(pick(*range(60)), pick("x", "y|z", "q", "1"), pick("z", "", "w"), pick(*(dt.date(2024, 1, d) for d in range(5, 12))), r.randrange(5)) for _ in range(n)]
    return {"a": spark.createDataFrame(a, "id int, s string, t string, d date, v double"),
            "b": spark.createDataFrame(b, "a_id bigint, s string, t string, d date, k smallint"), "empty": spark.createDataFrame([], "a_id bigint, s string")}


NN = (S.NotNull("a", "id"), S.NotNull("b", "t"), S.NotNull("empty", "s"))
CK = (S.Check("a", "ck_v", "v >= 0"), S.Check("b", "ck_none", "k >= 0"), S.Check("a", "ck_quote", "s <> 'it''s'"))
DOM = (S.Domain("a", "s", ("x", "it's", "z"), "dom_s"),)
UQ = (S.Unique("a", ("id",), "pk_a"), S.Unique("a", ("s", "t"), "uq_st"), S.Unique("a", ("d",), "uq_d", ("v",)), S.Unique("b", ("k", "s", "d"), "uq_b"), S.Unique("a", ("v",), "uq_v"), S.Unique("empty", ("s",), "uq_e"))
FK = (S.ForeignKey("b", ("a_id",), "a", ("id",), "fk_id"), S.ForeignKey("b", ("s", "t"), "a", ("s", "t"), "fk_st"), S.ForeignKey("b", ("d",), "a", ("d",), "fk_d"),
      S.ForeignKey("b", ("k",), "a", ("id",), "fk_k"), S.ForeignKey("b", ("s",), "a", ("t",), "fk_swap"), S.ForeignKey("empty", ("a_id",), "a", ("id",), "fk_e"), S.ForeignKey("b", ("s",), "empty", ("s",), "fk_to_empty"))


def as_set(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len({r[0] for r in rows})
    return set(rows)


def one_by_one(t):
    out = set()
    for c in (*NN, *CK, *DOM):
        out |= as_set(V.row_local_checks(t[c.table], c.table, [c]))
    for u in UQ:
        out |= as_set(V.check_unique(t[u.table], u))
    for fk in FK:
        out |= as_set(V.check_foreign_key(t[fk.child], t[fk.parent], fk))
    return out


def test_report_equals_one_query_a_constraint(spark):
    t = tables(spark)
    got = as_set(V.constraint_report(t, NN, CK, UQ, FK, DOM))
    assert got == one_by_one(t)
    assert any(v for *_, v in got) and len(got) == len(NN + CK + UQ + FK + DOM)


def test_all_keys_equal_and_no_rows(spark):
    t = tables(spark)
    same = {k: d.limit(1).crossJoin(spark.range(50)).drop("id") if k == "b" else d for k, d in t.items()}   # one hot key
    assert as_set(V.constraint_report(same, NN, CK, UQ, FK, DOM)) == one_by_one(same)
    none = {k: d.limit(0) for k, d in t.items()}
    assert {v for *_, v in as_set(V.constraint_report(none, NN, CK, UQ, FK, DOM))} == {0}


def test_one_scan_a_table_and_few_shuffles(spark, sf_dir):
    from airdata.plans.registry import fixtures_for
    from airdata.plans.constraints import _tables
    t = _tables(fixtures_for(spark, sf_dir))
    stored = {n: d.checkpoint() for n, d in t.items()}
    for df in (V.constraint_report(stored, S.NOT_NULL, S.CHECKS, S.UNIQUES, S.FOREIGN_KEYS, S.DOMAINS), V.constraint_report(stored, uniques=S.UNIQUES)):
        text = io.StringIO()
        with contextlib.redirect_stdout(text):
            df.explain(mode="formatted")
        scans = re.findall(r"^\(\d+\) Scan", text.getvalue(), re.M)
        assert len(scans) <= len(stored) and len(re.findall(r"^\(\d+\) Exchange", text.getvalue(), re.M)) <= 4
    used = ("airports", "airlines", "flights", "passengers", "bookings", "payments")
    assert pk_fk_issue_list({n: stored[n] for n in used}).count() == 12


def family(spark):
    fk = S.ForeignKey
    fks = (fk("b", ("a",), "a", ("id",), "b_a", "CASCADE"), fk("c", ("a",), "a", ("id",), "c_a", "CASCADE"),
           fk("d", ("b",), "b", ("id",), "d_b", "CASCADE"), fk("d", ("c",), "c", ("id",), "d_c", "SET NULL"),   # a diamond
           fk("e", ("d",), "d", ("id",), "e_d", "RESTRICT"), fk("f", ("c",), "c", ("id",), "f_c"), fk("f", ("code", "n"), "d", ("code", "n"), "f_d", "SET NULL"))
    t = {"a": spark.createDataFrame([(i,) for i in range(1, 6)], "id int"),
         "b": spark.createDataFrame([(1, 1), (2, 2), (3, None), (4, 4)], "id int, a int"),
         "c": spark.createDataFrame([(1, 1), (2, 2), (3, 3)], "id int, a int"),
         "d": spark.createDataFrame([(1, 1, 1, "x", 1), (2, 2, 1, "x", 2), (3, 4, 2, "y", 1), (4, None, None, None, 1), (5, 4, 1, "z", 1)], "id int, b int, c int, code string, n int"),
         "e": spark.createDataFrame([(1, 3), (2, None)], "id int, d int"),
         "f": spark.createDataFrame([(1, 3, "x", 1), (2, None, "y", 1), (3, None, None, 1)], "id int, c int, code string, n int")}
    return t, fks


def rows(d):
    return sorted((tuple(r) for r in d.collect()), key=str)


def test_deletion_over_a_diamond(spark):
    t, fks = family(spark)
    out = V.delete_rows(t, fks, {"a": spark.createDataFrame([(1,)], "id int")})
    assert rows(out["b"]) == rows(t["b"].filter("id <> 1")) and rows(out["c"]) == rows(t["c"].filter("id <> 1"))
    # d 1 goes with b 1; d 2 and d 5 lose their c; nothing else changes
    assert rows(out["d"]) == sorted([(2, 2, None, "x", 2), (3, 4, 2, "y", 1), (4, None, None, None, 1), (5, 4, None, "z", 1)], key=str)
    assert rows(out["f"]) == sorted([(1, 3, None, None), (2, None, "y", 1), (3, None, None, 1)], key=str)
    assert rows(out["e"]) == rows(t["e"]) and [c for c in out["d"].columns] == t["d"].columns


def test_refused_before_anything_changes(spark):
    t, fks = family(spark)
    try:
        V.delete_rows(t, fks, {"a": spark.createDataFrame([(4,), (3,)], "id int")})
        raise AssertionError("not refused")
    except V.Restricted as e:
        assert e.blocking == {"e_d": 1, "f_c": 1}   # d 3 goes with b 4 and e refers to it; f refers to c 3
    # a row that is asked to go as well does not forbid it
    out = V.delete_rows(t, fks, {"a": spark.createDataFrame([(4,)], "id int"), "e": spark.createDataFrame([(1,)], "id int")})
    assert rows(out["e"]) == [(2, None)] and rows(out["d"].select("id")) == [(1,), (2,), (4,)]


def test_circles_and_no_rows(spark):
    t, fks = family(spark)
    out = V.delete_rows(t, fks, {"a": spark.createDataFrame([], "id int")})
    assert all(rows(out[n]) == rows(t[n]) for n in t)
    circle = (S.ForeignKey("a", ("id",), "b", ("id",), "x", "CASCADE"), S.ForeignKey("b", ("a",), "a", ("id",), "y", "CASCADE"))
    try:
        V.delete_rows(t, circle, {"a": spark.createDataFrame([(1,)], "id int")})
        raise AssertionError("no error")
    except ValueError as e:
        assert "circle" in str(e)
