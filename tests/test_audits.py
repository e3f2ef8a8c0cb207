import pytest
from pyspark.sql import functions as F

from stratafold.contract import TableContract
from stratafold.operators import audits
from stratafold.operators.audits import Audit, all_passed, audits_for, summarise
from stratafold.plans.suite import target_audits


@pytest.fixture
def tables(frame):
    return {
        "child": frame([(1, "ok", 1), (2, "éééé", 9), (2, "long text", 9), (None, None, None),
                        (None, "x", 3)], "id int, name string, parent_id int"),
        "parent": frame([(1,), (1,), (None,)], "pid int"),
    }


SUITE = [
    Audit("child", "a_null", "pk_not_null", "id"), Audit("child", "a_unique", "pk_unique", "id"),
    Audit("child", "a_len", "max_length", "name", limit=4),
    Audit("child", "a_fk", "fk_orphan", "parent_id", parent=("parent", "pid")),
    Audit("parent", "b_unique", "pk_unique", "pid"),
]


def test_violating_rows(tables, rows):
    child, parent = tables["child"], tables["parent"]
    assert rows(audits.pk_not_null(child, "id")) == [(None, None, None), (None, "x", 3)]
    assert rows(audits.pk_unique(child, "id")) == [(None, 2), (2, 2)]
    assert rows(audits.max_length(child, "name", 4)) == [(2, "long text", 9)]
    assert rows(audits.fk_orphans(child, "parent_id", parent, "pid")) == [
        (None, "x", 3), (2, "long text", 9), (2, "éééé", 9)]
    assert rows(audits.pk_unique(child, "id", "parent_id")) == [(2, 9, 2)]


def test_summary_counts_what_the_audits_return(tables):
    found = {r.audit: (r.violations, r.passed) for r in summarise(tables, SUITE).collect()}
    single = {a.name: a.violations(tables).count() for a in SUITE}
    assert found == {name: (n, n == 0) for name, n in single.items()}
    assert not all_passed(summarise(tables, SUITE)).first().passed


def test_summary_of_empty_tables_passes(tables):
    empty = {name: df.limit(0) for name, df in tables.items()}
    summary = summarise(empty, SUITE)
    assert {r.violations for r in summary.collect()} == {0}
    assert all_passed(summary).first().passed


def test_one_scan_per_table_for_keys_nulls_and_lengths(layers, tables, capsys):
    layers.replace(tables["child"], "silver.child")
    summarise({"child": layers.table("silver.child")}, SUITE[:3]).explain()
    plan = capsys.readouterr().out
    assert plan.count("FileScan") == 1
    assert plan.count("Exchange hashpartitioning") == 1


def test_audits_follow_from_a_contract():
    contract = TableContract.of(
        "t", [("id", "INTEGER"), ("a", "VARCHAR(5)"), ("b", "VARCHAR(9)"), ("c", "TEXT")],
        pk=["id"], references=[("a", "gone", "x"), ("b", "p", "x")])
    names = [a.name for a in audits_for(contract, {"p": "pid"})]
    assert names == ["assert_t_pk_not_null", "assert_t_pk_unique", "assert_t_a_max_length",
                     "assert_t_b_max_length", "assert_fk_t_p"]
    moved = audits_for(contract, {"p": "pid"}, lengths={"b": "short"}, targets={"a": "p", "b": ""})
    assert [(a.name, a.limit, a.parent) for a in moved[2:]] == [
        ("assert_t_short_max_length", 9, None), ("assert_fk_t_p", None, ("p", "pid"))]
    pair = TableContract.of("t", [("id", "INTEGER"), ("v", "INTEGER")], pk=["id", "v"])
    assert [(a.kind, a.column) for a in audits_for(pair)] == [
        ("pk_not_null", "id"), ("pk_not_null", "v"), ("pk_unique", "id, v")]


def test_composite_keys_in_the_summary(frame):
    pair = TableContract.of("t", [("id", "INTEGER"), ("v", "INTEGER")], pk=["id", "v"])
    df = frame([(1, 1), (1, 2), (1, 2), (None, 2)], "id int, v int")
    found = {(r.kind, r.column_name): r.violations
             for r in summarise({"t": df}, audits_for(pair)).collect()}
    assert found == {("pk_not_null", "id"): 1, ("pk_not_null", "v"): 0, ("pk_unique", "id, v"): 1}


def test_the_shipped_suite():
    suite = target_audits()
    kinds = [a.kind for a in suite]
    assert len(suite) == len({a.name for a in suite}) == 24
    assert [kinds.count(k) for k in ("pk_not_null", "pk_unique", "max_length", "fk_orphan")] == [
        6, 6, 7, 5]
    limits = {(a.table, a.column): a.limit for a in suite if a.kind == "max_length"}
    assert limits == {
        ("beschikking", "code"): 20, ("beschikking", "commentaar"): 200,
        ("beschikte_voorziening", "status"): 50, ("client", "code"): 80,
        ("medewerker", "functie"): 50, ("medewerker", "achternaam"): 200,
        ("medewerker", "telefoonnummer"): 20}
    assert {a.name: a.parent for a in suite if a.kind == "fk_orphan"} == {
        "assert_fk_beschikking_client": ("client", "rechtspersoon_id"),
        "assert_fk_beschikking_beschikte_voorziening":
            ("beschikte_voorziening", "beschikte_voorziening_id"),
        "assert_fk_beschikte_voorziening_wet_enum": ("wet_enum", "wet_enum_id"),
        "assert_fk_declaratieregel_client": ("client", "rechtspersoon_id"),
        "assert_fk_declaratieregel_beschikking": ("beschikking", "beschikking_id")}


def test_measured_audits_are_not_counted_again(layers, spark, frame, rows):
    """Nulls and lengths come from the write; only keys and references are read."""
    suite = [Audit("t", "has_key", "pk_not_null", "k"), Audit("t", "one_key", "pk_unique", "k"),
             Audit("t", "short", "max_length", "s", limit=2), Audit("t", "known", "fk_orphan", "p", parent=("u", "u")),
             Audit("u", "u_key", "pk_not_null", "u")]
    t = frame([(1, "abc", 1), (1, "ab", 9), (None, None, None), (2, "abcd", 1)], "k int, s string, p int")
    tables = {"silver.t": t, "silver.u": frame([(1,), (None,)], "u int")}
    layers.replace_all(tables, suite)
    measured = layers.measured("silver")
    assert {key.split("|")[1]: n for key, n in measured.items()} == {"has_key": 1, "short": 2, "u_key": 1}
    found = summarise(layers.frames("silver"), suite, measured)
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    read = [line for line in plan(found).split("\n") if "FileScan" in line]
    assert len(read) == 3 and not any("s#" in line.split("[", 1)[1].split("]")[0] for line in read)
    assert plan(summarise(layers.frames("silver"), suite)).count("FileScan") == 4
    assert rows(found) == rows(summarise(layers.frames("silver"), suite))
    other = [Audit("t", "short", "max_length", "s", limit=3)]  # another limit was not measured
    assert rows(summarise(layers.frames("silver"), other, measured), "violations") == [(1,)]


def test_measures_of_no_rows(layers, frame):
    layers.replace(frame([], "k int"), "silver.t", audits=[Audit("t", "has_key", "pk_not_null", "k")])
    assert list(layers.measured("silver").values()) == [0]


@pytest.mark.parametrize("most", [audits.MOST_REPEATED, 0])
def test_repeated_keys_are_those_of_one_grouping(spark, rows, monkeypatch, most):
    data = [(i % 7 if i % 5 else None, None if i % 11 == 0 else "t" * (i % 3), i / 2 * (-1) ** i) for i in range(90)]
    data += [(1, "once", 0.0), (2, "zero", 0.0), (2, "zero", -0.0), (3, "nan", float("nan")), (3, "nan", float("nan"))]
    data += [(4, "hot", 1.0)] * 500
    df = spark.createDataFrame(data, "k int, _hash string, v double")
    for pk in (["k", "_hash"], ["_hash"], ["k", "_hash", "v"], ["v"]):
        want = [repr(r) for r in rows(audits.pk_unique(df, *pk))]
        assert want and [repr(r) for r in rows(audits.repeated_keys(df, *pk, most=most))] == want
    monkeypatch.setattr(audits, "_key_hash", lambda pk: F.xxhash64(F.col(pk[0]).isNull()))  # nearly all collide
    assert rows(audits.repeated_keys(df, "k", "_hash")) == rows(audits.pk_unique(df, "k", "_hash"))
    assert audits.repeated_keys(df.limit(0), "k").count() == 0


def test_repeated_keys_move_only_suspects(spark):
    df = spark.range(1000).selectExpr("id", "repeat(cast(id as string), 50) as t")
    plan = audits.repeated_keys(df, "id", "t")._jdf.queryExecution().toString()
    assert "BroadcastHashJoin" in plan and "LeftSemi" in plan and "SortMergeJoin" not in plan
