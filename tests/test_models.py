"""The shipped models on the small fixture: rows as the plain SQL joins give them."""

import random
import re
from datetime import date

import duckdb
import pytest
from pyspark.sql import functions as F

from stratafold.operators.audits import summarise
from stratafold.operators.conformance import conforms, schema_diff, schema_rows
from stratafold.plans import contracts, oracle
from stratafold.plans.layers import refresh, run
from stratafold.plans.models import all_models, target_models, unstored
from stratafold.plans.star_schema import exact_sum
from stratafold.plans.suite import target_audits
from stratafold.sources.raw import LOAD_ID, LOAD_TIME, stamp

WHEN = "2024-01-01 10:00:00"
N = 10


def fixture_rows(seed=123):
    rng = random.Random(seed)
    decisions = [(1000 + i, rng.randint(1, N)) for i in range(1, N + 1)]
    pairs = [(nr, client, line) for nr, client in decisions for line in (1, 2)]
    return {
        "szclient": [(i, str(rng.randint(0, 1))) for i in range(1, N + 1)],
        "szregel": [("1", "JEUGDWET"), ("2", "WMO")],
        "abc_refcod": [("EINDE_JZG", "JZG_REDEN_EINDE_PRODUCT", "Einde JZG"),
                       ("EINDE_WMO", "WVRTEIND", "Einde WMO")],
        "wvbesl": decisions,
        "wvind_b": [(nr, line, client, "2024-01-05T00:00:00", "2024-02-05T00:00:00",
                     float(rng.choice([1, 5, 10, 20])), rng.choice(["ACTIEF", "GESLOTEN"]),
                     str(rng.randint(1, 2))) for nr, client, line in pairs],
        "wvdos": [(nr, line, str(nr * 10 + line), rng.choice(["EINDE_JZG", "EINDE_WMO"]))
                  for nr, _, line in pairs],
        "szukhis": [(str(nr * 10 + line), rng.choice([25.0, 50.5, 75.25]), i + 1)
                    for i, (nr, _, line) in enumerate(pairs)],
        "szwerker": [(str(i), name, "JWG", "a@example.org", "X", "synthetic", "06-12345678")
                     for i, name in enumerate(["Jan", "Piet", "Anna", "Sanne", "Luka"], 1)],
    }


def columns(name):
    return [c for c in contracts.RAW[name].columns if c.name not in (LOAD_ID, LOAD_TIME)]


def frames(spark, data):
    return {name: spark.createDataFrame(
        rows, ", ".join(f"{c.name} {c.type.simpleString()}" for c in columns(name)))
        for name, rows in data.items()}


def built(spark, data, wide=False):
    found = frames(spark, data)
    return unstored(all_models(wide), lambda name: stamp(found[name.split(".")[1]], "L1", WHEN))


def expected(data, table):
    """The target table from the plain SQL of the joins, over the same rows."""
    con = duckdb.connect()
    types = {"INTEGER": "BIGINT", "VARCHAR": "VARCHAR", "DECIMAL": "DOUBLE"}
    for name, rows in data.items():
        declared = ", ".join(f"{c.name} {types[c.canonical]}" for c in columns(name))
        con.execute(f"CREATE TABLE {name} ({declared})")
        if rows:
            con.executemany(f"INSERT INTO {name} VALUES ({', '.join('?' * len(rows[0]))})", rows)
    sql = dict(oracle._TARGETS)[table][1]
    return con.sql(sql).columns, con.sql(sql).fetchall()


def key(row):
    return [(v is not None, v) for v in row]


@pytest.mark.parametrize("table", list(contracts.TARGETS.contracts))
def test_targets_on_the_fixture(spark, table):
    data = fixture_rows()
    df = built(spark, data)(f"silver.{table}")
    names, want = expected(data, table)
    found = [tuple(r) for r in df.select(*names).collect()]
    assert sorted(found, key=key) == sorted(want, key=key)
    assert df.columns == contracts.TARGETS.contracts[table].names


def test_row_counts_of_the_fixture(spark):
    table = built(spark, fixture_rows())
    counts = {name: table(f"silver.{name}").count() for name in contracts.TARGETS.contracts}
    assert counts == {"beschikking": N, "beschikte_voorziening": 2 * N, "client": N,
                      "declaratieregel": 2 * N, "medewerker": 5, "wet_enum": 2}


def test_audits_of_the_fixture_all_pass_but_one(spark):
    table = built(spark, fixture_rows())
    tables = {name: table(f"silver.{name}") for name in contracts.TARGETS.contracts}
    failed = {r.audit: r.violations for r in summarise(tables, target_audits()).collect()
              if not r.passed}
    assert failed == {"assert_fk_beschikking_beschikte_voorziening": N}


def test_models_conform_to_their_contracts(spark):
    table = built(spark, fixture_rows())
    tables = {name: table(f"silver.{name}") for name in contracts.TARGETS.contracts}
    diff = schema_diff(spark, contracts.TARGETS.select(), schema_rows(spark, tables))
    assert {r.status for r in diff.collect()} == {"ok"} and conforms(diff, "models")


def messy_rows():
    """Repeated keys on every side, missing laws and codes, and one very hot decision."""
    rng = random.Random(5)

    def nr():
        return 1001 if rng.random() < 0.4 else rng.randint(1001, 1012)

    return fixture_rows() | {
        "szregel": [("1", "JEUGDWET"), ("1", "WMO"), ("2", "WMO"), ("3", None), ("2", "WMO")],
        "abc_refcod": [("EINDE_JZG", "JZG_REDEN_EINDE_PRODUCT", "a"),
                       ("EINDE_JZG", "JZG_REDEN_EINDE_PRODUCT", "b"), ("EINDE_WMO", "WVRTEIND", "c"),
                       ("EINDE_JZG", "WVRTEIND", "d"), ("EINDE_WMO", "OTHER", "e")],
        "wvbesl": [(nr(), 1) for _ in range(15)],
        "wvind_b": [(nr(), rng.randint(1, 2), rng.choice([1, None]), "2024-01-05T00:00:00", None,
                     rng.choice([2.5, 3.5, 2.7, -2.5, None]), f"s{i}",
                     rng.choice(["1", "2", "3", "4", None])) for i in range(120)],
        "wvdos": [(nr(), rng.randint(1, 2), str(rng.randint(1, 30)),
                   rng.choice(["EINDE_JZG", "EINDE_WMO", "NONE", None])) for _ in range(40)],
        "szukhis": [(str(rng.randint(1, 30)), 1.5, i) for i in range(60)],
    }


@pytest.mark.parametrize("table", ["beschikte_voorziening", "declaratieregel"])
def test_joins_with_repeated_and_missing_keys(spark, table):
    data = messy_rows()
    names, want = expected(data, table)
    found = [tuple(r) for r in built(spark, data)(f"silver.{table}").select(*names).collect()]
    assert len(found) == len(want) > 200
    assert sorted(found, key=key) == sorted(want, key=key)


def test_provision_without_numbers_or_decisions(spark):
    """Decisions count for indications without a number too; those without a decision meet none."""
    data = messy_rows()
    rng = random.Random(6)
    data["wvind_b"] = [(*rng.choice([(nr, line), (nr, None), (None, line)]), *rest)
                       for nr, line, *rest in data["wvind_b"]]
    data["wvbesl"] += [(None, 1)] * 4
    data["wvdos"] += [(None, 1, "7", "EINDE_WMO"), (1001, None, "8", "EINDE_WMO"), (None, None, "9", None)] * 3
    for table in ("beschikte_voorziening", "declaratieregel"):
        names, want = expected(data, table)
        found = [tuple(r) for r in built(spark, data)(f"silver.{table}").select(*names).collect()]
        assert sorted(found, key=key) == sorted(want, key=key) and found


def test_pairs_are_shuffled_only_if_a_decision_stands_twice(spark):
    """Decisions that stand once add no rows, so the pairs wait for a count of the others."""
    for more in ([], [(1001, 1)], [(1001, 1)] * 2 + [(1002, 1)]):
        data = fixture_rows()
        data["wvbesl"] = data["wvbesl"] + more
        df = built(spark, data)("silver.beschikte_voorziening")
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert re.search(r"scalar-subquery#\d+ \[[^\]]*\] > 0", plan)
        names, want = expected(data, "beschikte_voorziening")
        found = [tuple(r) for r in df.select(*names).collect()]
        assert len(found) == 2 * (N + len(more)) and sorted(found, key=key) == sorted(want, key=key)


def test_sums_of_amounts_are_exact_and_narrow(spark):
    rng = random.Random(3)
    most = "9999999999999999.99"
    data = [(1, most)] * 40 + [(2, "-" + most)] * 3 + [(2, "0.01"), (3, None), (4, None), (4, "-0.07")]
    data += [(i, f"{rng.choice(['', '-'])}{rng.randrange(10 ** (i % 17))}.{rng.randrange(100):02d}")
             for i in range(5, 300) for _ in range(5)]
    rows = spark.createDataFrame(data, "k int, v string").select("k", F.col("v").cast("decimal(18,2)").alias("v"))
    found = rows.groupBy("k").agg(exact_sum(F.col("v")).alias("total"))
    want = rows.groupBy("k").agg(F.sum("v").alias("want"))
    both = found.join(want, "k").select("*", (F.col("total").cast("double").eqNullSafe(
        F.col("want").cast("double"))).alias("same")).collect()
    assert len(both) == 299 and all(r.same and r.total == r.want for r in both)
    partial = found._jdf.queryExecution().executedPlan().toString().split("Exchange")[1]
    assert "partial_sum" in partial and "isEmpty" not in partial  # no DECIMAL is summed


def test_dates_and_rounding(spark):
    data = fixture_rows() | {"wvind_b": [
        (1001, i, 1, "2024-03-31T02:30:00", "2024-12-31T23:59:59", v, "s", "1")
        for i, v in enumerate([2.5, 3.5, 2.7, -2.5, None])]}
    table = built(spark, data)
    found = table("silver.beschikte_voorziening").orderBy("beschikte_voorziening_id").collect()
    assert [r.omvang for r in found] == [2, 4, 3, -2, None]
    assert {(r.datumstart, r.datumeinde) for r in found} == {(date(2024, 3, 31), date(2024, 12, 31))}


def test_wide_contracts_hold_keys_beyond_int(spark):
    data = fixture_rows() | {"wvbesl": [(9_000_000_000, 1)]}
    with pytest.raises(Exception, match="CAST_OVERFLOW"):
        built(spark, data)("silver.beschikking").collect()
    assert built(spark, data, wide=True)("silver.beschikking").first().beschikking_id == 9_000_000_000


def test_stored_run(layers, spark):
    steps = run(layers, frames(spark, fixture_rows()), all_models(loads=layers.loads), "L1", WHEN)
    assert [s.action for s in steps] == ["load"] * 8 + ["build"] * 14
    assert {s.table: s.rows for s in steps[:8]}["raw.wvdos"] == 2 * N
    assert layers.tables("silver") == sorted(contracts.TARGETS.contracts)
    assert layers.table("silver.declaratieregel").count() == 2 * N
    diff = schema_diff(spark, contracts.TARGETS.select(),
                       schema_rows(spark, layers.frames("silver")))
    assert conforms(diff, "stored")
    assert {m.name: m.reads for m in target_models()}["silver.declaratieregel"] == (
        "stg.wvind_b", "stg.wvdos", "stg.szukhis")


def test_plans_have_no_nested_loops(spark, capsys):
    table = built(spark, fixture_rows())
    for name in contracts.TARGETS.contracts:
        table(f"silver.{name}").explain()
    plan = capsys.readouterr().out
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "Python" not in plan


def test_building_models_and_dry_runs_start_no_job(layers, spark):
    run(layers, frames(spark, fixture_rows()), all_models(loads=layers.loads), "L1", WHEN)
    spark.sparkContext.setJobGroup("dry", "dry run")
    try:
        steps = refresh(layers, all_models(), restate=False, dry_run=True)
        for model in target_models():
            model.build(layers.table)
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("dry")
    finally:
        spark.sparkContext._jsc.clearJobGroup()
    assert steps and not jobs
