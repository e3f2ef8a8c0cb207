import pytest

from stratafold.operators.latest import staging
from pyspark.sql import functions as F

from stratafold.plans.layers import _whole_plans, refresh, run, sources_of
from stratafold.plans.models import Model
from stratafold.sources.raw import LOAD_ID, append_load

WHEN = "2024-01-01 10:00:00"


def models(columns=("a",), version=1):
    return [
        Model("stg.t", lambda table: staging(table("raw.t"), columns), ("raw.t",), version=version),
        Model("silver.t", lambda table: table("stg.t").drop(LOAD_ID), ("stg.t",)),
    ]


def actions(steps):
    return [(s.table, s.action, s.reason) for s in steps]


@pytest.fixture
def loaded(layers, frame):
    append_load(frame([(1, 1)], "a int, b int"), layers.qualified("raw.t"), "test_first_1", WHEN)
    refresh(layers, models())
    append_load(frame([(2, 2)], "a int, b int"), layers.qualified("raw.t"), "test_second_1", WHEN)
    return layers


def test_refresh_takes_the_new_load(loaded, rows):
    steps = refresh(loaded, models())
    assert actions(steps) == [("stg.t", "build", "restated"), ("silver.t", "build", "restated")]
    assert rows(loaded.table("stg.t")) == [(2, "test_second_1")]
    assert rows(loaded.table("silver.t")) == [(2,)]


def test_without_restating_the_old_load_stays(loaded, rows):
    steps = refresh(loaded, models(), restate=False)
    assert actions(steps) == [("stg.t", "keep", "unchanged"), ("silver.t", "keep", "unchanged")]
    assert rows(loaded.table("stg.t")) == [(1, "test_first_1")]


@pytest.mark.parametrize("changed", [models(("a", "b")), models(version=2)])
def test_a_changed_model_is_rebuilt_with_its_dependents(loaded, rows, changed):
    steps = refresh(loaded, changed, restate=False)
    assert actions(steps) == [
        ("stg.t", "build", "definition changed"), ("silver.t", "build", "source rebuilt")]
    assert rows(loaded.table("stg.t"), LOAD_ID) == [("test_second_1",)]


def test_only_new_models_are_built_without_restating(loaded):
    extra = Model("silver.more", lambda table: table("stg.t"), ("stg.t",))
    steps = refresh(loaded, [*models(), extra], restate=False)
    assert [s.action for s in steps] == ["keep", "keep", "build"]


def test_dry_run_changes_nothing(loaded, rows):
    steps = refresh(loaded, models(), dry_run=True)
    assert [s.action for s in steps] == ["build", "build"]
    assert rows(loaded.table("stg.t")) == [(1, "test_first_1")]


def test_run_switches(layers, frame):
    source = {"t": frame([(1, 1)], "a int, b int")}
    both = dict(skip_ingest=True, skip_transform=True)
    assert run(layers, source, models(), "L1", WHEN, **both) == []
    planned = run(layers, source, models(), "L1", WHEN, dry_run=True)
    assert [(s.table, s.action) for s in planned] == [
        ("raw.t", "load"), ("stg.t", "build"), ("silver.t", "build")]
    assert layers.tables("raw") == [] and layers.tables("stg") == []
    run(layers, source, models(), "L1", WHEN, skip_transform=True)
    assert layers.tables("raw") == ["t"] and layers.tables("stg") == []
    run(layers, source, models(), "L2", WHEN, skip_ingest=True)
    assert layers.tables("stg") == ["t"] and layers.table("raw.t").count() == 1


def test_row_limit_of_a_run(layers, spark):
    source = {"t": spark.range(50).selectExpr("id AS a", "id AS b")}
    steps = run(layers, source, models(), "L1", WHEN, max_rows=7)
    assert steps[0].rows == 7 and layers.table("silver.t").count() == 7


def test_the_first_failure_ends_the_run(layers, frame):
    def broken(table):
        raise RuntimeError("no such column")

    bad = [models()[0], Model("silver.bad", broken, ("stg.t",)),
           Model("silver.after", lambda table: table("silver.bad"), ("silver.bad",))]
    with pytest.raises(RuntimeError, match="no such column"):
        run(layers, {"t": frame([(1, 1)], "a int, b int")}, bad, "L1", WHEN)
    assert layers.tables("stg") == ["t"] and layers.tables("silver") == []


def test_tables_of_a_layer(layers, spark, frame):
    layers.replace(frame([(1,)], "b int"), "silver.zz")
    layers.replace(frame([(1,)], "a int"), "silver.aa")
    spark.sql(f"CREATE VIEW {layers.qualified('silver.v')} AS SELECT * FROM "
              f"{layers.qualified('silver.aa')}")
    frame([(1,)], "a int").createOrReplaceTempView("passing_by")
    assert layers.tables("silver") == ["aa", "zz"]
    assert {name: df.columns for name, df in layers.frames("silver").items()} == {
        "aa": ["a"], "zz": ["b"]}


def test_reset_drops_everything(layers, spark, frame):
    layers.replace(frame([(1,)], "a int"), "silver.t")
    layers.reset()
    assert not spark.catalog.databaseExists(layers.qualified("silver"))
    layers.reset()
    layers.create()
    assert layers.tables("silver") == []


# --- only what a new load touches --------------------------------------------------------------------

def two_sources():
    def staged(name):
        return Model(f"stg.{name}", lambda table: staging(table(f"raw.{name}"), ["a"]), (f"raw.{name}",))

    return [staged("t"), staged("u"),
            Model("silver.t", lambda table: table("stg.t").select("a"), ("stg.t",)),
            Model("silver.u", lambda table: table("stg.u").select("a"), ("stg.u",)),
            Model("silver.both", lambda table: table("silver.t").union(table("stg.u").select("a")),
                  ("silver.t", "stg.u"))]


def load(layers, frame, name, value, load_id):
    append_load(frame([(value,)], "a int"), layers.qualified(f"raw.{name}"), load_id, WHEN)


@pytest.fixture
def two(layers, frame):
    for name, value in (("t", 1), ("u", 2)):
        load(layers, frame, name, value, "L1")
    refresh(layers, two_sources())
    return layers


def newly(layers, **more):
    return {s.table: s.action for s in refresh(layers, two_sources(), restate=False, new_loads=True, **more)}


def test_sources_below_each_model():
    assert sources_of(two_sources()) == {
        "stg.t": ("raw.t",), "stg.u": ("raw.u",), "silver.t": ("raw.t",), "silver.u": ("raw.u",),
        "silver.both": ("raw.t", "raw.u")}


def test_a_new_load_builds_what_lies_above_it(two, frame, rows):
    assert set(newly(two).values()) == {"keep"}
    load(two, frame, "t", 10, "L2")
    built = {"stg.t": "build", "stg.u": "keep", "silver.t": "build", "silver.u": "keep", "silver.both": "build"}
    assert newly(two, dry_run=True) == built and rows(two.table("silver.both")) == [(1,), (2,)]
    assert newly(two) == built
    found = {name: rows(two.table(name)) for name in built}
    refresh(two, two_sources())
    assert found == {name: rows(two.table(name)) for name in built}
    assert found["silver.both"] == [(2,), (10,)]
    assert set(newly(two).values()) == {"keep"}


def test_a_load_written_again_counts_as_new(two, frame, rows):
    load(two, frame, "u", 20, "L1")
    assert newly(two)["silver.u"] == "build" and rows(two.table("silver.both")) == [(1,), (20,)]


def test_a_table_left_behind_is_caught_up(two, frame, rows):
    """Staging saw the load, the target did not, as after a run that failed in between."""
    load(two, frame, "u", 30, "L2")
    staged = [m for m in two_sources() if m.name == "stg.u"]
    refresh(two, staged)
    assert newly(two) == {"stg.t": "keep", "stg.u": "keep", "silver.t": "keep", "silver.u": "build",
                          "silver.both": "build"}
    assert rows(two.table("silver.u")) == [(30,)]


def test_a_source_without_marks_is_always_built(layers, spark, frame, rows):
    frame([(1,)], "a int").write.saveAsTable(layers.qualified("raw.plain"))
    model = [Model("silver.plain", lambda table: table("raw.plain"), ("raw.plain",))]
    refresh(layers, model)
    assert [s.reason for s in refresh(layers, model, restate=False, new_loads=True)] == ["new load of raw.plain"]


def entries(layers):
    return [t for t in layers.spark.catalog.listTables(layers.qualified("silver")) if not t.isTemporary]


# --- replaced whole or not at all ------------------------------------------------------------------------

def test_a_failed_rebuild_leaves_the_old_rows(layers, spark, frame, rows):
    layers.replace(frame([(1, "a"), (2, "b")], "a int, b string"), "silver.t")
    bad = spark.range(100).select(F.when(F.col("id") == 77, F.raise_error(F.lit("broken row"))).otherwise("x").alias("z"))
    with pytest.raises(Exception, match="broken row"):
        layers.replace(bad, "silver.t")
    assert rows(layers.table("silver.t")) == rows(spark.table(layers.qualified("silver.t"))) == [(1, "a"), (2, "b")]
    assert layers.tables("silver") == ["t"]
    assert len(entries(layers)) == 2  # the view and its one version


def test_readers_keep_the_rows_they_began_with(layers, spark, frame, rows):
    layers.replace(frame([(1,)], "a int"), "silver.t")
    reader = layers.table("silver.t")
    layers.replace(frame([("x", 2.5)], "b string, c double"), "silver.t")
    assert rows(reader) == [(1,)]
    assert rows(spark.table(layers.qualified("silver.t"))) == [("x", 2.5)]
    layers.replace(layers.table("silver.t").select("b"), "silver.t")  # from its own rows
    assert rows(layers.table("silver.t")) == [("x",)] and layers.table("silver.t").columns == ["b"]
    assert len(entries(layers)) == 3  # the view, this version and the one before
    layers.drop_previous("silver.t")
    assert len(entries(layers)) == 2


def test_a_plain_table_becomes_a_versioned_one(layers, spark, frame, rows):
    frame([(1,)], "a int").write.saveAsTable(layers.qualified("silver.t"))
    assert layers.tables("silver") == ["t"] and rows(layers.table("silver.t")) == [(1,)]
    layers.replace(frame([(2,)], "a int"), "silver.t")
    assert layers.tables("silver") == ["t"] and rows(layers.table("silver.t")) == [(2,)]


def test_plan_setting_is_put_back_by_the_last_refresh(layers, spark):
    key = "spark.sql.debug.maxToStringFields"
    before = spark.conf.get(key)
    with _whole_plans(spark):
        with _whole_plans(spark):
            pass
        assert spark.conf.get(key) == "100000"
    assert spark.conf.get(key) == before


def test_stored_tables_are_compressed_with_zstd(layers, frame):
    run(layers, {"t": frame([(1, 1)], "a int, b int")}, models(), "L1", WHEN)
    for name in ("raw.t", "stg.t", "silver.t"):
        files = layers.table(name).inputFiles()
        assert files and all(".zstd." in file for file in files)
