"""Every registered query of the tidal operators against its SQL in DuckDB, on the smallest tables."""

import math

import duckdb
import pandas as pd
import pytest

from saltmesh import catalog
from saltmesh.fixtures import Fixtures
from saltmesh.operators import derive

catalog.load()
TABLES = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(v):
    if v is None or v is pd.NaT or v is pd.NA:
        return None
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6) + 0.0
    return v if isinstance(v, int | str | bool) else str(v)


def rows(df):
    names = sorted(df.columns)
    return names, sorted((tuple(plain(v) for v in r) for r in df[names].itertuples(index=False)), key=repr)


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_same_rows(name, spark, duck, sf_dir):
    assert rows(catalog.QUERIES[name](spark, sf_dir).toPandas()) == rows(duck.execute(catalog.SQL[name]).df())


# Whole jobs, with the column and number of keys that they hold at sf0.01: no prefix of suppliers, steps or faces.
WHOLE = {
    "jn_11_along_line": ("sid", 100), "top_2_closest_on_line": ("sid", 100), "set_6_distinct_cells": (None, None), "jn_21_point_series": ("t", 300),
    "win_7_trimmed_transect": ("line", 5), "api_13_export_year": ("face", 50), "jn_6_padded_year": ("face", 50),
}


@pytest.mark.parametrize("name", sorted(WHOLE))
def test_whole_jobs(name, spark):
    larger = "/root/testdata/sf0.01"
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{larger}/{t}.parquet'")
    got = catalog.QUERIES[name](spark, larger).toPandas()
    assert rows(got) == rows(con.execute(catalog.SQL[name]).df())
    key, n = WHOLE[name]
    assert key is None or got[key].nunique() == n


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.SQL)))
def test_runs(name, spark, sf_dir):
    assert catalog.QUERIES[name](spark, sf_dir).count() > 0


def test_no_cartesian_product_in_lookups(spark, sf_dir):
    for name in ("jn_8_nearest_point", "jn_9_nearest_k", "jn_12_point_in_polygon", "jn_14_nearest_shore", "jn_17_point_in_triangle"):
        plan = catalog.QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


@pytest.mark.parametrize("name", ["jn_11_along_line", "set_6_distinct_cells", "top_2_closest_on_line"])
def test_marked_cells_are_not_broadcast(name, spark):
    plan = catalog.QUERIES[name](spark, "/root/testdata/sf0.1")._jdf.queryExecution().executedPlan().toString()
    assert "BuildRight" in plan and "BuildLeft" not in plan


# Points on edges of the polygons but for rounding, and on the southern edges of the bands.
ON_EDGE = [2497, 21166, 32954, 53423, 54282, 73892, 74522, 12485, 22966, 37724, 42942, 43435, 63904, 83880, 94361, 104349, 114087, 114337, 114830, 124818, 126963, 130645, 135299, 147203, 150885, 167443, 207008, 221676, 223566, 92248, 94833, 97418, 192251, 194836, 197421]


@pytest.fixture(scope="module")
def edges_dir(tmp_path_factory, sf_dir):
    folder = tmp_path_factory.mktemp("edges")
    pd.DataFrame({"c_custkey": ON_EDGE}).astype("int64").to_parquet(folder / "customer.parquet")
    duckdb.sql(f"COPY (SELECT * FROM '{sf_dir}/nation.parquet') TO '{folder}/nation.parquet'")
    return str(folder)


@pytest.mark.parametrize("name", ["api_17_jurisdiction", "api_18_island_jurisdictions", "flt_37_overlapping_states", "jn_12_point_in_polygon", "jn_13_all_layers", "scl_46_containing_domains", "scl_16_jurisdiction", "scl_17_island_jurisdiction", "scl_18_containing_names"])
def test_points_on_edges(name, spark, edges_dir):
    con = duckdb.connect()
    for t in ("customer", "nation"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{edges_dir}/{t}.parquet'")
    assert rows(catalog.QUERIES[name](spark, edges_dir).toPandas()) == rows(con.execute(catalog.SQL[name]).df())


def test_many_files_give_the_faces_of_all_strips(spark, sf_dir, tmp_path):
    """Orders of the first and second strip of the series."""
    con = duckdb.connect()
    con.execute(f"COPY (SELECT * REPLACE (o_orderkey + 15000 * (o_orderkey // 50 % 2) AS o_orderkey) FROM '{sf_dir}/orders.parquet') TO '{tmp_path}/orders.parquet'")
    con.execute(f"COPY (SELECT * FROM '{sf_dir}/region.parquet') TO '{tmp_path}/region.parquet'")
    for t in ("orders", "region"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet'")
    got = catalog.QUERIES["src_5_many_files"](spark, str(tmp_path)).toPandas()
    assert rows(got) == rows(con.execute(catalog.SQL["src_5_many_files"]).df()) and got["face"].max() > 50


def test_attributes_of_far_strips(spark, sf_dir, tmp_path):
    """Every five-hundredth strip begins a row of the mesh, where centres lie on edges of the polygons but for rounding; of most faces here no node has a surface."""
    strips = [0, 500, 1000, 1500, 2000, 2500, 3000]
    keys = sorted({k for s in strips for k in (*range(s * 50, s * 50 + 50), *range(s * 36, s * 36 + 36), *range(s * 15000, s * 15000 + 100))})
    pd.DataFrame({"o_orderkey": keys}).astype("int64").to_parquet(tmp_path / "orders.parquet")
    con = duckdb.connect()
    for t in ("customer", "nation"):
        con.execute(f"COPY (SELECT * FROM '{sf_dir}/{t}.parquet') TO '{tmp_path}/{t}.parquet'")
    for t in ("customer", "nation", "orders"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet'")
    got = catalog.QUERIES["api_4_face_attributes"](spark, str(tmp_path)).toPandas()
    assert rows(got) == rows(con.execute(catalog.SQL["api_4_face_attributes"]).df()) and set(strips) <= set(got["face"] // 50)
    fx = Fixtures(spark, str(tmp_path))
    assert fx.face.count() > len(got) == derive.faces_of_nodes(fx.face, fx.zeta).count()


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    plan = catalog.QUERIES["set_4_changed_not_allowed"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<c_custkey:bigint>" in plan


def test_entry():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert "face_summary" in entry.queries()
