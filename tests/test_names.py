"""Queries on tiles whose names are cut to two digits, beyond a hundred strips, against their SQL."""

import duckdb
import pytest

from check import rows_of
from workload import load

SAME = ["k21_edge_ramp", "j17_tile_pair_overlap", "a15_boundary_profile", "b10_tile_lattice"]
APART = ["r8_apply_offsets", "a12_combine_clusters", "b5_merge_tile_edges"]  # their SQL mixes the tiles of a name; with names of full length it gives each tile's own result


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path = tmp_path_factory.mktemp("strips")
    duckdb.execute(
        f"""copy (select s * 100 + i as vec_id, list_transform(range(64), lambda c: cast((s * 37 + i * 11 + c * c * 7) % 400 / 64.0 - 3 as float)) as embedding
            from unnest([9, 10, 11, 99, 100, 101]) a(s), range(100) b(i)) to '{path}/embeddings.parquet' (format parquet)"""
    )
    return str(path)


def results(spark, folder, name, full_names):
    queries, oracles = load()
    d = queries[name](spark, folder)
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{folder}/embeddings.parquet'")
    sql = oracles[name]
    if full_names:
        sql = sql.replace("lpad(cast(strip_no as string), 2, '0')", "printf('%02d', strip_no)")
        sql = f"select * replace (lpad(split_part(tile_id, '_', 1), 2, '0') || '_' || split_part(tile_id, '_', 2) as tile_id) from ({sql})"
    cur = con.execute(sql)
    return rows_of(d.columns, [tuple(r) for r in d.collect()]), rows_of([c[0] for c in cur.description], cur.fetchall())


@pytest.mark.parametrize("name", SAME)
def test_tiles_of_one_name_agree_with_sql(spark, folder, name):
    got, want = results(spark, folder, name, False)
    assert got == want


@pytest.mark.parametrize("name", APART)
def test_tiles_of_one_name_stay_apart(spark, folder, name):
    got, want = results(spark, folder, name, True)
    assert got == want


def test_levelled_tiles_stay_apart(spark, folder):
    d = load()[0]["b6_level_boundaries"](spark, folder)
    assert d.groupBy("tile_id").count().count() == 12
    assert d.groupBy("tile_id", "row", "col").count().filter("count > 1").isEmpty()


def test_aligned_tiles_stay_apart(spark, folder):
    rows = load()[0]["r6_align_tiles"](spark, folder).collect()
    assert sorted(r["tile_id"] for r in rows) == sorted(f"{s:02d}_01" for s in (9, 10, 11, 99, 100, 101))
