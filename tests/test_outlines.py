"""Strips that share an outline: it is worked out once, and every strip keeps its own result."""

import duckdb
import pytest
from pyspark.sql import functions as F

from check import rows_of
from reliefgrid.operators import footprints as fp
from workload import load
from workload.inputs import Inputs

NAMES = ["a3_overlap_counts", "j5_exclude_masks", "b9_replay_reviews", "b8_cluster_cells", "flagship_tile_mosaic"]


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path = tmp_path_factory.mktemp("orders")
    # keys 12,000 apart have one corner, equal customers one width
    duckdb.execute(
        f"""copy (select cast(k * 7 + c * 12000 as bigint) as o_orderkey, cast(k as bigint) as o_custkey, 'O' as o_orderstatus,
                  cast((k * 17 + c * 31) % 60 * 1000 + 500 as double) as o_totalprice, date '1995-03-01' as o_orderdate, concat(1 + (k + c) % 5, '-X') as o_orderpriority
            from range(60) a(k), range(6) b(c)) to '{path}/orders.parquet' (format parquet)"""
    )
    return str(path)


def test_each_outline_is_one_row(spark, folder):
    f = Inputs(spark, folder).get("footprint")
    once, of = fp.by_outline(f)
    assert (f.count(), once.count(), of.count(), of.select("strip_id").distinct().count()) == (360, 60, 360, 360)
    null = f.limit(1).withColumn("poly", F.lit(None).cast(f.schema["poly"].dataType))
    assert fp.by_outline(null)[1].count() == 1


@pytest.mark.parametrize("name", NAMES)
def test_shared_outlines_agree_with_sql(spark, folder, name):
    queries, oracles = load()
    d = queries[name](spark, folder)
    con = duckdb.connect()
    con.execute(f"create view orders as select * from '{folder}/orders.parquet'")
    cur = con.execute(oracles[name])
    assert rows_of(d.columns, [tuple(r) for r in d.collect()]) == rows_of([c[0] for c in cur.description], cur.fetchall())
