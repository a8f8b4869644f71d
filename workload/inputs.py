"""Rasters, footprints, points and reports derived from the given tables.

Each input is defined twice: as a Spark DataFrame and as a SQL common table
expression for the oracle.  Values are binary fractions so that sums agree in
any order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reliefgrid.functions import polygon as pg
from reliefgrid.session import bounded_tasks

# ---- texts both engines run ------------------------------------------------

SQL: dict[str, str] = {
    "gcp": """
      select l_orderkey*8 + l_linenumber as src, cast((l_partkey%64)*8 + l_linenumber as double) as x,
             cast(-((l_suppkey*4+l_orderkey)%340)*8 as double) as y,
             1e2 + floor(l_extendedprice/64e0)/64e0 as z, cast(l_shipdate as timestamp) as t
      from lineitem""",
    "control": """
      select cast((l_partkey*53 + l_linenumber*7)%4200 as double)*1e2 + 5e1 as x,
             cast((l_suppkey*37 + l_orderkey*11)%3300 as double)*1e2 + 25e0 as y,
             1e2 + floor(l_extendedprice/64e0)/64e0 as z, cast(l_shipdate as date) as t
      from lineitem""",
    "footprint": """
      select cast(o_orderkey as bigint) as strip_no, concat('s', cast(o_orderkey as string)) as strip_id,
             cast(o_orderdate as date) as strip_date,
             cast(substring(o_orderpriority,1,1) as int) as qc, o_orderstatus as region,
             (o_orderkey*37)%4000*1e2 as xmin, (o_orderkey*91)%3000*1e2 as ymin,
             (o_orderkey*37)%4000*1e2 + 5e3 + (o_custkey%40)*5e2 as xmax,
             (o_orderkey*91)%3000*1e2 + 2e4 as ymax,
             floor(o_totalprice/1e3)/64e0 as rmse
      from orders""",
    "tiles": """
      select distinct cast(floor((o_orderkey*91)%3000*1e2/8e4) as int) as tile_row,
             cast(floor((o_orderkey*37)%4000*1e2/1e5) as int) as tile_col,
             concat('0', cast(cast(floor((o_orderkey*91)%3000*1e2/8e4) as int) as string), '_0',
                    cast(cast(floor((o_orderkey*37)%4000*1e2/1e5) as int) as string)) as tile_id,
             floor((o_orderkey*37)%4000*1e2/1e5)*1e5 as x0, floor((o_orderkey*37)%4000*1e2/1e5)*1e5 + 1e5 as x1,
             floor((o_orderkey*91)%3000*1e2/8e4)*8e4 as y0, floor((o_orderkey*91)%3000*1e2/8e4)*8e4 + 8e4 as y1
      from orders""",
    "strip_scene": """
      select cast(l_orderkey as bigint) as strip_id,
             concat('scene_', cast(l_partkey as string), '_', cast(l_suppkey as string), '_dem.tif') as scene_id,
             row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_extendedprice,
                                l_shipdate, l_quantity, l_discount) as seq,
             l_quantity/16e0 as rmse, floor(l_discount*256e0)/64e0 as dz, floor(l_tax*256e0)/32e0 as dx,
             (l_linenumber-4)/8e0 as dy
      from lineitem""",
    "registration": """
      select s_suppkey as strip_no, cast(s_nationkey as int) as ngcps,
             case when s_acctbal > 0 then floor(s_acctbal/16e0)/64e0 end as p75,
             floor(s_acctbal/32e0)/64e0 as dz, s_nationkey/8e0 as dx, -s_nationkey/4e0 as dy
      from supplier""",
    "inventory": """
      select user_id as scene_no, event_type as kind, ts as modified, event_id from events""",
}

PX_SPARK = """
      select cast(floor(vec_id/100) as int) as strip_no, concat('s', cast(floor(vec_id/100) as int)) as strip_id,
             cast(floor(vec_id/100)*60 + vec_id%100 as int) as row, cast(pos as int) as col,
             case when (vec_id*7+pos*13)%23=0 then null else 1e2 + round(cast(v as double)*64e1)/64e0 end as z,
             (vec_id*5+pos*3)%7 <> 0 as mt, cast((vec_id*11+pos*17)%251 as int) as ortho,
             round(cast(v as double)*64e1) as raw, cast(vec_id%100 as int) as i
      from embeddings lateral view posexplode(embedding) e as pos, v"""
PX_DUCK = """
      select cast(floor(vec_id/100) as int) as strip_no, concat('s', cast(cast(floor(vec_id/100) as int) as string)) as strip_id,
             cast(floor(vec_id/100)*60 + vec_id%100 as int) as row, cast(pos as int) as col,
             case when (vec_id*7+pos*13)%23=0 then null else 1e2 + round(cast(embedding[pos+1] as double)*64e1)/64e0 end as z,
             (vec_id*5+pos*3)%7 <> 0 as mt, cast((vec_id*11+pos*17)%251 as int) as ortho,
             round(cast(embedding[pos+1] as double)*64e1) as raw, cast(vec_id%100 as int) as i
      from embeddings, range(64) r(pos)"""

# texts over px, both engines
PX_SQL: dict[str, str] = {
    # smooth reference and shifted floating raster per strip, for alignment
    "pair_ref": """
      select strip_id as pair_id, i as row, col,
             2e2 + (i*i + 2*col*col - i*col)/256e0 + raw/4096e0 as z, mt as m from px""",
    "pair_flt": """
      select strip_id as pair_id, i as row, col,
             2e2 + ((i+(strip_no%3-1)/2e0)*(i+(strip_no%3-1)/2e0)
                    + 2*(col+(strip_no%5-2)/2e0)*(col+(strip_no%5-2)/2e0)
                    - (i+(strip_no%3-1)/2e0)*(col+(strip_no%5-2)/2e0))/256e0 + (strip_no%4)/2e0 as z,
             true as m from px""",
    # two tile columns per strip row; tiles share 16 columns and 40 rows
    "tile_px": """
      select strip_no as tile_row, h as tile_col, concat(lpad(cast(strip_no as string), 2, '0'), '_0', cast(h as string)) as tile_id,
             row, col, z + h/2e0 as z, mt, ortho, case when z is null then 0 else strip_no*16 + h + 1 end as dy,
             case when col < 20 then 1 when col < 44 then 2 else 3 end as cluster
      from px, (select 0 as h union all select 1 as h) t
      where (h = 0 and col < 40) or (h = 1 and col >= 24)""",
}


def _duck(name: str) -> str:
    if name == "px":
        return PX_DUCK
    return SQL.get(name) or PX_SQL[name]


def with_inputs(names: list[str] | str, body: str) -> str:
    """Oracle text: the inputs as CTEs, then ``body`` (which may start with a CTE)."""
    names = names.split() if isinstance(names, str) else list(names)
    need = [n for n in names if n not in PX_SQL]
    if any(n in PX_SQL for n in names) and "px" not in need:
        need.append("px")
    need += [n for n in names if n in PX_SQL]
    ctes = ", ".join(f"{n} as materialized ({_duck(n)})" for n in need)
    body = body.strip()
    if not ctes:
        return body
    if body.lower().startswith("with recursive "):
        return f"with recursive {ctes}, {body[15:]}"
    if body.lower().startswith("with "):
        return f"with {ctes}, {body[5:]}"
    return f"with {ctes} {body}"


class Inputs:
    """Spark side of the inputs for one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        bounded_tasks(spark)
        self.spark, self.dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    def _sql(self, text: str, **frames: DataFrame) -> DataFrame:
        for n in frames:
            text = text.replace(f"from {n}", f"from {{{n}}}")
        return self.spark.sql(text, **frames)

    def get(self, name: str) -> DataFrame:
        if name == "px":
            return self._sql(PX_SPARK, embeddings=self.table("embeddings"))
        if name in PX_SQL:
            return self._sql(PX_SQL[name], px=self.get("px"))
        text = SQL[name]
        source = text.split("from ")[-1].split()[0]
        d = self._sql(text, **{source: self.table(source)})
        if name == "footprint":
            d = d.withColumn("poly", skewed_ring())
        return d


def tiles_apart(tile_px: DataFrame) -> DataFrame:
    """``tile_px`` with one id per tile: its SQL cuts the names of strips from 100 on to two digits, so that tiles share them."""
    return tile_px.withColumn("tile_id", F.concat(F.format_string("%02d", "tile_row"), F.lit("_0"), F.col("tile_col").cast("string")))


def sql_name(tile_id: str):
    """The name that the SQL of ``tile_px`` gives the tile of an id of ``tiles_apart``."""
    return F.concat(F.lpad(F.substring_index(tile_id, "_", 1), 2, "0"), F.lit("_"), F.substring_index(tile_id, "_", -1))


def skewed_ring():
    """Box whose corners are cut back by a quarter of its width on alternate sides."""
    s = (F.col("xmax") - F.col("xmin")) / 4
    return pg.ring(
        (F.col("xmin"), F.col("ymin")),
        (F.col("xmax") - s, F.col("ymin")),
        (F.col("xmax"), F.col("ymax")),
        (F.col("xmin") + s, F.col("ymax")),
    )


# the same ring's vertices for the oracle, in order
RING_SQL = [
    ("xmin", "ymin"),
    ("(xmax-(xmax-xmin)/4)", "ymin"),
    ("xmax", "ymax"),
    ("(xmin+(xmax-xmin)/4)", "ymax"),
]


def pip_sql(px: str, py: str, ring=None) -> str:
    """Even-odd test as plain SQL over a fixed ring."""
    ring = ring or RING_SQL
    parts = []
    for (ax, ay), (bx, by) in zip(ring, ring[1:] + ring[:1]):
        if ay == by:
            continue
        parts.append(
            f"(case when (({ay}) > {py}) <> (({by}) > {py}) and {px} < ({ax}) + ({py}-({ay}))*(({bx})-({ax}))/(({by})-({ay})) then 1 else 0 end)"
        )
    return f"(({' + '.join(parts)}) % 2 = 1)"


def q(expr: str, bits: int = 1024) -> str:
    """Quantise an irrational result the same way in both engines."""
    return f"floor(({expr})*{bits}e0 + 0.5e0)/{bits}e0"


def qc(col, bits: int = 1024):
    return F.floor(col * float(bits) + 0.5) / float(bits)
