"""Neighbourhood, resampling and component queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from reliefgrid.operators import components as cc
from reliefgrid.operators import kernels as kn
from reliefgrid.operators import lattice as lt
from reliefgrid.operators import regrid as rg
from reliefgrid.operators import resample as rs

from .inputs import Inputs, q, qc, with_inputs
from .registry import query

K = ["strip_id"]
CELL = "strip_id, row, col"


def px(spark, sf):
    return Inputs(spark, sf).get("px")




def two_pass(inner: str, value: str, n: int, name: str) -> str:
    """CTE pair computing an n x n sum of ``value`` from ``inner`` as ``name``."""
    lo, hi = (n - 1) // 2, n // 2
    return f"""{name}_h as (select *, sum({value}) over (partition by strip_id, row order by col range between {lo} preceding and {hi} following) as h_ from {inner}),
    {name} as (select * exclude (h_), sum(h_) over (partition by strip_id, col order by row range between {lo} preceding and {hi} following) as {name}_sum from {name}_h)"""


for _n in (6, 11, 21):

    @query(
        f"k1_density_map_n{_n}",
        with_inputs("px", f"with b as (select *, case when mt then 1 else 0 end as m1 from px), {two_pass('b', 'm1', _n, 's')} select strip_id, row, col, s_sum/{_n * _n}e0 as density from s"),
    )
    def _density(spark, sf, n=_n):
        return kn.density_map(px(spark, sf), K, F.col("mt"), n).select(*K, "row", "col", "density")


def grad_sql(src: str, z: str = "z", dx: str = "1e0") -> str:
    """Gradient along columns (gcol) and rows (grow), one-sided at the edges."""

    def d(part, axis):
        w = f"over (partition by strip_id, {part} order by {axis})"
        return f"""case when lag({axis}) {w} is not null and lead({axis}) {w} is not null then (lead({z}) {w} - lag({z}) {w})/(2*{dx})
            when lead({axis}) {w} is not null then (lead({z}) {w} - {z})/{dx}
            when lag({axis}) {w} is not null then ({z} - lag({z}) {w})/{dx} end"""

    return f"select *, {d('row', 'col')} as gcol, {d('col', 'row')} as grow from {src}"


@query("k3_gradient", with_inputs("px", f"select strip_id, row, col, -gcol as sx, grow as sy from ({grad_sql('px', 'z', '2e0')})"))
def _k3(spark, sf):
    return kn.gradient(px(spark, sf), K, "z", 2.0).select(*K, "row", "col", (-F.col("gcol")).alias("sx"), F.col("grow").alias("sy"))


def mean_sql(src: str, value: str, n: int, name: str) -> str:
    """CTEs for a zero-padded kernel mean of ``value`` where NULL contaminates."""
    return f"""{name}_b as (select *, {value} as v_, case when {value} is null then 1 else 0 end as nul_ from {src}),
      {two_pass(name + '_b', 'v_', n, name + '_v')}, {two_pass(name + '_v', 'nul_', n, name + '_n')},
      {name} as (select * exclude (v_, nul_, {name}_v_sum, {name}_n_sum), case when {name}_n_sum = 0 then {name}_v_sum/{n * n}e0 end as {name}_mean from {name}_n)"""


@query(
    "k4_mean_slope",
    with_inputs("px", f"with g as (select *, sqrt(gcol*gcol + grow*grow) as sl from ({grad_sql('px')})), {mean_sql('g', 'sl', 5, 'm')} select strip_id, row, col, {q('m_mean')} as mean_slope, m_mean < 1 as gentle from m"),
)
def _k4(spark, sf):
    d = kn.mean_slope(px(spark, sf), K)
    return d.select(*K, "row", "col", qc(F.col("mean_slope")).alias("mean_slope"), (F.col("mean_slope") < 1).alias("gentle"))


@query(
    "k5_slope_deviation",
    with_inputs("px", f"""with g as ({grad_sql('px')}), {mean_sql('g', 'gcol', 5, 'a')}, {mean_sql('a', 'gcol*gcol', 5, 'b')},
      {mean_sql('b', 'grow', 5, 'c')}, {mean_sql('c', 'grow*grow', 5, 'e')}
      select strip_id, row, col, {q('sqrt(greatest(0e0, b_mean-a_mean*a_mean) + greatest(0e0, e_mean-c_mean*c_mean))')} as slope_dev from e"""),
)
def _k5(spark, sf):
    return kn.slope_deviation(px(spark, sf), K).select(*K, "row", "col", qc(F.col("slope_dev")).alias("slope_dev"))


for _n in (5, 13):
    _lo, _hi = (_n - 1) // 2, _n // 2

    @query(
        f"k6_dilate_n{_n}",
        with_inputs("px", f"with b as (select *, case when z > 102.5 then 1 else 0 end as m1 from px), {two_pass('b', 'm1', _n, 's')} select strip_id, row, col, s_sum > 0 as dilated from s"),
    )
    def _dil(spark, sf, n=_n):
        return kn.dilate(px(spark, sf), K, F.col("z") > 102.5, n).select(*K, "row", "col", "dilated")


for _n in (5, 6):

    @query(
        f"k6_erode_n{_n}",
        with_inputs("px", f"with b as (select *, case when z is not null then 0 else 1 end as m1 from px), {two_pass('b', 'm1', _n, 's')} select strip_id, row, col, s_sum = 0 as eroded from s"),
    )
    def _ero(spark, sf, n=_n):
        return kn.erode(px(spark, sf), K, F.col("z").isNotNull(), n).select(*K, "row", "col", "eroded")


@query(
    "k7_moving_range",
    with_inputs("px", """select strip_id, row, col, max(ortho) over w - min(ortho) over w as "range" from px
      window w as (partition by strip_id, col order by row rows between 2 preceding and 2 following)"""),
)
def _k7(spark, sf):
    return kn.moving_range(px(spark, sf), K, "ortho").select(*K, "row", "col", "range")


MIRROR = """ext as (select strip_id, min(row) r0, max(row) r1, min(col) c0, max(col) c1 from px group by 1),
  rows_ as (select p.*, r0, r1, c0, c1, u.nr from px p join ext using (strip_id), unnest([row, case when row-r0<2 then 2*r0-1-row end, case when r1-row<2 then 2*r1+1-row end]) u(nr) where u.nr is not null),
  mir as (select strip_id, strip_no, nr as row, u.nc as col, z, ortho, r0, r1, c0, c1 from rows_, unnest([col, case when col-c0<2 then 2*c0-1-col end, case when c1-col<2 then 2*c1+1-col end]) u(nc) where u.nc is not null)"""


@query(
    "k8_local_entropy",
    with_inputs("px", f"""with {MIRROR}, hits as (select p.strip_id, p.row, p.col, m.ortho//16 as v, count(*) as c
        from px p join mir m on m.strip_id = p.strip_id and m.row between p.row-2 and p.row+2 and m.col between p.col-2 and p.col+2
        group by 1,2,3,4)
      select strip_id, row, col, {q('-sum(c/25e0*log2(c/25e0))')} as entropy from hits group by 1,2,3"""),
)
def _k8(spark, sf):
    d = px(spark, sf).withColumn("v", F.floor(F.col("ortho") / 16).cast("int"))
    return kn.local_entropy(d, K, "v").select(*K, "row", "col", qc(F.col("entropy")).alias("entropy"))


@query(
    "k9_local_std",
    with_inputs("px", f"""with {MIRROR}, agg as (select p.strip_id, p.row, p.col, sum(m.z) s, sum(m.z*m.z) ss, count(m.z) n
        from px p join mir m on m.strip_id = p.strip_id and m.row between p.row-2 and p.row+2 and m.col between p.col-2 and p.col+2
        group by 1,2,3)
      select strip_id, row, col, case when n = 25 then {q('sqrt(greatest(0e0, (ss-s*s/25e0)/24e0))')} end as local_std from agg"""),
)
def _k9(spark, sf):
    return kn.local_std(px(spark, sf), K, "z").select(*K, "row", "col", qc(F.col("local_std")).alias("local_std"))


@query(
    "k10_residual_topography",
    with_inputs("px", f"with {mean_sql('px', 'z', 5, 'm')} select strip_id, row, col, {q('z - m_mean')} as residual from m"),
)
def _k10(spark, sf):
    return kn.residual_topography(px(spark, sf), K).select(*K, "row", "col", qc(F.col("residual")).alias("residual"))


def shift_sql(src: str, keys: str, value: str = "z") -> str:
    """Bilinear shift as one sum: each cell of ``src`` (with ic, fc, ir, fr) adds to the up to four targets around it.

    A target exists where its first cell does, and is null unless all cells of any weight have a value.
    """
    return f"""select {keys}, ar - ir as row, ac - ic as col, case when count({value}) = need then sum(wt*{value}) end as {value}
      from (select {keys}, row-di as ar, col-dj as ac, ir, ic, {value}, di+dj = 0 as own, (case when fr > 0 then 2 else 1 end)*(case when fc > 0 then 2 else 1 end) as need,
              (case when di=0 then 1-fr else fr end)*(case when dj=0 then 1-fc else fc end) as wt
            from {src}, range(2) a(di), range(2) b(dj) where (di=0 or fr>0) and (dj=0 or fc>0))
      group by {keys}, ar, ac, ir, ic, need having bool_or(own)"""


# per-strip shift: dx = (strip_no%7-3)/4 cells, dy = (strip_no%5-2)/2 cells, dz = strip_no/8
def strip_shifts(p):
    return p.select("strip_id", "strip_no").distinct().select(
        "strip_id",
        (F.col("strip_no") / 8.0).alias("dz"),
        ((F.col("strip_no") % 7 - 3) / 4.0).alias("dx"),
        ((F.col("strip_no") % 5 - 2) / 2.0).alias("dy"),
    )


_SC, _SR = "((strip_no%7-3)/4e0)", "(-(strip_no%5-2)/2e0)"
SHIFTED = f"sh as materialized (select *, floor{_SC} as ic, {_SC}-floor{_SC} as fc, floor{_SR} as ir, {_SR}-floor{_SR} as fr from px)"


@query(
    "k14_shift_resample",
    with_inputs("px", f"""with {SHIFTED} select strip_id, cast(row as int) as row, cast(col as int) as col, z - strip_no/8e0 as z
      from ({shift_sql('sh', 'strip_id, strip_no')})"""),
)
def _k14(spark, sf):
    p = px(spark, sf)
    return rs.shift_resample(p, K, strip_shifts(p), 1.0, {"z": "linear"}).select(*K, "row", "col", "z")


@query(
    "k14_nearest_mask",
    with_inputs("px", f"""with {SHIFTED}, u as (select strip_id, row, col, ir, ic, true as own, null as mt from sh union all
        select strip_id, row - (case when fr < 0.5 then 0 else 1 end), col - (case when fc < 0.5 then 0 else 1 end), ir, ic, false, mt from sh)
      select strip_id, cast(row-ir as int) as row, cast(col-ic as int) as col, coalesce(bool_or(mt), false) as mt from u group by strip_id, row, col, ir, ic having bool_or(own)"""),
)
def _k14n(spark, sf):
    p = px(spark, sf)
    return rs.resample_bands(p, K, strip_shifts(p), 1.0).select(*K, "row", "col", "mt")


def _cubic_sql() -> str:
    def axis(src, part, ax, f, v, out):
        w = f"over (partition by strip_id, {part} order by {ax})"
        p0, p1, p2, pm = v, f"lead({v},1) {w}", f"lead({v},2) {w}", f"lag({v},1) {w}"
        return f"""select *, case when {f}=0 then {v} else p0 + 0.5*{f}*(p1-pm) + {f}*{f}*(pm-2.5*p0+2*p1-0.5*pp) + {f}*{f}*{f}*(1.5*(p0-p1)+0.5*(pp-pm)) end as {out}
          from (select * exclude (xm,xp), case when xm is not null then m_ else 3*p0-3*p1+p2_ end as pm, case when xp is not null then p2_ else 3*p1-3*p0+m_ end as pp from
            (select *, {p0} as p0, {p1} as p1, {p2} as p2_, {pm} as m_, lag({ax}) {w} as xm, lead({ax},2) {w} as xp from {src}))"""

    first = axis("o", "row", "col", "fc", "v", "hv")
    second = axis("h", "col", "row", "fr", "hv", "cv")
    return f"""with {SHIFTED}, o as (select strip_id, row, col, ic, fc, ir, fr, case when ortho<>0 then cast(ortho as double) end as v from sh),
      h as (select strip_id,row,col,ic,fc,ir,fr,hv from ({first})), k as ({second})
      select strip_id, cast(row-ir as int) as row, cast(col-ic as int) as col, cast(coalesce(greatest(-32768, least(32767, round(cv))),0) as int) as ortho from k"""


@query("k14_cubic_ortho", with_inputs("px", _cubic_sql()))
def _k14c(spark, sf):
    p = px(spark, sf)
    return rs.resample_bands(p, K, strip_shifts(p), 1.0).select(*K, "row", "col", F.col("ortho").cast("int").alias("ortho"))


@query(
    "k16_coarsen",
    with_inputs("px", "select strip_id, cast(floor(row/4) as int) as row, cast(floor(col/4) as int) as col, avg(z) as z from px group by 1,2,3"),
)
def _k16(spark, sf):
    return lt.coarsen(px(spark, sf), K, ["z"], 4)


@query(
    "k16_enlarge_nearest",
    with_inputs("px", """with c as (select strip_id, cast(floor(row/4) as int) as row, cast(floor(col/4) as int) as col, z from px where row%4=2 and col%4=2)
      select strip_id, cast(row*4+i as int) as row, cast(col*4+j as int) as col, z from c, range(4) a(i), range(4) b(j)"""),
)
def _k16n(spark, sf):
    return lt.enlarge_nearest(lt.pick_every(px(spark, sf).select(*K, "row", "col", "z"), 4), 4)


@query(
    "k16_enlarge_bilinear",
    with_inputs("px", """with c as (select strip_id, cast(floor(row/4) as int) as row, cast(floor(col/4) as int) as col, avg(z) as z from px group by 1,2,3),
      e as (select strip_id, min(row) r0, max(row) r1, min(col) c0, max(col) c1 from c group by 1),
      f as (select c.strip_id, c.row, c.col, i, j, (i+0.5e0)/4e0-0.5e0 as fr, (j+0.5e0)/4e0-0.5e0 as fc, r0,r1,c0,c1 from c join e using (strip_id), range(4) a(i), range(4) b(j)),
      g as (select *, least(r1, greatest(r0, row + case when fr<0 then -1 else 1 end)) as orow, least(c1, greatest(c0, col + case when fc<0 then -1 else 1 end)) as ocol from f)
      select g.strip_id, cast(g.row*4+i as int) as row, cast(g.col*4+j as int) as col,
        (1-abs(fr))*((1-abs(fc))*p.z + abs(fc)*q.z) + abs(fr)*((1-abs(fc))*s.z + abs(fc)*t.z) as z
      from g join c p on p.strip_id=g.strip_id and p.row=g.row and p.col=g.col
      join c q on q.strip_id=g.strip_id and q.row=g.row and q.col=g.ocol
      join c s on s.strip_id=g.strip_id and s.row=g.orow and s.col=g.col
      join c t on t.strip_id=g.strip_id and t.row=g.orow and t.col=g.ocol""".replace(" as z\n      from g", " as z0\n      from g").replace("select g.strip_id", "select strip_id, row, col, floor(z0*1024e0+0.5e0)/1024e0 as z from (select g.strip_id") + ")"),
)
def _k16b(spark, sf):
    c = lt.coarsen(px(spark, sf), K, ["z"], 4)
    return lt.enlarge_bilinear(c, K, "z", 4).withColumn("z", qc(F.col("z")))


def _cubic_sql(x: str) -> str:
    return f"case when abs({x}) <= 1 then 1.5e0*abs({x})**3 - 2.5e0*abs({x})**2 + 1 when abs({x}) < 2 then -0.5e0*abs({x})**3 + 2.5e0*abs({x})**2 - 4*abs({x}) + 2 else 0 end"


_MIRRORED = "case when {i} < {a}0 then 2*{a}0 - 1 - {i} when {i} > {a}1 then 2*{a}1 + 1 - {i} else {i} end"


@query(
    "k16_enlarge_cubic",
    with_inputs("px", f"""with c as materialized (select strip_id, cast(floor(row/4) as int) as row, cast(floor(col/4) as int) as col, avg(z) as z from px group by 1,2,3),
      e as (select strip_id, min(row) r0, max(row) r1, min(col) c0, max(col) c1 from c group by 1),
      w as (select i, m, cast(floor((i+0.5e0)/4e0-0.5e0) as int) + m as step, {_cubic_sql("(m - ((i+0.5e0)/4e0-0.5e0) + floor((i+0.5e0)/4e0-0.5e0))")} as w from range(4) a(i), range(-1, 3) b(m)),
      t as (select c.strip_id, c.row*4+a.i as row, c.col*4+b.i as col, a.w*b.w as w, {_MIRRORED.format(i="(c.row+a.step)", a="r")} as sr, {_MIRRORED.format(i="(c.col+b.step)", a="c")} as sc
        from c join e using (strip_id), w a, w b)
      select t.strip_id, cast(t.row as int) as row, cast(t.col as int) as col, case when count(c.z) = 16 then floor(sum(w*c.z)*1024e0+0.5e0)/1024e0 end as z
      from t join c on c.strip_id=t.strip_id and c.row=t.sr and c.col=t.sc group by 1,2,3"""),
)
def _k16ec(spark, sf):
    c = lt.coarsen(px(spark, sf), K, ["z"], 4)
    return rg.enlarge_cubic(c, K, "z", 4).select(*K, "row", "col", qc(F.col("z")).alias("z"))


@query(
    "k16_shrink_cubic",
    with_inputs("px", f"""with e as (select strip_id, min(row) r0, max(row) r1, min(col) c0, max(col) c1 from px group by 1),
      v as (select d, {_cubic_sql("((1.5e0-d)/4e0)")} as v from range(-6, 10) a(d)), w as materialized (select d, v/(select sum(v) from v) as w from v),
      t as (select strip_id, r, c, r0, r1, c0, c1 from e, lateral (select unnest(range(0, cast(ceil((r1-r0+1)/4e0) as int))) as r) x, lateral (select unnest(range(0, cast(ceil((c1-c0+1)/4e0) as int))) as c) y),
      h as materialized (select t.strip_id, t.r, p.col, sum(a.w*p.z) as s, count(p.z) as n
        from (select distinct strip_id, r, r0, r1 from t) t, w a join px p on p.strip_id=t.strip_id and p.row={_MIRRORED.format(i="(t.r0+4*t.r+a.d)", a="t.r")} group by 1,2,3)
      select t.strip_id, cast(t.r as int) as row, cast(t.c as int) as col, case when min(h.n) = 16 then floor(sum(b.w*h.s)*1024e0+0.5e0)/1024e0 end as z
      from t, w b join h on h.strip_id=t.strip_id and h.r=t.r and h.col={_MIRRORED.format(i="(t.c0+4*t.c+b.d)", a="t.c")} group by 1,2,3"""),
)
def _k16sc(spark, sf):
    return rg.shrink_cubic(px(spark, sf), K, "z", 4).select(*K, "row", "col", qc(F.col("z")).alias("z"))


@query(
    "k19_distance",
    with_inputs("px", """with reg as (select strip_id, row, col, z from px where z > 103)
      select p.strip_id, p.row, p.col, cast(min(abs(p.row-r.row)+abs(p.col-r.col)) as bigint) as dist,
             min_by(r.z, (abs(p.row-r.row)+abs(p.col-r.col))*1000000000::bigint + r.row*10000 + r.col) as nearest
      from px p join reg r using (strip_id) group by 1,2,3"""),
)
def _k19(spark, sf):
    d = kn.distance_to(px(spark, sf), K, F.col("z") > 103, carry=F.col("z"))
    return d.select(*K, "row", "col", "dist", "nearest").filter("dist is not null")


@query(
    "k20_regrid",
    with_inputs("px", f"""with sh as materialized (select *, ceil(x0/2e0)-x0/2e0 as sx, (y0/2e0-floor(y0/2e0)) as sy from (select *, (strip_no%4)/2e0 as x0, (strip_no%3)/4e0 as y0 from px)),
      s2 as materialized (select *, floor(sx) as ic, sx-floor(sx) as fc, floor(sy) as ir, sy-floor(sy) as fr from sh)
      select strip_id, cast(row as int) as row, cast(col as int) as col, {q('z')} as z from ({shift_sql('s2', 'strip_id')})"""),
)
def _k20(spark, sf):
    p = px(spark, sf)
    o = p.select("strip_id", "strip_no").distinct().select(
        "strip_id", ((F.col("strip_no") % 4) / 2.0).alias("x0"), ((F.col("strip_no") % 3) / 4.0).alias("y0")
    )
    return rs.regrid_to_integer(p, K, o, 2.0).select(*K, "row", "col", qc(F.col("z")).alias("z"))


# ---- components -------------------------------------------------------------

COMPONENTS = """with recursive cells as (select strip_id, row, col, {mask} as m from px),
   marks as (select strip_id, row, col, col - row_number() over (partition by strip_id, row order by col) as g from cells where m),
   runs as (select strip_id, row, min(col) as c0, max(col) as c1, row_number() over () as id from (select * from marks) group by strip_id, row, g),
   pairs as (select a.id as u, b.id as v from runs a join runs b on a.strip_id=b.strip_id and b.row=a.row+1 and a.c0<=b.c1+{k} and b.c0-{k}<=a.c1),
   sym as (select u, v from pairs union all select v, u from pairs),
   walk(id, lab) as (select id, id from runs union select s.v, w.lab from walk w join sym s on s.u=w.id where s.v > w.lab),
   labs as (select id, min(lab) as lab from walk group by id),
   comp as (select r.strip_id, r.row, r.c0, r.c1, l.lab from runs r join labs l using (id)),
   size as (select strip_id, lab, sum(c1-c0+1) as cells, min(row) as r0, max(row) as r1 from comp group by 1,2)"""


@query(
    "k11_component_sizes",
    with_inputs("px", COMPONENTS.format(mask="coalesce(z > 102, false)", k=1) + """
      select strip_id, cast(cells as bigint) as cells, r0, r1 from size"""),
)
def _k11s(spark, sf):
    return cc.component_sizes(px(spark, sf), K, F.col("z") > 102).select("strip_id", "cells", "r0", "r1")


@query(
    "k11_drop_small",
    with_inputs("px", COMPONENTS.format(mask="coalesce(z > 101.5, false)", k=1) + """
      select p.strip_id, p.row, p.col, coalesce(s.cells >= 8, false) as mask from px p
      left join comp c on c.strip_id=p.strip_id and c.row=p.row and p.col between c.c0 and c.c1
      left join size s on s.strip_id=c.strip_id and s.lab=c.lab"""),
)
def _k11(spark, sf):
    return cc.drop_small(px(spark, sf), K, F.col("z") > 101.5, 8).select("strip_id", "row", "col", "mask")


HOLES = COMPONENTS.format(mask="not coalesce(abs(z - 100) < 2, false)", k=0) + """,
   ext as (select strip_id, min(row) as a0, max(row) as a1, min(col) as b0, max(col) as b1 from px group by 1),
   open_ as (select strip_id, lab, bool_or(row=a0 or row=a1 or c0=b0 or c1=b1) as o from comp join ext using (strip_id) group by 1,2),
   solid as (select p.strip_id, p.row, p.col, not coalesce(o.o, false) as mask from px p
      left join comp c on c.strip_id=p.strip_id and c.row=p.row and p.col between c.c0 and c.c1
      left join open_ o on o.strip_id=c.strip_id and o.lab=c.lab)"""


@query("k12_fill_holes", with_inputs("px", HOLES + " select * from solid"))
def _k12(spark, sf):
    return cc.fill_holes(px(spark, sf), K, F.abs(F.col("z") - 100) < 2).select("strip_id", "row", "col", "mask")


@query(
    "k13_boundary",
    with_inputs("px", HOLES + """ select a.strip_id, a.row, a.col, a.mask and not (
        coalesce(b.mask,false) and coalesce(c.mask,false) and coalesce(d.mask,false) and coalesce(e.mask,false)) as boundary
      from solid a left join solid b on b.strip_id=a.strip_id and b.row=a.row-1 and b.col=a.col
      left join solid c on c.strip_id=a.strip_id and c.row=a.row+1 and c.col=a.col
      left join solid d on d.strip_id=a.strip_id and d.row=a.row and d.col=a.col-1
      left join solid e on e.strip_id=a.strip_id and e.row=a.row and e.col=a.col+1"""),
)
def _k13(spark, sf):
    return cc.boundary_cells(px(spark, sf), K, F.abs(F.col("z") - 100) < 2).select("strip_id", "row", "col", "boundary")
