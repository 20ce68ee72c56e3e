"""Queries on units, samples, pixels and parameter tables: models, scores, statistics, classifiers and quality gates."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from loamgrid.operators import change as CH
from loamgrid.operators import classify as K
from loamgrid.operators import quality as Q
from loamgrid.operators import score as SC
from loamgrid.operators import services as SV
from loamgrid.operators import stats as ST
from loamgrid.operators import zonal as Z
from loamgrid.sources import tables as IO
from loamgrid.plans.bindings import (
    SQL, BIO_ROWS, CELL_HA, CELL_M2, CRITERIA, EXACT_UNITS_SQL, EXTENT_SQL, FACTORS, GRID, INDEX, PIXELS_SQL, POOL_ROWS, PRICE, QUANTITY, SAMPLES_SQL, SCORE_SQL, UNITS_SQL,
    biophysical, cells_sql, dated_cells, dated_stack, extent, factor_samples, pixels, pools, query, scratch, stable, stable_sql, table, units, values, year_of,
)
from loamgrid.plans.cell_queries import DEPTH_SQL, depth_cells, layer_sizes, year_grids

W = "WITH "


def rounded(df, **digits):
    return df.withColumns({c: F.round(c, d) for c, d in digits.items()})


# ecosystem services


@query("f1_carbon_storage", W + cells_sql() + f""", p(lucode, a, b, s, d) AS (FROM {values(POOL_ROWS)}) SELECT year, round(sum((a + b + s + d) * 0.09::DOUBLE), 3) AS carbon_mg, count(*) AS cells FROM cells JOIN p ON value = lucode GROUP BY ALL""")
def _(spark, sf):
    return rounded(SV.carbon_storage(dated_cells(spark, sf), pools(spark), ["year"], CELL_HA), carbon_mg=3)


@query("f2_water_yield", W + cells_sql() + ", " + cells_sql("p", PRICE) + ", " + cells_sql("e", QUANTITY) + f""", bio(lucode, rd, kc, veg) AS (FROM {values(BIO_ROWS)}),
x AS (SELECT c.year, p.value / 40 AS pr, e.value * 30 AS et0, kc, veg, least(5, 12.0 * least(1500.0, rd) * 0.15 / (p.value / 40) + 1.25) AS w FROM cells c JOIN p USING (year, "row", "col") JOIN e USING (year, "row", "col") JOIN bio ON c.value = lucode),
y AS (SELECT year, CASE WHEN pr > 0 THEN pr * (1 - CASE WHEN veg = 1 THEN 1 + kc * et0 / pr - (1 + (kc * et0 / pr) ** w) ** (1 / w) ELSE least(kc * et0 / pr, 1) END) END AS mm FROM x)
SELECT year, round(sum(mm) / 1000 * 900, 2) AS yield_m3, round(avg(mm), 4) AS mean_mm, count(mm) AS cells FROM y GROUP BY ALL""")
def _(spark, sf):
    cells = dated_stack(spark, sf, {"lulc": "1 + sum(l_linenumber) % 7", "precip": f"{PRICE} / 40", "et0": f"{QUANTITY} * 30"}).withColumns({"rest_depth": F.lit(1500.0), "pawc": F.lit(0.15)})
    return rounded(SV.water_yield(cells, biophysical(spark), ["year"], 12.0, CELL_M2), yield_m3=2, mean_mm=4)


THREATS = [("road", 90.0, 1.0, "linear"), ("mine", 60.0, 0.6, "exponential")]
SENSITIVITY = [(c, t, round((c % 4) / 4 + (0.1 if t == "road" else 0.0), 2), round(1 - c / 10, 2)) for c in range(1, 8) for t in ("road", "mine")]


@query("c12_f3_habitat_quality", W + cells_sql() + f""", t(threat, reach, share, decay) AS (FROM {values([("road", 3.0, 0.625, "linear"), ("mine", 2.0, 0.375, "exponential")])}), s(lulc, threat, sens, hab) AS (FROM {values(SENSITIVITY)}),
l AS (SELECT "row", "col", value AS lulc FROM cells WHERE year = 1997), src AS (SELECT CASE WHEN value = 6 THEN 'road' ELSE 'mine' END AS threat, "row" AS r, "col" AS c FROM cells WHERE year = 1998 AND value IN (6, 7)),
pr AS (SELECT l."row", l."col", lulc, threat, reach, share, decay, sqrt((l."row" - r) ** 2 + (l."col" - c) ** 2) / reach AS d FROM src JOIN t USING (threat) JOIN l ON abs(l."row" - r) <= reach AND abs(l."col" - c) <= reach),
i AS (SELECT "row", "col", lulc, threat, avg(CASE WHEN decay = 'linear' THEN 1 - d ELSE exp(-2.99 * d) END) * any_value(share) AS inf FROM pr WHERE d <= 1 GROUP BY ALL),
g AS (SELECT "row", "col", sum(inf * sens) AS deg FROM i JOIN s USING (lulc, threat) GROUP BY ALL), h AS (SELECT lulc, max(hab) AS hab FROM s GROUP BY lulc)
SELECT l."row", l."col", lulc, hab AS habitat, round(coalesce(deg, 0), 6) AS degradation, round(hab * (1 - coalesce(deg, 0) ** 2.5 / (coalesce(deg, 0) ** 2.5 + 0.05 ** 2.5)), 6) AS quality FROM l JOIN h USING (lulc) LEFT JOIN g USING ("row", "col")""")
def _(spark, sf):
    cells = dated_cells(spark, sf).filter("year IN (1997, 1998)")  # cells and threats from one scan
    at = lambda code: F.when((F.col("year") == 1998) & (F.col("value") == code), 1.0)
    rows = cells.select("row", "col", F.col("value").alias("lulc"), (F.col("year") == 1997).alias("own"), ((F.col("year") == 1998) & F.col("value").isin(6, 7)).alias("source"), at(6).alias("road"), at(7).alias("mine"))
    threats = spark.createDataFrame(THREATS, "threat string, max_dist double, weight double, decay string")
    sens = spark.createDataFrame(SENSITIVITY, "lulc long, threat string, sensitivity double, habitat double")
    return rounded(SV.habitat_of(rows, threats, sens, 30.0, 0.05), degradation=6, quality=6)


@query("f3_threat_intensity", W + cells_sql() + f""", t(threat, reach, share, decay) AS (FROM {values([("road", 6.0, 0.625, "linear"), ("mine", 4.0, 0.375, "exponential")])}), s(lulc, threat, sens, hab) AS (FROM {values(SENSITIVITY)}),
l AS (SELECT "row", "col", min(value) AS lulc FROM cells GROUP BY ALL), src AS (SELECT CASE WHEN value = 6 THEN 'road' ELSE 'mine' END AS threat, "row" AS r, "col" AS c, count(*) / 7 AS y FROM cells WHERE value IN (6, 7) GROUP BY ALL),
pr AS (SELECT l."row", l."col", lulc, threat, y, reach, share, decay, sqrt((l."row" - r) ** 2 + (l."col" - c) ** 2) / reach AS d FROM src JOIN t USING (threat) JOIN l ON abs(l."row" - r) <= reach AND abs(l."col" - c) <= reach),
i AS (SELECT "row", "col", lulc, threat, avg(y * CASE WHEN decay = 'linear' THEN 1 - d ELSE exp(-2.99 * d) END) * any_value(share) AS inf FROM pr WHERE d <= 1 GROUP BY ALL),
g AS (SELECT "row", "col", sum(inf * sens) AS deg FROM i JOIN s USING (lulc, threat) GROUP BY ALL), h AS (SELECT lulc, max(hab) AS hab FROM s GROUP BY lulc)
SELECT l."row", l."col", lulc, hab AS habitat, {stable_sql("coalesce(deg, 0)")} AS degradation, {stable_sql("hab * (1 - coalesce(deg, 0) ** 2.5 / (coalesce(deg, 0) ** 2.5 + 0.05 ** 2.5))")} AS quality FROM l JOIN h USING (lulc) LEFT JOIN g USING ("row", "col")""")
def _(spark, sf):
    """The intensity of a threat's cell is the share of the years in which it was there."""
    years = lambda code: F.count(F.when(F.col("value") == code, 1))
    cells = dated_cells(spark, sf).groupBy("row", "col").agg(F.min("value").alias("lulc"), years(6).alias("road"), years(7).alias("mine"))
    share = lambda c: F.when(F.col(c) > 0, F.col(c) / 7).alias(c)
    rows = cells.select("row", "col", "lulc", F.lit(True).alias("own"), (F.col("road") + F.col("mine") > 0).alias("source"), share("road"), share("mine"))
    threats = spark.createDataFrame([("road", 180.0, 1.0, "linear"), ("mine", 120.0, 0.6, "exponential")], "threat string, max_dist double, weight double, decay string")
    sens = spark.createDataFrame(SENSITIVITY, "lulc long, threat string, sensitivity double, habitat double")
    out = SV.habitat_of(rows, threats, sens, 30.0, 0.05)
    return out.withColumns({c: stable(F.col(c)) for c in ("degradation", "quality")})


SITES = {
    "water_volume_m3": "sum(l_quantity)", "water_carbon_density_g_c_m3": "10.0", "aquatic_vegetation_area_ha": "avg(l_quantity) / 10", "aquatic_vegetation_carbon_density_t_c_ha": "2.0",
    "bottom_sediment_area_ha": "avg(l_tax) * 100", "bottom_sediment_carbon_density_t_c_ha": "20.0",
}


@query("f4_f5_replaced_carbon", """WITH s AS (SELECT l_suppkey AS site_id, year(l_shipdate) AS year, sum(l_quantity) * 10 / 1e6 AS w, avg(l_quantity) / 10 * 2 AS v, avg(l_tax) * 100 * 20 AS d, sum(l_extendedprice) AS total, sum(l_discount) * 100 AS water FROM lineitem GROUP BY ALL)
SELECT site_id, year, round(w, 6) AS water_t_c, round(v, 6) AS vegetation_t_c, round(d, 6) AS sediment_t_c, round(w + v + d, 5) AS composite_t_c, round(CASE WHEN water <= total THEN total - water + (w + v + d) END, 2) AS replaced_total FROM s""")
def _(spark, sf):
    s = table(spark, sf, "lineitem").groupBy(F.col("l_suppkey").alias("site_id"), F.year("l_shipdate").alias("year")).agg(
        *[F.expr(v).cast("double").alias(k) for k, v in SITES.items()], F.sum("l_extendedprice").alias("total"), (F.sum("l_discount") * 100).alias("water")
    )
    out = SV.composite_carbon(s).withColumn("replaced_total", SV.replaced_total(F.col("total"), F.col("water"), F.col("composite_t_c")))
    out = out.select("site_id", "year", "water_t_c", "vegetation_t_c", "sediment_t_c", "composite_t_c", "replaced_total")
    return rounded(out, water_t_c=6, vegetation_t_c=6, sediment_t_c=6, composite_t_c=5, replaced_total=2)


@query("f5b_subsidence_water_carbon", W + DEPTH_SQL + """, a AS (SELECT year, count(CASE WHEN depth > 0 THEN 1 END) AS wet, sum(CASE WHEN depth > 0 THEN depth END) * 900 AS vol, count(CASE WHEN depth > 0 AND depth <= 2 THEN 1 END) * 0.09::DOUBLE AS veg, count(CASE WHEN depth > 0 THEN 1 END) * 0.09::DOUBLE AS sed FROM depth GROUP BY ALL)
SELECT year, wet AS wet_cells, round(vol, 2) AS volume_m3, round(veg, 4) AS vegetation_ha, round(sed, 4) AS sediment_ha, round(CASE WHEN wet > 0 THEN vol * 1000 / 1e6 + veg * 10 + sed * 100 END, 3) AS composite_t_c FROM a""")
def _(spark, sf):
    out = SV.subsidence_water_carbon(depth_cells(spark, sf), ["year"], CELL_M2, 1000.0, 10.0, 100.0, 2.0)
    return rounded(out, volume_m3=2, vegetation_ha=4, sediment_ha=4, composite_t_c=3)


# scores


@query("f7_min_max_score", W + SCORE_SQL + " SELECT unit_id, scenario, round(nc, 6) AS norm_carbon, round(nw, 6) AS norm_water, round(nh, 6) AS norm_habitat, round(score, 6) AS score FROM scored")
def _(spark, sf):
    out = SC.score_units(units(spark, sf), CRITERIA).select("unit_id", "scenario", "norm_carbon", "norm_water", "norm_habitat", "score")
    return rounded(out, norm_carbon=6, norm_water=6, norm_habitat=6, score=6)


@query("f8_ahp_weights")
def _(spark, sf):
    """One judgement matrix per nation, built from the mean size, balance and price level of its trade."""
    s = table(spark, sf, "supplier").groupBy("s_nationkey").agg(F.avg(F.abs("s_acctbal")).alias("a"), F.count(F.lit(1)).alias("b"), (F.avg("s_suppkey") + 1).alias("c"))
    share = [F.col(c) / (F.col("a") + F.col("b") * 500 + F.col("c")) + 0.1 for c in ("a", "b", "c")]
    cells = [F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), (share[i] / share[j]).alias("v")) for i in range(3) for j in range(3)]
    entries = s.select(F.col("s_nationkey").alias("panel_id"), F.explode(F.array(*cells)).alias("x")).select("panel_id", "x.*")
    bad = SC.ahp_problems(entries).select("panel_id").distinct()
    return rounded(SC.ahp_weights(entries.join(bad, "panel_id", "left_anti")), weight=6, lambda_max=6, ci=6, cr=6)


@query("f8_inconsistent_matrices", W + """s AS (SELECT s_suppkey, 1 + s_suppkey % 5 AS a, (1 + s_nationkey % 7) / 2 AS b, 2.0::DOUBLE ** (s_suppkey % 9 - 4) AS c FROM supplier), w AS (SELECT s_suppkey, (a * c) ** (1 / 3::DOUBLE) AS g0, (b / a) ** (1 / 3::DOUBLE) AS g1, (1 / (b * c)) ** (1 / 3::DOUBLE) AS g2, (c / (a * b)) ** (1 / 3::DOUBLE) AS k FROM s),
x AS (SELECT s_suppkey, [g0, g1, g2] AS g, g0 + g1 + g2 AS total, 1 + k + 1 / k AS lam FROM w)
SELECT s_suppkey AS panel_id, i::INT AS i, round(g[i + 1] / total, 6) AS weight, round(lam, 6) AS lambda_max, round((lam - 3) / 2, 6) AS ci, round((lam - 3) / 2 / 0.58, 6) AS cr, (lam - 3) / 2 / 0.58 <= 0.1 AS consistent FROM x, range(3) r(i)""")
def _(spark, sf):
    """A judgement matrix per supplier whose three judgements contradict each other more or less; of three rows the weights are the geometric means."""
    k = F.col("s_suppkey")
    v = {(0, 1): 1.0 + k % 5, (1, 2): (1.0 + F.col("s_nationkey") % 7) / 2, (0, 2): F.pow(F.lit(2.0), k % 9 - 4)}
    cell = lambda i, j: F.lit(1.0) if i == j else v[i, j].cast("double") if i < j else 1 / v[j, i].cast("double")
    cells = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), cell(i, j).alias("v")) for i in range(3) for j in range(3)]))
    entries = table(spark, sf, "supplier").select(k.alias("panel_id"), cells.alias("x")).select("panel_id", "x.*")
    return rounded(SC.ahp_weights(entries), weight=6, lambda_max=6, ci=6, cr=6)


@query("f16_weight_sensitivity", W + SCORE_SQL.replace(UNITS_SQL, EXACT_UNITS_SQL) + """, v(field, sign, wc, ww, wh) AS (VALUES ('base', 0, 0.5::DOUBLE, 0.25::DOUBLE, 0.25::DOUBLE), ('carbon', -1, 0.4 / 0.9, 0.25 / 0.9, 0.25 / 0.9), ('carbon', 1, 0.6 / 1.1, 0.25 / 1.1, 0.25 / 1.1), ('water', -1, 0.5 / 0.95, 0.2 / 0.95, 0.25 / 0.95), ('water', 1, 0.5 / 1.05, 0.3 / 1.05, 0.25 / 1.05), ('habitat', -1, 0.5 / 0.95, 0.25 / 0.95, 0.2 / 0.95), ('habitat', 1, 0.5 / 1.05, 0.25 / 1.05, 0.3 / 1.05)),
x AS (SELECT unit_id, field, sign, nc * wc + nw * ww + nh * wh AS sc FROM scored, v), r AS (SELECT *, row_number() OVER (PARTITION BY field, sign ORDER BY sc DESC, unit_id) AS rk FROM x)
SELECT a.field, a.sign, round(avg(abs(a.sc - b.sc)), 6) AS mean_change, round(max(abs(a.sc - b.sc)), 6) AS max_change, count(CASE WHEN a.rk <> b.rk THEN 1 END) AS rank_changes, max(abs(a.rk - b.rk)) AS max_shift FROM r a JOIN r b ON a.unit_id = b.unit_id AND b.sign = 0 WHERE a.sign <> 0 GROUP BY ALL""")
def _(spark, sf):
    return rounded(SC.weight_sensitivity(SC.score_units(units(spark, sf), CRITERIA), CRITERIA, 0.2), mean_change=6, max_change=6)


@query("e4_ordinal_ranks", W + SCORE_SQL + " SELECT unit_id, scenario, row_number() OVER (PARTITION BY scenario ORDER BY score DESC, unit_id) AS rank FROM scored")
def _(spark, sf):
    scored = SC.score_units(units(spark, sf), CRITERIA)
    return SC.ordinal_ranks(scored, ["scenario"]).select("unit_id", "scenario", "rank")


SERIES_SQL = "sc AS (SELECT r_name AS scenario, s_suppkey // 10 AS unit_id, avg(s_acctbal) AS score FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ALL)"


@query("c5_f17_scenario_comparison", W + SERIES_SQL + """, rf AS (FROM sc WHERE scenario = 'ASIA'), j AS (SELECT sc.*, rf.score AS ref FROM sc LEFT JOIN rf USING (unit_id))
SELECT j.scenario, count(*) AS units, round(avg(j.score), 4) AS mean, round(avg(j.score - ref), 4) AS paired_mean_delta, count(ref) AS paired, count(*) - count(ref) AS unpaired, round(avg(j.score) - (SELECT avg(score) FROM rf), 4) AS delta FROM j GROUP BY ALL""")
def _(spark, sf):
    u = units(spark, sf).select("unit_id", "scenario").join(table(spark, sf, "supplier"), F.col("unit_id") == F.col("s_suppkey"), "right")
    place = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "r_name")
    s = u.join(F.broadcast(place), F.col("s_nationkey") == F.col("n_nationkey"))  # 25 nations
    s = s.groupBy(F.col("r_name").alias("scenario"), F.expr("cast(s_suppkey div 10 as string)").alias("unit_id")).agg(F.avg("s_acctbal").alias("score"))
    return rounded(SC.compare_scenarios(s, "ASIA"), mean=4, paired_mean_delta=4, delta=4)


@query("e5_f18_calibration", "WITH c AS (SELECT o_custkey AS site, o_orderkey AS line, o_totalprice AS modeled, abs(o_totalprice - 150000) AS abs_error FROM orders) SELECT *, row_number() OVER (PARTITION BY site ORDER BY abs_error, line) = 1 AS selected FROM c")
def _(spark, sf):
    c = table(spark, sf, "orders").select(F.col("o_custkey").alias("site"), F.col("o_orderkey").alias("line"), F.col("o_totalprice").alias("modeled"))
    return SC.calibrate(c, 150000.0, ["site"])


# statistics


@query("e3_average_ranks", "SELECT event_id, round(rank() OVER (ORDER BY round(value, 12)) + (count(*) OVER (PARTITION BY round(value, 12)) - 1) / 2, 1) AS rank FROM events")
def _(spark, sf):
    return ST.average_ranks(table(spark, sf, "events").select("event_id", "value"), "value").select("event_id", F.round("rank", 1).alias("rank"))


@query("f9_tradeoff_synergy", W + EXACT_UNITS_SQL + """, r AS (SELECT rank() OVER (ORDER BY carbon) + (count(*) OVER (PARTITION BY carbon) - 1) / 2 AS c, rank() OVER (ORDER BY round(water, 12)) + (count(*) OVER (PARTITION BY round(water, 12)) - 1) / 2 AS w, rank() OVER (ORDER BY round(habitat, 12)) + (count(*) OVER (PARTITION BY round(habitat, 12)) - 1) / 2 AS h FROM units),
p AS (SELECT 'carbon' AS field_a, 'water' AS field_b, corr(c, w) AS rho, count(*) AS n FROM r UNION ALL SELECT 'carbon', 'habitat', corr(c, h), count(*) FROM r UNION ALL SELECT 'water', 'habitat', corr(w, h), count(*) FROM r)
SELECT field_a, field_b, round(rho, 6) AS rho, n, CASE WHEN rho > 0 THEN 'synergy' WHEN rho < 0 THEN 'tradeoff' ELSE 'neutral' END AS relation FROM p""")
def _(spark, sf):
    return rounded(ST.spearman(units(spark, sf), ["carbon", "water", "habitat"]), rho=6)


FIELDS = [c["field"] for c in CRITERIA]


@query("f10_permutation_test")
def _(spark, sf):
    return rounded(ST.permutation_tests(units(spark, sf), FIELDS), observed=6, p_value=6)


@query("f11_e11_bootstrap_interval")
def _(spark, sf):
    return rounded(ST.bootstrap_intervals(units(spark, sf), FIELDS), low=6, high=6)


@query("e6_benjamini_hochberg", """WITH t AS (SELECT s_suppkey, s_nationkey, (s_suppkey * 37 % 1009 + 1) / 1010.0::DOUBLE AS p_value FROM supplier), k AS (SELECT *, row_number() OVER (PARTITION BY s_nationkey ORDER BY p_value, s_suppkey) AS i, count(*) OVER (PARTITION BY s_nationkey) AS m FROM t)
SELECT s_suppkey, s_nationkey, round(p_value, 9) AS p_value, round(least(1, min(p_value * m / i) OVER (PARTITION BY s_nationkey ORDER BY i DESC)), 9) AS adjusted FROM k""")
def _(spark, sf):
    t = table(spark, sf, "supplier").select("s_suppkey", "s_nationkey", ((F.col("s_suppkey") * 37 % 1009 + 1) / 1010.0).alias("p_value"))
    return rounded(ST.benjamini_hochberg(t, by=["s_nationkey"]), p_value=9, adjusted=9)


@query("e7_quantile_bins", "WITH e AS (SELECT list_distinct(quantile_cont(l_extendedprice, [0, 0.2, 0.4, 0.6, 0.8, 1])) AS edges FROM lineitem) SELECT 'Q' || least(len(edges) - 1, len(list_filter(edges, lambda x: x <= l_extendedprice))) AS bin, count(*) AS n FROM lineitem, e GROUP BY ALL")
def _(spark, sf):
    li = table(spark, sf, "lineitem").select("l_extendedprice")
    label = ST.bin_label(F.col("l_extendedprice"), ST.quantile_edges(li, "l_extendedprice", 5))
    return li.groupBy(label.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def q_sql(stratum: str) -> str:
    return f"(SELECT greatest(0, least(1, 1 - sum(n * v) / (SELECT count(*) * var_pop(t) FROM s))) FROM (SELECT count(*) AS n, var_pop(t) AS v FROM s GROUP BY {stratum}))"


@query("f12_factor_detector", W + SAMPLES_SQL + " " + " UNION ALL ".join(f"SELECT '{f}' AS factor, round({q_sql(f)}, 8) AS q, count(DISTINCT {f}) AS strata, count(*) AS n FROM s" for f in FACTORS))
def _(spark, sf):
    return rounded(ST.factor_detector(factor_samples(spark, sf), "t", FACTORS), q=8)


_PAIRS = [(a, b) for i, a in enumerate(FACTORS) for b in FACTORS[i + 1 :]]


@query("f13_interaction_detector", W + SAMPLES_SQL + ", k AS (" + " UNION ALL ".join(f"SELECT '{a}' AS factor_a, '{b}' AS factor_b, {q_sql(a)} AS qa, {q_sql(b)} AS qb, {q_sql(a + ', ' + b)} AS qj" for a, b in _PAIRS) + """)
SELECT factor_a, factor_b, round(qa, 8) AS q_a, round(qb, 8) AS q_b, round(qj, 8) AS q_joint, CASE WHEN qj <= greatest(qa, qb) THEN 'weaken_or_non_enhance' WHEN abs(qj - qa - qb) <= 1e-9 THEN 'independent' WHEN qj < qa + qb THEN 'bi_factor_enhancement' ELSE 'nonlinear_enhancement' END AS interaction FROM k""")
def _(spark, sf):
    return rounded(ST.interaction_detector(factor_samples(spark, sf), "t", FACTORS), q_a=8, q_b=8, q_joint=8)


@query("f14_factor_permutation")
def _(spark, sf):
    """q and permutation p of every factor and of every pair's joint strata, from shared replicas."""
    return rounded(ST.factor_tests(factor_samples(spark, sf), "t", FACTORS), q=8, p_value=6)


@query("f15_geodetector_samples", W + cells_sql("p", PRICE) + ", " + cells_sql("i", INDEX) + ", " + cells_sql("q", QUANTITY) + """, j AS (SELECT p."row" AS r, p."col" AS c, p.value AS target, i.value AS discount, q.value AS quantity FROM p JOIN i USING (year, "row", "col") JOIN q USING (year, "row", "col") WHERE year = 1997 AND "row" % 2 = 0 AND "col" % 2 = 0),
e AS (SELECT list_distinct(quantile_cont(discount, [0, 0.25, 0.5, 0.75, 1])) AS d, list_distinct(quantile_cont(quantity, [0, 0.25, 0.5, 0.75, 1])) AS q FROM j)
SELECT printf('r%d_c%d', r, c) AS sample_id, 5 * (c + 0.5) AS x, -10 * (r + 0.5) + 1000 AS y, round(target, 4) AS target, 'Q' || least(len(d) - 1, len(list_filter(d, lambda z: z <= discount))) AS discount, 'Q' || least(len(q) - 1, len(list_filter(q, lambda z: z <= quantity))) AS quantity FROM j, e""")
def _(spark, sf):
    layer = lambda v: year_of(dated_cells(spark, sf, v), 1997)
    out = ST.build_samples(layer(PRICE), {"discount": layer(INDEX), "quantity": layer(QUANTITY)}, 2, GRID, 4)
    return rounded(out, target=4)


# classifiers


@query("f20_minimum_distance", W + PIXELS_SQL + """, m AS (SELECT label, avg(b1) m1, avg(b2) m2, avg(b3) m3, avg(b4) m4 FROM px WHERE vec_id % 5 <> 0 GROUP BY ALL), d AS (SELECT vec_id, px.label AS class, m.label AS p, (b1 - m1) ** 2 + (b2 - m2) ** 2 + (b3 - m3) ** 2 + (b4 - m4) ** 2 AS d2 FROM px, m), k AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d2, p) AS i FROM d)
SELECT vec_id, class, p AS predicted, round(d2, 6) AS distance2 FROM k WHERE i = 1""")
def _(spark, sf):
    px = pixels(spark, sf)
    return rounded(K.minimum_distance(px, px.filter("vec_id % 5 <> 0"), 4).drop("bands"), distance2=6)


@query("f21_maximum_likelihood")
def _(spark, sf):
    px = pixels(spark, sf)
    return rounded(K.maximum_likelihood(px, px.filter("vec_id % 5 <> 0"), 4).drop("bands"), score=6)


@query("f21_three_bands", W + PIXELS_SQL + """, m AS (SELECT label, avg(b1) m1, avg(b2) m2, avg(b3) m3, var_samp(b1) a, covar_samp(b1, b2) b, covar_samp(b1, b3) c, var_samp(b2) d, covar_samp(b2, b3) e, var_samp(b3) f FROM px WHERE vec_id % 5 <> 0 GROUP BY ALL),
i AS (SELECT *, a * (d * f - e * e) - b * (b * f - c * e) + c * (b * e - c * d) AS det FROM m),
q AS (SELECT vec_id, px.label AS class, i.label AS p, -0.5 * ln(det) - 0.5 / det * ((d * f - e * e) * (b1 - m1) ** 2 + (a * f - c * c) * (b2 - m2) ** 2 + (a * d - b * b) * (b3 - m3) ** 2
  + 2 * ((c * e - b * f) * (b1 - m1) * (b2 - m2) + (b * e - c * d) * (b1 - m1) * (b3 - m3) + (b * c - a * e) * (b2 - m2) * (b3 - m3))) AS score FROM px, i),
k AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY score DESC, p DESC) AS n FROM q) SELECT vec_id, class, p AS predicted, round(score, 6) AS score FROM k WHERE n = 1""")
def _(spark, sf):
    px = pixels(spark, sf)
    return rounded(K.maximum_likelihood(px, px.filter("vec_id % 5 <> 0"), 3).drop("bands"), score=6)


def share_model(tensor):
    """A scorer whose probabilities are the bands' shares of their sum, the k-th with 1 + k / 10 added; of one patch or of many."""
    up = np.nan_to_num(tensor) + 1.0 + 0.1 * np.arange(1, len(tensor) + 1).reshape(-1, *[1] * (tensor.ndim - 1))
    return up / up.sum(axis=0)


@query("f22_scored_patches", W + """cells AS (SELECT year(l_shipdate) AS layer_id, l_partkey // 10 AS "row", l_suppkey // 5 AS "col", [count(*), sum(l_linenumber) % 7, sum(l_orderkey) % 5]::DOUBLE[] AS b FROM lineitem GROUP BY ALL),
g AS (SELECT layer_id, max("row") + 1 AS h, max("col") + 1 AS w FROM cells GROUP BY ALL), sr AS (SELECT DISTINCT layer_id, least(r, greatest(h - 8, 0)) AS pr FROM g, range(0, h + 4, 4) a(r)), sc AS (SELECT DISTINCT layer_id, least(c, greatest(w - 8, 0)) AS pc FROM g, range(0, w + 4, 4) b(c)),
x AS (SELECT cells.*, "row" - pr AS i, "col" - pc AS j FROM cells JOIN sr ON sr.layer_id = cells.layer_id AND "row" - pr BETWEEN 0 AND 7 JOIN sc ON sc.layer_id = cells.layer_id AND "col" - pc BETWEEN 0 AND 7),
p AS (SELECT layer_id, "row", "col", k AS class, (b[k] + 1 + 0.1 * k) / (b[1] + b[2] + b[3] + 3.6) AS p, greatest((0.5 - 0.5 * cos(2 * pi() * i / 7)) * (0.5 - 0.5 * cos(2 * pi() * j / 7)), 0.05) AS w FROM x, range(1, 4) r(k)),
q AS (SELECT layer_id, "row", "col", class, round(sum(w * p) / sum(w), 9) AS p FROM p GROUP BY ALL), n AS (SELECT *, row_number() OVER (PARTITION BY layer_id, "row", "col" ORDER BY p DESC, class) AS n FROM q)
SELECT layer_id, "row", "col", class::INT AS class, round(p, 6) AS confidence, CASE WHEN p < 0.47 THEN 1 ELSE 0 END AS low_confidence FROM n WHERE n = 1""")
def _(spark, sf):
    """Patches of every layer cut, scored as arrays by a model, and blended."""
    cells = dated_stack(spark, sf, {"b1": "cast(count(*) as double)", "b2": "cast(sum(l_linenumber) % 7 as double)", "b3": "cast(sum(l_orderkey) % 5 as double)"}).withColumnRenamed("year", "layer_id")
    return rounded(K.predict_layers(cells, layer_sizes(spark, sf), share_model, 8, 4, ["b1", "b2", "b3"], [1, 2, 3], 0.47), confidence=6)


@query("f22_blended_prediction", W + """p AS (SELECT o_orderkey % 40 AS pr, o_custkey % 40 AS pc, (o_orderkey // 40) % 8 AS i, (o_custkey // 40) % 8 AS j, 1 + o_orderkey % 3 AS class, avg(o_totalprice) / 600000 AS p FROM orders GROUP BY ALL),
w AS (SELECT pr + i AS "row", pc + j AS "col", class, p, greatest((0.5 - 0.5 * cos(2 * pi() * i / 7)) * (0.5 - 0.5 * cos(2 * pi() * j / 7)), 0.05) AS w FROM p), q AS (SELECT "row", "col", class, sum(w * p) / sum(w) AS p FROM w GROUP BY ALL), k AS (SELECT *, row_number() OVER (PARTITION BY "row", "col" ORDER BY p DESC, class) AS n FROM q)
SELECT "row", "col", class, round(p, 6) AS confidence, CASE WHEN p < 0.25 THEN 1 ELSE 0 END AS low_confidence FROM k WHERE n = 1""")
def _(spark, sf):
    o = table(spark, sf, "orders")
    part = o.groupBy(
        (F.col("o_orderkey") % 40).alias("patch_row"), (F.col("o_custkey") % 40).alias("patch_col"), F.expr("(o_orderkey div 40) % 8").alias("i"), F.expr("(o_custkey div 40) % 8").alias("j"), (1 + F.col("o_orderkey") % 3).alias("class")
    ).agg((F.avg("o_totalprice") / 600000).alias("p"))
    return rounded(K.blend_predictions(part, 8, 0.25), confidence=6)


@query("f23_patch_classes", "WITH p AS (SELECT l_partkey AS patch_id, avg(CASE WHEN l_quantity > 22 THEN 1 ELSE 0 END) AS vs, max(l_linenumber) AS label, max(l_discount) * 10 AS conf FROM lineitem GROUP BY ALL) SELECT patch_id, round(vs, 6) AS valid_share, label, round(conf, 6) AS confidence, CASE label WHEN 1 THEN 3 WHEN 2 THEN 4 WHEN 3 THEN 5 WHEN 7 THEN 1 ELSE 2 END AS value, CASE WHEN conf < 0.9 THEN 1 ELSE 0 END AS low_confidence FROM p WHERE vs >= 0.5")
def _(spark, sf):
    li = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("patch_id"), F.when(F.col("l_quantity") > 22, 1).otherwise(0).alias("valid"), F.col("l_linenumber").alias("label"), (F.col("l_discount") * 10).alias("confidence"))
    return rounded(K.patch_classes(li, 0.9), valid_share=6, confidence=6)


# quality


@query("q1_carbon_table", """WITH t AS (SELECT p_size % 20 + CASE WHEN p_partkey % 50 = 0 THEN 0.5 ELSE 0 END AS lucode, CASE WHEN p_partkey % 30 = 0 THEN -1.0 ELSE p_retailprice END AS c_above, p_partkey FROM part)
SELECT lucode::DOUBLE::VARCHAR AS subject, 'integer_code' AS rule, count(*) AS n FROM t WHERE lucode <> floor(lucode) GROUP BY ALL UNION ALL SELECT lucode::DOUBLE::VARCHAR, 'c_above_not_negative', count(*) FROM t WHERE c_above < 0 GROUP BY ALL UNION ALL SELECT lucode::DOUBLE::VARCHAR, 'unique_code', 1 FROM t GROUP BY lucode HAVING count(*) > 1""")
def _(spark, sf):
    code = (F.col("p_size") % 20 + F.when(F.col("p_partkey") % 50 == 0, 0.5).otherwise(0.0)).cast("double")
    t = table(spark, sf, "part").select(code.alias("lucode"), F.when(F.col("p_partkey") % 30 == 0, -1.0).otherwise(F.col("p_retailprice")).alias("c_above"), *[F.lit(1.0).alias(c) for c in ("c_below", "c_soil", "c_dead")])
    return Q.carbon_table_violations(t).groupBy("subject", "rule").agg(F.count(F.lit(1)).alias("n"))


@query("q2_table_coverage", W + cells_sql() + ", t AS (SELECT DISTINCT p_size::BIGINT AS c FROM part WHERE p_size <= 5) SELECT (SELECT count(DISTINCT value) FROM cells WHERE value NOT IN (FROM t)) AS missing, (SELECT count(*) FROM t WHERE c NOT IN (SELECT value FROM cells)) AS extra, (SELECT count(DISTINCT value) FROM cells WHERE value NOT IN (FROM t)) = 0 AS covered")
def _(spark, sf):
    from loamgrid.operators.cells import code_coverage

    c = code_coverage(dated_cells(spark, sf), table(spark, sf, "part").filter("p_size <= 5").select(F.col("p_size").alias("lucode")))
    count = lambda s: F.count(F.when(F.col("status") == s, 1))
    return c.agg(count("missing").alias("missing"), count("extra").alias("extra"), (count("missing") == 0).alias("covered"))


@query("q3_layer_preflight", W + cells_sql() + """, g AS (SELECT year::VARCHAR AS layer_id, max("col") + 1 AS w, max("row") + 1 AS h, list(DISTINCT value) AS codes FROM cells GROUP BY year), m AS (FROM g WHERE layer_id = '1996')
SELECT layer_id AS subject, 'known_codes' AS rule, 'error' AS severity FROM g WHERE list_contains(codes, 7) UNION ALL SELECT g.layer_id, 'aligned', 'error' FROM g, m WHERE g.w <> m.w OR g.h <> m.h OR g.layer_id IN ('1999', '2001') UNION ALL SELECT layer_id, 'metre', 'error' FROM g WHERE layer_id = '2000'
UNION ALL SELECT layer_id, 'nodata_set', 'error' FROM g WHERE layer_id = '1998' UNION ALL SELECT layer_id, 'value_range', 'error' FROM g WHERE list_max(codes) > 6 UNION ALL SELECT layer_id, 'sensor', 'error' FROM g WHERE layer_id = '1997' UNION ALL SELECT layer_id, 'sensor_tag', 'warning' FROM g WHERE layer_id = '1995'
UNION ALL SELECT layer_id, 'band_count', 'error' FROM g WHERE layer_id = '1999' UNION ALL SELECT layer_id, 'band_names', 'error' FROM g WHERE layer_id = '2000' UNION ALL SELECT layer_id, 'cell_size', 'error' FROM g WHERE layer_id = '2001' UNION ALL SELECT 'table', 'datum', 'error'""")
def _(spark, sf):
    year = F.col("layer_id")
    names = lambda *x: F.array(*map(F.lit, x))
    layers = year_grids(spark, sf).withColumns({
        "kind": F.lit("lulc"), "projected": F.lit(True), "unit": F.when(year == "2000", "degree").otherwise("Metre"), "nodata": F.when(year != "1998", 0.0), "require_metre": F.lit(True), "require_nodata": F.lit(True),
        "allowed_codes": F.array(*[F.lit(float(c)) for c in CH.STANDARD_6]), "expected_range": F.array(F.lit(0.0), F.lit(6.0)), "expected_sensor": F.lit("Landsat 8 OLI"), "sensor": F.when(year == "1997", "TM").when(year != "1995", "landsat 8 oli"),
        "expected_bands": F.lit(1), "bands": F.when(year == "1999", 2).otherwise(1), "expected_band_names": names("class"), "band_names": F.when(year == "2000", names("code")).when(year != "1996", names("CLASS")),
        "expected_cell": F.lit(30.0), "a": F.when(year == "2001", 10.0).otherwise(30.0), "must_align": F.lit(True),
    })
    cells = dated_cells(spark, sf).select(F.col("year").cast("string").alias("layer_id"), F.col("value").cast("double").alias("value"))
    return Q.layer_violations(Z.layer_profile(cells, ["layer_id"]), layers, "1996", ("H85", "H56"))


@query("q3_carbon_coverage", W + cells_sql() + """, t AS (SELECT p_partkey, (CASE p_partkey % 9 WHEN 3 THEN 12 ELSE p_partkey % 9 END + CASE WHEN p_partkey % 40 = 0 THEN 0.5 ELSE 0 END)::DOUBLE AS c, CASE WHEN p_partkey % 30 = 0 THEN -1.0 ELSE 1.0 END AS v FROM part),
g AS (SELECT year::VARCHAR AS layer_id, list(DISTINCT value::DOUBLE) AS codes FROM cells GROUP BY year), h AS (SELECT list(DISTINCT c) AS have FROM t)
SELECT layer_id AS subject, 'carbon_missing' AS rule, 'error' AS severity FROM g, h WHERE len(list_filter(codes, lambda x: NOT list_contains(have, x))) > 0 UNION ALL SELECT layer_id, 'carbon_extra', 'warning' FROM g, h WHERE len(list_filter(have, lambda x: NOT list_contains(codes, x))) > 0
UNION ALL SELECT 'carbon density/' || c::VARCHAR, 'integer_code', 'error' FROM t WHERE c <> floor(c) UNION ALL SELECT 'carbon density/' || c::VARCHAR, 'c_above_not_negative', 'error' FROM t WHERE v < 0 UNION ALL SELECT 'carbon density/' || c::VARCHAR, 'unique_code', 'error' FROM t GROUP BY c HAVING count(*) > 1""")
def _(spark, sf):
    """The preflight of every layer with a carbon table that lacks a code, has others, and is faulty in itself."""
    k = F.col("p_partkey")
    code = (F.when(k % 9 == 3, 12).otherwise(k % 9) + F.when(k % 40 == 0, 0.5).otherwise(0.0)).cast("double")
    t = table(spark, sf, "part").select(code.alias("lucode"), F.when(k % 30 == 0, -1.0).otherwise(1.0).alias("c_above"), *[F.lit(1.0).alias(c) for c in ("c_below", "c_soil", "c_dead")])
    cells = dated_cells(spark, sf).select(F.col("year").cast("string").alias("layer_id"), F.col("value").cast("double").alias("value"))
    layers = year_grids(spark, sf).withColumns({"kind": F.lit("lulc")})
    return Q.layer_violations(Z.layer_profile(cells, ["layer_id"]), layers, carbon=t)


@query("q4_habitat_tables", W + cells_sql() + """, t AS (SELECT n_name AS threat, n_nationkey % 4 * 100.0 AS reach, CASE n_nationkey % 3 WHEN 0 THEN 'linear' WHEN 1 THEN 'exponential' ELSE 'step' END AS decay FROM nation)
SELECT threat AS subject, 'max_dist' AS rule FROM t WHERE reach <= 0 UNION ALL SELECT threat, 'decay' FROM t WHERE decay = 'step' UNION ALL SELECT threat, 'threat_column' FROM t WHERE threat NOT IN (SELECT n_name FROM nation WHERE n_nationkey < 20)
UNION ALL SELECT k || '/' || n_name, 'sensitivity' FROM nation, range(1, 6) r(k) WHERE n_nationkey < 20 AND (n_nationkey + k) / 20.0 > 1 UNION ALL SELECT DISTINCT value::VARCHAR, 'code_covered' FROM cells WHERE value > 5""")
def _(spark, sf):
    n = table(spark, sf, "nation")
    decay = F.element_at(F.array(*map(F.lit, ["linear", "exponential", "step"])), (F.col("n_nationkey") % 3 + 1).cast("int"))
    threats = n.select(F.col("n_name").alias("threat"), (F.col("n_nationkey") % 4 * 100.0).alias("max_dist"), F.lit(1.0).alias("weight"), decay.alias("decay"))
    s = n.filter("n_nationkey < 20").withColumn("lulc", F.explode(F.sequence(F.lit(1), F.lit(5))))
    sens = s.select("lulc", F.col("n_name").alias("threat"), ((F.col("n_nationkey") + F.col("lulc")) / 20).alias("sensitivity"), F.lit(0.5).alias("habitat"))
    return Q.threat_violations(threats, sens, dated_cells(spark, sf))


@query("q6_biophysical_table", "SELECT (p_partkey % 40)::VARCHAR AS subject, 'root_depth' AS rule, count(*) AS n FROM part WHERE p_size < 5 GROUP BY ALL UNION ALL SELECT (p_partkey % 40)::VARCHAR, 'lulc_veg', count(*) FROM part WHERE p_size % 3 = 2 GROUP BY ALL UNION ALL SELECT 'z', 'positive', 1")
def _(spark, sf):
    t = table(spark, sf, "part").select((F.col("p_partkey") % 40).alias("LUCODE"), (F.col("p_size") - 5).alias("Root_depth"), F.lit(0.8).alias("Kc"), (F.col("p_size") % 3).alias("lulc_veg"))
    return Q.biophysical_violations(t, 0.0).groupBy("subject", "rule").agg(F.count(F.lit(1)).alias("n"))


@query("q7_sample_coverage", """WITH s AS (SELECT CASE WHEN vec_id % 50 = 1 THEN '' ELSE label::VARCHAR END AS c, CASE WHEN vec_id % 5 = 0 THEN 'validation' WHEN vec_id % 7 = 0 THEN 'test' ELSE 'training' END AS role, CASE WHEN vec_id % 11 > 0 THEN '[' || vec_id % 83 || ',' || label || ']' END AS g,
  CASE WHEN vec_id % 13 = 0 THEN 'many' ELSE '9' END AS pixels FROM embeddings WHERE label <> 3 AND (label <> 4 OR vec_id % 4 = 0)), l AS (FROM s WHERE c <> ''), k AS (SELECT c, count(*) AS n FROM l GROUP BY c)
SELECT 'table' AS subject, 'blank_class' AS rule, 'error' AS severity, count(*) AS n FROM s WHERE c = '' HAVING count(*) > 0 UNION ALL SELECT c, 'few_samples', 'warning', n FROM k WHERE n < 30 UNION ALL SELECT '3', 'missing_class', 'error', 1 UNION ALL SELECT 'table', 'imbalance', 'warning', 1 FROM k HAVING max(n) / min(n) > 2
UNION ALL SELECT 'table', 'pixel_count', 'warning', count(*) FROM l WHERE pixels = 'many' HAVING count(*) > 0 UNION ALL SELECT 'table', 'geometry', 'error', count(*) FROM s WHERE g IS NULL HAVING count(*) > 0 UNION ALL SELECT 'table', 'crs', 'error', 1
UNION ALL SELECT 'table', 'overlap', 'error', count(*) FROM l WHERE role = 'validation' AND g IN (SELECT g FROM l WHERE role = 'training' AND g IS NOT NULL) HAVING count(*) > 0 UNION ALL SELECT 'test', 'other_role', 'error', count(*) FROM l WHERE role = 'test' HAVING count(*) > 0 UNION ALL SELECT 'validation', 'other_role', 'error', count(*) FROM l WHERE role = 'validation' HAVING count(*) > 0""")
def _(spark, sf):
    k = F.col("vec_id")
    e = table(spark, sf, "embeddings").filter("label <> 3 AND (label <> 4 OR vec_id % 4 = 0)")
    s = e.select(
        F.when(k % 50 == 1, "").otherwise(F.col("label").cast("string")).alias("class"), F.when(k % 5 == 0, "validation").when(k % 7 == 0, "test").otherwise("training").alias("role"),
        F.when(k % 11 > 0, F.to_json(F.array((k % 83).cast("long"), F.col("label").cast("long")))).alias("geometry"), F.lit(" ").alias("crs"), F.when(k % 13 == 0, "many").otherwise("9").alias("pixels"),
    )
    return Q.sample_violations(s, [str(i) for i in range(10)], 30, 2.0, training_only=True)


@query("q8_validation_samples", "WITH s AS (SELECT event_type AS label, count(*) AS n, count(CASE WHEN user_id % 7 = 0 THEN 1 END) AS bad FROM events GROUP BY ALL) SELECT label AS subject, 'known_label' AS rule FROM s WHERE label NOT IN ('click', 'view') UNION ALL SELECT label, 'coordinates' FROM s WHERE bad > 0 UNION ALL SELECT label, 'enough' FROM s WHERE n < 2000")
def _(spark, sf):
    e = table(spark, sf, "events").select(F.col("event_type").alias("label"), F.when(F.col("user_id") % 7 == 0, "n/a").otherwise(F.col("user_id").cast("string")).alias("x"), F.col("value").cast("string").alias("y"))
    return Q.validation_violations(e, ["click", "view"], 2000)


@query("q9_evidence_gate", """WITH p AS (SELECT n_name AS project, n_nationkey AS k FROM nation),
s AS (SELECT project, k, 'lulc' AS section, CASE WHEN k % 5 = 0 OR k % 7 = 0 THEN 2 ELSE 0 END AS level FROM p UNION ALL SELECT project, k, 'plus', CASE WHEN k > 20 THEN 2 WHEN k % 2 = 1 THEN 1 ELSE 0 END FROM p
 UNION ALL SELECT project, k, 'invest', CASE WHEN k % 3 = 0 THEN 1 WHEN k % 3 = 1 THEN CASE WHEN k / 10000.0 / (1 + k / 10000.0) <= 0.001 THEN 0 ELSE 2 END WHEN k % 4 = 0 THEN 2 ELSE 0 END FROM p
 UNION ALL SELECT project, k, 'ecosystem', CASE WHEN k > 10 THEN 2 ELSE 0 END FROM p UNION ALL SELECT project, k, 'subsidence_water', CASE k % 3 WHEN 0 THEN CASE WHEN k = 0 THEN 2 ELSE 0 END WHEN 1 THEN CASE WHEN k < 5 THEN 2 ELSE 0 END ELSE 2 END FROM p)
SELECT project, section, ['completed', 'pending_validation', 'failed'][level + 1] AS status, ['completed', 'pending_validation', 'failed'][max(level) OVER (PARTITION BY project) + 1] AS gate FROM s""")
def _(spark, sf):
    return Q.evidence_gate(evidence(spark, sf)).drop("broken")


def evidence(spark, sf):
    """``project, section, body``: reports of every nation, as JSON text, faulty in different ways."""
    k = F.col("n_nationkey")
    say = lambda **x: F.to_json(F.struct(*[v.alias(n) for n, v in x.items()]))
    one = lambda v: F.create_map(F.lit("1"), v)
    lit = F.lit
    scores = F.struct(lit(0.9).alias("precision"), lit(0.8).alias("recall"), lit(0.85).alias("f1"), F.when(k % 7 != 0, 0.7).alias("iou"))
    metrics = F.struct((0.8 + k / 200).alias("oa"), lit(0.7).alias("f1"), F.when(k % 5 == 0, 1.2).otherwise(0.6).alias("iou"), one(scores).alias("classes"))
    seed = lambda v: F.struct(v.alias("fom"))
    run = F.struct(lit("completed").alias("status"), F.array(lit("yield.tif")).alias("outputs"), F.create_map(lit("yield"), F.when(k % 4 == 0, "undeclared").otherwise("mm")).alias("units"))
    bodies = {
        "lulc": say(metrics=metrics),
        "plus": say(fom=k / 20, classes=one(F.struct(lit(0.5).alias("f1"), lit(0.4).alias("iou"))), seed_metrics=F.when(k % 2 == 0, F.array(seed(k / 30), seed(lit(0.2)))).otherwise(F.array(seed(lit(0.2))))),
        "invest": F.when(k % 3 == 0, "{}").when(k % 3 == 1, say(workflow_total_t_c=lit(5120.0), independent_total_t_c=5120 * (1 + k / 10000))).otherwise(say(carbon=F.struct(lit(1.0).alias("workflow_total_t_c"), lit(1.0).alias("independent_total_t_c")), models=F.create_map(lit("water_yield"), run))),
        "ecosystem": say(normalised_ranges=F.create_map(lit("carbon"), F.array(lit(0.0), lit(1.0))), method=lit("ahp"), ahp_consistency_ratio=k / 100, sensitivity=F.struct(lit(True).alias("available"), lit(1).alias("maximum_rank_shift"))),
        "subsidence_water": F.when(k % 3 == 0, say(mode=lit("classify_only"), water_code=k, water_cell_count=lit(10), water_area_m2=lit(9000.0))).when(k % 3 == 1, say(mode=lit("estimate_volume"), water_volume_m3=k - 5)).otherwise(say(mode=lit("guess"))),
    }
    rows = F.explode(F.array(*[F.struct(lit(n).alias("section"), b.alias("body")) for n, b in bodies.items()]))
    return table(spark, sf, "nation").select(F.col("n_name").alias("project"), rows.alias("r")).select("project", "r.*")


@query("q11_temporal_contract", """WITH p AS (SELECT c_custkey % 100 AS project, c_custkey // 100 AS pos, 1890 + c_custkey * 7 % 300 AS yr, CASE WHEN c_custkey % 5 = 0 THEN 'v' || c_custkey % 15 END AS f FROM customer), l AS (SELECT *, lag(yr) OVER (PARTITION BY project ORDER BY pos) AS prev FROM p)
SELECT project || '/' || yr AS subject, 'range' AS rule, count(*) AS n FROM l WHERE yr < 1900 OR yr > 2200 GROUP BY ALL UNION ALL SELECT project || '/' || yr, 'ascending', count(*) FROM l WHERE prev >= yr GROUP BY ALL UNION ALL SELECT project || '/' || yr, 'unique_year', 1 FROM p GROUP BY project, yr HAVING count(*) > 1 UNION ALL SELECT project || '/' || f, 'validation_file', 1 FROM p WHERE f IS NOT NULL GROUP BY project, f HAVING count(*) > 1""")
def _(spark, sf):
    c = F.col("c_custkey")
    p = table(spark, sf, "customer").select((c % 100).alias("project"), F.expr("c_custkey div 100").alias("position"), (1890 + c * 7 % 300).alias("year"), F.when(c % 5 == 0, F.concat(F.lit("v"), (c % 15).cast("string"))).alias("validation_file"))
    return Q.period_violations(p).groupBy("subject", "rule").agg(F.count(F.lit(1)).alias("n"))


@query("q13_rule_warnings", "SELECT n_name AS project, CASE n_nationkey % 3 WHEN 0 THEN 'annual_water_yield' WHEN 1 THEN 'habitat_quality' END AS service, CASE n_nationkey % 3 WHEN 0 THEN 'annual_water_yield' WHEN 1 THEN 'habitat_quality' END || ' should not be aggregated by sum' AS warning FROM nation WHERE n_nationkey % 3 < 2 AND n_nationkey % 2 = 0")
def _(spark, sf):
    k = F.col("n_nationkey")
    s = F.element_at(F.array(*map(F.lit, ["annual_water_yield", "habitat_quality", "carbon_storage"])), (k % 3 + 1).cast("int"))
    return Q.rule_warnings(table(spark, sf, "nation").select(F.col("n_name").alias("project"), s.alias("service"), F.when(k % 2 == 0, "sum").otherwise("mean").alias("rule")))


@query("a11_unit_geometry", W + cells_sql(value=INDEX) + ", " + EXTENT_SQL + """, u AS (SELECT DISTINCT "row" // 8 AS r, "col" // 8 AS c FROM cells WHERE year = 1997),
b AS (SELECT printf('r%05d_c%05d', r, c) AS unit_id, least(c * 8, w) * 5.0::DOUBLE AS x1, least(c * 8 + 8, w) * 5.0::DOUBLE AS x2, top * 10.0::DOUBLE - least(r * 8, h) * 10.0::DOUBLE AS y1, top * 10.0::DOUBLE - least(r * 8 + 8, h) * 10.0::DOUBLE AS y2 FROM u, gr)
SELECT unit_id, '{"type":"Feature","properties":{"unit_id":"' || unit_id || '"},"geometry":{"type":"Polygon","coordinates":[[[' || x1 || ',' || y1 || '],[' || x2 || ',' || y1 || '],[' || x2 || ',' || y2 || '],[' || x1 || ',' || y2 || '],[' || x1 || ',' || y1 || ']]]}}' AS feature FROM b""")
def _(spark, sf):
    cells = year_of(dated_cells(spark, sf, INDEX), 1997)
    return Z.unit_geometry(Z.grid_units(cells, 8, "mean", CELL_M2), extent(spark, sf), 8)


# files: each query writes what it reads


@query("a1_a6_a9_csv_table", W + UNITS_SQL + " SELECT scenario, unit_id::VARCHAR AS unit_id, round(carbon, 2) AS carbon, round(habitat, 6) AS habitat FROM units")
def _(spark, sf):
    path = scratch(spark, "units")
    IO.write_result(rounded(units(spark, sf, exact=False), carbon=2, habitat=6), path, ["scenario", "unit_id", "carbon", "habitat"], ["scenario", "unit_id"])
    return IO.read_csv(spark, path, ["scenario", "unit_id"], ["carbon", "habitat"])


@query("a2_cell_table", W + cells_sql(value=INDEX) + """ SELECT year::VARCHAR AS layer_id, "row", "col", round(value, 6) AS value FROM cells WHERE year IN (1996, 1997) AND value <> 0""")
def _(spark, sf):
    path = scratch(spark, "cells")
    cells = dated_cells(spark, sf, INDEX).select(F.col("year").cast("string").alias("layer_id"), "row", "col", "value")
    IO.write_cells(cells, path)
    return rounded(IO.read_cells(spark, path, ["1996", "1997"], 0.0).select(F.col("layer_id").cast("string").alias("layer_id"), "row", "col", "value"), value=6)


@query("a3_depth_points", """WITH l AS (SELECT l_orderkey % 7 AS k, l_suppkey AS x, l_partkey AS y, l_quantity * 10 - 20 AS w FROM lineitem) SELECT CASE WHEN k = 1 THEN 'too few fields' WHEN k = 2 THEN 'not a number' WHEN w < 0 THEN 'negative depth' END AS reason, count(*) AS n, round(sum(CASE WHEN k > 2 AND w >= 0 THEN w / 1000 END), 3) AS depth FROM l WHERE k > 0 GROUP BY ALL""")
def _(spark, sf):
    path, k = scratch(spark, "points"), F.col("l_orderkey") % 7
    w = (F.col("l_quantity") * 10 - 20).cast("string")
    line = F.when(k == 0, F.concat(F.lit("  # "), w)).when(k == 1, F.concat_ws(", ", F.col("l_suppkey").cast("string"), w)).when(k == 2, F.concat_ws(" ", F.col("l_suppkey").cast("string"), F.lit("?"), w)).otherwise(F.concat_ws(" , ", "l_suppkey", "l_partkey", w))
    table(spark, sf, "lineitem").select(line.alias("value")).write.text(path)
    good, bad = IO.read_depth_points(spark, path, flip=False)
    both = good.select(F.lit(None).cast("string").alias("reason"), "value").unionByName(bad.select("reason", F.lit(None).cast("double").alias("value")))
    return rounded(both.groupBy("reason").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("depth")), depth=3)


@query("a4_h5_vector_file", "SELECT n_name AS name, 'Point' AS geom_type, n_nationkey % 4 <> 0 AS finite, 'EPSG:32650' AS crs FROM nation")
def _(spark, sf):
    path, k = scratch(spark, "vector"), F.col("n_nationkey")
    at = F.when(k % 4 == 0, F.concat(F.lit('[1e999,'), k.cast("string"), F.lit("]"))).otherwise(F.concat(F.lit("["), k.cast("string"), F.lit(".5, -3]")))
    feature = F.concat(F.lit('{"type":"Feature","properties":{"name":"'), F.trim("n_name"), F.lit('"},"geometry":{"type":"Point","coordinates":'), at, F.lit("}}"))
    one = table(spark, sf, "nation").agg(F.array_join(F.array_sort(F.collect_list(feature)), ",").alias("f"))  # one document is one row, by its format
    one.select(F.concat(F.lit('{"type":"FeatureCollection","crs":{"type":"name","properties":{"name":"EPSG:32650"}},"features":['), "f", F.lit("]}")).alias("value")).coalesce(1).write.text(path)
    out = IO.read_geojson(spark, path)
    return out.select(F.col("props.name").alias("name"), "geom_type", Q.finite_coordinates(F.col("coordinates")).alias("finite"), "crs")


@query("a4_large_vector_file", "SELECT row_number() OVER (ORDER BY p_partkey)::INT - 1 AS feature_id, p_name AS name, p_partkey::VARCHAR AS id, 'Point' AS geom_type, '[' || p_partkey || ',' || p_size || ']' AS coordinates, 'EPSG:32650' AS crs FROM part")
def _(spark, sf):
    """One document with a feature per part, read by many tasks."""
    path = scratch(spark, "large_vector")
    k = F.col("p_partkey").cast("string")
    feature = F.concat(F.lit('{"type":"Feature","properties":'), F.to_json(F.struct(F.col("p_name").alias("name"), k.alias("id"))), F.lit(',"geometry":{"type":"Point","coordinates":['), k, F.lit(","), F.col("p_size").cast("string"), F.lit("]}}"))
    ends = spark.createDataFrame([(-1, 0, '{"type":"FeatureCollection","crs":{"type":"name","properties":{"name":"EPSG:32650"}},"features":['), (1, 0, "]}")], "part int, place long, value string")
    body = table(spark, sf, "part").select(F.lit(0).alias("part"), F.col("p_partkey").alias("place"), feature.alias("value"))
    first = body.agg(F.min("place").alias("_first"))
    body = body.join(F.broadcast(first), F.lit(True)).select("part", "place", F.concat(F.when(F.col("place") > F.col("_first"), ",").otherwise(""), "value").alias("value"))
    ends.unionByName(body).coalesce(1).sortWithinPartitions("part", "place").select("value").write.text(path)  # one document is one file
    out = IO.read_features(spark, path)
    return out.select("feature_id", F.col("props.name").alias("name"), F.col("props.id").alias("id"), "geom_type", "coordinates", "crs")


@query("a5_roi_file", "SELECT CASE WHEN s_suppkey % 10 = 0 THEN 'unnamed' ELSE 'class ' || s_nationkey END AS class, sum(1 + s_suppkey % 3)::BIGINT AS polygons FROM supplier GROUP BY ALL")
def _(spark, sf):
    path, k = scratch(spark, "roi"), F.col("s_suppkey")
    name = F.when(k % 10 == 0, F.lit(" ")).otherwise(F.concat(F.lit("class "), F.col("s_nationkey").cast("string")))
    polygons = F.array_join(F.array_repeat(F.lit("<Polygon><Coordinates>0 0 1 0 1 1</Coordinates></Polygon>"), (1 + k % 3).cast("int")), "")
    region = F.concat(F.lit('<Region name="'), name, F.lit('"><GeometryDef>'), polygons, F.lit("</GeometryDef></Region>"))
    one = table(spark, sf, "supplier").groupBy(F.col("s_nationkey").alias("file")).agg(F.array_join(F.collect_list(region), "").alias("regions"))  # one document is one row, by its format
    one.select("file", F.concat(F.lit("<RegionsOfInterest>"), "regions", F.lit("</RegionsOfInterest>")).alias("value")).repartition("file").write.partitionBy("file").text(path)
    roi = IO.read_roi_xml(spark, path)
    named = F.when(F.col("class").startswith("unnamed_region_"), "unnamed").otherwise(F.col("class"))
    return roi.groupBy(named.alias("class")).agg(F.count(F.lit(1)).alias("polygons"))


@query("a7_evidence_files", "SELECT project, section, status = 'completed' AS completed FROM (" + SQL["q9_evidence_gate"] + ")")
def _(spark, sf):
    """Reports of all sections as files of a tree, assembled by pattern and put to the gate."""
    path = scratch(spark, "evidence")
    docs = evidence(spark, sf).select("project", F.col("section").alias("part"), F.col("body").alias("value"))
    docs.repartition("project").write.partitionBy("project", "part").text(path)
    found = IO.assemble_evidence(spark, path, {s: [rf"part={s}/.*\\.json$", rf"part={s}/part-[^/]*$"] for s in ("lulc", "plus", "invest", "ecosystem", "subsidence_water")}, per_folder=True)
    project = F.regexp_extract(F.url_decode("folder"), "project=([^/]*)/", 1)
    return Q.evidence_gate(found.select(project.alias("project"), "section", "body")).select("project", "section", (F.col("status") == "completed").alias("completed"))


@query("a12_a13_a15_manifest", "SELECT 2 AS files, true AS same_digest, count(DISTINCT s_suppkey) AS units, true AS digests FROM supplier")
def _(spark, sf):
    """A result, its sidecar, and the inventory and digest of the tree that holds both."""
    path = scratch(spark, "tree")
    n = table(spark, sf, "supplier").select("s_suppkey").distinct().count()
    IO.write_result(table(spark, sf, "supplier").coalesce(1), f"{path}/result", ["s_suppkey", "s_acctbal"], ["s_suppkey"])
    IO.write_sidecar(spark, f"{path}/sidecar", {"units": n, "rule": "sum"})
    files = IO.file_inventory(spark, path).filter("path LIKE '%part-%'")
    digests = [IO.directory_digest(files, path).first()["sha256"] for _ in range(2)]
    side = spark.read.json(f"{path}/sidecar")
    out = files.agg(F.count(F.lit(1)).cast("int").alias("files"), F.min(F.length("sha256") == 64).alias("digests"))
    return out.join(F.broadcast(side.select(F.col("units"))), F.lit(True)).withColumn("same_digest", F.lit(digests[0] == digests[1]))
