"""Registered queries of the model search, scoring, selection and budget operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mediamix.grain import Grain
from mediamix.modelling import budget, cluster, decompose, exposure_fit, features, pareto, score, search
from mediamix.modelling.search import BOUNDS, ModelSpec
from mediamix.operators import calendar, conform
from mediamix.plans.model import SearchOptions, Selection, select_models
from mediamix.queries.prepare import rounded
from mediamix.queries.sqltext import PRICE, SALES, SPENDS, rounded_sql, sql
from mediamix.session import cut_lineage
from mediamix.sources import star

SEGMENT = Grain(("segment",), "date", unique=True)
CHANNELS = [c for _, c, _ in star.CHANNELS]
MEDIA = [(c, f"{ch}_spend", f"{ch}_impressions") for _, c, ch in star.CHANNELS]
PRIORITIES = [p for p, _, _ in star.CHANNELS]
SMALL = {"trials": 1, "iterations": 3}


def segment_weeks(spark: SparkSession, d: str) -> DataFrame:
    """Gap-free weekly panel by segment, absent cells as 0."""
    values = [*SALES, PRICE, "cpi", *SPENDS, *[e for _, _, e in MEDIA]]
    weekly = calendar.convert_grain(star.panel_daily(spark, d), "date", "daily", "weekly")
    sums = weekly.groupBy(conform.segment_key(["region", "category"]).alias("segment"), "date").agg(
        *[(F.avg(c) if c in (PRICE, "cpi") else F.sum(c)).alias(c) for c in values]
    )
    return calendar.fill_calendar(sums, SEGMENT, "weekly").fillna(0.0, values)


def media(spark: SparkSession, d: str) -> DataFrame:
    return features.media_long(segment_weeks(spark, d), MEDIA)


def holidays(spark: SparkSession, d: str) -> DataFrame:
    """Days with orders that are a fixed holiday."""
    return (
        star.table(spark, d, "orders")
        .select(F.to_date("o_orderdate").alias("date"))
        .distinct()
        .filter(F.date_format("date", "MM-dd").isin("01-01", "08-15", "12-25"))
    )


def all_segments(spark: SparkSession, d: str) -> DataFrame:
    return conform.segments(star.panel_daily(spark, d), ["region", "category"])


def carried(spark: SparkSession, d: str) -> DataFrame:
    weeks = media(spark, d)
    grid = search.candidate_grid(weeks.select("segment").distinct(), CHANNELS, **SMALL)
    return search.adstock_long(weeks, grid)


def saturated(spark: SparkSession, d: str) -> DataFrame:
    x = search.hill(F.col("adstocked"), F.col("alpha"), F.col("gamma"), F.col("low"), F.col("high"))
    return carried(spark, d).withColumn("x", x)


def media_effects(spark: SparkSession, d: str) -> DataFrame:
    """Saturated media with a coefficient that depends on the candidate."""
    coef = (F.col("candidate") + 1) * 1000.0
    return saturated(spark, d).withColumns({"coef": coef, "effect": coef * F.col("x")})


def channels(spark: SparkSession, d: str) -> DataFrame:
    return decompose.with_shares(star.solution_channels(spark, d))


def fits(spark: SparkSession, d: str) -> DataFrame:
    return decompose.fit_metrics(star.solution_weekly(spark, d), channels(spark, d))


def measures(spark: SparkSession, d: str) -> DataFrame:
    """Measures of all solutions, written once; their sources are read once each."""
    parts, weekly = cut_lineage(star.solution_channels(spark, d)), cut_lineage(star.solution_weekly(spark, d))
    shared = decompose.with_shares(parts)
    return cut_lineage(score.measure_solutions(decompose.fit_metrics(weekly, shared), shared, weekly, PRIORITIES))


def order_points(spark: SparkSession, d: str) -> DataFrame:
    """Orders of each region as points: little quantity against a high price."""
    return (
        star.sales_lines(spark, d, {"price": star.money("l_extendedprice"), "quantity": star.money("l_quantity")})
        .groupBy(F.col("r_name").alias("segment"), F.col("l_orderkey").cast("string").alias("sol_id"))
        .agg(
            F.sum("quantity").cast("double").alias("nrmse"),
            (10_000_000 - F.sum("price")).cast("double").alias("decomp_rssd"),
        )
    )


def curve_inputs(spark: SparkSession, d: str) -> DataFrame:
    """One curve per segment and channel: mean weekly spend, exposure as the scale."""
    at = F.lit(7)
    params = {
        name: F.element_at(
            F.create_map(*[v for i, c in enumerate(CHANNELS) for v in (F.lit(c), search.parameter(name, at, i))]), F.col("channel")
        )
        for name in BOUNDS
    }
    return (
        media(spark, d)
        .groupBy("segment", "channel")
        .agg(F.avg("spend").alias("mean_spend"), F.sum("exposure").alias("coef"), F.max("spend").alias("top"))
        .withColumns(params)
        .withColumn("half", F.col("gamma") * F.col("top"))
    )


def panel_spec(spark: SparkSession, d: str) -> tuple[DataFrame, ModelSpec]:
    panel = features.time_features(segment_weeks(spark, d), holidays(spark, d))
    context = (("cpi", "default"), ("trend", "default"), ("season_sin", "default"), ("season_cos", "default"), ("holiday", "positive"))
    return panel, ModelSpec("sales_revenue", tuple((c, s) for c, s, _ in MEDIA), context)


def candidate_fits(spark: SparkSession, d: str) -> DataFrame:
    panel, spec = panel_spec(spark, d)
    return search.search_candidates(cut_lineage(panel), spec)


# Selections by session and folder: their tables are written, and several queries show parts of one.
_SELECTED: dict[tuple[str, str], Selection] = {}


def selection(spark: SparkSession, d: str) -> Selection:
    key = (spark.sparkContext.applicationId, d)
    if key not in _SELECTED:
        panel, spec = panel_spec(spark, d)
        panel = cut_lineage(panel)
        exposures = {c: e for c, _, e in MEDIA}
        _SELECTED[key] = select_models(panel, spec, features.media_long(panel, MEDIA), exposures=exposures)
    return _SELECTED[key]


def spoilt_panel(spark: SparkSession, d: str) -> tuple[DataFrame, ModelSpec]:
    """The panel with the target of two regions spoilt: one has none, the other never varies."""
    panel, spec = panel_spec(spark, d)
    region = F.split("segment", "_")[0]
    target = F.when(region == "ASIA", F.lit(None)).when(region == "EUROPE", 7.0).otherwise(F.col(spec.target))
    return panel.withColumn(spec.target, target.cast("double")), spec


def quarantined_segments(spark: SparkSession, d: str) -> DataFrame:
    """Segments that the search reports instead of failing for all."""
    panel, spec = spoilt_panel(spark, d)
    found = search.search_report(cut_lineage(panel), spec)
    return found.filter(F.col("error").isNotNull()).select("segment", F.col("error").alias("reason")).distinct()


def clustered(spark: SparkSession, d: str) -> DataFrame:
    points = cut_lineage(measures(spark, d).join(fits(spark, d).select("segment", "sol_id", "mape"), ["segment", "sol_id"]))
    return cluster.cluster_solutions(points, ["roas", "roas_cv", "carryover_pct", "max_share_delta"])


_grid_columns = {
    p: "CASE channel " + " ".join(
        f"WHEN '{c}' THEN {low} + {high - low}::DOUBLE*((candidate+1)*{search._irrational(3 * i + j)!r}::DOUBLE - FLOOR((candidate+1)*{search._irrational(3 * i + j)!r}::DOUBLE))"
        for i, c in enumerate(CHANNELS)
    ) + " END"
    for j, (p, (low, high)) in enumerate(BOUNDS.items())
}


def _grid_sql(trials: int, iterations: int) -> str:
    names = ", ".join(f"('{c}')" for c in CHANNELS)
    return (
        f"SELECT segment, CAST(candidate // {iterations} + 1 AS VARCHAR) || '_' || CAST(candidate % {iterations} + 1 AS VARCHAR) AS sol_id, CAST(candidate AS INTEGER) AS candidate, channel, "
        + ", ".join(f"{e} AS {p}" for p, e in _grid_columns.items())
        + f" FROM (SELECT DISTINCT segment FROM media), range({trials * iterations}) r(candidate), (VALUES {names}) v(channel)"
    )


_carried = (
    f"grid AS ({_grid_sql(**SMALL)}), carried0 AS (SELECT g.segment, g.sol_id, g.candidate, g.channel, g.theta, g.alpha, g.gamma, t.date, t.spend, "
    "SUM(s.spend * POWER(g.theta, (t.date - s.date) // 7)) AS adstocked FROM grid g JOIN media t ON g.segment=t.segment AND g.channel=t.channel "
    "JOIN media s ON s.segment=t.segment AND s.channel=t.channel AND s.date<=t.date GROUP BY ALL), "
    "carried AS (SELECT *, MIN(adstocked) OVER (PARTITION BY segment, sol_id, channel) AS low, MAX(adstocked) OVER (PARTITION BY segment, sol_id, channel) AS high FROM carried0), "
    "saturated AS (SELECT *, POWER(adstocked, alpha)/(POWER(adstocked, alpha) + POWER(low + gamma*(high-low), alpha)) AS x FROM carried) "
)


def _on_media(body: str, extra: str = "") -> str:
    head = sql("", "media").rstrip()
    return f"{head}{', ' + extra if extra else ''} {body}"


def _front_sql(source: str) -> str:
    """Whole-number first criterion, so "strictly less" is a range of one."""
    return (
        f"SELECT segment, sol_id, nrmse, decomp_rssd FROM (SELECT *, MIN(decomp_rssd) OVER (PARTITION BY segment ORDER BY nrmse RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before, "
        f"MIN(decomp_rssd) OVER (PARTITION BY segment, nrmse) AS here FROM {source}) WHERE decomp_rssd=here AND (before IS NULL OR decomp_rssd<before)"
    )


POINTS_SQL = (
    "SELECT r_name AS segment, CAST(o_orderkey AS VARCHAR) AS sol_id, CAST(SUM(CAST(l_quantity AS DECIMAL(14,2))) AS DOUBLE) AS nrmse, "
    "CAST(10000000 - SUM(CAST(l_extendedprice AS DECIMAL(14,2))) AS DOUBLE) AS decomp_rssd FROM lineitem JOIN orders ON l_orderkey=o_orderkey "
    "JOIN supplier ON l_suppkey=s_suppkey JOIN nation ON s_nationkey=n_nationkey JOIN region ON n_regionkey=r_regionkey GROUP BY 1,2"
)
# Peels fronts off level by level; a point's front is the number of levels that still have it.
FRONTS_SQL = (
    f"WITH RECURSIVE p0 AS MATERIALIZED ({POINTS_SQL}), "
    "level AS (SELECT *, 1 AS n FROM p0 UNION ALL SELECT segment, sol_id, nrmse, decomp_rssd, n + 1 FROM (SELECT *, "
    "MIN(decomp_rssd) OVER (PARTITION BY segment ORDER BY nrmse RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before, "
    "MIN(decomp_rssd) OVER (PARTITION BY segment, nrmse) AS here FROM level) WHERE NOT (decomp_rssd=here AND (before IS NULL OR decomp_rssd<before))), "
    "numbered AS (SELECT segment, sol_id, nrmse, decomp_rssd, CAST(MAX(n) AS INTEGER) AS front FROM level GROUP BY 1,2,3,4), "
    "counted AS (SELECT segment, front, SUM(COUNT(*)) OVER (PARTITION BY segment ORDER BY front) AS n FROM numbered GROUP BY 1,2), "
    f"enough AS (SELECT segment, GREATEST({pareto.FRONTS}, COALESCE(MIN(front) FILTER (n >= {pareto.MIN_CANDIDATES}), MAX(front))) AS last FROM counted GROUP BY 1) "
    "SELECT numbered.* FROM numbered JOIN enough USING (segment) WHERE front <= last"
)


def _mm_sql() -> str:
    """The same search, every round as two common tables over rows and points."""
    last = exposure_fit.POINTS - 1
    g = "(CASE WHEN u<>0 THEN u/(k+u) ELSE 0.0 END)"
    h = "(CASE WHEN u<>0 THEN u/((k+u)*(k+u)) ELSE 0.0 END)"
    tables = [
        "totals AS (SELECT segment, channel, AVG(spend) AS mean_spend, SUM(exposure*exposure) AS syy, SUM(spend*exposure) AS sxy, SUM(spend*spend) AS sxx, "
        "SUM(exposure*exposure)-SUM(exposure)*SUM(exposure)/COUNT(*) AS tss FROM media GROUP BY 1,2)",
        "scaled AS (SELECT segment, channel, COALESCE(spend/NULLIF(mean_spend,0),0.0) AS u, exposure AS y FROM media JOIN totals USING (segment, channel))",
        f"b0 AS (SELECT segment, channel, LN({exposure_fit.LOW}::DOUBLE) AS low, LN({exposure_fit.HIGH}::DOUBLE) AS high FROM totals)",
    ]
    for n in range(exposure_fit.ROUNDS):
        tables.append(
            f"p{n} AS (SELECT segment, channel, i, low, step, SUM(y*{g})*SUM({g}*{h})-SUM(y*{h})*SUM({g}*{g}) AS rise, COALESCE(SUM(y*{g})*SUM(y*{g})/NULLIF(SUM({g}*{g}),0),-1) AS gain "
            f"FROM (SELECT *, EXP(low+step*i) AS k FROM (SELECT *, (high-low)/{last} AS step FROM scaled JOIN b{n} USING (segment, channel)), range({last + 1}) r(i)) GROUP BY 1,2,3,4,5)"
        )
        if n == 0:
            at = f"SELECT segment, channel, low, step, CASE WHEN rise>0 THEN i ELSE i-1 END AS place FROM p0 QUALIFY ROW_NUMBER() OVER (PARTITION BY segment, channel ORDER BY gain DESC, i)=1"
        else:
            at = f"SELECT segment, channel, ANY_VALUE(low) AS low, ANY_VALUE(step) AS step, COALESCE(MIN(i) FILTER (i>0 AND rise<=0), {last})-1 AS place FROM p{n} GROUP BY 1,2"
        tables.append(f"a{n} AS (SELECT *, GREATEST(0, LEAST(place, {last - 1})) AS inside FROM ({at}))")
        tables.append(
            f"b{n + 1} AS (SELECT a.segment, a.channel, a.low+a.step*inside AS low, a.low+a.step*(inside+1) AS high, x.rise AS rise, y.rise AS fall FROM a{n} a "
            f"JOIN p{n} x ON x.segment=a.segment AND x.channel=a.channel AND x.i=inside JOIN p{n} y ON y.segment=a.segment AND y.channel=a.channel AND y.i=inside+1)"
        )
    crossing = "rise>0 AND fall<=0"
    tables.append(
        f"ends AS (SELECT segment, channel, CASE WHEN place<0 THEN 'low' WHEN place>={last} THEN 'high' END AS edge, {crossing} AND place>=0 AND place<{last} AS converged, "
        f"CASE WHEN place<0 THEN {exposure_fit.LOW}::DOUBLE WHEN place>={last} THEN {exposure_fit.HIGH}::DOUBLE ELSE EXP(b.low+(high-b.low)*(CASE WHEN {crossing} THEN rise/(rise-fall) WHEN rise>0 THEN 1.0 ELSE 0.0 END)) END AS k "
        f"FROM b{exposure_fit.ROUNDS} b JOIN (SELECT segment, channel, place FROM a0) USING (segment, channel))"
    )
    tables.append(f"best AS (SELECT segment, channel, ANY_VALUE(k) AS k, ANY_VALUE(edge) AS edge, ANY_VALUE(converged) AS converged, SUM(y*{g}) AS yg, SUM({g}*{g}) AS gg FROM scaled JOIN ends USING (segment, channel) GROUP BY 1,2)")
    return _on_media(
        "SELECT segment, channel, mean_spend, yg/NULLIF(gg,0) AS vmax, CASE WHEN gg>0 THEN k*mean_spend END AS km, 1-(syy-yg/NULLIF(gg,0)*yg)/NULLIF(tss,0) AS rsq_nls, "
        "sxy/NULLIF(sxx,0) AS coef_lm, 1-(syy-sxy/NULLIF(sxx,0)*sxy)/NULLIF(tss,0) AS rsq_lm, CASE WHEN gg>0 THEN edge END AS km_edge, gg>0 AND converged AS converged FROM totals JOIN best USING (segment, channel)",
        ", ".join(tables),
    )


MM_SQL = _mm_sql()
CURVES_SQL = _on_media(
    "SELECT segment, channel, CAST(step AS INTEGER) AS step, mean_spend, mean_spend*2/100*step AS spend, coef*h(step) AS response, CASE WHEN step>0 THEN coef*h(step)-coef*h(step-1) ELSE 0.0 END AS marginal FROM inputs, range(101) r(step)",
    "inputs AS (SELECT segment, channel, AVG(spend) AS mean_spend, SUM(exposure) AS coef, MAX(spend) AS top, "
    + ", ".join(f"{e.replace('candidate', '7')} AS {p}" for p, e in _grid_columns.items())
    + " FROM media GROUP BY 1,2)",
)
_hill = "(POWER(mean_spend*2/100*({s})/(1-theta), alpha)/(POWER(mean_spend*2/100*({s})/(1-theta), alpha) + POWER(gamma*top, alpha)))"
CURVES_SQL = CURVES_SQL.replace("h(step-1)", _hill.replace("{s}", "step-1")).replace("h(step)", _hill.replace("{s}", "step"))



def _cluster_sql(body: str, rounds: int = 80) -> str:
    """The same seeds, moves and choice of k in SQL; the moves as a recursion of fixed depth."""
    names = ["roas", "roas_cv", "carryover_pct", "max_share_delta"]
    scaled = ", ".join(f"COALESCE(({c} - AVG({c}) OVER w) / NULLIF(STDDEV_POP({c}) OVER w, 0), 0)" for c in names)
    distance = " + ".join(f"(v[{i}] - c[{i}]) * (v[{i}] - c[{i}])" for i in range(1, 5))
    dot = " + ".join(f"f.v[{i}] * m.c[{i}]" for i in range(1, 5))
    means = ", ".join(f"AVG(v[{i}])" for i in range(1, 5))
    square = " + ".join(f"v[{i}] * v[{i}]" for i in range(1, 5))
    text = sql("SELECT 1", "measures", "fits").rstrip()
    head = text[: text.rindex("SELECT 1")].rstrip()
    return (
        f"{head.replace('WITH ', 'WITH RECURSIVE ', 1)}, base AS (SELECT m.*, f.mape FROM (SELECT segment, sol_id, {', '.join(names)}, nrmse, decomp_rssd FROM measures) m JOIN (SELECT segment, sol_id, mape FROM fits) f USING (segment, sol_id)), "
        f"vectors AS MATERIALIZED (SELECT segment, sol_id, nrmse, [{scaled}] AS v FROM base WINDOW w AS (PARTITION BY segment)), "
        "ranked AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY segment ORDER BY nrmse, sol_id) - 1 AS place, COUNT(*) OVER (PARTITION BY segment) AS n FROM vectors), "
        f"wanted AS (SELECT segment, n, CASE WHEN r.k = {cluster.MIN_K} THEN LEAST(r.k, n) ELSE r.k END AS k FROM (SELECT DISTINCT segment, n FROM ranked), range({cluster.MIN_K}, {cluster.MAX_K + 1}) r(k) WHERE r.k = {cluster.MIN_K} OR r.k <= n), "
        "seeds AS (SELECT w.segment, w.k, j AS cluster, v AS c FROM wanted w, range(10) r(j), ranked x WHERE j < w.k AND x.segment = w.segment AND x.place = CAST(FLOOR((j + 0.5) * w.n / w.k) AS BIGINT)), "
        f"state AS (SELECT 0 AS round, segment, k, sol_id, ANY_VALUE(v) AS v, arg_min(cluster, {{'d': {distance}, 'i': cluster}}) AS cluster FROM seeds JOIN vectors USING (segment) GROUP BY segment, k, sol_id "
        f"UNION ALL SELECT round + 1, segment, k, p.sol_id, ANY_VALUE(p.v), arg_min(cluster, {{'d': {distance}, 'i': cluster}}) FROM "
        f"(SELECT round, segment, k, ROW_NUMBER() OVER (PARTITION BY segment, k ORDER BY state.cluster) - 1 AS cluster, [{means}] AS c FROM state WHERE round < {rounds} GROUP BY round, segment, k, state.cluster) m JOIN vectors p USING (segment) GROUP BY round, segment, k, p.sol_id), "
        f"final AS MATERIALIZED (SELECT * FROM state WHERE round = {rounds}), "
        f"middles AS (SELECT segment, k, cluster, COUNT(*) AS n, AVG({square}) AS sq, [{means}] AS c FROM final GROUP BY 1,2,3), "
        f"apart AS (SELECT f.segment, f.k, f.sol_id, m.n, m.cluster = f.cluster AS own, GREATEST({square.replace('v[', 'f.v[')} + m.sq - 2 * ({dot}), 0) AS d FROM final f JOIN middles m ON m.segment = f.segment AND m.k = f.k), "
        "sides AS (SELECT segment, k, sol_id, MAX(n) FILTER (own) AS n, MAX(d * n / NULLIF(n - 1, 0)) FILTER (own) AS inside, MIN(d) FILTER (NOT own) AS outside FROM apart GROUP BY 1,2,3), "
        "silhouettes AS (SELECT segment, k, AVG(CASE WHEN n > 1 THEN COALESCE((outside - inside) / NULLIF(GREATEST(outside, inside), 0), 0) ELSE 0 END) AS silhouette FROM sides GROUP BY 1,2), "
        "chosen AS (SELECT final.* FROM final JOIN (SELECT segment, arg_max(k, {'s': silhouette, 'k': -k}) AS k FROM silhouettes GROUP BY 1) USING (segment, k)) " + body
    )


Q, S = {}, {}

Q["time_features"] = lambda s, d: rounded(features.time_features(segment_weeks(s, d).select("segment", "date", "sales_qty"), holidays(s, d)))
S["time_features"] = rounded_sql(
    _on_media(
        "SELECT w.segment, w.date, COALESCE(q, 0.0) AS sales_qty, (w.date - MIN(w.date) OVER (PARTITION BY w.segment))/7 AS trend, SIN(2*PI()*dayofyear(w.date)/365.25::DOUBLE) AS season_sin, COS(2*PI()*dayofyear(w.date)/365.25::DOUBLE) AS season_cos, COALESCE(h.n, 0.0)::DOUBLE AS holiday "
        "FROM (SELECT DISTINCT segment, date FROM media) w LEFT JOIN (SELECT region || '_' || category AS segment, CAST(date_trunc('week', date) AS DATE) - 1 AS date, SUM(sales_qty) AS q FROM panel0 GROUP BY 1,2) p USING (segment, date) "
        "LEFT JOIN (SELECT CAST(date_trunc('week', d) AS DATE) - 1 AS date, COUNT(*) AS n FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders) WHERE strftime(d, '%m-%d') IN ('01-01','08-15','12-25') GROUP BY 1) h USING (date)"
    ),
    ["sales_qty", "trend", "season_sin", "season_cos", "holiday"],
)
Q["candidate_grid"] = lambda s, d: rounded(search.candidate_grid(all_segments(s, d), CHANNELS), 8)
S["candidate_grid"] = rounded_sql(_on_media(_grid_sql(search.TRIALS, search.ITERATIONS)), list(BOUNDS), 8)
Q["adstock_geometric"] = lambda s, d: rounded(carried(s, d).select("segment", "sol_id", "channel", "date", "spend", "adstocked"), 3)
S["adstock_geometric"] = rounded_sql(_on_media("SELECT segment, sol_id, channel, date, spend, adstocked FROM carried", _carried), ["spend", "adstocked"], 3)
Q["hill_saturation"] = lambda s, d: rounded(saturated(s, d).select("segment", "sol_id", "channel", "date", "x"), 6)
S["hill_saturation"] = rounded_sql(_on_media("SELECT segment, sol_id, channel, date, x FROM saturated", _carried), ["x"], 6)
Q["candidate_fits"] = lambda s, d: candidate_fits(s, d)
Q["fit_metrics"] = lambda s, d: rounded(fits(s, d), 6)
S["fit_metrics"] = rounded_sql(sql("SELECT * FROM fits", "fits"), ["rsq_train", "nrmse", "mape", "decomp_rssd"], 6)
Q["channel_decomposition"] = lambda s, d: rounded(decompose.channel_decomposition(media_effects(s, d)), 3)
S["channel_decomposition"] = rounded_sql(
    _on_media(
        "SELECT segment, sol_id, channel, coef, effect, spend, mean_carryover, mean_spend_adstocked, effect/SUM(effect) OVER p AS effect_share, spend/SUM(spend) OVER p AS spend_share, effect/spend AS roi_total FROM "
        "(SELECT segment, sol_id, channel, MAX((candidate+1)*1000.0::DOUBLE) AS coef, SUM((candidate+1)*1000.0::DOUBLE*x) AS effect, SUM(spend) AS spend, AVG(adstocked-spend) AS mean_carryover, AVG(adstocked) AS mean_spend_adstocked FROM saturated GROUP BY 1,2,3) WINDOW p AS (PARTITION BY segment, sol_id)",
        _carried,
    ),
    ["coef", "effect", "spend", "mean_carryover", "mean_spend_adstocked", "effect_share", "spend_share", "roi_total"],
    3,
)
Q["pareto_front_1"] = lambda s, d: pareto.front(order_points(s, d))
S["pareto_front_1"] = f"WITH p0 AS MATERIALIZED ({POINTS_SQL}) {_front_sql('p0')}"
Q["pareto_fronts"] = lambda s, d: pareto.pareto_fronts(order_points(s, d))
S["pareto_fronts"] = FRONTS_SQL
Q["cluster_solutions"] = lambda s, d: clustered(s, d).select("segment", "sol_id", "k", "cluster")
S["cluster_solutions"] = _cluster_sql("SELECT segment, sol_id, k, CAST(cluster AS INTEGER) AS cluster FROM chosen")
Q["cluster_top_solutions"] = lambda s, d: rounded(cluster.cluster_winners(clustered(s, d)), 6)
S["cluster_top_solutions"] = rounded_sql(
    _cluster_sql(
        "SELECT segment, cluster, arg_min(sol_id, {'e': e, 's': sol_id}) AS sol_id, MIN(e) AS balanced_error, COUNT(*) AS cluster_size FROM (SELECT c.segment, CAST(cluster AS INTEGER) AS cluster, c.sol_id, SQRT("
        + " + ".join(f"POWER(COALESCE(({m} - MIN({m}) OVER w) / NULLIF(MAX({m}) OVER w - MIN({m}) OVER w, 0), 0), 2)" for m in ("nrmse", "decomp_rssd", "mape"))
        + ") AS e FROM chosen c JOIN base USING (segment, sol_id) WINDOW w AS (PARTITION BY c.segment)) GROUP BY 1,2"
    ),
    ["balanced_error"],
    6,
)
Q["mm_fit"] = lambda s, d: rounded(exposure_fit.mm_fit(media(s, d)))
S["mm_fit"] = rounded_sql(MM_SQL, ["mean_spend", "vmax", "km", "rsq_nls", "coef_lm", "rsq_lm"])
Q["mm_use_flag"] = lambda s, d: exposure_fit.mm_use_flag(exposure_fit.mm_fit(media(s, d))).select("segment", "channel", "model_type", "use_mm")
S["mm_use_flag"] = f"SELECT segment, channel, CASE WHEN rsq_nls>=rsq_lm THEN 'nls' ELSE 'lm' END AS model_type, rsq_nls>=rsq_lm AND km/(mean_spend+1e-10)<=10 AND rsq_nls>=0.95 AS use_mm FROM ({MM_SQL})"
Q["score_roas"] = lambda s, d: rounded(score.channel_scores(channels(s, d)).select("segment", "sol_id", "roas", "roas_cv"), 6)
S["score_roas"] = rounded_sql(sql("SELECT segment, sol_id, roas, roas_cv FROM measures", "measures"), ["roas", "roas_cv"], 6)
_base = ["baseline_min_weekly", "baseline_mean_weekly", "baseline_pct_mean", "media_contribution_pct"]
Q["score_baseline"] = lambda s, d: rounded(score.baseline_scores(star.solution_weekly(s, d), PRIORITIES))
S["score_baseline"] = rounded_sql(sql(f"SELECT segment, sol_id, {', '.join(_base)} FROM measures", "measures"), _base)
_shares = ["max_channel_effect_share", "max_share_delta", "carryover_pct"]
Q["score_shares"] = lambda s, d: rounded(score.channel_scores(channels(s, d)).select("segment", "sol_id", *_shares), 6)
S["score_shares"] = rounded_sql(sql(f"SELECT segment, sol_id, {', '.join(_shares)} FROM measures", "measures"), _shares, 6)
Q["score_viability"] = lambda s, d: score.viability(measures(s, d)).select("segment", "sol_id", "disqualified", "tier", "viable")
S["score_viability"] = sql("SELECT segment, sol_id, disqualified, tier, viable FROM viability", "viability")
Q["model_scores"] = lambda s, d: rounded(score.model_scores(measures(s, d)).select("segment", "sol_id", "score", "rank"), 6)
S["model_scores"] = rounded_sql(sql("SELECT * FROM scores", "scores"), ["score"], 6)
Q["model_notes"] = lambda s, d: score.model_scores(measures(s, d)).select("segment", "sol_id", "notes", "eliminated_peers")
S["model_notes"] = sql(
    """SELECT v.segment, v.sol_id, concat_ws(' | ', CASE WHEN roas<1 THEN 'return ' || printf('%.2f', roas) || ' is under 1' END,
CASE WHEN low IS NOT NULL THEN 'weak channels (return under 0.3): ' || low END,
CASE WHEN media_contribution_pct<0.15 THEN 'small media part: ' || printf('%.0f%%', media_contribution_pct*100) END,
CASE WHEN max_channel_effect_share>0.5 THEN top || ' has ' || printf('%.0f%%', max_channel_effect_share*100) || ' of the effect' END,
CASE WHEN carryover_pct>0.6 THEN 'carried over: ' || printf('%.0f%%', carryover_pct*100) END,
CASE WHEN rsq_train>0.95 THEN 'may overfit, r2 ' || printf('%.3f', rsq_train) END) AS notes, COALESCE(peers, 'none') AS eliminated_peers
FROM viability v JOIN (SELECT segment, sol_id, string_agg(CASE WHEN roi_total<0.3 THEN channel END, ', ' ORDER BY channel) AS low, arg_max(channel, effect_share) AS top FROM channels GROUP BY 1,2) c USING (segment, sol_id)
LEFT JOIN (SELECT segment, string_agg(sol_id, ', ' ORDER BY sol_id) AS peers FROM viability WHERE disqualified GROUP BY 1) p ON p.segment=v.segment WHERE viable""",
    "viability",
    "channels",
)
Q["best_model"] = lambda s, d: rounded(score.best_models(score.model_scores(measures(s, d))), 6)
S["best_model"] = rounded_sql(sql("SELECT segment, sol_id, score FROM scores WHERE rank=1", "scores"), ["score"], 6)
Q["response_curves"] = lambda s, d: rounded(budget.response_curves(curve_inputs(s, d)))
S["response_curves"] = rounded_sql(CURVES_SQL, ["mean_spend", "spend", "response", "marginal"])
Q["budget_scenarios"] = lambda s, d: rounded(budget.budget_scenarios(budget.response_curves(curve_inputs(s, d))), 3)
S["budget_scenarios"] = rounded_sql(
    f"WITH curves AS ({CURVES_SQL}), "
    "tops AS (SELECT segment, channel, step AS top_step, response AS top_response FROM curves QUALIFY ROW_NUMBER() OVER (PARTITION BY segment, channel ORDER BY CASE WHEN step>0 THEN response/step ELSE -1 END DESC, step DESC)=1), "
    "steps AS (SELECT c.*, spend/step AS cost, CASE WHEN step<=top_step THEN COALESCE(top_response/NULLIF(top_step,0),0.0) ELSE marginal END AS gain FROM curves c JOIN tops USING (segment, channel) WHERE step>0), "
    "goals AS (SELECT segment, SUM(now) AS budget, SUM(response_now) AS target FROM (SELECT segment, channel, mean_spend AS now, response AS response_now FROM curves QUALIFY ROW_NUMBER() OVER (PARTITION BY segment, channel ORDER BY ABS(spend-mean_spend))=1) GROUP BY 1), "
    "bought AS (SELECT *, SUM(cost) OVER o AS spent, SUM(gain) OVER o AS reached FROM (SELECT *, ROUND(COALESCE(gain/NULLIF(cost,0),0.0),9) AS rate FROM steps) WINDOW o AS (PARTITION BY segment ORDER BY rate DESC, channel, step ROWS UNBOUNDED PRECEDING)), "
    "taken AS (SELECT segment, channel, cost, gain, 'max_response' AS scenario, spent<=budget*(1+1e-9) AS taken, LEAST(GREATEST(1+COALESCE((budget-spent)/NULLIF(cost,0),0.0),0.0),1.0)*gain AS best FROM bought JOIN goals USING (segment) "
    "UNION ALL SELECT segment, channel, cost, gain, 'min_spend', reached-gain<target*(1-1e-9), LEAST(GREATEST(1+COALESCE((target-reached)/NULLIF(gain,0),0.0),0.0),1.0)*cost FROM bought JOIN goals USING (segment)) "
    "SELECT segment, scenario, channel, COUNT(*) FILTER (taken) AS steps, COUNT(*) FILTER (taken)=COUNT(*) AS at_limit, SUM(CASE WHEN taken THEN cost ELSE 0.0 END) AS spend, SUM(CASE WHEN taken THEN gain ELSE 0.0 END) AS response, "
    "SUM(SUM(best)) OVER (PARTITION BY segment, scenario) AS bound FROM taken GROUP BY 1,2,3",
    ["spend", "response", "bound"],
    3,
)
Q["segment_selection"] = lambda s, d: selection(s, d).best
Q["winner_weekly"] = lambda s, d: rounded(
    selection(s, d).params.select("segment", "sol_id", F.inline("weekly_decomp")).select("segment", "sol_id", "date", F.explode("values").alias("component", "value")), 3
)
Q["quarantined_segments"] = quarantined_segments
S["quarantined_segments"] = _on_media(
    "SELECT DISTINCT segment, CASE split_part(segment, '_', 1) WHEN 'ASIA' THEN 'no target value' ELSE 'target does not vary' END AS reason FROM media WHERE split_part(segment, '_', 1) IN ('ASIA', 'EUROPE')"
)
Q["winner_params"] = lambda s, d: selection(s, d).params.drop("weekly_decomp").select(F.to_json(F.struct("*")).alias("params"))
