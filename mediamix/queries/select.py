"""Registered queries of the funnel, signal selection and conforming operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mediamix.catalog import catalog_frame, extend_catalog
from mediamix.operators import conform, funnel, signals
from mediamix.operators.priorities import GLOBAL_RESPONSE, PRIORITIES, keywords, matching_key
from mediamix.operators.rules import primary_exposures
from mediamix.plans.preprocess import Options, preprocess, weekly_panel
from mediamix.queries.prepare import GRAIN, plan, rounded
from mediamix.queries.sqltext import FLAG, IMPRESSIONS, MACRO, METRICS, PREFIXES, PRICE, SPENDS, rounded_sql, sql
from mediamix.session import cut_lineage
from mediamix.sources import star

RATIO_PARTS = [("clicks", "impressions"), ("conversions", "clicks"), ("spend", "clicks"), ("spend", "impressions"), ("spend", "conversions")]
RATIOS = [(f"{ch}__{n}_per_{m}", f"{ch}_{n}", f"{ch}_{m}") for ch in PREFIXES for n, m in RATIO_PARTS]


def weekly(spark: SparkSession, d: str) -> DataFrame:
    return weekly_panel(star.panel_daily(spark, d), GRAIN, plan(spark))


def with_ratios(spark: SparkSession, d: str) -> DataFrame:
    panel = weekly(spark, d)
    return funnel.add_ratios(panel, funnel.plan_ratios(star.panel_catalog(spark), panel.columns))


def extended(spark: SparkSession) -> DataFrame:
    catalog = star.panel_catalog(spark)
    return extend_catalog(catalog, funnel.derived_metrics(funnel.funnel_ratios(catalog)))


def quality(spark: SparkSession, d: str) -> DataFrame:
    panel = with_ratios(spark, d)
    return cut_lineage(signals.metric_quality(panel, [c for c in panel.columns if c not in GRAIN.columns]))


def sparse_quality(spark: SparkSession, d: str) -> DataFrame:
    """Quality on the daily panel, where most channel cells are empty."""
    panel = star.panel_daily(spark, d).withColumn(FLAG, F.when(F.col(FLAG) == "Yes", 1).otherwise(0))
    return cut_lineage(signals.metric_quality(panel, METRICS))


def registry(spark: SparkSession, d: str) -> DataFrame:
    return signals.candidate_registry(extended(spark), quality(spark, d))


def stage_registry(spark: SparkSession, d: str) -> DataFrame:
    """Registry of the whole first stage, under a catalogue that is wider than the data."""
    catalog = star.panel_catalog(spark)
    last = catalog.agg(F.max("pos")).collect()[0][0]
    more = [("radio_spend", "absolute", "spend", "radio", "no"), ("radio_grp", "rate", "response", "radio", "no"), ("tv_reach", "absolute", "response", "tv", "no")]
    wide = catalog.unionByName(catalog_frame(spark, more).withColumn("pos", F.col("pos") + last + 1))
    return preprocess(star.panel_daily(spark, d), wide, GRAIN, Options(macro_edge="hold")).registry


def correlations(spark: SparkSession, d: str) -> DataFrame:
    candidates = [(c, f"{ch}_{m}") for _, c, ch in star.CHANNELS for m in ("impressions", "clicks")]
    return cut_lineage(conform.exposure_correlations(weekly(spark, d), candidates, "sales_revenue"))


def supplier_fields(spark: SparkSession, d: str) -> DataFrame:
    """The supplier catalogue, written once: what joins it with itself would read all line items each time."""
    return cut_lineage(star.supplier_catalog(spark, d))


def supplier_extended(spark: SparkSession, d: str) -> DataFrame:
    catalog = supplier_fields(spark, d)
    return extend_catalog(catalog, funnel.derived_metrics(funnel.funnel_ratios(catalog)))


def model_ready(spark: SparkSession, d: str) -> DataFrame:
    columns = ["sales_revenue", PRICE, FLAG, MACRO, *IMPRESSIONS, *SPENDS, "not_in_the_panel"]
    return conform.model_ready_panel(weekly(spark, d), GRAIN.keys, "date", columns)


def chosen_registry(spark: SparkSession, d: str) -> DataFrame:
    found = registry(spark, d)
    return conform.with_best_exposures(found, conform.best_exposures(correlations(spark, d)))


_ratio_sql = ", ".join(f"CASE WHEN {b}<>0 THEN {a}/{b} ELSE 0.0 END AS {n}" for n, a, b in RATIOS)
_wide = sql(f"SELECT *, {_ratio_sql} FROM weekly", "weekly")
_names = [n for n, _, _ in RATIOS]


def _quality_sql(source: str, metrics: list[str]) -> str:
    one = " UNION ALL ".join(
        f"SELECT '{m}' AS metric, COALESCE(AVG(CASE WHEN {m} IS NULL THEN 1.0::DOUBLE ELSE 0 END), 0) AS null_share, COALESCE(AVG(CASE WHEN {m}<>0 THEN 1.0::DOUBLE WHEN {m}=0 THEN 0 END), 0) AS nonzero_share, COALESCE(AVG({m}), 0) AS mean, COALESCE(STDDEV_SAMP({m}), 0) AS std FROM wide"
        for m in metrics
    )
    return f"WITH wide AS MATERIALIZED ({source}) SELECT *, CASE WHEN mean=0 THEN 0 ELSE std/mean END AS cv FROM ({one})"


QUALITY_SQL = _quality_sql(_wide, METRICS + _names)
SPARSE_SQL = _quality_sql(sql("SELECT * FROM flagged", "flagged"), METRICS)


def _checked(text: str) -> str:
    return (
        "SELECT *, null_share<=0.3 AND std>=1e-6 AND cv>=0.05 AS passes, null_share<=0.3 AND std>=1e-6 AND (cv>=0.05 OR regexp_matches(metric,'grp|trp')) AS passes_as_exposure, "
        f"nonzero_share<0.2 AS low_density, 1-null_share<0.6 AS low_coverage FROM ({text})"
    )


# the panel's catalogue: (pos, field, channel, class), ratios as derived responses
_fields = [(8 + 5 * i + j, f"{ch}_{m}", c, k) for i, (_, c, ch) in enumerate(star.CHANNELS) for j, (m, k) in enumerate(
    [("spend", "spend"), ("impressions", "exposure"), ("clicks", "exposure"), ("conversions", "exposure"), ("conversion_perc", "response")]
)]
_place = {"spend": 0, "impressions": 1, "clicks": 2, "conversions": 3}
_derived = [(1000 + 10 * (5 * i + _place[n]) + _place[m], f"{ch}__{n}_per_{m}", c, "response") for i, (_, c, ch) in enumerate(star.CHANNELS) for n, m in RATIO_PARTS]
# priority keys that the five channel names contain
_keys = {"tv": ("tv", "tv"), "google search": ("search", "search"), "facebook": ("facebook", "facebook"), "email": ("email", "email"), "amazon": ("amazon", "amazon")}


def _values(rows: list[tuple], columns: str) -> str:
    quoted = ", ".join("(" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in r) + ")" for r in rows)
    return f"(SELECT * FROM (VALUES {quoted}) AS v({columns}))"


def _words(role: int) -> str:
    table = PRIORITIES[("exposure", "response")[role]]
    rows = [(c, i, w) for c, keys in _keys.items() for i, w in enumerate(table.keywords[table.keys.index(keys[role])])]
    return _values(rows, "channel, place, word")


def _ranked(source: str, role: int) -> str:
    return (
        f"SELECT f.channel, f.field_name, f.tier, ROW_NUMBER() OVER (PARTITION BY f.channel ORDER BY COALESCE(k.place, 99), f.pos) AS rank FROM {source} f "
        f"LEFT JOIN (SELECT s.channel, s.field_name, MIN(w.place) AS place FROM {source} s JOIN {_words(role)} w ON s.channel=w.channel AND contains(s.field_name, w.word) GROUP BY 1,2) k ON f.channel=k.channel AND f.field_name=k.field_name"
    )


def candidates_sql(quality_text: str, fields: list[tuple]) -> str:
    return f"""WITH q AS ({_checked(quality_text)}),
fields AS (SELECT f.*, COALESCE(q.passes, FALSE) AS passes, COALESCE(q.passes_as_exposure, FALSE) AS pe, NULL AS tier FROM {_values(fields, 'pos, field_name, channel, class')} f LEFT JOIN q ON q.metric=f.field_name),
first_spend AS (SELECT channel, arg_min(field_name, pos) AS field_name, 1 AS rank FROM fields WHERE class='spend' GROUP BY 1),
e0 AS (SELECT * FROM fields WHERE class='exposure' AND pe),
e1 AS (SELECT channel, rank, field_name FROM ({_ranked('e0', 0)}) WHERE rank<=2),
e AS (SELECT * FROM e1 UNION ALL SELECT channel, rank, field_name FROM first_spend WHERE channel NOT IN (SELECT channel FROM e1)),
s1 AS (SELECT channel, rank, field_name FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY channel ORDER BY pos) AS rank FROM fields WHERE class='spend' AND passes) WHERE rank<=2),
s AS (SELECT * FROM s1 UNION ALL SELECT channel, rank, field_name FROM first_spend WHERE channel NOT IN (SELECT channel FROM s1)),
r0 AS (SELECT channel, pos, field_name, 'derived' AS tier FROM fields WHERE class='response' AND passes),
r1 AS (SELECT * FROM r0 UNION ALL SELECT channel, rank AS pos, field_name, 'proxy_exposure' FROM e WHERE channel NOT IN (SELECT channel FROM r0)),
r AS (SELECT * FROM ({_ranked('r1', 1)}) WHERE rank<=4)
SELECT 'exposure' AS role, channel, CAST(rank AS INTEGER) AS rank, field_name, NULL::VARCHAR AS tier FROM e
UNION ALL SELECT 'spend', channel, CAST(rank AS INTEGER), field_name, NULL FROM s
UNION ALL SELECT 'response', channel, CAST(rank AS INTEGER), field_name, tier FROM r"""


_global_words = _values([(i, w) for i, w in enumerate(keywords(GLOBAL_RESPONSE))], "place, word")
GLOBAL_SQL = (
    f"SELECT 1 AS rank, metric AS field_name FROM ({_checked(QUALITY_SQL)}) LEFT JOIN {_global_words} w ON contains(metric, word) "
    "WHERE metric IN ('sales_qty','sales_revenue') AND passes GROUP BY metric ORDER BY MIN(COALESCE(place, 99)), metric LIMIT 1"
)
CONTROLS_SQL = (
    f"WITH c AS (SELECT v.*, passes FROM {_values([(3, PRICE), (6, FLAG), (7, MACRO)], 'pos, field_name')} v JOIN ({_checked(QUALITY_SQL)}) ON metric=field_name) "
    "SELECT CAST(pos AS BIGINT) AS pos, field_name FROM c WHERE passes OR NOT EXISTS (SELECT 1 FROM c WHERE passes)"
)
CORR_SQL = f"WITH weeks AS MATERIALIZED ({sql('SELECT * FROM weekly', 'weekly')}) " + " UNION ALL ".join(
    f"SELECT '{c}' AS channel, '{ch}_{m}' AS field_name, {2 * i + j} AS rank, COALESCE(COVAR_SAMP(COALESCE({ch}_{m},0), COALESCE(sales_revenue,0))/NULLIF(STDDEV_SAMP(COALESCE({ch}_{m},0))*STDDEV_SAMP(COALESCE(sales_revenue,0)),0), 0) AS corr FROM weeks"
    for i, (_, c, ch) in enumerate(star.CHANNELS)
    for j, m in enumerate(("impressions", "clicks"))
)
BEST_SQL = f"SELECT channel, arg_max(field_name, corr) AS field_name, ROUND(MAX(corr), 4) AS corr FROM ({CORR_SQL}) GROUP BY 1"


def _key_case(role: str) -> str:
    cases = " ".join(f"WHEN contains(plain, '{k}') THEN '{k}'" for k in PRIORITIES[role].keys)
    return f"CASE {cases} END"


def _all_words(role: str) -> str:
    table = PRIORITIES[role]
    rows = [(k, i, w) for k, words in zip(table.keys, table.keywords) for i, w in enumerate(words)]
    return _values([*rows, *[("default", i, w) for i, w in enumerate(table.default)]], "key, place, word")


Q, S = {}, {}

Q["funnel_roles"] = lambda s, d: funnel.funnel_roles(star.supplier_catalog(s, d))
S["funnel_roles"] = sql("SELECT field_name, channel, funnel_role FROM roles", "roles")
Q["primary_exposure"] = lambda s, d: primary_exposures(star.supplier_catalog(s, d))
S["primary_exposure"] = sql("SELECT channel, primary_exposure FROM primaries", "primaries")
Q["clean_metric_names"] = lambda s, d: star.supplier_catalog(s, d).filter(F.col("channel").isNotNull()).select(
    "field_name",
    funnel.clean_name(F.col("field_name"), F.col("channel")).alias("clean"),
    funnel.clean_name(F.concat_ws("_", F.lit("total"), "field_name"), F.col("channel")).alias("clean_inner"),
)
S["clean_metric_names"] = sql(
    "SELECT field_name, substr(field_name, length(channel)+2) AS clean, 'total_' || substr(field_name, length(channel)+2) AS clean_inner FROM catalog WHERE channel IS NOT NULL",
    "catalog",
)
Q["funnel_pairs"] = lambda s, d: funnel.funnel_ratios(supplier_fields(s, d)).select("channel", "field_name", "numerator", "denominator", "funnel_role")
S["funnel_pairs"] = sql(
    """SELECT n.channel, replace(n.channel,' ','_') || '__' || substr(n.field_name, length(n.channel)+2) || '_per_' || substr(m.field_name, length(n.channel)+2) AS field_name,
n.field_name AS numerator, m.field_name AS denominator, n.funnel_role || '/' || m.funnel_role AS funnel_role
FROM roles n JOIN roles m ON n.channel=m.channel LEFT JOIN primaries p ON p.channel=n.channel
WHERE n.data_type='absolute' AND m.data_type='absolute' AND (n.funnel_role, m.funnel_role) IN (('engagement','exposure'),('conversion','engagement'),('cost','engagement'),('cost','exposure'),('cost','conversion'))
AND (m.funnel_role<>'exposure' OR m.field_name=p.primary_exposure)""",
    "roles",
    "primaries",
)
Q["funnel_ratios"] = lambda s, d: rounded(with_ratios(s, d).select(*GRAIN.columns, *_names))
S["funnel_ratios"] = rounded_sql(f"SELECT region, category, date, {', '.join(_names)} FROM ({_wide})", _names)
Q["catalog_extend"] = lambda s, d: supplier_extended(s, d).select("field_name", "channel", "data_type", "is_derived", "derived_from")
S["catalog_extend"] = (
    sql("SELECT field_name, channel, data_type, FALSE AS is_derived, NULL::VARCHAR AS derived_from FROM catalog", "catalog")
    + f" UNION ALL SELECT field_name, channel, 'rate', TRUE, numerator || '/' || denominator FROM ({S['funnel_pairs']})"
)
Q["funnel_null_report"] = lambda s, d: funnel.null_share_report(
    funnel.add_ratios(star.panel_daily(s, d), [(n, a, b) for n, a, b in RATIOS]), _names
)
S["funnel_null_report"] = "WITH r AS MATERIALIZED (" + sql(f"SELECT {_ratio_sql} FROM panel0", "panel0") + ") " + " UNION ALL ".join(
    f"SELECT '{n}' AS metric, ROUND(100*COUNT(*) FILTER ({n} IS NULL)/COUNT(*), 2) AS pct_null FROM r" for n in _names
)
Q["metric_quality"] = lambda s, d: rounded(quality(s, d))
S["metric_quality"] = rounded_sql(QUALITY_SQL, ["null_share", "nonzero_share", "mean", "std", "cv"])
Q["quality_filter"] = lambda s, d: signals.quality_filter(sparse_quality(s, d)).select("metric", "passes", "passes_as_exposure", "low_density", "low_coverage")
S["quality_filter"] = f"SELECT metric, passes, passes_as_exposure, low_density, low_coverage FROM ({_checked(SPARSE_SQL)})"
Q["field_classes"] = lambda s, d: signals.field_classes(star.supplier_catalog(s, d)).select("field_name", "channel", "field_class")
S["field_classes"] = sql(
    "SELECT field_name, channel, CASE WHEN regexp_matches(field_name, 'gqv|macro|cpi|inflation|price|promo_flag|promo_offer_flag|promo_perc') THEN 'control' WHEN data_category='spend' THEN 'spend' WHEN data_type='absolute' OR (data_type='rate' AND regexp_matches(field_name,'grp|trp')) THEN 'exposure' ELSE 'response' END AS field_class FROM catalog WHERE channel IS NOT NULL",
    "catalog",
)
Q["channel_priority"] = lambda s, d: star.supplier_catalog(s, d).filter(F.col("channel").isNotNull()).select("channel").distinct().select(
    "channel", *[matching_key(F.col("channel"), r).alias(f"{r}_key") for r in ("exposure", "response")]
)
S["channel_priority"] = sql(
    f"SELECT channel, {_key_case('exposure')} AS exposure_key, {_key_case('response')} AS response_key FROM (SELECT DISTINCT channel, regexp_replace(lower(channel), '[^a-z0-9]', '', 'g') AS plain FROM catalog WHERE channel IS NOT NULL)",
    "catalog",
)
Q["keyword_rank"] = lambda s, d: signals.keyword_rank(
    star.supplier_catalog(s, d).filter(F.col("channel").isNotNull()), "exposure"
).select("channel", "field_name", "rank")
S["keyword_rank"] = sql(
    f"""SELECT f.channel, f.field_name, CAST(ROW_NUMBER() OVER (PARTITION BY f.channel ORDER BY COALESCE(k.place, 99), f.pos) AS INTEGER) AS rank FROM catalog f LEFT JOIN (
SELECT field_name, MIN(place) AS place FROM (SELECT *, COALESCE({_key_case('exposure')}, 'default') AS key FROM (SELECT *, regexp_replace(lower(channel), '[^a-z0-9]', '', 'g') AS plain FROM catalog WHERE channel IS NOT NULL)) c
JOIN {_all_words('exposure')} w ON c.key=w.key AND contains(c.field_name, w.word) GROUP BY 1) k ON f.field_name=k.field_name WHERE f.channel IS NOT NULL""",
    "catalog",
)
Q["response_tiers"] = lambda s, d: signals.field_classes(supplier_extended(s, d), absolute_conversions_as_response=True).filter(
    F.col("field_class") == "response"
).select("channel", "field_name", signals.response_tier().alias("tier"))
S["response_tiers"] = (
    sql("SELECT channel, field_name, CASE WHEN data_type='absolute' THEN 1 ELSE 3 END AS tier FROM catalog WHERE channel IS NOT NULL AND (field_name LIKE '%_conversions' OR data_type='percentage')", "catalog")
    + f" UNION ALL SELECT channel, field_name, 3 FROM ({S['funnel_pairs']})"
)
Q["global_response"] = lambda s, d: signals.global_response(star.panel_catalog(s), quality(s, d))
S["global_response"] = GLOBAL_SQL
Q["global_controls"] = lambda s, d: signals.global_controls(star.panel_catalog(s), quality(s, d))
S["global_controls"] = CONTROLS_SQL
Q["channel_candidates"] = lambda s, d: signals.channel_candidates(extended(s), quality(s, d))
S["channel_candidates"] = candidates_sql(QUALITY_SQL, _fields + _derived)
Q["channel_candidates_sparse"] = lambda s, d: signals.channel_candidates(star.panel_catalog(s), sparse_quality(s, d))
S["channel_candidates_sparse"] = candidates_sql(SPARSE_SQL, _fields)
Q["candidate_registry"] = registry
S["candidate_registry"] = (
    f"SELECT * FROM ({S['channel_candidates']}) UNION ALL SELECT 'global_response', NULL, rank, field_name, NULL FROM ({GLOBAL_SQL}) "
    f"UNION ALL SELECT 'global_control', NULL, CAST(pos+1 AS BIGINT), field_name, NULL FROM ({CONTROLS_SQL})"
)
Q["stage_registry"] = stage_registry
S["stage_registry"] = S["candidate_registry"]
Q["registry_document"] = lambda s, d: signals.nested_registry(registry(s, d), star.panel_catalog(s)).select(F.to_json(F.struct("*")).alias("document"))
_listed = "to_json(COALESCE(list(field_name ORDER BY rank) FILTER (role = '{}'), []))"
S["registry_document"] = (
    f"WITH registry AS ({S['candidate_registry']}), channels AS (SELECT channel, '{{\"exposure\":' || {_listed.format('exposure')} || ',\"response\":' || {_listed.format('response')} || ',\"spend\":' || {_listed.format('spend')} "
    "|| ',\"response_tier\":\"' || COALESCE(MAX(tier), 'none') || '\"}' AS body FROM registry WHERE channel IS NOT NULL GROUP BY 1) "
    f"SELECT '{{\"global_response\":' || {_listed.format('global_response')} || ',\"global_controls\":' || {_listed.format('global_control')} || ',\"channels\":{{' "
    "|| (SELECT string_agg('\"' || channel || '\":' || body, ',' ORDER BY channel) FROM channels) || '}}' AS document FROM registry"
)
Q["exposure_correlation"] = lambda s, d: rounded(correlations(s, d))
S["exposure_correlation"] = rounded_sql(CORR_SQL, ["corr"])
Q["best_exposure"] = lambda s, d: conform.best_exposures(correlations(s, d))
S["best_exposure"] = BEST_SQL
Q["segment_key"] = lambda s, d: star.panel_daily(s, d).select("date", conform.segment_key(["region", "category"]).alias("segment"), "sales_qty")
S["segment_key"] = sql("SELECT date, region || '_' || category AS segment, sales_qty FROM panel0", "panel0")
Q["segments"] = lambda s, d: conform.segments(star.panel_daily(s, d), ["region", "category"])
S["segments"] = sql("SELECT DISTINCT region || '_' || category AS segment FROM panel0", "panel0")
Q["model_ready_panel"] = lambda s, d: rounded(model_ready(s, d))
S["model_ready_panel"] = rounded_sql(
    sql(f"SELECT date, region || '_' || category AS segment, sales_revenue, {PRICE}, {FLAG}, {MACRO}, {', '.join([*IMPRESSIONS, *SPENDS])} FROM weekly", "weekly"),
    ["sales_revenue", PRICE, MACRO, *IMPRESSIONS, *SPENDS],
)
Q["chronological_panel"] = lambda s, d: rounded(conform.chronological(model_ready(s, d), "date"))
S["chronological_panel"] = S["model_ready_panel"]
Q["model_spec"] = lambda s, d: conform.model_spec(chosen_registry(s, d))
S["model_spec"] = (
    f"SELECT s.channel, s.field_name AS spend, e.field_name AS exposure FROM ({S['channel_candidates']}) s JOIN ({BEST_SQL}) e ON s.channel=e.channel WHERE s.role='spend' AND s.rank=1"
)
