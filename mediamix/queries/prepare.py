"""Registered queries of the preprocessing operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mediamix.catalog import Catalog, contract_violations, normalize_catalog
from mediamix.functions.frequency import Frequency, parse_mixed_date, truncate
from mediamix.grain import Grain
from mediamix.operators import calendar, checks, impute, outliers, series
from mediamix.operators.aggregate import aggregate_panel, merge_metric_frames
from mediamix.operators.rules import plan_catalog, resolve_weights
from mediamix.plans.preprocess import weekly_panel
from mediamix.queries.sqltext import (
    FLAG,
    IMPRESSIONS,
    MACRO,
    METRICS,
    PREFIXES,
    PRICE,
    RATES,
    RESPONSES,
    SALES,
    SPENDS,
    TIE_SHIFT,
    UP,
    WINSORIZED,
    W_ALL,
    between,
    clipped,
    each,
    iqr,
    nearest,
    rounded_sql,
    sql,
    weighted,
)
from mediamix.session import cut_lineage
from mediamix.sources import star

GRAIN = star.PANEL_GRAIN
KEYS = ["date", "region", "category"]
ROWS = Grain(("segment",), "date", unique=False)


def rounded(df: DataFrame, digits: int = 4) -> DataFrame:
    """Doubles rounded for comparison, shifted off exact ties as in ``rounded_sql``."""
    doubles = [c for c, kind in df.dtypes if kind == "double"]
    return df.withColumns({c: F.round(F.col(c) + TIE_SHIFT, digits) for c in doubles}) if doubles else df


def plan(spark: SparkSession) -> Catalog:
    return plan_catalog(star.panel_catalog(spark), [*KEYS, *METRICS])


def flagged(spark: SparkSession, d: str) -> DataFrame:
    return checks.normalize_flags(star.panel_daily(spark, d), [FLAG])


def continuous(spark: SparkSession, d: str) -> DataFrame:
    return calendar.fill_calendar(flagged(spark, d), GRAIN, "daily")


def order_dates(spark: SparkSession, d: str) -> DataFrame:
    """Order dates as text: day first, ISO, or in a notation that is not accepted."""
    date = F.col("o_orderdate")
    kind = F.col("o_orderkey") % 3
    text = (
        F.when(kind == 0, F.date_format(date, "dd-MM-yyyy"))
        .when(kind == 1, F.date_format(date, "yyyy-MM-dd"))
        .otherwise(F.date_format(date, "yyyy/MM/dd"))
    )
    return star.table(spark, d, "orders").select("o_orderkey", text.alias("text"))


def sale_rows(spark: SparkSession, d: str) -> DataFrame:
    """Line items as raw rows: return flag as segment, many rows per segment and date.

    Prices of quantities below 10 are missing.
    """
    return star.table(spark, d, "lineitem").select(
        F.col("l_returnflag").alias("segment"),
        F.to_date("l_shipdate").alias("date"),
        "l_orderkey",
        "l_linenumber",
        F.when(F.col("l_quantity") >= 10, F.col("l_extendedprice")).alias("price"),
    )


SALE_ROWS_SQL = "SELECT l_returnflag AS segment, CAST(l_shipdate AS DATE) AS date, l_orderkey, l_linenumber, CASE WHEN l_quantity>=10 THEN l_extendedprice END AS price FROM lineitem"


def by_grain(frequency: Frequency):
    def query(spark: SparkSession, d: str) -> DataFrame:
        period = truncate(F.col("date"), frequency)
        return star.panel_daily(spark, d).groupBy(period.alias("date")).agg(
            F.count("*").alias("n_rows"), F.round(F.sum("sales_revenue"), 2).alias("sales_revenue")
        )

    return query


def by_grain_sql(period: str) -> str:
    return sql(f"SELECT {period} AS date, COUNT(*) AS n_rows, ROUND(SUM(sales_revenue), 2) AS sales_revenue FROM panel0 GROUP BY 1", "panel0")


def masks(spark: SparkSession, d: str) -> DataFrame:
    columns = [*SALES, PRICE, *SPENDS]
    bounded = outliers.with_bounds(star.panel_daily(spark, d), GRAIN, columns)
    return bounded.select(*KEYS, *[outliers.iqr_mask(c).alias(f"{c}_mask") for c in columns])


def zmasks(spark: SparkSession, d: str) -> DataFrame:
    columns = ["cpi", "sales_revenue"]
    bounded = outliers.with_bounds(star.panel_daily(spark, d), GRAIN, (), columns)
    return bounded.select(*KEYS, *[outliers.zscore_mask(c).alias(f"{c}_mask") for c in columns])


def pick(df: DataFrame, columns: list[str]) -> DataFrame:
    return rounded(df.select(*KEYS, *columns))


def guarded(spark: SparkSession, d: str) -> DataFrame:
    plan_ = plan(spark)
    days = continuous(spark, d)
    responses = {s: [r for _, s2, r in checks.spend_response_pairs(plan_) if s2 == s] for s in SPENDS}
    return days.select(*KEYS, *[F.round(impute.guarded_spend(s, responses[s]) + TIE_SHIFT, 4).alias(s) for s in SPENDS])


def aggregated(spark: SparkSession, d: str, fields: list[str]) -> DataFrame:
    plan_ = plan(spark)
    weekly = calendar.convert_grain(flagged(spark, d), "date", "daily", "weekly")
    return rounded(aggregate_panel(weekly, GRAIN.columns, Catalog(tuple(plan_.where(field=fields)))))


def merged(spark: SparkSession, d: str) -> DataFrame:
    month = F.trunc
    shipped = star.table(spark, d, "lineitem").groupBy(month("l_shipdate", "month").alias("month")).agg(
        F.sum(star.money("l_quantity")).cast("double").alias("shipped_qty")
    )
    ordered = star.table(spark, d, "orders").groupBy(month("o_orderdate", "month").alias("month")).agg(
        F.count("*").alias("n_orders")
    )
    events = star.table(spark, d, "events").groupBy(month("ts", "month").alias("month")).agg(F.count("*").alias("n_events"))
    return merge_metric_frames([shipped, ordered, events], ["month"])


def messy_flags(spark: SparkSession, d: str) -> DataFrame:
    """Line items with a promo word: proper, oddly spelled, or not a flag at all."""
    words = F.element_at(
        F.array(*[F.lit(w) for w in ["Yes", " no ", "TRUE", "0", "Y", "maybe", "n", "unknown"]]),
        (F.col("l_quantity") % 8 + 1).cast("int"),
    )
    return star.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", words.alias("promo"))


FLAG_WORDS_SQL = "SELECT l_orderkey, l_linenumber, list_extract(['Yes', ' no ', 'TRUE', '0', 'Y', 'maybe', 'n', 'unknown'], CAST(l_quantity % 8 AS INTEGER) + 1) AS promo FROM lineitem"


def margins(spark: SparkSession, d: str) -> DataFrame:
    """Line items with a margin that some discounts make negative."""
    return star.table(spark, d, "lineitem").select(
        F.col("l_extendedprice").alias("revenue"),
        (F.lit(0.05) - F.col("l_discount")).alias("margin"),
        (F.col("l_tax") - F.col("l_discount")).alias("net_rate"),
    )


def catalog_raw_fields(spark: SparkSession, d: str) -> DataFrame:
    return normalize_catalog(star.supplier_catalog_raw(spark, d))


Q, S = {}, {}

# sources and schema
Q["scan_panel"] = lambda s, d: rounded(star.panel_daily(s, d))
S["scan_panel"] = rounded_sql(sql("SELECT * FROM panel", "panel"), [*SALES, PRICE, "cpi", *SPENDS, *IMPRESSIONS, *RATES])
Q["site_panel"] = lambda s, d: star.site_daily(s, d)
S["site_panel"] = (
    "SELECT CAST(ts AS DATE) AS date, CAST(user_id % 3 AS INT) AS region_id, "
    "CAST(SUM(CASE WHEN event_type='view' THEN 1 END) AS BIGINT) AS site_impressions, "
    "CAST(SUM(CASE WHEN event_type='click' THEN 1 END) AS BIGINT) AS site_clicks, "
    "CAST(SUM(CASE WHEN event_type='purchase' THEN 1 END) AS BIGINT) AS site_conversions, "
    "CAST(SUM(CASE WHEN event_type='purchase' THEN CAST(value AS DECIMAL(14,2)) END) AS DOUBLE) AS sales_revenue, "
    "CAST(SUM(CASE WHEN event_type='signup' THEN CAST(value AS DECIMAL(14,2)) END) AS DOUBLE) AS site_spend "
    "FROM events GROUP BY 1,2"
)
Q["normalize_columns"] = lambda s, d: calendar.normalize_columns(
    star.table(s, d, "supplier").toDF(" S_SuppKey ", "S_NAME", "s_nationkey", "S_AcctBal ")
)
S["normalize_columns"] = "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier"
Q["catalog_load"] = catalog_raw_fields
S["catalog_load"] = sql("SELECT pos, field_name, LOWER(data_type) AS data_type, data_category, can_be_negative, channel FROM catalog_raw", "catalog_raw")
Q["catalog_violations"] = lambda s, d: contract_violations(star.supplier_catalog_raw(s, d))
S["catalog_violations"] = sql(
    " UNION ALL ".join(
        [f"SELECT 'null' AS rule, '{c}' AS column_name, COUNT(*) FILTER ({'FALSE' if c == 'channel' else c + ' IS NULL'}) AS n_bad FROM catalog_raw" for c in ("field_name", "data_type", "data_category", "channel", "can_be_negative")]
        + [
            "SELECT 'vocabulary', 'data_type', COUNT(*) FILTER (data_type='Ratio') FROM catalog_raw",
            "SELECT 'vocabulary', 'data_category', COUNT(*) FILTER (data_category NOT IN ('response','spend')) FROM catalog_raw",
            "SELECT 'vocabulary', 'can_be_negative', COUNT(*) FILTER (can_be_negative='maybe') FROM catalog_raw",
        ]
    ),
    "catalog_raw",
)

# validation
Q["negativity_report"] = lambda s, d: checks.negativity_report(margins(s, d), ["revenue", "margin", "net_rate"])
S["negativity_report"] = (
    "SELECT 'revenue' AS metric, COUNT(*) FILTER (l_extendedprice<0) AS n_bad FROM lineitem UNION ALL "
    "SELECT 'margin', COUNT(*) FILTER (0.05::DOUBLE-l_discount<0) FROM lineitem UNION ALL "
    "SELECT 'net_rate', COUNT(*) FILTER (l_tax-l_discount<0) FROM lineitem"
)
Q["flag_normalize"] = lambda s, d: checks.normalize_flags(messy_flags(s, d), ["promo"])
S["flag_normalize"] = f"SELECT l_orderkey, l_linenumber, CASE WHEN LOWER(TRIM(promo)) IN ('yes','y','true','1') THEN 1 ELSE 0 END AS promo FROM ({FLAG_WORDS_SQL})"
Q["flag_violations"] = lambda s, d: checks.flag_violations(messy_flags(s, d), ["promo"])
S["flag_violations"] = f"SELECT 'promo' AS column_name, promo AS value, COUNT(*) AS n_rows FROM ({FLAG_WORDS_SQL}) WHERE LOWER(TRIM(promo)) NOT IN ('yes','y','true','1','no','n','false','0') GROUP BY 2"
Q["null_audit"] = lambda s, d: checks.null_audit(continuous(s, d), METRICS)
S["null_audit"] = sql(" UNION ALL ".join(f"SELECT '{c}' AS metric, COUNT(*) FILTER ({c} IS NULL) AS n_null FROM continuous" for c in METRICS), "continuous")
Q["spend_response_conflicts"] = lambda s, d: checks.spend_response_conflicts(
    star.panel_daily(s, d).withColumns({c: F.when(F.col(c) > 0, F.col(c)) for c in SPENDS[:2]}), checks.spend_response_pairs(plan(s))
)
S["spend_response_conflicts"] = sql(
    " UNION ALL ".join(
        f"SELECT '{kind}' AS kind, '{name}' AS channel, '{ch}_spend' AS spend, '{ch}_{m}' AS response, COUNT(*) FILTER ({ch}_{m}>0 AND {test}) AS n_rows FROM panel0"
        for i, (_, name, ch) in enumerate(star.CHANNELS)
        for m in ("impressions", "clicks", "conversions")
        for kind, test in (
            ("warning", "FALSE" if i < 2 else f"{ch}_spend=0"),
            ("error", f"({ch}_spend IS NULL OR {ch}_spend<=0)" if i < 2 else f"{ch}_spend IS NULL"),
        )
    ),
    "panel0",
)

# calendar
Q["parse_mixed_dates"] = lambda s, d: order_dates(s, d).select("o_orderkey", parse_mixed_date(F.col("text")).alias("date"))
S["parse_mixed_dates"] = "SELECT o_orderkey, CASE WHEN o_orderkey % 3 < 2 THEN CAST(o_orderdate AS DATE) END AS date FROM orders"
Q["grain_week"] = by_grain(Frequency.WEEK)
S["grain_week"] = by_grain_sql("CAST(date_trunc('week', date) AS DATE) - 1")
Q["grain_month"] = by_grain(Frequency.MONTH)
S["grain_month"] = by_grain_sql("CAST(date_trunc('month', date) AS DATE)")
Q["grain_quarter"] = by_grain(Frequency.QUARTER)
S["grain_quarter"] = by_grain_sql("CAST(date_trunc('quarter', date) AS DATE)")
Q["date_spine"] = lambda s, d: calendar.date_spine(star.panel_daily(s, d), GRAIN, "daily")
S["date_spine"] = sql("SELECT region, category, date FROM spine", "spine")
Q["date_continuity"] = lambda s, d: pick(continuous(s, d), [*SALES, PRICE, FLAG, *SPENDS])
S["date_continuity"] = rounded_sql(sql(f"SELECT date, region, category, {', '.join([*SALES, PRICE, FLAG, *SPENDS])} FROM continuous", "continuous"), [*SALES, PRICE, *SPENDS])
Q["off_grid_report"] = lambda s, d: calendar.off_grid_report(star.panel_daily(s, d), GRAIN, "weekly")
S["off_grid_report"] = sql(
    "SELECT region, category, COUNT(*) AS n_rows, COUNT(*) FILTER ((date - first) % 7 <> 0) AS n_off_grid, COUNT(*) FILTER (date IS NULL) AS n_without_date FROM (SELECT *, MIN(date) OVER (PARTITION BY region, category) AS first FROM panel0) GROUP BY 1,2",
    "panel0",
)

# outliers
Q["iqr_mask"] = masks
S["iqr_mask"] = sql(f"SELECT date, region, category, {each(iqr('{c}') + ' AS {c}_mask', [*SALES, PRICE, *SPENDS])} FROM bounded", "bounded")
Q["zscore_mask"] = zmasks
S["zscore_mask"] = sql(
    "SELECT date, region, category, " + each("CASE WHEN {c}_std IS NULL OR {c}_std=0 THEN FALSE ELSE ABS({c}-{c}_mean)/{c}_std>3 END AS {c}_mask", ["cpi", "sales_revenue"]) + " FROM bounded",
    "bounded",
)
Q["winsorize"] = lambda s, d: pick(outliers.winsorize(star.panel_daily(s, d), GRAIN, WINSORIZED), WINSORIZED)
S["winsorize"] = rounded_sql(sql(f"SELECT date, region, category, {each(clipped('{c}') + ' AS {c}', WINSORIZED)} FROM bounded", "bounded"), [*SALES, *SPENDS, *IMPRESSIONS, *RATES])
Q["winsorize_rows"] = lambda s, d: outliers.winsorize(sale_rows(s, d), ROWS, ["price"])
S["winsorize_rows"] = f"SELECT segment, date, l_orderkey, l_linenumber, {clipped('price')} AS price FROM ({SALE_ROWS_SQL}) JOIN (SELECT l_returnflag AS segment, quantile_disc(CASE WHEN l_quantity>=10 THEN l_extendedprice END, 0.01) AS price_lo, quantile_disc(CASE WHEN l_quantity>=10 THEN l_extendedprice END, 0.99) AS price_hi FROM lineitem GROUP BY 1) USING (segment)"
Q["ffill_outliers"] = lambda s, d: pick(outliers.forward_fill_outliers(star.panel_daily(s, d), GRAIN, [PRICE, "tv_spend"]), [PRICE, "tv_spend"])
S["ffill_outliers"] = rounded_sql(
    sql("SELECT date, region, category, " + each(f"LAST_VALUE(CASE WHEN NOT COALESCE({iqr('{c}')}, FALSE) THEN {{c}} END IGNORE NULLS) {UP} AS {{c}}", [PRICE, "tv_spend"]) + " FROM bounded", "bounded"),
    [PRICE, "tv_spend"],
)
Q["ffill_outliers_zscore"] = lambda s, d: pick(outliers.forward_fill_outliers(star.panel_daily(s, d), GRAIN, ["sales_revenue"], "zscore"), ["sales_revenue"])
S["ffill_outliers_zscore"] = rounded_sql(
    sql(f"SELECT date, region, category, LAST_VALUE(CASE WHEN NOT COALESCE(ABS(sales_revenue-sales_revenue_mean)/sales_revenue_std>3, FALSE) THEN sales_revenue END IGNORE NULLS) {UP} AS sales_revenue FROM bounded", "bounded"),
    ["sales_revenue"],
)
Q["smooth_rolling"] = lambda s, d: pick(series.trailing_mean(star.panel_daily(s, d), GRAIN, {c: F.col(c) for c in [MACRO, *SALES]}), [MACRO, *SALES])
S["smooth_rolling"] = rounded_sql(sql("SELECT date, region, category, " + each(f"AVG({{c}}) OVER ({W_ALL} ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS {{c}}", [MACRO, *SALES]) + " FROM panel", "panel"), [MACRO, *SALES])
Q["outlier_report"] = lambda s, d: outliers.outlier_report(star.panel_daily(s, d), GRAIN, plan(s))
S["outlier_report"] = sql(
    "SELECT metric, category, n_outliers, n_rows, ROUND(100*n_outliers/n_rows, 2) AS pct FROM ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS metric, '{cat}' AS category, COUNT(*) FILTER ({iqr(c) if c != MACRO else 'cpi_std>0 AND ABS(cpi-cpi_mean)/cpi_std>3'}) AS n_outliers, COUNT(*) AS n_rows FROM bounded"
        for c in [*WINSORIZED, PRICE, MACRO]
        for cat in [("sales" if c in SALES else "spend" if c in SPENDS else "price" if c == PRICE else "macro" if c == MACRO else "response")]
    )
    + ")",
    "bounded",
)
Q["outlier_treatment"] = lambda s, d: pick(outliers.treat_outliers(flagged(s, d), GRAIN, plan(s)), METRICS)
S["outlier_treatment"] = rounded_sql(sql("SELECT * FROM treated", "treated"), [*SALES, PRICE, MACRO, *SPENDS, *IMPRESSIONS, *RATES])

# missing values
Q["fill_zero"] = lambda s, d: pick(impute.zero_fill(continuous(s, d), [*SALES, *RESPONSES]), [*SALES, *RESPONSES])
S["fill_zero"] = rounded_sql(sql(f"SELECT date, region, category, {each('COALESCE({c}, 0) AS {c}', [*SALES, *RESPONSES])} FROM continuous", "continuous"), [*SALES, *IMPRESSIONS])
Q["forward_fill"] = lambda s, d: pick(series.fill_series(continuous(s, d), GRAIN, {c: (F.col(c), "forward_fill") for c in [PRICE, "tv_spend"]}), [PRICE, "tv_spend"])
S["forward_fill"] = rounded_sql(sql("SELECT date, region, category, " + each(f"LAST_VALUE({{c}} IGNORE NULLS) {UP} AS {{c}}", [PRICE, "tv_spend"]) + " FROM continuous", "continuous"), [PRICE, "tv_spend"])
Q["forward_fill_rows"] = lambda s, d: series.fill_series(sale_rows(s, d), ROWS, {"price": (F.col("price"), "forward_fill")})
S["forward_fill_rows"] = (
    f"WITH r AS ({SALE_ROWS_SQL}), d AS (SELECT segment, date, LAST_VALUE(MAX(price) IGNORE NULLS) OVER (PARTITION BY segment ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS held FROM r GROUP BY segment, date) "
    "SELECT segment, date, l_orderkey, l_linenumber, COALESCE(price, held) AS price FROM r JOIN d USING (segment, date)"
)
Q["ffill_bfill"] = lambda s, d: pick(series.fill_series(continuous(s, d), GRAIN, {c: (F.col(c), "nearest_known") for c in [PRICE, "email_spend"]}), [PRICE, "email_spend"])
S["ffill_bfill"] = rounded_sql(sql("SELECT date, region, category, " + each(nearest("{c}") + " AS {c}", [PRICE, "email_spend"]) + " FROM continuous", "continuous"), [PRICE, "email_spend"])
Q["interpolate_linear"] = lambda s, d: pick(series.fill_series(continuous(s, d), GRAIN, {c: (F.col(c), "interpolate") for c in [MACRO, "sales_qty"]}), [MACRO, "sales_qty"])
S["interpolate_linear"] = rounded_sql(
    sql("SELECT date, region, category, " + each(between("{c}") + " AS {c}", [MACRO, "sales_qty"]) + f" FROM (SELECT *, ROW_NUMBER() OVER ({W_ALL}) AS pos FROM continuous)", "continuous"),
    [MACRO, "sales_qty"],
)
Q["spend_conditional_fill"] = guarded
S["spend_conditional_fill"] = rounded_sql(sql(f"SELECT date, region, category, {each('COALESCE({c}, 0) AS {c}', SPENDS)} FROM continuous", "continuous"), SPENDS)
Q["rate_fill"] = lambda s, d: impute.rate_fill_report(continuous(s, d), plan(s))
S["rate_fill"] = sql(
    " UNION ALL ".join(
        f"SELECT '{ch}_conversion_perc' AS metric, COUNT(*) FILTER ({ch}_conversion_perc IS NULL AND COALESCE({ch}_spend=0, FALSE)) AS n_spend_gap, COUNT(*) FILTER ({ch}_conversion_perc IS NULL AND NOT COALESCE({ch}_spend=0, FALSE)) AS n_other FROM continuous"
        for ch in PREFIXES
    ),
    "continuous",
)
Q["missing_report"] = lambda s, d: impute.missing_report(calendar.fill_calendar(outliers.treat_outliers(flagged(s, d), GRAIN, plan(s)), GRAIN, "daily"), GRAIN, plan(s))
S["missing_report"] = sql(
    " UNION ALL ".join(
        f"SELECT '{c}' AS metric, '{cat}' AS category, '{rule}' AS rule, (SELECT COUNT(*) FILTER ({c} IS NULL) FROM treated_days) AS n_before, (SELECT COUNT(*) FILTER ({c} IS NULL) FROM imputed) AS n_after"
        for c in METRICS
        for cat, rule in [
            ("sales", "zero") if c in SALES
            else ("spend", "guarded_zero") if c in SPENDS
            else ("price", "nearest_known") if c == PRICE
            else ("macro", "interpolate") if c == MACRO
            else ("promo", "zero") if c == FLAG
            else ("response", "zero")
        ]
    ),
    "imputed",
)
Q["impute_panel"] = lambda s, d: pick(impute.impute(calendar.fill_calendar(outliers.treat_outliers(flagged(s, d), GRAIN, plan(s)), GRAIN, "daily"), GRAIN, plan(s)), METRICS)
S["impute_panel"] = rounded_sql(sql("SELECT * FROM imputed", "imputed"), [*SALES, PRICE, MACRO, *SPENDS, *IMPRESSIONS, *RATES])

# aggregation
_wk = "CAST(date_trunc('week', date) AS DATE) - 1 AS date, region, category"
Q["agg_sum"] = lambda s, d: aggregated(s, d, [*SALES, *SPENDS])
S["agg_sum"] = rounded_sql(sql(f"SELECT {_wk}, {each('SUM({c}) AS {c}', [*SALES, *SPENDS])} FROM panel GROUP BY 1,2,3", "panel"), [*SALES, *SPENDS])
Q["agg_weighted_mean"] = lambda s, d: aggregated(s, d, RATES)
S["agg_weighted_mean"] = rounded_sql(sql(f"SELECT {_wk}, " + ", ".join(f"{weighted(f'{ch}_conversion_perc', f'{ch}_impressions')} AS {ch}_conversion_perc" for ch in PREFIXES) + " FROM panel GROUP BY 1,2,3", "panel"), RATES)
Q["agg_mean"] = lambda s, d: aggregated(s, d, [MACRO])
S["agg_mean"] = rounded_sql(sql(f"SELECT {_wk}, AVG(cpi) AS cpi FROM panel GROUP BY 1,2,3", "panel"), [MACRO])
Q["agg_flag_max"] = lambda s, d: aggregated(s, d, [FLAG])
S["agg_flag_max"] = sql(f"SELECT {_wk}, MAX({FLAG}) AS {FLAG} FROM flagged GROUP BY 1,2,3", "flagged")
Q["resolve_weights"] = lambda s, d: resolve_weights(cut_lineage(star.supplier_catalog(s, d)))
S["resolve_weights"] = sql(
    """SELECT r.field_name, r.channel, w.weight FROM catalog r LEFT JOIN (SELECT channel, arg_min(field_name, family*100000000000 + pos) AS weight FROM (
SELECT *, CASE WHEN regexp_matches(field_name,'impression|impr|imp') THEN 0 WHEN regexp_matches(field_name,'reach') THEN 1 WHEN regexp_matches(field_name,'engagement|engage|interaction') THEN 2 WHEN regexp_matches(field_name,'click|clk') THEN 3 WHEN regexp_matches(field_name,'view|vv|watch') THEN 4 WHEN regexp_matches(field_name,'install') THEN 5 WHEN regexp_matches(field_name,'conversion|conv|order|purchase') THEN 6 WHEN regexp_matches(field_name,'spend|cost|expense') THEN 7 END AS family
FROM catalog WHERE data_type='absolute' AND channel IS NOT NULL) WHERE family IS NOT NULL GROUP BY 1) w ON r.channel=w.channel WHERE r.data_category='response' AND r.data_type IN ('rate','percentage')""",
    "catalog",
)
Q["weekly_panel"] = lambda s, d: rounded(weekly_panel(star.panel_daily(s, d), GRAIN, plan(s)))
S["weekly_panel"] = rounded_sql(sql("SELECT * FROM weekly", "weekly"), [*SALES, PRICE, MACRO, *SPENDS, *IMPRESSIONS, *RATES])
Q["merge_metric_frames"] = merged
S["merge_metric_frames"] = (
    "SELECT COALESCE(a.month, b.month, c.month) AS month, shipped_qty, n_orders, n_events FROM "
    "(SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS month, CAST(SUM(CAST(l_quantity AS DECIMAL(14,2))) AS DOUBLE) AS shipped_qty FROM lineitem GROUP BY 1) a FULL JOIN "
    "(SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, COUNT(*) AS n_orders FROM orders GROUP BY 1) b ON a.month=b.month FULL JOIN "
    "(SELECT CAST(date_trunc('month', ts) AS DATE) AS month, COUNT(*) AS n_events FROM events GROUP BY 1) c ON COALESCE(a.month,b.month)=c.month"
)
