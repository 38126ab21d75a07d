"""Reference SQL of the derived inputs, as named common table expressions."""

from __future__ import annotations

from mediamix.sources.star import CHANNELS, MEASURES

# Added before rounding: sums may differ in the last bit between engines, and an exact
# tie would then round to different sides.
TIE_SHIFT = 1e-7

PREFIXES = [ch for _, _, ch in CHANNELS]
SPENDS = [f"{ch}_spend" for ch in PREFIXES]
IMPRESSIONS = [f"{ch}_impressions" for ch in PREFIXES]
COUNTS = [f"{ch}_{m}" for ch in PREFIXES for m in ("clicks", "conversions")]
RATES = [f"{ch}_conversion_perc" for ch in PREFIXES]
SALES = ["sales_qty", "sales_revenue"]
PRICE, MACRO, FLAG = "price_or_unitmargin", "cpi", "promo_offer_flag"
RESPONSES = [f"{ch}_{m}" for ch in PREFIXES for m in ("impressions", "clicks", "conversions")]
WINSORIZED = SALES + [m for ch in PREFIXES for m in (f"{ch}_spend", f"{ch}_impressions", f"{ch}_clicks", f"{ch}_conversions", f"{ch}_conversion_perc")]
METRICS = SALES + [PRICE, FLAG, MACRO] + WINSORIZED[2:]

_channel_columns = ",\n".join(
    f"""CAST(SUM(CASE WHEN o_orderpriority='{p}' THEN CAST(l_extendedprice AS DECIMAL(14,2))*CAST(l_tax AS DECIMAL(4,2)) END) AS DOUBLE) AS {ch}_spend,
CAST(SUM(CASE WHEN o_orderpriority='{p}' THEN CAST(l_quantity AS DECIMAL(14,2)) END) AS DOUBLE) AS {ch}_impressions,
CAST(SUM(CASE WHEN o_orderpriority='{p}' THEN 1 END) AS BIGINT) AS {ch}_clicks,
CAST(SUM(CASE WHEN o_orderpriority='{p}' AND l_returnflag='A' THEN 1 END) AS BIGINT) AS {ch}_conversions"""
    for p, _, ch in CHANNELS
)
_joins = """lineitem JOIN orders ON l_orderkey=o_orderkey JOIN part ON l_partkey=p_partkey
JOIN supplier ON l_suppkey=s_suppkey JOIN nation ON s_nationkey=n_nationkey JOIN region ON n_regionkey=r_regionkey"""

W_ALL = "PARTITION BY region, category ORDER BY date"
UP = f"OVER ({W_ALL} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
DOWN = f"OVER ({W_ALL} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"


def nearest(c: str) -> str:
    return f"COALESCE(LAST_VALUE({c} IGNORE NULLS) {UP}, FIRST_VALUE({c} IGNORE NULLS) {DOWN})"


def between(c: str) -> str:
    """Interpolation by position; expects the row number as ``pos``."""
    place = f"CASE WHEN {c} IS NOT NULL THEN pos END"
    return (
        f"CASE WHEN {c} IS NOT NULL THEN {c} ELSE LAST_VALUE({c} IGNORE NULLS) {UP} + "
        f"(FIRST_VALUE({c} IGNORE NULLS) {DOWN} - LAST_VALUE({c} IGNORE NULLS) {UP}) * "
        f"(pos - LAST_VALUE({place} IGNORE NULLS) {UP}) / "
        f"(FIRST_VALUE({place} IGNORE NULLS) {DOWN} - LAST_VALUE({place} IGNORE NULLS) {UP}) END"
    )


def iqr(c: str) -> str:
    reach = f"1.5*({c}_q3-{c}_q1)"
    return f"({c} < {c}_q1 - {reach} OR {c} > {c}_q3 + {reach})"


def clipped(c: str) -> str:
    return f"CASE WHEN {c} IS NOT NULL THEN LEAST(GREATEST({c}, {c}_lo), {c}_hi) END"


def weighted(v: str, w: str) -> str:
    return f"CASE WHEN SUM({w}) > 0 THEN SUM({v}*{w})/SUM({w}) ELSE AVG({v}) END"


def aggregates() -> str:
    parts = [f"SUM({c}) AS {c}" for c in SALES + [PRICE]] + [f"MAX({FLAG}) AS {FLAG}", f"AVG({MACRO}) AS {MACRO}"]
    for ch in PREFIXES:
        parts += [f"SUM({ch}_spend) AS {ch}_spend", f"SUM({ch}_impressions) AS {ch}_impressions"]
        parts += [f"CAST(SUM({ch}_{m}) AS BIGINT) AS {ch}_{m}" for m in ("clicks", "conversions")]
        parts.append(f"{weighted(f'{ch}_conversion_perc', f'{ch}_impressions')} AS {ch}_conversion_perc")
    return ", ".join(parts)


def each(template: str, names: list[str]) -> str:
    return ", ".join(template.replace("{c}", c) for c in names)


_medium = "CASE o_orderpriority " + " ".join(f"WHEN '{p}' THEN '{c}'" for p, c, _ in CHANNELS) + " END"


def _of_measure(place: int) -> str:
    return "CASE l_linenumber " + " ".join(f"WHEN {m[0]} THEN '{m[place]}'" for m in MEASURES) + " END"


# name: (names it reads, SQL)
CTES: dict[str, tuple[list[str], str]] = {
    "panel0": (
        [],
        f"""SELECT CAST(l_shipdate AS DATE) AS date, r_name AS region, p_type AS category,
CAST(SUM(CAST(l_extendedprice AS DECIMAL(14,2))) AS DOUBLE) AS sales_revenue,
CAST(SUM(CAST(l_quantity AS DECIMAL(14,2))) AS DOUBLE) AS sales_qty,
MAX(p_retailprice) AS price_or_unitmargin,
MAX(CASE WHEN l_discount>=0.08 THEN 'Yes' ELSE 'No' END) AS promo_offer_flag,
{_channel_columns} FROM {_joins} GROUP BY 1,2,3""",
    ),
    "cpis": (
        [],
        "SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, FLOOR(CAST(SUM(CAST(o_totalprice AS DECIMAL(14,2))) AS DOUBLE)/COUNT(*)) AS cpi FROM orders GROUP BY 1",
    ),
    "panel": (
        ["panel0", "cpis"],
        f"SELECT p.*, {each('{c}_conversions/{c}_clicks AS {c}_conversion_perc', PREFIXES)}, cpi FROM panel0 p LEFT JOIN cpis ON CAST(date_trunc('month', p.date) AS DATE) = month",
    ),
    "flagged": (["panel"], f"SELECT * REPLACE (CASE WHEN {FLAG}='Yes' THEN 1 ELSE 0 END AS {FLAG}) FROM panel"),
    "spine": (
        ["panel"],
        "SELECT region, category, CAST(UNNEST(generate_series(MIN(date), MAX(date), INTERVAL 1 DAY)) AS DATE) AS date FROM panel GROUP BY 1,2",
    ),
    "continuous": (
        ["spine", "flagged"],
        "SELECT f.* EXCLUDE (region, category, date), s.* FROM spine s LEFT JOIN flagged f ON s.region=f.region AND s.category=f.category AND s.date=f.date",
    ),
    "bounds": (
        ["panel"],
        "SELECT region, category, "
        + ", ".join(
            f"quantile_disc({c}, {p}) AS {c}_{n}"
            for c in [*WINSORIZED, PRICE]
            for n, p in (("lo", 0.01), ("q1", 0.25), ("q3", 0.75), ("hi", 0.99))
        )
        + ", AVG(cpi) AS cpi_mean, STDDEV_SAMP(cpi) AS cpi_std, AVG(sales_revenue) AS sales_revenue_mean, STDDEV_SAMP(sales_revenue) AS sales_revenue_std FROM panel GROUP BY 1,2",
    ),
    "bounded": (["flagged", "bounds"], "SELECT * FROM flagged JOIN bounds USING (region, category)"),
    "treated": (
        ["bounded"],
        "SELECT date, region, category, "
        + each(f"{clipped('{c}')} AS {{c}}", WINSORIZED)
        + f", LAST_VALUE(CASE WHEN NOT COALESCE({iqr(PRICE)}, FALSE) THEN {PRICE} END IGNORE NULLS) {UP} AS {PRICE}, {FLAG}, AVG(cpi) OVER ({W_ALL} ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS cpi FROM bounded",
    ),
    "treated_days": (
        ["spine", "treated"],
        f"SELECT t.* EXCLUDE (region, category, date), s.*, ROW_NUMBER() OVER (PARTITION BY s.region, s.category ORDER BY s.date) AS pos FROM spine s LEFT JOIN treated t ON s.region=t.region AND s.category=t.category AND s.date=t.date",
    ),
    "imputed": (
        ["treated_days"],
        f"SELECT date, region, category, {each('COALESCE({c}, 0) AS {c}', WINSORIZED + [FLAG])}, {nearest(PRICE)} AS {PRICE}, {between(MACRO)} AS {MACRO} FROM treated_days",
    ),
    "weekly": (
        ["imputed"],
        f"SELECT CAST(date_trunc('week', date) AS DATE) - 1 AS date, region, category, {aggregates()} FROM imputed GROUP BY 1,2,3",
    ),
    "catalog_raw": (
        [],
        f"""SELECT CAST(substr(o_orderpriority,1,1) AS BIGINT)*10000000000 + l_suppkey*10 + l_linenumber AS pos,
replace(medium || ' s' || l_suppkey, ' ', '_') || '_' || measure AS field_name,
CASE WHEN l_suppkey%37=0 THEN NULL WHEN l_suppkey%41=0 THEN 'Ratio' ELSE type END AS data_type,
category AS data_category,
CASE WHEN l_suppkey%50=0 THEN NULL ELSE medium || ' s' || l_suppkey END AS channel,
CASE WHEN l_suppkey%43=0 THEN 'maybe' ELSE 'no' END AS can_be_negative
FROM (SELECT DISTINCT o_orderpriority, l_suppkey, l_linenumber, {_medium} AS medium, {_of_measure(1)} AS measure, LOWER({_of_measure(2)}) AS type, LOWER({_of_measure(3)}) AS category
FROM lineitem JOIN orders ON l_orderkey=o_orderkey) WHERE measure IS NOT NULL""",
    ),
    "catalog": (
        ["catalog_raw"],
        "SELECT * FROM catalog_raw WHERE data_type IS NOT NULL AND data_type<>'Ratio' AND can_be_negative<>'maybe'",
    ),
    "roles": (
        ["catalog"],
        """SELECT *, CASE WHEN data_category='spend' THEN 'cost' WHEN data_type='rate' THEN 'efficiency'
WHEN regexp_matches(field_name, 'impression|reach|grp|trp|imp|spot|sent|deliver') THEN 'exposure'
WHEN regexp_matches(field_name, 'click|view|visit|engage|clk|read') THEN 'engagement'
WHEN regexp_matches(field_name, 'conversion|conv|order|install|purchase') THEN 'conversion' END AS funnel_role FROM catalog""",
    ),
    "primaries": (
        ["roles"],
        """SELECT channel, arg_min(field_name, (CASE WHEN field_name LIKE '%impressions%' THEN 0 WHEN field_name LIKE '%reach%' THEN 1 WHEN field_name LIKE '%grp%' THEN 2 ELSE 3 END) * 100000000000 + pos) AS primary_exposure
FROM roles WHERE channel IS NOT NULL AND data_type='absolute' AND funnel_role='exposure' GROUP BY 1""",
    ),
    "media": (
        ["panel0"],
        "SELECT segment, date, channel, COALESCE(spend, 0.0) AS spend, COALESCE(exposure, 0.0) AS exposure FROM ("
        "SELECT g.segment, g.date, g.channel, SUM(spend) AS spend, SUM(exposure) AS exposure FROM "
        "(SELECT w.segment, w.date, c.channel FROM (SELECT segment, CAST(UNNEST(generate_series(MIN(date), MAX(date), INTERVAL 7 DAY)) AS DATE) AS date FROM (SELECT region || '_' || category AS segment, CAST(date_trunc('week', date) AS DATE) - 1 AS date FROM panel0) GROUP BY 1) w, "
        "(VALUES " + ", ".join(f"('{c}')" for _, c, _ in CHANNELS) + ") c(channel)) g LEFT JOIN ("
        + " UNION ALL ".join(
            f"SELECT region || '_' || category AS segment, CAST(date_trunc('week', date) AS DATE) - 1 AS date, '{c}' AS channel, {ch}_spend AS spend, {ch}_impressions AS exposure FROM panel0"
            for _, c, ch in CHANNELS
        )
        + ") l ON g.segment=l.segment AND g.date=l.date AND g.channel=l.channel GROUP BY 1,2,3)",
    ),
    "lines": (
        [],
        f"SELECT r_name AS segment, 's' || CAST(l_orderkey % 20 AS VARCHAR) AS sol_id, o_orderpriority AS channel, CAST(date_trunc('month', l_shipdate) AS DATE) AS date, l_linenumber, l_returnflag, l_extendedprice, l_quantity, l_discount FROM {_joins}",
    ),
    "channels0": (
        ["lines"],
        """SELECT segment, sol_id, channel,
CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE)/CAST(SUM(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE)/1000 AS roi_total,
CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS effect,
CAST(SUM(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS spend,
AVG(CAST(l_linenumber AS DOUBLE)) AS mean_carryover, AVG(CAST(l_linenumber AS DOUBLE))*2 AS mean_spend_adstocked
FROM lines GROUP BY 1,2,3""",
    ),
    "channels": (
        ["channels0"],
        "SELECT *, effect/SUM(effect) OVER (PARTITION BY segment, sol_id) AS effect_share, spend/SUM(spend) OVER (PARTITION BY segment, sol_id) AS spend_share FROM channels0",
    ),
    "weeklies": (
        ["lines"],
        """SELECT segment, sol_id, date, component, CAST(SUM(value) AS DOUBLE) AS value FROM (
SELECT segment, sol_id, date, CASE WHEN l_linenumber<=3 THEN channel ELSE 'base_' || LOWER(l_returnflag) END AS component, CAST(CAST(l_extendedprice AS DECIMAL(18,2))*(1-CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(24,4)) AS value FROM lines
UNION ALL SELECT segment, sol_id, date, 'dep_var', CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DECIMAL(24,4)) FROM lines
UNION ALL SELECT segment, sol_id, date, 'depVarHat', CAST(CAST(l_extendedprice AS DECIMAL(18,2))*(1-CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(24,4)) FROM lines) GROUP BY 1,2,3,4""",
    ),
    "fits": (
        ["weeklies", "channels"],
        """SELECT segment, sol_id, 1 - (rss/n)/var_y AS rsq_train, SQRT(rss/n)/range_y AS nrmse, mape, decomp_rssd FROM (
SELECT segment, sol_id, SUM((y-f)*(y-f)) AS rss, VAR_POP(y) AS var_y, COUNT(*) AS n, MAX(y)-MIN(y) AS range_y, AVG(ABS((y-f)/y)) AS mape FROM (
SELECT segment, sol_id, date, SUM(CASE WHEN component='dep_var' THEN value END) AS y, SUM(CASE WHEN component='depVarHat' THEN value END) AS f FROM weeklies GROUP BY 1,2,3) GROUP BY 1,2)
JOIN (SELECT segment, sol_id, SQRT(SUM((effect_share-spend_share)*(effect_share-spend_share))) AS decomp_rssd FROM channels GROUP BY 1,2) USING (segment, sol_id)""",
    ),
    "measures": (
        ["fits", "channels", "weeklies"],
        """SELECT segment, sol_id, nrmse, decomp_rssd, rsq_train, roas, roas_cv, max_channel_effect_share, max_share_delta, carryover_pct,
baseline_min_weekly, baseline_mean_weekly, baseline_pct_mean, 1 - baseline_pct_mean AS media_contribution_pct FROM fits
JOIN (SELECT segment, sol_id, SUM(roi_total*spend_share)/(SUM(spend_share)+1e-10) AS roas, COALESCE(STDDEV_SAMP(roi_total)/(ABS(AVG(roi_total))+1e-10), 0) AS roas_cv,
MAX(effect_share) AS max_channel_effect_share, MAX(ABS(effect_share-spend_share)) AS max_share_delta, SUM(mean_carryover)/(SUM(mean_spend_adstocked)+1e-10) AS carryover_pct FROM channels GROUP BY 1,2) USING (segment, sol_id)
JOIN (SELECT segment, sol_id, MIN(b) AS baseline_min_weekly, AVG(b) AS baseline_mean_weekly, AVG(b/(y+1e-10)) AS baseline_pct_mean FROM (
SELECT segment, sol_id, date, COALESCE(SUM(CASE WHEN component LIKE 'base_%' THEN value END), 0) AS b, SUM(CASE WHEN component='dep_var' THEN value END) AS y FROM weeklies GROUP BY 1,2,3) GROUP BY 1,2) USING (segment, sol_id)""",
    ),
    "viability": (
        ["measures"],
        """SELECT *, tier = MIN(tier) OVER (PARTITION BY segment) AS viable FROM (
SELECT *, baseline_min_weekly<0 OR rsq_train<0.5 AS disqualified, CASE WHEN baseline_min_weekly>=0 AND rsq_train>=0.5 THEN 0 WHEN baseline_min_weekly>=0 THEN 1 ELSE 2 END AS tier FROM measures)""",
    ),
    "scores": (
        ["viability"],
        "SELECT segment, sol_id, score, CAST(ROW_NUMBER() OVER (PARTITION BY segment ORDER BY score DESC, sol_id) AS INTEGER) AS rank FROM (SELECT segment, sol_id, "
        "0.25*LEAST(GREATEST(roas,0),8)/8 + 0.18*(1-n_decomp_rssd) + 0.12*n_media_contribution_pct + 0.12*(1-n_roas_cv) + 0.10*(1-n_max_channel_effect_share) + 0.08*(1-n_max_share_delta) + 0.05*(1-n_carryover_pct) + 0.05*n_rsq_train + 0.05*(1-n_nrmse) - 0.10*LEAST(GREATEST((rsq_train-0.95)/0.05,0),1) AS score FROM (SELECT *, "
        + ", ".join(
            f"({m} - MIN({m}) OVER s)/(MAX({m}) OVER s - MIN({m}) OVER s + 1e-10) AS n_{m}"
            for m in ("decomp_rssd", "media_contribution_pct", "roas_cv", "max_channel_effect_share", "max_share_delta", "carryover_pct", "rsq_train", "nrmse")
        )
        + " FROM viability WHERE viable WINDOW s AS (PARTITION BY segment)))",
    ),
}


def sql(body: str, *names: str) -> str:
    """``body`` preceded by the common table expressions it needs, in order."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in CTES[name][0]:
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    heads = ",\n".join(f"{n} AS ({CTES[n][1]})" for n in ordered)
    return f"WITH {heads}\n{body}" if heads else body


def rounded_sql(text: str, columns: list[str], digits: int = 4) -> str:
    """Wrap a query so that the named doubles are rounded."""
    return f"SELECT * REPLACE ({', '.join(f'ROUND({c} + {TIE_SHIFT}, {digits}) AS {c}' for c in columns)}) FROM ({text})"
