"""Stages end to end on the smallest test data."""

from mediamix.grain import Grain
from mediamix.plans.preprocess import weekly_panel
from mediamix.queries.prepare import plan, rounded
from mediamix.session import cut_lineage
from mediamix.sources import star


def test_both_grain_paths_give_the_same_weekly_panel(spark):
    raw = cut_lineage(star.panel_daily(spark, "/root/testdata/sf0.001"))
    rules = plan(spark)
    windows = rounded(weekly_panel(raw, star.PANEL_GRAIN, rules), 3)
    joins = rounded(weekly_panel(raw, Grain(star.PANEL_GRAIN.keys), rules), 3)
    columns = sorted(windows.columns)
    left, right = (sorted((tuple(r) for r in df.select(columns).collect()), key=str) for df in (windows, joins))
    assert left == right and len(left) > 0
