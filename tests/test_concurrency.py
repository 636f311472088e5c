from concurrent.futures import ThreadPoolExecutor

from strata.config import Config
from strata.plans.medallion import MedallionRun


def test_concurrent_queries_build_each_layer_once(spark):
    run = MedallionRun(spark, "/root/testdata/sf0.001", Config())
    calls = []
    original = run.wh.save

    def counting_save(df, layer, table, *a, **kw):
        calls.append((layer, table))
        return original(df, layer, table, *a, **kw)

    run.wh.save = counting_save
    jobs = [lambda: run.fact().count(),
            lambda: run.gold_table("agg_revenue_by_state").count(),
            lambda: run.silver_table("orders").count(),
            lambda: run.merged("orders").count()]
    with ThreadPoolExecutor(4) as pool:
        counts = list(pool.map(lambda f: f(), jobs))
    assert counts[0] == 6000 and counts[1] == 25 and counts[2] == 1500 and counts[3] == 1500
    assert len(calls) == len(set(calls))   # no table written twice
