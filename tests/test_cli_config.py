import datetime as dt
import uuid

from strata.__main__ import main
from strata.config import Config


def test_resolved_run_ts_is_captured_once():
    c = Config(run_ts=None).resolved()
    assert dt.datetime.strptime(c.run_ts, "%Y-%m-%d %H:%M:%S")
    assert c.resolved() is c
    assert Config().resolved().run_ts == Config.run_ts


def test_cli_runs_stages_into_plain_schemas(spark, tmp_path, capsys):
    root = f"{spark.conf.get('spark.checkpoint.dir').rstrip('/')}/cli-test-{uuid.uuid4().hex[:10]}"
    cfg = Config(bronze_schema="cli_bronze", silver_schema="cli_silver", gold_schema="cli_gold")
    from strata.plans.medallion import MedallionRun
    from strata.sources.tables import Warehouse
    p = MedallionRun(spark, "/root/testdata/sf0.001", cfg, Warehouse(spark, cfg, root=root, prefix=""))
    p.bronze()
    assert spark.catalog.tableExists("cli_bronze.raw_orders")
    assert spark.table("cli_bronze.raw_orders").count() == 1500
    main(["/root/testdata/sf0.001", "bronze"])
    assert "bronze: done" in capsys.readouterr().out
    assert spark.catalog.tableExists("bronze.raw_customers")
