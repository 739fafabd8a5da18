"""SQL views over a method's tables and the command line."""

from __future__ import annotations

from refinery import views
from refinery.plans import batch as batch_plan
from refinery.plans.store import TableStore
from refinery.session import fresh_workspace


def test_sql_over_the_batch_views(spark, golden_bronze):
    store = TableStore(spark, fresh_workspace(spark, "t-views"))
    batch_plan.create_batch_tables(spark, store)
    batch_plan.run_all_batches(spark, golden_bronze[0], store)
    views.register(spark, store, "batch", prefix="b_")
    spread = spark.sql("""
        SELECT count(DISTINCT batch_id) AS years, max(batch_id) - min(batch_id) AS span,
               sum(CASE WHEN silver_rows_loaded = 0 THEN 1 ELSE 0 END) < count(*) AS some_loaded,
               sum(silver_rows_loaded) AS loaded
        FROM b_run_metrics""").first()
    assert (spread.years, spread.span, spread.some_loaded, spread.loaded) == (28, 27, True, 18)
    assert spark.sql("SELECT COUNT(*) AS n FROM b_silver").first().n == 18
    assert spark.table("b_silver").columns[-1] == "loaded_at"
    assert spark.sql("SELECT next_year FROM b_batch_state").first().next_year == 2024


def test_cli_runs_upsert_and_report(spark, golden_bronze, capsys):
    from refinery.__main__ import main
    target = fresh_workspace(spark, "t-cli")
    assert main(["upsert", "--bronze", golden_bronze[0], "--target", target]) == 0
    assert "upsert OK" in capsys.readouterr().out
    assert main(["report", "--target", target, "--method", "upsert", "--name", "layers"]) == 0
    out = capsys.readouterr().out
    assert "silver" in out and "16" in out
    assert main(["sql", "--target", target, "--method", "upsert",
                 "SELECT COUNT(*) AS n FROM gold"]) == 0


def test_views_for_clean_and_upsert(spark, golden_bronze):
    from refinery.plans import clean as clean_plan
    from refinery.plans import upsert as upsert_plan
    for method, run in (("clean_refresh", clean_plan.clean_refresh),
                        ("upsert", upsert_plan.process_upsert)):
        store = TableStore(spark, fresh_workspace(spark, f"t-views-{method}"))
        run(spark, golden_bronze[0], store)
        views.register(spark, store, method, prefix=f"v_{method}_")
        counts = spark.sql(f"""
            SELECT (SELECT COUNT(*) FROM v_{method}_silver) AS s,
                   (SELECT COUNT(*) FROM v_{method}_gold) AS g,
                   (SELECT MAX(method) FROM v_{method}_run_metrics) AS m""").first()
        assert counts.m == method
        assert (counts.s, counts.g) == ((19, 8) if method == "clean_refresh" else (16, 7))
