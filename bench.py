"""Times the loads and the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8).
The star is built once, with its writes, as `build_star`; the business
queries then read the written star, as a user's reports would.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
CPUS = os.environ.get("BENCH_CPUS", "8")


def main() -> None:
    from contract import load_all
    from pyspark.sql import functions as F
    from tidemark import session
    from tidemark.operators.upsert import upsert
    from tidemark.plans import star as plans

    scratch = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark = session.build("bench", f"local[{CPUS}]", int(CPUS), {
        "spark.ui.enabled": "false", "spark.driver.memory": "16g", "spark.checkpoint.dir": f"{scratch}/shared",
        "spark.sql.warehouse.dir": f"{scratch}/warehouse"})
    spark.sparkContext.setLogLevel("ERROR")
    queries, _ = load_all()
    spent: dict[str, float] = {}

    def timed(name, work):
        start = time.time()
        work()
        spent[name] = round(time.time() - start, 3)

    def drain(df):
        df.write.format("noop").mode("overwrite").save()

    spark.range(1000).selectExpr("sum(id)").collect()  # start the executors
    timed("build_star", lambda: plans.store_all(plans.gold(spark, SF_DIR)))
    for name in ("campaigns", "channels", "customers", "products", "performance", "sales"):
        timed(f"silver_{name}", lambda: drain(plans.silver_table(spark, SF_DIR, name)))
    listed = [k for k in queries if k.startswith("q_")] + [
        "fact_performance", "fact_sales", "fact_campaign_daily", "scd2_incremental", "detect_changes", "fact_asof_lookup", "run_layer_checks",
        "val_business_rules", "profile_columns", "aud_check_status", "aud_exec_summary", "aud_lineage_flow", "multi_table_ingest", "secured_view"]
    for key in listed:
        timed(key, lambda: drain(queries[key](spark, SF_DIR)))

    # upsert: all rows changed, and one day's worth of rows
    sales = f"{scratch}/sales"
    plans.silver_table(spark, SF_DIR, "sales").write.parquet(sales)
    target = spark.read.parquet(sales)
    total = target.count()
    changed = target.withColumn("revenue", F.col("revenue") + 1).withColumn("revenue", F.col("revenue").cast("decimal(18,2)"))
    timed("upsert_all", lambda: drain(upsert(target, changed, ["order_line_id"])))
    newest = target.agg(F.max("order_date")).scalar()
    few = changed.where(F.col("order_date") > F.date_sub(newest, 25))
    n = few.count()
    timed("upsert_increment", lambda: drain(upsert(target, few, ["order_line_id"])))
    spark.stop()
    print(json.dumps({
        "metric": "total_query_time", "value": round(sum(spent.values()), 3), "unit": "sec", "queries": spent, "sf": SF_DIR.rsplit("sf", 1)[-1],
        "cpus": int(CPUS), "rows": {"sales": total, "upsert_increment": n},
        "rows_per_sec": {"upsert_all": round(total / spent["upsert_all"]), "upsert_increment": round(total / spent["upsert_increment"])}}))


if __name__ == "__main__":
    main()
