"""Time the jobs at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

The raw document collections are landed as parquet first, outside the timings: jobs start from
landed files, as they do in production.  Each job runs once to warm up and then three times, of
which the median counts; the two whole loads run once, after them.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time
from pathlib import Path
from statistics import median

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from checks import envelopes  # noqa: E402
from checks.queries import CUTOFF, RUN_1, RUN_2  # noqa: E402
from sparkmart import schemas as S  # noqa: E402
from sparkmart.operators.lookup import account_bridge, lookup_view  # noqa: E402
from sparkmart.operators.quality import check_not_null  # noqa: E402
from sparkmart.plans import presentation as P  # noqa: E402
from sparkmart.plans import processed  # noqa: E402
from sparkmart.plans.run import run_pipeline  # noqa: E402
from sparkmart.session import prepare, shared_folder, staged  # noqa: E402
from sparkmart.sources.store import TableStore, empty_table  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = prepare(
        SparkSession.builder.master(f"local[{CPUS}]").appName("bench")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g").config("spark.sql.shuffle.partitions", CPUS)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    landed = {
        "customers": staged(envelopes.raw_customers(spark, SF_DIR)),
        "accounts": staged(envelopes.raw_accounts(spark, SF_DIR)),
        "transactions": staged(envelopes.raw_transactions(spark, SF_DIR)),
    }
    earlier = dict(landed, transactions=staged(
        envelopes.raw_transactions(spark, SF_DIR, CUTOFF)))
    later = {
        "customers": staged(envelopes.raw_customers(spark, SF_DIR, 2)),
        "accounts": staged(envelopes.raw_accounts(spark, SF_DIR, 2)),
        "transactions": landed["transactions"],
    }

    people = staged(processed.process_customers(landed["customers"]))
    ledger = staged(processed.process_accounts(landed["accounts"]))
    moves = staged(processed.process_transactions(landed["transactions"]))
    people_2 = staged(processed.process_customers(later["customers"]))
    dim_customer = staged(P.build_dim_customer(
        people, empty_table(spark, S.DIM_CUSTOMER), RUN_1.date()))
    dim_account = staged(P.build_dim_account(
        ledger, empty_table(spark, S.DIM_ACCOUNT), RUN_1.date()))
    details = staged(P.build_dim_transaction_details(
        moves, empty_table(spark, S.DIM_TRANSACTION_DETAILS)))

    def two_runs() -> None:
        store = TableStore(spark, shared_folder(spark))
        run_pipeline(spark, store, earlier, RUN_1)
        run_pipeline(spark, store, later, RUN_2)

    jobs = {
        "process_customers": lambda: run(processed.process_customers(landed["customers"])),
        "process_accounts": lambda: run(processed.process_accounts(landed["accounts"])),
        "process_transactions": lambda: run(
            processed.process_transactions(landed["transactions"])),
        "dim_customer": lambda: run(P.customer_grain(people)),
        "dim_account": lambda: run(P.account_grain(ledger)),
        "scd2_customer": lambda: run(
            P.build_dim_customer(people_2, dim_customer, RUN_2.date())),
        "dim_transaction_details": lambda: run(
            P.build_dim_transaction_details(moves, details)),
        "fact_transaction": lambda: run(P.build_fact_transaction(
            moves, account_bridge(people),
            lookup_view(dim_customer, ["customer_bk"], "customer_sk"),
            lookup_view(dim_account, ["account_id"], "account_sk"), details, str(RUN_1))),
        "dq_not_null": lambda: run(check_not_null(moves, S.NOT_NULL["transaction"])),
        "two_runs": two_runs,
    }
    def seconds(job) -> float:
        start = time.perf_counter()
        job()
        return time.perf_counter() - start

    times = {}
    for name, job in jobs.items():
        if name == "two_runs":  # the other jobs have compiled and read what it uses
            times[name] = round(seconds(job), 3)
            continue
        job()
        times[name] = round(median(seconds(job) for _ in range(3)), 3)
    found = re.search(r"sf([\d.]+)", SF_DIR)
    print(json.dumps({
        "metric": "total_wall_time", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": float(found.group(1)) if found else None,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
