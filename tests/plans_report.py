"""Write PLANS.md: the final (adaptive) physical plans of the headline
operators over written Parquet layers (sf0.01 by default), each taken after
running the query, trimmed to the operator tree plus the scan lines that
show pushdown and pruning.

    python tests/plans_report.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import datetime as dt
import os
import re
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from txnlake.operators import anomaly as AN  # noqa: E402
from txnlake.operators import incremental as INC  # noqa: E402
from txnlake.operators import ml as ML  # noqa: E402
from txnlake.operators import monitoring as MON  # noqa: E402
from txnlake.operators.silver import to_silver  # noqa: E402
from txnlake.plans import jobs  # noqa: E402
from txnlake.session import build_session  # noqa: E402
from txnlake.plans.fixtures import AS_OF, bronze_from_events, load_table, predictions_from_gold  # noqa: E402

KEEP = re.compile(r"(PushedFilters|PartitionFilters|ReadSchema|Location)")


def trimmed(df) -> str:
    """Run the query (results are small at this scale), then print the plan
    of that same execution: AQE's final plan, with its runtime choices."""
    df.collect()
    text = df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    tree, details = text.split("\n\n", 1) if "\n\n" in text else (text, "")
    if "== Initial Plan ==" in tree:
        tree = tree.split("+- == Initial Plan ==")[0]
    scans = [re.sub(r"#\d+L?", "", ln) for ln in details.splitlines() if KEEP.match(ln) and not ln.startswith("Location")]
    return tree.strip() + "\n" + "\n".join(dict.fromkeys(scans))


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session()
    root = tempfile.mkdtemp(prefix="plans-", dir="/tmp")
    bronze_from_events(load_table(spark, sf, "events")).write.parquet(f"{root}/bronze")
    jobs.bronze_to_silver(spark, f"{root}/bronze", f"{root}/silver")
    jobs.silver_to_gold(spark, f"{root}/silver", f"{root}/gold", as_of=AS_OF)
    gold = spark.read.parquet(f"{root}/gold")
    predictions_from_gold(gold).withColumn("batch_id", F.lit("b1")).write.partitionBy("batch_id").parquet(f"{root}/pred")
    pred = spark.read.parquet(f"{root}/pred")
    plans = {
        "E1 Silver: null-key filter, partial max_by dedupe, features": to_silver(spark.read.parquet(f"{root}/bronze")),
        "N1+L1 next batch: anti-join + top-k (no global sort)": INC.next_batch(INC.unscored(gold, pred.select("trans_num"))),
        "Cursor mode: files since the mark, key columns only, scored keys found by a semi-join": INC.absent(
            INC.with_arrival(gold).filter(F.col(INC.ARRIVED) >= F.lit(dt.datetime(2024, 1, 20))).select("trans_num", INC.CURSOR),
            pred.select("trans_num"),
        ),
        "K4 rows to append: broadcast semi-join reduction, then anti-join": INC.rows_to_append(
            pred.limit(5000).drop("batch_id"), pred.select("trans_num")
        ),
        "E7 one-pass panel aggregate (GROUPING SETS)": MON.panel_aggregates(pred),
        "A4 frauds by hour: pushed filter, two-column read": MON.by_hour(pred),
        "L6 map sample: pruned columns, top-k": MON.map_points(pred),
        "M2 exact split (bucket histogram, bounded cut broadcast)": ML.stratified_split(
            ML.clean_training(gold.select("trans_num", *ML.FEATURES, "is_fraud"))
        ),
        "X5 per-customer z-score (hot keys broadcast, rest shuffled)": AN.amount_anomalies(gold),
    }
    print("# PLANS\n")
    print(f"Final adaptive plans, taken after each query ran, over Parquet layers written from `{sf}`")
    print("(local[8]; at this size AQE broadcasts small sides that would be shuffled at scale).")
    print("Regenerate with `python tests/plans_report.py > PLANS.md`.\n")
    for title, df in plans.items():
        print(f"## {title}\n\n```\n{trimmed(df)}\n```\n")
    spark.stop()


if __name__ == "__main__":
    main()
