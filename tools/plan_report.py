"""Print the physical plan shape of the heavy operators.

    python tools/plan_report.py [sf_dir] > docs/PLANS.md

For each operator: the count of exchanges, joins by strategy, aggregates and
windows in the executed plan, then the formatted plan's operator tree.
"""

from __future__ import annotations

import collections
import contextlib
import io
import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

PATTERN = re.compile(r"(Exchange hashpartitioning|Exchange rangepartitioning|Exchange SinglePartition"
                     r"|BroadcastExchange|BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin"
                     r"|BroadcastNestedLoopJoin|CartesianProduct|WindowGroupLimit|Window\b"
                     r"|HashAggregate|SortAggregate|ObjectHashAggregate|TakeOrderedAndProject"
                     r"|BatchEvalPython|ArrowEvalPython)")


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from ledgerline.session import local_session
    from ledgerline.plans import measures as M
    from ledgerline.plans import queries as Q
    from ledgerline.plans import warehouse as W
    from ledgerline.sources.bridge import bridge_raw
    from ledgerline.operators import quality as DQ

    spark = local_session()
    raw = bridge_raw(spark, sf_dir)
    cz = W.build_clean_zone(raw, medians=(0.0, 650))
    run = W.from_testdata(spark, sf_dir)            # what the pipeline wrote
    wh, written = run.wh, run.cz
    ops = {
        "clean_transactions (winners)": cz.transactions,
        "rejected_transactions": cz.transactions_rejected,
        "enriched_transactions": W.enriched_transactions(written),
        "customer_risk_metrics": W.risk_metrics(written),
        "dq_scorecard": DQ.dq_scorecard(raw.transactions, raw.accounts),
        "Q7a branch_performance_sql": Q.branch_performance_sql(wh),
        "Q6 monthly_trend": Q.monthly_trend(wh),
        "B bi_measures": M.bi_measures(wh),
    }
    print("# Physical plans of the heavy operators\n")
    print(f"Generated by `tools/plan_report.py` on `{sf_dir}` (cleaners and quality from "
          "the raw test tables, with the bridge's own joins; the rest over the pipeline's tables).\n")
    for name, df in ops.items():
        plan = df._jdf.queryExecution().executedPlan().toString()
        counts = collections.Counter(PATTERN.findall(plan))
        print(f"## {name}\n")
        print("operators: " + ", ".join(f"{k} x{v}" for k, v in sorted(counts.items())) + "\n")
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain("formatted")
        lines = buf.getvalue().split("\n\n")[0].splitlines()
        print("```")
        print("\n".join(lines[:60]))
        print("```\n")
    spark.stop()


if __name__ == "__main__":
    main()
