"""Write PLANS.md: the physical plan of each headline query, with a summary of
its shuffles, broadcasts, joins and scan pushdown.  Run: python tools/plan_report.py [sf_dir]"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

INTRO = """# Physical plans of the headline queries

Generated by `tools/plan_report.py` on local[8] (AQE on; the plans are the
initial adaptive plans, before runtime re-optimization).  Layers are
materialized first, so the questions read stored tables exactly as in the
benchmark.  What to look for:

* **Exchanges** — one hash exchange per aggregation (after a partial
  aggregate), none for the zone lookups (the optimizer broadcasts them by
  their size in bytes).  Global sorts add a range exchange over the
  *aggregated* rows only.
* **Pushdown** — the window and fare predicates of the bronze questions appear
  in `PushedFilters`; `ReadSchema` lists only the columns used.
* **Exact percentiles** — the daily model's measures and its (day, amount)
  histogram come from one scan and one shuffle, written once; the wanted
  ranks are narrowed down on the stored histogram, and the plan shown ranks
  only the values in the intervals left.  No `percentile` aggregate buffers
  a whole group.
* **Fused gold** — one scan of silver feeds an `Expand` (one copy of each row
  per grouping set) and a single partial/final aggregation for four models;
  the fare histogram is a second, two-column aggregate.
* **Aggregates** — all are hash aggregates (`sort aggregates: 0`).
* **Counter rates** — one exchange by (series, window) for the per-sample
  steps, one partial/final aggregate, one small exchange by series over the
  per-window rows.
"""


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def summary(p: str) -> str:
    tree = p.split("\n\n")[0]
    broadcast = len(re.findall(r"BroadcastExchange \(", tree))
    exchanges = len(re.findall(r"Exchange \(", tree)) - broadcast
    joins = ", ".join(re.findall(r"(\w+Join)", tree)) or "none"
    windows = len(re.findall(r"Window \(", tree))
    python = "yes" if re.search("EvalPython|InPandas", p) else "no"
    return (f"hash/range exchanges: {exchanges}; broadcast exchanges: {broadcast}; joins: {joins}; "
            f"windows: {windows}; sort aggregates: {tree.count('SortAggregate')}; python: {python}")


def main(argv):
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    from strata.session import build_session
    scratch = tempfile.mkdtemp(prefix="plans-")
    spark = build_session("local[8]", shuffle_partitions=8,
                          extra={"spark.sql.warehouse.dir": os.path.join(scratch, "wh")})
    spark.sparkContext.setLogLevel("ERROR")
    from strata.operators import metrics
    from strata.plans import pipeline, questions as Q
    from strata.plans.layers import Medallion
    from strata.sources import fixtures
    m = Medallion(spark, sf_dir)
    b = pipeline.build(m, root=os.path.join(scratch, "layers"), run_tests=False)
    w = fixtures.FIXTURE_WINDOW
    cases = {
        "q1_bronze": Q.q1_bronze(b.bronze, w), "q1_silver": Q.q1_silver(b.clean),
        "q1_gold": Q.q1_gold(b.gold("daily_revenue")),
        "q2_bronze": Q.q2_bronze(b.bronze, b.zones, w), "q2_silver": Q.q2_silver(b.enriched),
        "q2_gold": Q.q2_gold(b.gold("borough_pairs")),
        "gold daily_revenue (exact percentiles, recomputed from stored bronze)": m.__class__(
            spark, window=w, bronze_trips=b.bronze, bronze_zones=b.zones).gold("daily_revenue"),
        "fused gold aggregate (daily, hourly, monthly and ride type in one scan)":
            __import__("strata.operators.gold", fromlist=["x"]).fused_aggregates(b.clean),
        "metric rate (6 h windows)": metrics.increase(
            fixtures.metric_samples(fixtures.table(spark, sf_dir, "events")), ["instance"], 21600),
    }
    out = [INTRO]
    for name, df in cases.items():
        p = plan(df)
        out += [f"## {name}\n", f"`{summary(p)}`\n", "```", p.strip(), "```\n"]
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md")
    with open(path, "w") as f:
        f.write("\n".join(out))
    print(path)
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
