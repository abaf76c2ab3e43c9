"""Regenerate PLANS.md: physical plans of the main operators on sf0.01."""
import os, sys, io, contextlib; sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from barlake.session import build_session
from barlake import queries as q, testdata as td
from barlake.operators import daily_metrics, upsert
from barlake.plans import gold_source
spark = build_session("local[8]")
SF = "/root/testdata/sf0.01"
def tree(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    blocks = [b.strip() for b in buf.getvalue().split("\n\n") if b.strip()]
    shown = [blocks[0]]
    wanted = {"Scan parquet": ("PushedFilters", "PartitionFilters", "ReadSchema"),
              "Exchange": ("Arguments",), "WindowGroupLimit": ("Arguments",),
              "HashAggregate": ("Keys", "Functions"), "SortMergeJoin": ("Left keys", "Join type"),
              "BroadcastHashJoin": ("Left keys", "Join type")}
    for b in blocks[1:]:
        lines = b.splitlines()
        head = lines[0]
        for op, fields in wanted.items():
            if head.startswith("(") and op in head:
                body = [l for l in lines[1:] if l.split(" [")[0].split(":")[0].strip() in fields]
                shown.append("\n".join([head.strip()] + [l[:160] for l in body]))
    return "\n\n".join(shown)


from barlake.plans import gold_metrics_frame
from barlake.session import scratch_path
from barlake.sources import Lake
import uuid
_tag = uuid.uuid4().hex[:8]
_lake = Lake(spark, scratch_path(spark, "plans"), {k: f"p{k}_{_tag}" for k in ("bronze", "silver", "gold")}).create()
_s, _e = "2024-01-10 00:00:00", "2024-01-12 23:59:59.999999"
sections = [
    ("Flagship: daily metrics (`daily_metrics`)", "One exchange; partial and final hash aggregates; only four columns read.",
     daily_metrics(td.bars(td.table(spark, SF, "events"), td.NULL_CLOSE_EVERY))),
    ("Latest record in a load-time range (`latest_in_range`)", "Partial `WindowGroupLimit` before the shuffle; the lower bound is a pushed scan filter, the upper bound stays above the window (D1).",
     q.latest_in_range(spark, SF)),
    ("Bars conform over two loads (`bars_conform`)", "Rank-1 per (Ticker, Datetime) with a partial limit; no distinct (redundant after rank 1).",
     q.bars_conform(spark, SF)),
    ("Gold metrics over silver (`gold_metrics_job`)", "The bar-date partition filter prunes silver to the days of the range; the time range is pushed to the scan; one aggregate.",
     gold_metrics_frame(gold_source(_lake, _s, _e), _s, _e, td.LOAD_1)),
    ("Upsert (`upsert_null_keys`)", "One scan and one exchange per side; source rows per key are counted by a window on the join's own partitioning; rows with a null key are spread by part.",
     q.upsert_null_keys(spark, SF)),
]
out = ["# PLANS", "", "Physical plans of the main operators from `explain(\"formatted\")` on sf0.01: a", "`barlake.session.build_session` session, `local[8]`, AQE on, initial plans before runtime", "re-optimisation, with the scan details. Each section names its registered query;", "`barlake.queries.QUERIES[name](spark, sf_dir).explain(\"formatted\")` prints the full plan.", ""]
for title, note, df in sections:
    out += [f"## {title}", "", note, "", "```", tree(df), "```", ""]
flag = q.daily_metrics_q(spark, SF)
flag.collect()
final = flag._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
final = "\n".join(l[:150] for l in final.splitlines()[:-1])
out += ["## Flagship after execution (`daily_metrics`)", "",
        "The final adaptive plan: two whole-stage-codegen spans (`*(1)`: scan, projection, partial",
        "aggregate; `*(2)`: final aggregate, group filter, projection) around one shuffle, whose read AQE",
        "coalesced.", "", "```", final.strip(), "```", ""]
open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w").write("\n".join(out))
