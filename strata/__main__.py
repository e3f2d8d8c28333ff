"""Command line for ``spark-submit``: run one job by name, or the whole flow.

    spark-submit --py-files strata.zip -m strata rl  <in_csv> <out> [fmt]
    python -m strata up   <in_csv> <out> [fmt]
    python -m strata crm  <in_csv> <out> [fmt] [--words good,great]
    python -m strata ma   <silver_root> <gold_root> [fmt]
    python -m strata show <silver_root> <table_name> [fmt] [n_records] [--order-by col,...]
    python -m strata test
    python -m strata flow <landing> <purchase_table> <export> <movie_review_csv> <log_reviews_csv>
                          <silver_root> <gold_root> <state> [fmt] [--words good,great]

``flow`` goes on from the step at which an earlier run with the same ``state`` folder failed.
Only the arguments of the chosen job are read; a missing one is an error for that job alone.
"""

from __future__ import annotations

import argparse
import sys

from strata.plans.jobs import JOBS, FlowPaths, run
from strata.plans.resume import resumable_flow
from strata.session import build_session, size_session

FLOW_PATHS = ["landing", "purchase_table", "export", "movie_review_csv", "log_reviews_csv", "silver_root", "gold_root"]

POSITIONAL = {
    "test": [],
    "show": ["silver_root", "table_name", "fmt", "n_records"],
    "rl": ["in_csv", "out", "fmt"],
    "crm": ["in_csv", "out", "fmt"],
    "cmr": ["in_csv", "out", "fmt"],
    "up": ["in_csv", "out", "fmt"],
    "ma": ["silver_root", "gold_root", "fmt"],
    "flow": [*FLOW_PATHS, "state", "fmt"],
}
REQUIRED = {"show": 2, "rl": 2, "crm": 2, "cmr": 2, "up": 2, "ma": 2, "test": 0, "flow": len(FLOW_PATHS) + 1}


def parse(argv: list[str]) -> tuple[str, dict]:
    ap = argparse.ArgumentParser(prog="strata")
    ap.add_argument("job", choices=sorted([*JOBS, "flow"]))
    ap.add_argument("args", nargs="*")
    ap.add_argument("--words", help="comma-separated positive words (crm/cmr/flow)")
    ap.add_argument("--order-by", help="comma-separated columns (show)")
    ns = ap.parse_args(argv)
    names = POSITIONAL[ns.job]
    if not REQUIRED[ns.job] <= len(ns.args) <= len(names):
        ap.error(f"{ns.job} takes {REQUIRED[ns.job]}..{len(names)} arguments: {' '.join(names)}")
    params = dict(zip(names, ns.args))
    if ns.words and ns.job in ("crm", "cmr", "flow"):
        params["positive_words"] = [w for w in ns.words.split(",") if w]
    if ns.order_by and ns.job == "show":
        params["order_by"] = [c for c in ns.order_by.split(",") if c]
    return ns.job, params


def main(argv: list[str] | None = None) -> int:
    job, params = parse(sys.argv[1:] if argv is None else argv)
    spark = build_session(f"strata-{job}")
    if job == "flow":
        size_session(spark, [params[k] for k in ("landing", "movie_review_csv", "log_reviews_csv")])
        paths = FlowPaths(**{k: params.pop(k) for k in FLOW_PATHS})
        done = resumable_flow(spark, paths, **params)
        print(f"ran: {', '.join(done.ran) or 'nothing'}; skipped: {', '.join(done.skipped) or 'nothing'}; gold: {done.gold}")
        return 0
    inputs = [params[k] for k in ("in_csv", "silver_root") if k in params]
    if inputs:
        size_session(spark, inputs)
    result = run(spark, job, **params)
    if job == "test":
        result.show()
    elif isinstance(result, str):
        print(result)
    return 0


if __name__ == "__main__":
    sys.exit(main())
