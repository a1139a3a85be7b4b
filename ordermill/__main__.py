"""Command line: run the jobs and the registered queries.

  python -m ordermill create  --raw ROOT [--snapshots]
  python -m ordermill expire  --table PATH [--keep N]
  python -m ordermill batch   --orders CSV --raw ROOT [--reference name=CSV ...]
  python -m ordermill stream  --source DIR --good PATH --bad PATH --checkpoint PATH [--early S] [--once]
  python -m ordermill replay  --orders CSV --out DIR [--good PATH] [--errors PATH] [--late-offset S]
  python -m ordermill reconcile --table PATH
  python -m ordermill build   --raw ROOT --models ROOT [--full-refresh]
  python -m ordermill lineage --raw ROOT [--models ROOT]
  python -m ordermill report  NAME --models ROOT [--as-of DATE] [--show N] [--out PATH]
  python -m ordermill quality --models ROOT
  python -m ordermill counts  --raw ROOT
  python -m ordermill governed --models ROOT --principal P [--allow P=PREDICATE ...] [--mask COLUMN=READER,... ...]
  python -m ordermill query   NAME --data DIR [--show N] [--out PATH]
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="ordermill")
    sub = ap.add_subparsers(dest="cmd", required=True)
    b = sub.add_parser("batch")
    b.add_argument("--orders", required=True)
    b.add_argument("--raw", required=True)
    b.add_argument("--reference", action="append", default=[], help="name=path (customers, products, campaigns)")
    s = sub.add_parser("stream")
    s.add_argument("--source", required=True)
    s.add_argument("--good", required=True)
    s.add_argument("--bad", required=True)
    s.add_argument("--checkpoint", required=True)
    s.add_argument("--window", type=int, default=60)
    s.add_argument("--lateness", type=int, default=300)
    s.add_argument("--records", action="store_true", help="the source holds keyed records with headers (parquet)")
    s.add_argument("--trigger", default="30 seconds")
    s.add_argument("--early", type=int, help="fire panes, early ones after so many seconds")
    s.add_argument("--sinks-must-exist", action="store_true", help="fail when a sink was not created")
    s.add_argument("--once", action="store_true", help="process what is there, then stop")
    r = sub.add_parser("replay")
    r.add_argument("--orders", required=True)
    r.add_argument("--out", required=True)
    r.add_argument("--good")
    r.add_argument("--errors")
    r.add_argument("--late-offset", type=int, default=0)
    c = sub.add_parser("reconcile")
    c.add_argument("--table", required=True)
    for cmd in ("create", "counts"):
        x = sub.add_parser(cmd)
        x.add_argument("--raw", required=True)
        if cmd == "create":
            x.add_argument("--snapshots", action="store_true", help="as snapshot tables")
    e = sub.add_parser("expire")
    e.add_argument("--table", required=True)
    e.add_argument("--keep", type=int, default=2, help="versions to keep")
    m = sub.add_parser("build")
    m.add_argument("--raw", required=True)
    m.add_argument("--models", required=True)
    m.add_argument("--full-refresh", action="store_true")
    p = sub.add_parser("report")
    p.add_argument("name")
    p.add_argument("--models", required=True)
    p.add_argument("--as-of", type=dt.date.fromisoformat, help="last day of the 90-day report (today)")
    li = sub.add_parser("lineage")
    li.add_argument("--raw", required=True)
    li.add_argument("--models", help="list the stored models a build would renew")
    q = sub.add_parser("quality")
    q.add_argument("--models", required=True)
    q.add_argument("--orders-since", type=int, metavar="VERSION", help="only: order ids repeated since a version of the fact")
    g = sub.add_parser("governed")
    g.add_argument("--models", required=True)
    g.add_argument("--principal", required=True)
    g.add_argument("--allow", action="append", default=[], help="principal=row predicate")
    g.add_argument("--mask", action="append", default=[], help="column=principals that may read it")
    q = sub.add_parser("query")
    q.add_argument("name")
    q.add_argument("--data", required=True)
    for shown in (q, p, g):
        shown.add_argument("--show", type=int, default=20)
        shown.add_argument("--out")
    a = ap.parse_args(argv)

    from pyspark.sql import SparkSession

    from ordermill.session import get_spark
    owned = SparkSession.getActiveSession() is None
    spark = get_spark(f"ordermill-{a.cmd}")
    df = None
    if a.cmd == "create":
        from ordermill.plans.batch_job import create_raw
        print(json.dumps({"created": create_raw(spark, a.raw, a.snapshots)}))
    elif a.cmd == "expire":
        from ordermill.sources.snapshots import SnapshotTable
        print(json.dumps({"removed": SnapshotTable(spark, a.table).expire(a.keep)}))
    elif a.cmd == "batch":
        from ordermill.plans.batch_job import ingest_orders, ingest_reference
        out = {"orders": ingest_orders(spark, a.orders, a.raw)}
        for spec in a.reference:
            name, path = spec.split("=", 1)
            out[name] = ingest_reference(spark, name, path, a.raw)
        print(json.dumps(out))
    elif a.cmd == "stream":
        from ordermill.sources.messages import read_message_stream, read_record_stream
        from ordermill.streaming.orders_stream import RunCounters, start
        counters = RunCounters()
        spark.streams.addListener(counters)
        trigger = {"availableNow": True} if a.once else {"processingTime": a.trigger}
        source = (read_record_stream if a.records else read_message_stream)(spark, a.source)
        qh = start(source, a.good, a.bad, a.checkpoint,
                   a.window, a.lateness, trigger, a.sinks_must_exist, a.early)
        qh.awaitTermination()
        spark.streams.removeListener(counters)
        print(json.dumps(counters.counts))
    elif a.cmd == "replay":
        from ordermill.plans.replay import run_replay
        from ordermill.sources.files import read_table
        good = read_table(spark, a.good) if a.good else None
        errors = read_table(spark, a.errors) if a.errors else None
        print(json.dumps(run_replay(spark, a.orders, a.out, good, errors, late_offset_s=a.late_offset)))
    elif a.cmd == "reconcile":
        from ordermill.streaming.reconcile import reconcile_sink
        print(json.dumps(reconcile_sink(spark, a.table)))
    elif a.cmd == "build":
        from ordermill.plans.build_job import build
        print(json.dumps(build(spark, a.raw, a.models, a.full_refresh)))
    elif a.cmd == "lineage":
        from ordermill.plans.build_job import REPORTS, stale_models
        from ordermill.plans.lineage import model_edges
        from ordermill.plans.model import StoredRaw
        if a.models:
            print(json.dumps({"stale": stale_models(spark, a.raw, a.models)}))
        else:
            df = spark.createDataFrame(model_edges(StoredRaw(spark, a.raw), REPORTS), "model string, input string")
            a.show, a.out = 1000, None
    elif a.cmd == "quality" and a.orders_since is not None:
        from ordermill.plans.build_job import Built
        Built(spark, a.models).repeated_orders(a.orders_since).show(truncate=False)
    elif a.cmd == "quality":
        from ordermill.plans.build_job import Built
        failures = Built(spark, a.models).quality().collect()  # one row per declared check
        print(json.dumps({f"{r['table_name']}.{r['column_name']}.{r['test']}": r["failures"] for r in failures}))
    elif a.cmd == "counts":
        from ordermill.plans.build_job import raw_row_counts
        print(json.dumps({r["table_name"]: r["row_count"] for r in raw_row_counts(spark, a.raw).collect()}))
    elif a.cmd == "report":
        from ordermill.plans.build_job import Built
        df = Built(spark, a.models).report(a.name, **({"as_of": a.as_of} if a.as_of else {}))
    elif a.cmd == "governed":
        from ordermill.operators.governance import ColumnMask, RowPolicy, governed
        from ordermill.plans.build_job import Built
        allow = [spec.split("=", 1) for spec in a.allow]
        mask = [spec.split("=", 1) for spec in a.mask]
        df = governed(Built(spark, a.models).tables["fact_orders"], a.principal,
                      [RowPolicy(f"rows of {who}", frozenset({who}), rows) for who, rows in allow],
                      [ColumnMask((column,), frozenset(readers.split(","))) for column, readers in mask])
    elif a.cmd == "query":
        from ordermill.plans.registry import QUERIES
        df = QUERIES[a.name](spark, a.data)
    if df is not None and a.out:
        df.write.mode("overwrite").parquet(a.out)
    elif df is not None:
        df.show(a.show, truncate=False)
    if owned:
        spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
