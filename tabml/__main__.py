"""Command line: run an analysis job or a single query.

    python -m tabml list
    python -m tabml run <job> --data DIR [--task T] [--sink DIR]
    python -m tabml query <name> --data DIR [--show N] [--out DIR] [--explain]

Under ``spark-submit`` the submitted session configuration is used as is (master, checkpoint folder, ...);
started with plain ``python`` it runs on a local session.
"""

from __future__ import annotations

import argparse
import sys


def _session():
    from pyspark import SparkConf
    from pyspark.sql import SparkSession

    if SparkConf().contains("spark.master"):
        return SparkSession.builder.appName("tabml").getOrCreate()
    from tabml.session import local_session

    return local_session()


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="python -m tabml")
    sub = ap.add_subparsers(dest="cmd", required=True)
    sub.add_parser("list", help="list jobs, tasks and queries")
    run = sub.add_parser("run", help="run an analysis job (all tasks, or one)")
    run.add_argument("job", help="job name, or a JSON job file (see tabml.plans.config)")
    run.add_argument("--data", required=True, help="folder holding <table>.parquet")
    run.add_argument("--task")
    run.add_argument("--sink", help="append the metric rows to this parquet folder")
    q = sub.add_parser("query", help="run one registered query")
    q.add_argument("name")
    q.add_argument("--data", required=True)
    q.add_argument("--show", type=int, default=20)
    q.add_argument("--out", help="write the full result as parquet here instead of showing it")
    q.add_argument("--explain", action="store_true", help="print the formatted physical plan instead of running")
    args = ap.parse_args(argv)

    from dataclasses import replace

    from tabml.plans import catalog
    from tabml.plans.job_queries import DIGITS, JOB_BY_NAME
    from tabml.plans.jobs import run_job

    if args.cmd == "list":
        for name, job in JOB_BY_NAME.items():
            print(f"job {name}: tasks {', '.join(t.name for t in job.tasks)}")
        catalog.load_all()
        for name in catalog.QUERIES:
            print(f"query {name} [{catalog.KIND[name]}]")
        return 0

    spark = _session()
    if args.cmd == "run":
        if args.job.endswith(".json"):
            from tabml.plans.config import job_from_json

            job = job_from_json(args.job)
        else:
            job = JOB_BY_NAME[args.job]
        if args.task:
            job = replace(job, tasks=[t for t in job.tasks if t.name == args.task])
        run_job(spark, job, args.data, sink=args.sink, digits=DIGITS).show(1000, truncate=False)
        return 0

    catalog.load_all()
    df = catalog.QUERIES[args.name](spark, args.data)
    if args.explain:
        df.explain("formatted")
    elif args.out:
        df.write.mode("overwrite").parquet(args.out)
    else:
        df.show(args.show, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
