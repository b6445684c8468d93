"""Command line: analyse one dataset and print (or write) its JSON document.

    spark-submit --py-files strata.zip -m strata s3a://bucket/sales.csv
    python -m strata /data/sales.parquet --format parquet --out /data/reports/sales

The session comes from the environment (``spark-submit`` / cluster defaults);
``--local`` starts a local one for a workstation.
"""

from __future__ import annotations

import argparse
import uuid

from pyspark.sql import SparkSession

from strata.plans import report
from strata.plans.analytics import run_file


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="strata", description=__doc__.splitlines()[0])
    parser.add_argument("path", help="file, directory or glob on any Hadoop file system")
    parser.add_argument("--format", help="csv, json, parquet or excel (detected when omitted)")
    parser.add_argument("--schema", help="DDL schema; skips type inference for CSV/JSON")
    parser.add_argument("--topk-method", default="auto", choices=["exact", "hashed", "auto"])
    parser.add_argument("--top-k", type=int, default=10)
    parser.add_argument("--job-id", default=None)
    parser.add_argument("--out", help="write the JSON document here (text) instead of printing it")
    parser.add_argument("--local", action="store_true", help="run on a local session")
    args = parser.parse_args(argv)

    if args.local:
        from strata.session import local_session

        spark = local_session()
    else:
        spark = SparkSession.builder.appName("strata").getOrCreate()
    job_id = args.job_id or str(uuid.uuid4())
    _, res = run_file(
        spark, args.path, fmt=args.format, schema=args.schema, top_k=args.top_k, topk_method=args.topk_method
    )
    doc = report.result_json(spark, res, job_id)
    if args.out:
        report.write_json(doc, args.out)
    else:
        for row in doc.toLocalIterator():
            print(row["result_json"])


if __name__ == "__main__":
    main()
