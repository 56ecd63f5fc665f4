"""python -m capturebase COMMAND: inspect, survey, load, verify, ingest, ingest-manifest, status. Prints JSON; exit 1 if the work isn't done."""

from __future__ import annotations

import argparse
import json
import os
import sys
from dataclasses import asdict

from pyspark.sql import SparkSession

from capturebase.plans.surfaces import package_status
from capturebase.sources import archives, ingest, remote
from capturebase.sources.ledger import Ledger
from capturebase.sources.packages import package


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    top = argparse.ArgumentParser(prog="capturebase")
    top.add_argument("--ledger", default="ledger", help="folder of the ledger")
    top.add_argument("--data", default="data", help="folder of downloaded archives")
    sub = top.add_subparsers(dest="command", required=True)
    for name in ("inspect", "survey"):
        sub.add_parser(name).add_argument("paths", nargs="+")
    load = sub.add_parser("load")
    load.add_argument("path")
    load.add_argument("--force", action="store_true")
    sub.add_parser("verify").add_argument("capture_id", type=int)
    one, status = sub.add_parser("ingest"), sub.add_parser("status")
    for p in (load, one):
        p.add_argument("--package-id", required=True)
    status.add_argument("--package-id")
    many = sub.add_parser("ingest-manifest")
    many.add_argument("manifest")
    many.add_argument("--report")
    many.add_argument("--sha256", help="refuse a manifest of any other digest")
    many.add_argument("--check", action="store_true", help="read the manifest and print its digest")
    return top.parse_args(argv)


def run(spark: SparkSession, a: argparse.Namespace) -> tuple[object, bool]:
    """What to print, and whether the work is done."""
    if a.command in ("inspect", "survey"):
        raw = archives.read_archives(spark, a.paths, "strict" if a.command == "inspect" else "survey").cache()
        rows = [r.asDict() for r in archives.inspection(raw).join(archives.facts(spark, a.paths), "archive").collect()]  # one an archive
        if a.command == "survey":
            rejects = [r.asDict() for r in archives.survey(raw).collect()]
            more = {"categories": archives.categories(raw), "samples": archives.samples(raw)}
            return {"archives": rows, "members": rejects} | {k: [r.asDict() for r in df.collect()] for k, df in more.items()}, all(r["loadable"] for r in rows)
        return rows, all(r["loadable"] for r in rows)
    ledger = Ledger(spark, a.ledger)
    if a.command == "load":
        with ledger.locked(package(a.package_id).name):
            return {"capture_id": ledger.load(a.package_id, remote.sha256(a.path), a.path, force=a.force)}, True
    if a.command == "verify":
        found = ledger.verify(a.capture_id, remote.listing)
        return found, found["state"] == "verified"
    if a.command == "ingest":
        done = ingest.ingest(ledger, a.package_id, a.data)
        return asdict(done), done.checkpoint_is_current
    if a.command == "status":
        df = package_status(ledger.tables())
        return [r.asDict() for r in (df.where(df.source_package_id == a.package_id) if a.package_id else df).collect()], True
    with open(a.manifest) as f:
        entries = ingest.manifest(json.load(f))
    if a.check or (a.sha256 and a.sha256 != ingest.digest(entries)):
        return {"sha256": ingest.digest(entries), "packages": len(entries)}, a.check
    report = ingest.run_manifest(entries, lambda name: ingest.ingest(ledger, name, a.data))
    if a.report:
        ingest.write_report(a.report, report)
    return report, report["status"] == "completed"


def main(argv: list[str] | None = None) -> int:
    a = _arguments(argv)
    spark = SparkSession.builder.appName("capturebase").config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false").getOrCreate()
    os.makedirs(a.data, exist_ok=True)
    out, done = run(spark, a)
    print(json.dumps(out, indent=2, default=str))
    return 0 if done else 1


if __name__ == "__main__":
    sys.exit(main())
