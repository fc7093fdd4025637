"""Command line: ``python -m tidemill.cli fetch|update|status|search``.

Vendors are read from landed files (``--landing``: a folder with one folder for
each vendor), so that no command needs a network; a vendor whose folder is missing
isn't registered."""

from __future__ import annotations

import argparse
import sys
import uuid
from datetime import date, datetime
from pathlib import Path

from tidemill.operators.tables import TABLES
from tidemill.plans.config import Config, load
from tidemill.sources import fetch as fetching
from tidemill.sources.storage import backend
from tidemill.sources.tasks import TaskLog, TaskTracer
from tidemill.sources.vendors import search, vendor

ASSET_TYPES = ("stock", "index", "etf", "cb", "future", "option")
FREQUENCIES = ("daily", "1min", "5min", "15min", "30min", "60min")


def registry(landing: str, config: Config) -> fetching.SourceRegistry:
    """The vendors of each table that have a folder under ``landing``."""
    out = fetching.SourceRegistry()
    for table, priorities in config.priorities.items():
        for name, priority in priorities.items():
            folder = Path(landing) / name
            # Daily bars lie in the vendor's folder, other tables in one below it.
            folder = folder / table if (folder / table).exists() else folder
            if (found := vendor(name, table)) and folder.exists():
                out.register(table, fetching.Source(found, fetching.landed(f"file://{folder.resolve()}"), priority))
    return out


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tidemill")
    p.add_argument("--data-dir", default="data")
    p.add_argument("--log-dir", default="logs")
    p.add_argument("--config")
    commands = p.add_subparsers(dest="command", required=True)
    for name in ("fetch", "update"):
        c = commands.add_parser(name)
        c.add_argument("--asset-type", required=True, choices=ASSET_TYPES)
        c.add_argument("--table", required=True, choices=sorted(TABLES))
        c.add_argument("--landing", required=True)
        if name == "fetch":
            c.add_argument("--codes", default="")
            c.add_argument("--start-date", required=True, type=date.fromisoformat)
            c.add_argument("--end-date", type=date.fromisoformat)
            c.add_argument("--frequency", default="daily", choices=FREQUENCIES)
    commands.add_parser("status").add_argument("--limit", type=int, default=10)
    c = commands.add_parser("search")
    c.add_argument("keyword")
    c.add_argument("--instruments", required=True)
    c.add_argument("--limit", type=int, default=20)
    return p


def main(argv: list[str] | None = None, spark=None) -> int:
    args = parser().parse_args(argv)
    config = load(args.config) if args.config else Config()
    Path(args.data_dir).mkdir(parents=True, exist_ok=True)
    tracer = TaskTracer(str(Path(args.data_dir) / "tasks.db"))
    if args.command == "status":
        for t in tracer.recent(args.limit):
            print(f"{t['task_id']}  {t['table_name']}  {t['source'] or '-'}  {t['status']}  {t['rows'] or 0}")
        return 0
    if spark is None:
        from tidemill.plans.session import session

        spark = session("tidemill-cli")
    if args.command == "search":
        found = search(spark.read.parquet(args.instruments), args.keyword, args.limit).collect()
        for r in found:
            print(f"{r.code}  {r.name}  {r.type}  {r.status}")
        return 0 if found else 1
    log, task = TaskLog(args.log_dir, config.log_days), uuid.uuid4().hex
    store = backend(config.backend, spark, f"file://{Path(args.data_dir).resolve()}", config.compression)
    sources = registry(args.landing, config)
    limits = fetching.Limits(config.attempts, config.base_delay_s, config.backoff, config.source_timeout_s, config.run_timeout_s)
    tracer.start(task, args.table)
    try:
        if args.command == "fetch":
            end = args.end_date or date.today()
            if args.start_date > end:
                raise ValueError("the start date is after the end date")
            spec = fetching.FetchSpec(args.asset_type, args.table, tuple(c for c in args.codes.split(",") if c), args.start_date, end, args.frequency)
            report = fetching.run(spark, sources, store, spec, config.profile, limits=limits)
        else:
            report = fetching.update(spark, sources, store, args.asset_type, args.table, date.today(), profile=config.profile, limits=limits)
    except (fetching.PipelineError, ValueError) as e:
        tracer.finish(task, "failed", message=str(e))
        log.write(task, "ERROR", str(e))
        print(f"failed: {e}", file=sys.stderr)
        return 1
    tracer.finish(task, report.status, source=report.source, rows=report.rows)
    log.write(task, "INFO", report.status, rows=report.rows, at=datetime.now())
    print(f"{report.status}: {report.rows} rows from {report.source}" + (f", missing {', '.join(report.failed_codes)}" if report.failed_codes else ""))
    return 0


if __name__ == "__main__":
    sys.exit(main())
