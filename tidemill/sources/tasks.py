"""Task records (SQLite on the driver) and a task log in JSON lines."""

from __future__ import annotations

import json
import sqlite3
from contextlib import closing
from datetime import date, datetime, timedelta
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_COLUMNS = ("task_id", "table_name", "status", "source", "rows", "started_at", "finished_at", "message")


class TaskTracer:
    def __init__(self, path: str):
        self.path = path
        with closing(self._open()) as db, db:
            db.execute("CREATE TABLE IF NOT EXISTS tasks (task_id TEXT PRIMARY KEY, table_name TEXT, status TEXT, source TEXT, rows INTEGER, started_at TEXT, finished_at TEXT, message TEXT)")

    def _open(self) -> sqlite3.Connection:
        db = sqlite3.connect(self.path)
        db.row_factory = sqlite3.Row
        return db

    def start(self, task_id: str, table: str, at: datetime | None = None) -> None:
        self.save(task_id=task_id, table_name=table, status="running", started_at=(at or datetime.now()).isoformat())

    def save(self, **values) -> None:
        """Inserts a record or changes the given values of it."""
        old = self.get(values["task_id"]) or {}
        row = [(old | values).get(c) for c in _COLUMNS]
        with closing(self._open()) as db, db:
            db.execute(f"INSERT OR REPLACE INTO tasks VALUES ({', '.join('?' * len(_COLUMNS))})", row)  # noqa: S608

    def finish(self, task_id: str, status: str, at: datetime | None = None, **values) -> None:
        self.save(task_id=task_id, status=status, finished_at=(at or datetime.now()).isoformat(), **values)

    def get(self, task_id: str) -> dict | None:
        with closing(self._open()) as db:
            row = db.execute("SELECT * FROM tasks WHERE task_id = ?", (task_id,)).fetchone()
        return dict(row) if row else None

    def recent(self, limit: int = 10, table: str | None = None) -> list[dict]:
        where, args = ("WHERE table_name = ?", (table, limit)) if table else ("", (limit,))
        with closing(self._open()) as db:
            return [dict(r) for r in db.execute(f"SELECT * FROM tasks {where} ORDER BY started_at DESC, task_id LIMIT ?", args)]  # noqa: S608


class TaskLog:
    """A folder a day, a file a task; readable as one JSON table."""

    def __init__(self, root: str, keep_days: int = 90):
        self.root, self.keep_days = Path(root), keep_days

    def write(self, task_id: str, level: str, message: str, at: datetime | None = None, **fields) -> None:
        at = at or datetime.now()
        folder = self.root / f"{at:%Y-%m-%d}"
        folder.mkdir(parents=True, exist_ok=True)
        with (folder / f"{task_id}.jsonl").open("a", encoding="utf-8") as f:
            f.write(json.dumps({"ts": at.isoformat(), "task_id": task_id, "level": level, "message": message, **fields}, ensure_ascii=False) + "\n")

    def cleanup(self, today: date | None = None) -> int:
        oldest = (today or date.today()) - timedelta(days=self.keep_days)
        gone = [d for d in self.root.iterdir() if d.is_dir() and date.fromisoformat(d.name) < oldest] if self.root.exists() else []
        for d in gone:
            for f in d.iterdir():
                f.unlink()
            d.rmdir()
        return len(gone)

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema("ts string, task_id string, level string, message string").json(str(self.root / "*" / "*.jsonl"))
