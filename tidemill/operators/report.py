"""Validation reports and monitoring, from aggregates that fit the driver."""

from __future__ import annotations

import html
import itertools
import json
from collections.abc import Callable
from dataclasses import asdict, dataclass, field
from datetime import datetime

from tidemill.operators.diffs import DiffSummary

_numbers = itertools.count(1)


@dataclass(frozen=True)
class ResolutionSummary:
    total_conflicts: int
    resolved_count: int
    by_method: dict = field(default_factory=dict)

    @property
    def unresolved_count(self) -> int:
        return self.total_conflicts - self.resolved_count

    @property
    def resolution_rate(self) -> float:
        return self.resolved_count / self.total_conflicts if self.total_conflicts else 1.0


def quality_score(diff_rate: float, resolution_rate: float) -> float:
    return round(0.6 * max(0.0, 100 - 100 * diff_rate) + 0.4 * 100 * resolution_rate, 2)


def grade(score: float) -> str:
    return next((g for g, least in (("A", 90), ("B", 70), ("C", 50)) if score >= least), "D")


@dataclass(frozen=True)
class Report:
    report_id: str
    created_at: str
    source: str
    target: str
    summary: dict
    recommendations: list[str]

    def to_json(self) -> str:
        return json.dumps(asdict(self), ensure_ascii=False, indent=2)

    def to_html(self) -> str:
        cell = lambda v: html.escape(json.dumps(v, ensure_ascii=False) if isinstance(v, dict) else str(v))
        rows = "".join(f"<tr><th>{html.escape(k)}</th><td>{cell(v)}</td></tr>" for k, v in self.summary.items())
        items = "".join(f"<li>{html.escape(r)}</li>" for r in self.recommendations)
        return f"<!DOCTYPE html><html><head><meta charset='utf-8'><title>{self.report_id}</title></head><body><h1>{self.report_id}</h1><p>{html.escape(self.source)} / {html.escape(self.target)}, {self.created_at}</p><table>{rows}</table><ul>{items}</ul></body></html>"

    def save(self, path: str) -> None:
        with open(path, "w", encoding="utf-8") as f:
            f.write(self.to_html() if path.endswith(".html") else self.to_json())


def recommendations(diffs: DiffSummary | None, resolved: ResolutionSummary | None) -> list[str]:
    out = []
    if diffs:
        out += [
            f"{n} {what}"
            for n, what in (
                (diffs.structural, "structural differences: compare the declared schemas"),
                (diffs.value, "values differ: compare when the sources were updated"),
                (diffs.missing, "records are missing: check that the data are complete"),
                (diffs.critical, "critical differences: act now"),
            )
            if n
        ]
    if resolved:
        if resolved.resolution_rate < 0.8:
            out.append(f"only {resolved.resolution_rate:.1%} of the conflicts are resolved: change the strategy")
        if resolved.unresolved_count:
            out.append(f"{resolved.unresolved_count} conflicts are unresolved: review them by hand")
    return out or ["the data are in good order"]


def report(source: str, target: str, diffs: DiffSummary | None = None, resolved: ResolutionSummary | None = None, now: datetime | None = None) -> Report:
    now = now or datetime.now()
    summary: dict = {}
    if diffs:
        summary |= {
            "total_diffs": diffs.total,
            "structural_diffs": diffs.structural,
            "value_diffs": diffs.value,
            "missing_diffs": diffs.missing,
            "diff_rate": round(diffs.diff_rate, 4),
            "source_count": diffs.source_count,
            "target_count": diffs.target_count,
            "diff_by_type": diffs.by_type,
            "diff_by_severity": diffs.by_severity,
        }
    if resolved:
        summary |= {
            "total_conflicts": resolved.total_conflicts,
            "resolved_count": resolved.resolved_count,
            "unresolved_count": resolved.unresolved_count,
            "resolution_rate": round(resolved.resolution_rate, 4),
            "resolution_by_method": resolved.by_method,
        }
    if diffs and resolved:
        score = quality_score(diffs.diff_rate, resolved.resolution_rate)
        summary |= {"quality_score": score, "quality_grade": grade(score)}
    return Report(f"VR-{now:%Y%m%d}-{next(_numbers):04d}", now.isoformat(), source, target, summary, recommendations(diffs, resolved))


# --- monitoring -------------------------------------------------------------------------


@dataclass(frozen=True)
class Thresholds:
    diff_rate_warning: float = 0.1
    diff_rate_error: float = 0.2
    resolution_rate_warning: float = 0.8
    resolution_rate_error: float = 0.5
    critical_diffs: int = 5


@dataclass(frozen=True)
class Alert:
    level: str
    message: str
    timestamp: datetime
    details: dict = field(default_factory=dict)


class Monitor:
    """Turns summaries into alerts and hands them to callbacks, whose errors it
    ignores."""

    def __init__(self, thresholds: Thresholds = Thresholds(), callbacks: list[Callable[[Alert], None]] | None = None):
        self.thresholds, self.callbacks, self.alerts = thresholds, callbacks or [], []

    def check(self, diffs: DiffSummary | None = None, resolved: ResolutionSummary | None = None, now: datetime | None = None) -> list[Alert]:
        t, now, found = self.thresholds, now or datetime.now(), []
        if diffs:
            if diffs.diff_rate >= t.diff_rate_warning:
                level = "error" if diffs.diff_rate >= t.diff_rate_error else "warning"
                found.append(Alert(level, f"difference rate {diffs.diff_rate:.2%}", now, {"diff_rate": diffs.diff_rate}))
            if diffs.critical >= t.critical_diffs:
                found.append(Alert("critical", f"{diffs.critical} critical differences", now, {"critical": diffs.critical}))
        if resolved and resolved.resolution_rate <= t.resolution_rate_warning:
            level = "error" if resolved.resolution_rate <= t.resolution_rate_error else "warning"
            found.append(Alert(level, f"resolution rate {resolved.resolution_rate:.2%}", now, {"resolution_rate": resolved.resolution_rate}))
        self.alerts += found
        for alert in found:
            for call in self.callbacks:
                try:
                    call(alert)
                except Exception:  # noqa: BLE001, S110
                    pass
        return found

    def get(self, level: str | None = None, since: datetime | None = None) -> list[Alert]:
        return [a for a in self.alerts if level in (None, a.level) and (since is None or a.timestamp >= since)]

    def summary(self) -> dict:
        by_level: dict = {}
        for a in self.alerts:
            by_level[a.level] = by_level.get(a.level, 0) + 1
        return {"total_alerts": len(self.alerts), "by_level": by_level}

    def export(self, path: str) -> None:
        with open(path, "w", encoding="utf-8") as f:
            json.dump([asdict(a) | {"timestamp": a.timestamp.isoformat()} for a in self.alerts], f, ensure_ascii=False, indent=2)
