"""Configuration: priorities of sources by table, retries, storage, instruments."""

from __future__ import annotations

import json
import os
import re
from dataclasses import dataclass, field

#: Priorities of the sources of each table, the highest first.
PRIORITIES = {
    "daily": {"akshare": 100, "baostock": 80, "tushare": 50},
    "minute": {"akshare": 100, "tushare": 50},
    "finance": {"akshare": 100, "tushare": 80},
    "alternative": {"akshare": 100, "tushare": 50},
    "north_flow": {"akshare": 100, "tushare": 50},
    "margin_trade": {"akshare": 100, "tushare": 50},
    "convertible_bond": {"akshare_cb": 100},
    "futures": {"akshare_futures": 100, "tushare_futures": 80},
    "options": {"akshare_options": 100, "tushare_options": 80},
}


@dataclass(frozen=True)
class Config:
    priorities: dict = field(default_factory=lambda: PRIORITIES)
    attempts: int = 3
    base_delay_s: float = 5.0
    backoff: float = 2.0
    source_timeout_s: float = 60.0
    run_timeout_s: float = 600.0
    profile: str = "baseline"
    backend: str = "parquet"
    compression: str = "zstd"
    log_days: int = 90
    markets: tuple[str, ...] = ("sh", "sz", "bj")
    etf_min_days: int = 120


def expand(value: str) -> str:
    """``${NAME}`` by the environment, empty where it is unset."""
    return re.sub(r"\$\{(\w+)\}", lambda m: os.environ.get(m[1], ""), value)


def load(path: str) -> Config:
    """From JSON, or from YAML where a YAML library is installed. Tables that aren't
    declared are skipped."""
    from tidemill.operators.tables import TABLES

    with open(path, encoding="utf-8") as f:
        text = expand(f.read())
    if path.endswith((".yaml", ".yml")):
        try:
            import yaml
        except ImportError as e:
            raise RuntimeError("YAML needs a library that isn't installed; use JSON") from e
        values = yaml.safe_load(text)
    else:
        values = json.loads(text)
    if "priorities" in values:
        values["priorities"] = {t: p for t, p in values["priorities"].items() if t in TABLES}
    if "markets" in values:
        values["markets"] = tuple(values["markets"])
    return Config(**values)
