"""Settings of a pipeline run, with their ranges."""

from __future__ import annotations

import os
from dataclasses import dataclass, field, fields


def _setting(default, low=None, high=None, among: tuple[str, ...] | None = None):
    return field(default=default, metadata={"low": low, "high": high, "among": among})


@dataclass(frozen=True)
class Settings:
    """Read from ``TIERFLOW_<NAME>`` by ``from_env``; a value out of its range fails.

    Settings of collectors outside Spark (addresses, pacing, time limits) are kept here too, so that one set of variables
    configures a deployment.
    """

    data_dir: str = "data"
    export_dir: str = "exports"
    time_zone: str = "UTC"
    sample_size: int = _setting(5, 1, 100_000)
    sample_seed: int = _setting(0, 0, 2**31 - 1)
    window_minutes: int = _setting(30, 1, 525_600)
    error_run: int = _setting(5, 1, 1000)
    stuck_minutes: int = _setting(60, 1, 10_080)
    files_per_batch: int = _setting(100, 1, 100_000)

    # Stores
    database_url: str = ""
    database_user: str = ""
    database_password: str = ""
    broker_url: str = ""
    storage_backend: str = _setting("file", among=("file", "gcs", "s3"))
    bucket_name: str = ""
    storage_project: str = ""
    storage_endpoint: str = ""
    storage_access_key: str = ""
    storage_secret_key: str = ""

    # Defaults and ranges of the collector.
    base_url: str = ""
    user_agent: str = ""
    delay_min: float = _setting(0.5, 0.1, 30.0)
    delay_max: float = _setting(1.5, 0.2, 60.0)
    request_timeout: int = _setting(60, 10, 300)
    request_retries: int = _setting(8, 1, 20)
    backoff_base: float = _setting(2.0, 0.0, 60.0)
    backoff_max: float = _setting(180.0, 0.0, 3600.0)
    scrape_workers: int = _setting(3, 1, 10)
    limit_enabled: bool = True
    max_concurrent: int = _setting(5, 1, 50)

    # Retries of rows, the work queue, the workers.
    max_retries: int = _setting(3, 0, 20)
    max_district_retries: int = _setting(3, 0, 100)
    max_body_retries: int = _setting(3, 0, 100)
    max_pdf_retries: int = _setting(3, 0, 100)
    max_queue: int = _setting(1000, 10, 100_000)
    queue_check_seconds: float = _setting(5.0, 1.0, 60.0)
    batch_size: int = _setting(100, 1, 1000)
    worker_concurrency: int = _setting(3, 1, 20)
    task_seconds: int = _setting(3600, 1, 86_400)
    task_soft_seconds: int = _setting(3000, 1, 86_400)
    log_level: str = _setting("INFO", among=("DEBUG", "INFO", "WARNING", "ERROR", "CRITICAL"))
    log_format: str = _setting("json", among=("json", "console"))

    def __post_init__(self):
        for f in fields(self):
            low, high, among = (f.metadata.get(k) for k in ("low", "high", "among"))
            value = getattr(self, f.name)
            if low is not None and not low <= value <= high:
                raise ValueError(f"{f.name} is {value}; it must be between {low} and {high}")
            if among and value not in among:
                raise ValueError(f"{f.name} is {value!r}; it must be one of {', '.join(among)}")
        if self.delay_min > self.delay_max:
            raise ValueError(f"delay_min is {self.delay_min}; it must not exceed delay_max, {self.delay_max}")

    @classmethod
    def from_env(cls, env=os.environ) -> Settings:
        found = {f.name: env[f"TIERFLOW_{f.name.upper()}"] for f in fields(cls) if f"TIERFLOW_{f.name.upper()}" in env}
        return cls(**{k: _parse(type(getattr(cls, k)), v) for k, v in found.items()})


def _parse(kind: type, text: str):
    if kind is not bool:
        return kind(text)
    if text.strip().lower() not in ("1", "true", "yes", "on", "0", "false", "no", "off"):
        raise ValueError(f"{text!r} is neither true nor false")
    return text.strip().lower() in ("1", "true", "yes", "on")
