"""Log lines of a run: to the console, and to a file of its own where a folder is given."""

from __future__ import annotations

import logging
from datetime import datetime, timezone
from pathlib import Path

FORMAT = "%(asctime)s | %(levelname)s | %(name)s | %(message)s"


def start(name: str, folder: str | Path | None = None, level: int = logging.INFO) -> logging.Logger:
    """The logger ``name`` with a console handler and, with a folder, the file ``<name>_<UTC time>.log``.

    A second start of the same name in one process adds no second handler.
    """
    log = logging.getLogger(name)
    log.setLevel(level)
    if any(getattr(h, "of_run", False) for h in log.handlers):
        return log
    handlers: list[logging.Handler] = [logging.StreamHandler()]
    if folder is not None:
        Path(folder).mkdir(parents=True, exist_ok=True)
        at = datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%S%fZ")
        handlers.append(logging.FileHandler(Path(folder) / f"{name}_{at}.log", encoding="utf-8"))
    for handler in handlers:
        handler.setFormatter(logging.Formatter(FORMAT))
        handler.of_run = True
        log.addHandler(handler)
    return log


def stop(name: str) -> None:
    """Closes what ``start`` opened."""
    log = logging.getLogger(name)
    for handler in [h for h in log.handlers if getattr(h, "of_run", False)]:
        log.removeHandler(handler)
        handler.close()
