"""Logging of the driver: a rotating file and the console."""

from __future__ import annotations

import logging
import logging.handlers
from pathlib import Path


def configure(folder: str, level: int = logging.INFO, size: int = 5 << 20, keep: int = 5) -> logging.Logger:
    """The package's logger with a rotating file in folder, which is made, and the console; a second call adds nothing."""
    log = logging.getLogger("tidemark")
    log.setLevel(level)
    form = logging.Formatter("%(asctime)s %(levelname)s %(name)s: %(message)s")
    path = Path(folder, "tidemark.log").absolute()
    path.parent.mkdir(parents=True, exist_ok=True)
    if not any(getattr(h, "baseFilename", None) == str(path) for h in log.handlers):
        log.addHandler(logging.handlers.RotatingFileHandler(path, maxBytes=size, backupCount=keep, encoding="utf-8"))
    if not any(type(h) is logging.StreamHandler for h in log.handlers):
        log.addHandler(logging.StreamHandler())
    for h in log.handlers:
        h.setFormatter(form)
    return log
