"""Log files and the console."""

from __future__ import annotations

import datetime as dt
import logging
from pathlib import Path

FORMAT = "%(asctime)s:%(name)s:%(levelname)8s:%(funcName)s:%(message)s"


def logger(name: str, path: str | None = None, verbose: bool = False, folder: str | None = None) -> logging.Logger:
    """A logger that writes warnings (all if verbose) to the console and more to a file named by the time.

    path: an existing folder for the file, or the beginning of the file's own path.
    """
    stamp = dt.datetime.now().strftime("%Y%m%d_%H%M%S")
    if path is None:
        at = Path(folder or Path.home() / ".orbitframe" / "logs") / f"orbitframe_{stamp}.log"
    elif Path(path).is_dir():
        at = Path(path) / f"orbitframe_{stamp}.log"
    else:
        at = Path(path).with_name(f"{Path(path).name}_{stamp}.log")
    at.parent.mkdir(parents=True, exist_ok=True)
    out = logging.getLogger(name)
    for h in list(out.handlers):
        h.close()
        out.removeHandler(h)
    out.propagate = False
    out.setLevel(logging.DEBUG)
    for handler, level in ((logging.StreamHandler(), logging.WARNING), (logging.FileHandler(at, mode="w"), logging.INFO)):
        handler.setLevel(logging.DEBUG if verbose else level)
        handler.setFormatter(logging.Formatter(FORMAT))
        out.addHandler(handler)
    return out
