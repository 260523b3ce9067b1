"""The package's logger."""

from __future__ import annotations

import logging

logger = logging.getLogger("corpusloom")


def setup_logging(verbose: bool = False) -> logging.Logger:
    """Shows what the package logs, with time and level; ``verbose`` adds details. Other loggers stay as they are."""
    if not logger.handlers:
        handler = logging.StreamHandler()
        handler.setFormatter(logging.Formatter("%(asctime)s - %(levelname)s - %(message)s", "%H:%M:%S"))
        logger.addHandler(handler)
    logger.setLevel(logging.DEBUG if verbose else logging.INFO)
    return logger
