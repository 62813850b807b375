"""Retry around catalog and ledger writes."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable
from typing import TypeVar

log = logging.getLogger(__name__)
Result = TypeVar("Result")


def retry(action: Callable[[], Result], tries: int = 15, pause: float = 10.0, sleep=time.sleep) -> Result:
    """Run an action until it succeeds; the last failure is raised."""
    for attempt in range(1, tries + 1):
        try:
            return action()
        except (TypeError, NameError, AttributeError):
            raise  # a mistake in the program does not pass
        except Exception as error:  # noqa: BLE001 - whatever the store raises
            if attempt == tries:
                raise
            log.warning("attempt %d of %d failed: %s", attempt, tries, error)
            sleep(pause)
    raise ValueError("tries must be at least 1")
