"""One bad file must not stop the others: work on a group of files is split until it goes through.

A job over many files that fails is repeated on both halves of them, in order, down to single
files.  One bad file among n costs about 2 * log2(n) small jobs more; where nothing fails, nothing
is added.  What fails for a reason that has nothing to do with files fails for each of them and
stops there: after MOST_FAILURES files in a row the rest is given up with the last reason.
"""

from __future__ import annotations

import logging
from collections.abc import Callable
from typing import TypeVar

logger = logging.getLogger(__name__)

MOST_FAILURES = 20

Item = TypeVar("Item")
Result = TypeVar("Result")


def message(error: Exception) -> str:
    return str(error).splitlines()[0] if str(error) else type(error).__name__


def isolate(
    work: Callable[[list[Item]], Result], items: list[Item], split_first: bool = False
) -> tuple[list[Result], dict[Item, str]]:
    """Results of ``work`` on groups that together hold all good items, in order, and the reason for
    each of the others.  ``split_first``: go on with halves, as the whole has failed before."""
    results: list[Result] = []
    failed: dict[Item, str] = {}
    in_a_row = 0

    def attempt(group: list[Item], known_to_fail: bool) -> None:
        nonlocal in_a_row
        if in_a_row >= MOST_FAILURES:
            failed.update(dict.fromkeys(group, last))
            return
        if not known_to_fail:
            try:
                results.append(work(group))
                in_a_row = 0
                return
            except Exception as e:  # noqa: BLE001  whatever it is, it must stay with its file
                note(group, e)
        if len(group) > 1:
            middle = len(group) // 2
            attempt(group[:middle], False)
            attempt(group[middle:], False)

    last = ""

    def note(group: list[Item], error: Exception) -> None:
        nonlocal in_a_row, last
        last = message(error)
        if len(group) == 1:
            logger.error("'%s' failed: %s", group[0], last, exc_info=error)
            failed[group[0]] = last
            in_a_row += 1
        else:
            logger.warning("work on %d files failed and is split: %s", len(group), last)

    if items:
        attempt(items, split_first and len(items) > 1)
    return results, failed
