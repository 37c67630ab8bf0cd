"""Resumable scans up to a pinned target: the base moves only when a scan is complete."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirlake.operators.changes import keyset_page


@dataclass(frozen=True)
class Cursor:
    """``base``: everything up to it is done; ``target``: the end of the scan under way; ``after``: the last key applied in it."""

    base: str | None = None
    target: str | None = None
    after: tuple | None = None


def pin(cursor: Cursor, feed: DataFrame, column: str) -> Cursor:
    """The cursor with a target: that of the scan under way, else the feed's present head."""
    if cursor.target is not None:
        return cursor
    head = feed.agg(F.max(column).alias("h")).first()["h"]
    return cursor if head is None or head == cursor.base else replace(cursor, target=head, after=None)


def next_page(cursor: Cursor, feed: DataFrame, key: list[str], limit: int) -> DataFrame:
    """Rows above the base and up to the target that have not been applied."""
    return keyset_page(feed, key, cursor.after, until=cursor.target, lower=cursor.base, limit=limit)


def advance(cursor: Cursor, page: list, key: list[str], limit: int) -> Cursor:
    """The cursor after a page was applied: a full page moves ``after``, a short one completes the scan."""
    if len(page) < limit:
        return Cursor(base=cursor.target)
    return replace(cursor, after=tuple(page[-1][k] for k in key))
