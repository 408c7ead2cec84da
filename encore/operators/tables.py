"""Joins of two keyed tables that both change, update by update.

``outer_changelog`` is the full outer join of two changelog tables on their
key. Every update of either side gives one row with the joined value before
and after it, so that what is built on the join can take back what the old
value gave and add what the new one gives (``withdrawn_sum``).

Both are running aggregates over the two sides as records of one stream. A hot
key is spread over cells like any other, and on a stream the last values per
key are carried from batch to batch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from encore.operators.running import Spec


def outer_changelog(records: DataFrame, key: str, order: list[Column], time_col: str, side: str, value: str, scan,
                    name: str = "join") -> DataFrame:
    """``records`` without ``value``, with the joined values ``old`` and ``new``: structs ``left, right``.

    A record updates the row of ``key`` in the left table (``side`` 0) or the
    right one (1) to ``value``; a null value deletes it. A side without a row
    is null in ``old`` and ``new``. Records that delete what neither table has
    give no row, and neither do those with a null key.
    """
    row = F.struct(F.col(value).alias("value"))  # a deletion is a row of its own, with a null inside
    sides = (("left", F.when(F.col(side) == 0, row)), ("right", F.when(F.col(side) == 1, row)))
    specs = [Spec(f"{state}_{s}", "last", changed, before=state == "old") for s, changed in sides for state in ("old", "new")]
    joined = scan(name, records, [key], order, time_col, specs)
    both = {state: F.struct(*[F.col(f"{state}_{s}")["value"].alias(s) for s, _ in sides]) for state in ("old", "new")}
    out = joined.select(*[c for c in records.columns if c != value], *[both[state].alias(state) for state in ("old", "new")])
    there = [F.col(f"{state}.{s}").isNotNull() for state in ("old", "new") for s, _ in sides]
    return out.where(there[0] | there[1] | there[2] | there[3])


def withdrawn_sum(changes: DataFrame, keys: list[str], order: list[Column], time_col: str, old: Column, new: Column, scan,
                  out: str = "n", name: str = "sum") -> DataFrame:
    """Running sum per ``keys`` over updates: each takes its ``old`` number back and adds its ``new`` one (null is 0).
    ``old_<out>`` is the sum before the update, null at the first one of a key, and ``new_<out>`` the sum after it."""
    step = F.coalesce(new, F.lit(0)) - F.coalesce(old, F.lit(0))
    return scan(name, changes, keys, order, time_col,
                [Spec(f"old_{out}", "sum", step, before=True), Spec(f"new_{out}", "sum", step)])
