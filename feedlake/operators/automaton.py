"""An automaton run over a long sequence in parallel.

What an automaton does to a stretch of rows is a table, from the state before to the state after, and such
tables can be put one behind the other. So each block of a sequence is first summed up for every state it may
begin in; a row per block then tells in which state each really begins, and the blocks are run
once more from there. No task sees more than one block's rows, however long the sequence.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame

from feedlake.session import materialize

NONE = -1


def transition(ends: list) -> int | Column:
    """The code of a row that leads from state i to ``ends[i]``, numbers or columns."""
    return sum(end * len(ends) ** i for i, end in enumerate(ends))


def _run(code: np.ndarray, marks: np.ndarray, place: np.ndarray, states: int, state: int, owner: int) -> tuple[list[int], list[int], int]:
    """The state before each row, the last marked place met in state 0 up to it, and the state at the end."""
    before, owners = [], []
    for c, marked, at in zip(code.tolist(), marks.tolist(), place.tolist(), strict=True):
        if marked and state == 0:
            owner = at
        before.append(state)
        owners.append(owner)
        state = c // states**state % states
    return before, owners, state


def _ordered(rows: pa.Table) -> pa.Table:
    return rows.take(pa.array(np.argsort(rows.column("place").to_numpy(), kind="stable")))


def _columns(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return rows.column("code").to_numpy(), rows.column("marks").to_numpy(zero_copy_only=False), rows.column("place").to_numpy()


def states_before(rows: DataFrame, states: int) -> DataFrame:
    """(row, state, owner, alone) of ``rows`` (sequence, block, place, code, marks, row).

    Rows of a sequence are in the order of (block, place); it begins in state 0. ``code`` is a ``transition``.
    ``owner``: the place of the last row, this one included, that has ``marks`` and is met in state 0; ``NONE``
    before the first. ``alone``: the row is its own owner, and no other's, as far as its block shows.
    """

    def summed(block: pa.Table) -> pa.Table:
        runs = [_run(*_columns(_ordered(block)), states, s, NONE) for s in range(states)]
        return pa.table(
            [block.column("sequence")[:1], block.column("block")[:1], pa.array([[end for *_, end in runs]], pa.list_(pa.int64())), pa.array([[o[-1] for _, o, _ in runs]], pa.list_(pa.int64()))],
            ["sequence", "block", "ends", "owners"],
        )

    def chained(sequence: pa.Table) -> pa.Table:
        found, state, owner = [], 0, NONE
        for r in sorted(sequence.to_pylist(), key=lambda r: r["block"]):
            found.append({"sequence": r["sequence"], "block": r["block"], "first_state": state, "first_owner": owner})
            owner = r["owners"][state] if r["owners"][state] != NONE else owner
            state = r["ends"][state]
        return pa.Table.from_pylist(found, pa.schema([("sequence", pa.string()), ("block", pa.int64()), ("first_state", pa.int64()), ("first_owner", pa.int64())]))

    def placed(block: pa.Table) -> pa.Table:
        block = _ordered(block)
        before, owners, _ = _run(*_columns(block), states, block.column("first_state")[0].as_py(), block.column("first_owner")[0].as_py())
        owner = np.array(owners)
        # The next block may go on with the last row.
        alone = (owner == block.column("place").to_numpy()) & np.append(owner[1:] != owner[:-1], False)
        return pa.table([block.column("row"), pa.array(before, pa.int64()), pa.array(owner, pa.int64()), pa.array(alone)], ["row", "state", "owner", "alone"])

    rows = rows.select("sequence", "block", "place", "code", "marks", "row")
    blocks = rows.groupBy("sequence", "block").applyInArrow(summed, "sequence string, block bigint, ends array<bigint>, owners array<bigint>")
    begins = blocks.groupBy("sequence").applyInArrow(chained, "sequence string, block bigint, first_state bigint, first_owner bigint")
    begins = materialize(begins, "begins")
    return rows.join(begins, ["sequence", "block"]).groupBy("sequence", "block").applyInArrow(placed, "row bigint, state bigint, owner bigint, alone boolean")
