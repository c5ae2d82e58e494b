"""State machines along lines, without a line in one task.

A machine with a few states reads the rows of each line in order. Rows are range-partitioned by line and order, so a long line
is dealt to as many tasks as it has rows for. A task does not know the state in which its first row finds the machine, so it
follows all of them at once: what a run of rows does is a function from the state before it to the state behind it, and such
functions are composed by a prefix scan. The functions of whole partitions, a row each, are then composed along the lines that
cross partitions, and every row picks the state that was right.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.scratch import written


@dataclass(frozen=True)
class Machine:
    """``step[state][symbol]`` is the next state; ``opens[state][symbol]`` whether the row begins a group. State 0 begins."""

    step: list[list[int]]
    opens: list[list[bool]]


def _scan(first: np.ndarray, goes: np.ndarray, opened: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix compositions of the rows' functions. ``goes``: rows x states, the state behind a row; ``opened``: the id of the
    group that it begins, or -1; ``first``: the number of the first row of the run that each row is in."""
    n, far, at = len(first), 1, np.arange(len(first))
    while far < n:
        on = np.flatnonzero(at - far >= first)
        if not len(on):
            break
        before = goes[on - far]
        later = np.take_along_axis(opened[on], before, 1)
        opened_on = np.where(later >= 0, later, opened[on - far])
        goes_on = np.take_along_axis(goes[on], before, 1)
        goes, opened = goes.copy(), opened.copy()
        goes[on], opened[on] = goes_on, opened_on
        far *= 2
    return goes, opened


def _follow(machine: Machine):
    step, opens = np.array(machine.step, np.int64), np.array(machine.opens, bool)
    states = len(step)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows (line, seq, symbol, ...) sorted by line and order; adds what each state before the partition leads to."""
        piece, held, goes_held, opened_held = TaskContext.get().partitionId(), None, None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            line, seq = batch.column(0), batch.column(1).to_numpy()
            symbol = batch.column(2).fill_null(-1).to_numpy()
            codes = line.dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
            n = len(codes)
            new = np.append(True, codes[1:] != codes[:-1])
            first = np.flatnonzero(new)[np.cumsum(new) - 1]
            same = np.arange(states)
            goes = np.where(symbol[:, None] >= 0, step.T[symbol], same)
            opened = np.where((symbol[:, None] >= 0) & opens.T[symbol], seq[:, None], -1)
            goes, opened = _scan(first, goes, opened)
            name = (line[0].as_py(), line[n - 1].as_py())
            if held is not None and held[0] == name[0]:
                # the line goes on from the batch before
                own = first == 0
                later = np.take_along_axis(opened[own], np.broadcast_to(goes_held, (own.sum(), states)), 1)
                opened[own] = np.where(later >= 0, later, opened_held)
                goes[own] = goes[own][:, goes_held]
            start, start_opened = np.concatenate([[same], goes[:-1]]), np.concatenate([[same * 0 - 1], opened[:-1]])
            start[new], start_opened[new] = same, -1
            if held is not None and held[0] == name[0]:
                start[0], start_opened[0] = goes_held, opened_held
            held, goes_held, opened_held = (name[1],), goes[-1], opened[-1]
            lists = lambda x: pa.FixedSizeListArray.from_arrays(pa.array(x.reshape(-1)), states).cast(pa.list_(pa.int64()))
            columns = [*batch.columns, pa.array(np.full(n, piece, np.int64)), lists(start), lists(goes), lists(opened)]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "_piece", "_start", "_goes", "_opened"])

    return run


def _along(states: int):
    def run(part: pd.DataFrame) -> pd.DataFrame:
        """The state and the open group before each piece of a line; as many rows as the line has partitions."""
        part, out, state, group = part.sort_values("_piece"), [], 0, -1
        for piece, goes, opened in zip(part["_piece"], part["_goes"], part["_opened"], strict=True):
            out.append((piece, state, group))
            group = opened[state] if opened[state] >= 0 else group
            state = goes[state]
        return pd.DataFrame({"_line": part["_line"].to_list(), "_piece": [o[0] for o in out], "_in": [o[1] for o in out], "_group": [o[2] for o in out]})

    return run


def run_machine(rows: DataFrame, line: str, order: list[str], seq: str, symbol: Column, machine: Machine) -> DataFrame:
    """``rows`` with ``state``, that of the machine before the row, and ``group``, the ``seq`` of the last row of the line,
    itself included, that began a group (null before the first).

    ``symbol`` numbers a row's symbol; null leaves the state as it is. ``order`` must end with what tells rows apart;
    ``seq`` is a number of 0 or more. A null line is a line of its own.
    """
    names = rows.columns
    packed = rows.select(F.col(line).alias("_line"), F.col(seq).cast("long").alias("_seq"), symbol.cast("long").alias("_symbol"), *[F.col(c).alias(f"_o{k}") for k, c in enumerate(order)], F.struct(*names).alias("_row"))
    keys = ["_line", *[f"_o{k}" for k in range(len(order))]]
    lists = T.ArrayType(T.LongType())
    schema = T.StructType([*packed.schema.fields, T.StructField("_piece", T.LongType()), *[T.StructField(c, lists) for c in ("_start", "_goes", "_opened")]])
    followed = written(packed.repartitionByRange(*keys).sortWithinPartitions(*keys).mapInArrow(_follow(machine), schema), "fold")
    pieces = followed.groupBy("_line", "_piece").agg(F.max_by(F.struct("_goes", "_opened"), F.struct(*keys[1:])).alias("f")).select("_line", "_piece", "f.*")
    # only lines that cross partitions, at most two for each partition and all of a hot line
    many = pieces.groupBy("_line").agg(F.count("*").alias("_n")).where("_n > 1").withColumnRenamed("_line", "_many")
    crossing = pieces.join(many, F.col("_line").eqNullSafe(F.col("_many")), "left_semi")
    starts = crossing.groupBy("_line").applyInPandas(_along(len(machine.step)), T.StructType([packed.schema["_line"], T.StructField("_piece", T.LongType()), T.StructField("_in", T.LongType()), T.StructField("_group", T.LongType())]))
    starts = written(starts, "fold-starts").withColumnsRenamed({"_line": "_at", "_piece": "_p"})
    met = followed.join(starts, (F.col("_piece") == F.col("_p")) & F.col("_line").eqNullSafe(F.col("_at")), "left")
    pick = lambda c: F.element_at(c, (F.coalesce("_in", F.lit(0)) + 1).cast("int"))
    own, before = pick("_opened"), F.coalesce("_group", F.lit(-1))
    group = F.when(own >= 0, own).when(before >= 0, before)
    return met.select(*[F.col(f"_row.`{c}`") for c in names], pick("_start").alias("state"), group.alias("group"))
