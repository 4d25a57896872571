"""Chat formatting with minimum-cost role repair.

Legal conversations are those of a small automaton: perhaps a system turn, then user and
assistant in turns, the assistant last. A turn may keep its role or get another one, it may
be merged into the turn before it, and empty turns may be put in. Dynamic programming over
the automaton's states finds the cheapest choice.

A conversation is cut into parts by turn number, and where many rows share a stretch of turn
numbers, also by their number in the order of the conversation. A part's effect is a small matrix, the
cheapest cost from each state to each state; the matrices of a conversation are combined
in order, and with the states at its two ends every part is repaired by itself. So a
conversation that holds a third of all turns is no single task's work.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textloom.llm.common import NO_ID, sorted_groups
from textloom.storage import materialise

ROLES = ("system", "user", "assistant")
UNKNOWN = len(ROLES)
# States: nothing yet, and after a turn of each role.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = 4
NEXT = {(START, 0), (START, 1), (SYSTEM, 1), (USER, 2), (ASSISTANT, 1)}  # (state, role that may follow)


@dataclass(frozen=True)
class RepairCosts:
    """Costs of one repair each. An unknown role has to be replaced, at ``unknown``."""

    merge: float = 1.0
    relabel: float = 2.0
    insert: float = 3.0
    unknown: float = 1.0


@dataclass(frozen=True)
class Step:
    """One way to take a turn: empty turns put in before it, its role, and whether it joins the turn before."""

    cost: float
    inserted: tuple[int, ...]
    role: int
    merged: bool


def _fill(state: int, role: int, most: int = 2) -> tuple[int, ...] | None:
    """The fewest empty turns that lead from ``state`` to where ``role`` may follow."""
    paths: list[tuple[int, tuple[int, ...]]] = [(state, ())]
    for _ in range(most + 1):
        for at, put in paths:
            if (at, role) in NEXT:
                return put
        paths = [(r + 1, (*put, r)) for at, put in paths for r in range(len(ROLES)) if (at, r) in NEXT]
    return None


def steps(costs: RepairCosts) -> dict[tuple[int, int, int], Step]:
    """The cheapest step for (state, given role, next state); of equal ones the first of: keep, merge, relabel, insert."""
    best: dict[tuple[int, int, int], Step] = {}
    for state in range(STATES):
        for given in range(len(ROLES) + 1):
            for role in range(len(ROLES)):
                change = 0.0 if role == given else costs.unknown if given == UNKNOWN else costs.relabel
                ways = []
                if state == role + 1:
                    ways.append(Step(change + costs.merge, (), role, True))
                put = _fill(state, role)
                if put is not None:
                    ways.append(Step(change + costs.insert * len(put), put, role, False))
                if ways:
                    best[state, given, role + 1] = min(ways, key=lambda s: (s.cost, len(s.inserted)))
    return best


def closing(costs: RepairCosts) -> dict[int, tuple[float, tuple[int, ...]]]:
    """Cost and empty turns to end after each state."""
    ends = {START: (0.0, ()), ASSISTANT: (0.0, ())}
    for state in (SYSTEM, USER):
        put = (*_fill(state, 2), 2)
        ends[state] = (costs.insert * len(put), put)
    return ends


def matrices(costs: RepairCosts) -> np.ndarray:
    """``[given role, state, next state]``: the cost of a turn."""
    out = np.full((len(ROLES) + 1, STATES, STATES), np.inf)
    for (state, given, after), step in steps(costs).items():
        out[given, state, after] = step.cost
    return out


def combined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a[:, :, None] + b[None, :, :]).min(axis=1)


def repair(given: list[int], entry: int, leave: int, costs: RepairCosts) -> list[Step]:
    """The cheapest steps from ``entry`` to ``leave``; ties go to the earlier state, from the last turn back."""
    turn, cost = matrices(costs), [np.full(STATES, np.inf)]
    cost[0][entry] = 0.0
    for role in given:
        cost.append((cost[-1][:, None] + turn[role]).min(axis=0))
    table, path, state = steps(costs), [], leave
    for i in range(len(given) - 1, -1, -1):
        before = int(np.argmin(cost[i] + turn[given[i]][:, state]))
        path.append(table[before, given[i], state])
        state = before
    return path[::-1]


KEYS = ["conv", "part", "sub"]


def _by_part(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, pa.Table]]:
    """Group by group out of tables of whole groups."""
    for table in sorted_groups(batches, keys):
        columns = [table.column(k).to_numpy() for k in keys]
        change = np.zeros(max(0, table.num_rows - 1), bool)
        for c in columns:
            change |= c[1:] != c[:-1]
        cuts = [0, *(np.flatnonzero(change) + 1).tolist(), table.num_rows]
        for low, high in zip(cuts, cuts[1:], strict=False):
            yield tuple(int(c[low]) for c in columns), table.slice(low, high - low)


def _effects(batches: Iterator[pa.RecordBatch], costs: RepairCosts) -> Iterator[pa.RecordBatch]:
    turn = matrices(costs)
    for key, rows in _by_part(batches, KEYS):
        effect = np.where(np.eye(STATES, dtype=bool), 0.0, np.inf)
        for role in rows.column("given").to_pylist():
            effect = combined(effect, turn[role])
        yield pa.RecordBatch.from_pydict(
            {**{k: [v] for k, v in zip(KEYS, key, strict=True)}, "effect": pa.array([effect.ravel().tolist()], pa.list_(pa.float64()))}
        )


def _ends(batches: Iterator[pa.RecordBatch], costs: RepairCosts) -> Iterator[pa.RecordBatch]:
    """The states at both ends of every part of a conversation."""
    for (conv,), rows in _by_part(batches, ["conv"]):
        effects = [np.array(e).reshape(STATES, STATES) for e in rows.column("effect").to_pylist()]
        reach = [np.full(STATES, np.inf)]
        reach[0][START] = 0.0
        for effect in effects:
            reach.append((reach[-1][:, None] + effect).min(axis=0))
        ends = np.array([closing(costs)[s][0] for s in range(STATES)])
        states = [int(np.argmin(reach[-1] + ends))]
        for i in range(len(effects) - 1, -1, -1):
            states.append(int(np.argmin(reach[i] + effects[i][:, states[-1]])))
        states.reverse()
        n = len(effects)
        columns = {"conv": [conv] * n, "part": rows.column("part").to_pylist(), "sub": rows.column("sub").to_pylist()}
        columns |= {"number": range(n), "entry": states[:-1], "leave": states[1:], "closes": [i == n - 1 for i in range(n)]}
        yield pa.RecordBatch.from_pydict(columns)


def _actions(step: Step, given: int) -> str:
    names = [*(["relabel"] if step.role != given else []), *(["merge"] if step.merged else [])]
    return "+".join(names) or "keep"


def _rendered(batches: Iterator[pa.RecordBatch], costs: RepairCosts) -> Iterator[pa.RecordBatch]:
    for _, rows in _by_part(batches, KEYS):
        given, texts = rows.column("given").to_pylist(), rows.column("text").to_pylist()
        convs, turns = rows.column("conv_id").to_pylist(), rows.column("turn").to_pylist()
        first = {c: rows.column(c)[0].as_py() for c in ("number", "entry", "leave", "closes")}
        out: dict[str, list] = {c: [] for c in ("conv_id", "part", "step", "turn", "role", "action", "cost", "rendered")}
        opened = first["entry"] != START

        def put(conv, turn, role, action, cost, rendered, part=first["number"], out=out):
            for column, value in zip(out.values(), (conv, part, len(out["step"]), turn, ROLES[role], action, cost, rendered), strict=True):
                column.append(value)

        for i, step in enumerate(repair(given, first["entry"], first["leave"], costs)):
            for role in step.inserted:
                put(convs[i], None, role, "insert", costs.insert, ("<|im_end|>\n" if opened else "") + f"<|im_start|>{ROLES[role]}\n")
                opened = True
            text = texts[i] or ""
            head = "\n" if step.merged else ("<|im_end|>\n" if opened else "") + f"<|im_start|>{ROLES[step.role]}\n"
            put(convs[i], turns[i], step.role, _actions(step, given[i]), step.cost - costs.insert * len(step.inserted), head + text)
            opened = True
        if first["closes"]:
            for role in closing(costs)[first["leave"]][1]:
                put(convs[-1], None, role, "insert", costs.insert, f"<|im_end|>\n<|im_start|>{ROLES[role]}\n")
            out["rendered"][-1] += "<|im_end|>\n"
        types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.string(), pa.float64(), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out.values(), types, strict=True)], list(out))


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows of a range with its number and the place of each row among those of its conversation and part."""
    pid, last, seen = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        places = np.empty(batch.num_rows, np.int64)
        conv, part = (batch.column(c).to_numpy() for c in ("conv", "part"))
        cuts = np.flatnonzero((conv[1:] != conv[:-1]) | (part[1:] != part[:-1])) + 1
        for low, high in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows], strict=True):
            if high > low:
                seen = seen if last == (conv[low], part[low]) else 0
                places[low:high] = np.arange(seen, seen + high - low)
                last, seen = (conv[low], part[low]), seen + high - low
        yield batch.append_column("range", pa.array(np.full(batch.num_rows, pid, np.int64))).append_column("place", pa.array(places))


def _with_sub(rows: DataFrame, order: list[str], part_turns: int) -> DataFrame:
    """``rows`` with ``sub``: parts of more rows than ``part_turns`` are cut by the number of a row in the order.

    Those rows are sorted in ranges, equal ones by their place in the input, so a range may hold
    any stretch of a part; rows per range and part then give the number of each row.
    """
    large = rows.groupBy("conv", "part").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > part_turns).select("conv", "part")
    large = materialise(large, "large-parts")  # at most one in part_turns rows
    if large.isEmpty():
        return rows.withColumn("sub", F.lit(0).cast("long"))
    ranges = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = rows.join(F.broadcast(large), ["conv", "part"], "left_semi").select(*rows.columns, F.monotonically_increasing_id().alias("_at"))
    hot = hot.repartitionByRange(ranges, *order, "_at").sortWithinPartitions(*order, "_at").drop("_at")
    kind = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + ", `range` long, place long"
    hot = materialise(hot.mapInArrow(_placed, kind), "placed-turns")
    ahead = Window.partitionBy("conv", "part").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    base = hot.groupBy("conv", "part", "range").agg(F.count(F.lit(1)).alias("_n"))  # a row per range and part
    base = base.select("conv", "part", "range", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_base"))
    sub = F.floor((F.col("_base") + F.col("place")) / part_turns).cast("long")
    hot = hot.join(F.broadcast(base), ["conv", "part", "range"]).select(*rows.columns, sub.alias("sub"))
    cold = rows.join(F.broadcast(large), ["conv", "part"], "left_anti").select(*rows.columns, F.lit(0).cast("long").alias("sub"))
    return hot.unionByName(cold)


def format_chats(
    turns: DataFrame,
    conversation_column: str = "conv_id",
    turn_column: str = "turn",
    role_column: str = "role",
    text_column: str = "text",
    costs: RepairCosts = RepairCosts(),
    part_turns: int = 1024,
) -> DataFrame:
    """The repaired turns of all conversations with the least total cost, rendered.

    Returns ``(conv_id, part, step, turn, role, action, cost, rendered)``: a row for every input
    turn and every empty turn put in (``turn`` null, action ``insert``). Parts are numbered from
    0 in each conversation and hold at most ``part_turns`` turns. In the order of
    part and step, the ``rendered`` pieces of a conversation make up its text; a merged turn
    goes on with a line break. Actions are keep, merge, relabel, relabel+merge and insert.

    Defined cases: turns without a conversation id make up one conversation. A null turn
    number comes first; turns of one number stand in the order of role and text, nulls
    first. Roles are compared without blanks around and in lower case; null and other roles
    are unknown and are replaced. A null text is empty. A conversation of one system turn
    gets empty user and assistant turns. An empty table gives an empty table. Other columns
    are not read.
    """
    role = F.lower(F.trim(role_column))
    given = F.lit(UNKNOWN)
    for number, name in enumerate(ROLES):
        given = F.when(role == name, number).otherwise(given)
    number = F.col(turn_column).cast("long")
    rows = turns.select(
        F.col(conversation_column).cast("long").alias("conv_id"),
        F.coalesce(F.col(conversation_column).cast("long"), F.lit(NO_ID)).alias("conv"),
        F.coalesce(F.floor(number / part_turns), F.lit(NO_ID)).alias("part"),
        number.alias("turn"),
        given.alias("given"),
        F.col(role_column).alias("role"),
        F.col(text_column).alias("text"),
    )
    order = ["turn", "given", "role", "text"]
    rows = _with_sub(rows, ["conv", "part", *order], part_turns)
    parts = rows.select(*KEYS, *order).repartition(*KEYS).sortWithinPartitions(*KEYS, *order).select(*KEYS, "given")
    effects = parts.mapInArrow(lambda b: _effects(b, costs), "conv long, part long, sub long, effect array<double>")
    ends = effects.repartition("conv").sortWithinPartitions(*KEYS)
    kind = "conv long, part long, sub long, number long, entry long, leave long, closes boolean"
    ends = ends.mapInArrow(lambda b: _ends(b, costs), kind)
    placed = rows.join(ends, KEYS).repartition(*KEYS).sortWithinPartitions(*KEYS, *order).drop("role")
    schema = "conv_id long, part long, step int, turn long, role string, action string, cost double, rendered string"
    return placed.mapInArrow(lambda b: _rendered(b, costs), schema)
