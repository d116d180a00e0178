"""Chat formatting with the cheapest repair of roles that breaks the order of turns.

A legal chat is an optional system turn, then user and assistant in turn, where an assistant may be followed by a tool turn and that by an
assistant; it ends with a user or an assistant turn, or is empty. For each turn the repair may keep its role, merge it into the
turn before, give it another role, or put empty turns before it, each at its cost; empty turns may also be put at the end. Dynamic
programming over the automaton's states finds the cheapest way; of equally cheap ones the first in a fixed order is taken.

A conversation is cut into chunks of at most ``CHUNK`` rows. A chunk's effect is a matrix of costs between states; the matrices of a
conversation are put together in order (minimum in place of sum, sum in place of product), which fixes the states at each cut, and then every
chunk is repaired by itself. The result has one row per turn with its rendered piece, so no conversation is ever one cell or one task:
the pieces of a conversation in order of (chunk, part, place) are the formatted text.

Defined cases: null or empty text is an empty turn; control tokens within a text are spelled with blanks inside the bars, so that no text can open or close
a turn; roles are compared without case and outer blanks; a null or unknown role has to be
relabelled, at ``UNKNOWN``; rows equal in all of conv_id, turn, role and text are one; several rows of one turn follow each other by
role and text; rows without conv_id or turn have no place: they come back with action "unplaced" and nothing rendered; an empty table
gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tidemark.llm.frames import arrays
from tidemark.llm.scratch import parts, written

ROLES = ("system", "user", "assistant", "tool")
START = "start"
STATES = (START, *ROLES)  # the role of the last turn so far
NEXT = {START: ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user", "tool"), "tool": ("assistant",)}
LAST = (START, "user", "assistant")
MERGE, RELABEL, UNKNOWN, INSERT = 2, 3, 1, 4
_CONTROL = re.compile(r"<\|(im_start|im_end)\|>")
CHUNK = 4096
OPEN, CLOSE, JOINT = "<|im_start|>", "<|im_end|>\n", "\n\n"

Step = tuple[int, tuple[str, ...], str, str]  # cost, roles of empty turns put before, action, role


@lru_cache(None)
def steps(role: str) -> dict[tuple[str, str], Step]:
    """The cheapest way over one turn from state to state."""
    best: dict[tuple[str, str], Step] = {}

    def offer(a: str, b: str, step: Step) -> None:
        if (a, b) not in best or step[0] < best[a, b][0]:
            best[a, b] = step

    def change(to: str) -> int:
        return 0 if to == role else RELABEL if role in ROLES else UNKNOWN

    for a in STATES:
        for put in range(4):
            for way in itertools.product(ROLES, repeat=put):
                at = (a, *way)
                if any(y not in NEXT[x] for x, y in zip(at, at[1:])):
                    continue
                for to in NEXT[at[-1]]:
                    offer(a, to, (put * INSERT + change(to), way, "keep" if to == role else "relabel", to))
        if a != START:
            offer(a, a, (MERGE + change(a), (), "merge", a))
    return best


@lru_cache(None)
def ending(state: str) -> tuple[int, tuple[str, ...]]:
    """Cost and roles of the empty turns that make a legal end."""
    for put in range(4):
        for way in itertools.product(ROLES, repeat=put):
            at = (state, *way)
            if at[-1] in LAST and all(y in NEXT[x] for x, y in zip(at, at[1:])):
                return put * INSERT, way
    raise ValueError(state)


@lru_cache(None)
def costs(role: str) -> np.ndarray:
    out = np.full((len(STATES),) * 2, np.inf)
    for (a, b), step in steps(role).items():
        out[STATES.index(a), STATES.index(b)] = step[0]
    return out


def effect(roles: list[str]) -> np.ndarray:
    """Costs between states over all the turns."""
    total = np.where(np.eye(len(STATES)), 0.0, np.inf)
    for role in roles:
        total = (total[:, :, None] + costs(role)[None]).min(1)
    return total


def cheapest(roles: list[str], entry: int, leave: int) -> list[Step]:
    """The steps from one state to another."""
    reach = np.full(len(STATES), np.inf)
    reach[entry] = 0
    back = []
    for role in roles:
        way = reach[:, None] + costs(role)
        back.append(way.argmin(0))
        reach = way.min(0)
    out, at = [], leave
    for role, came in zip(reversed(roles), reversed(back)):
        a = int(came[at])
        out.append(steps(role)[STATES[a], STATES[at]])
        at = a
    return out[::-1]


def cut_states(effects: list[np.ndarray]) -> tuple[list[int], int]:
    """The state before each chunk and at the end, of a cheapest way with a legal end."""
    reach = np.where(np.arange(len(STATES)) == 0, 0.0, np.inf)
    back = []
    for e in effects:
        way = reach[:, None] + e
        back.append(way.argmin(0))
        reach = way.min(0)
    last = at = int(np.argmin(reach + np.array([ending(s)[0] for s in STATES])))
    states = []
    for came in reversed(back):
        at = int(came[at])
        states.append(at)
    return states[::-1], last


def harmless(text: str) -> str:
    """The text with its control tokens spelled apart."""
    return _CONTROL.sub(r"<| \1 |>", text)


def render(state: str, step: Step, text: str) -> list[tuple[str, str, str]]:
    """Action, role and piece for the empty turns put before a turn, and the turn."""
    _, put, action, role = step
    out = []
    for empty in put:
        out.append(("insert", empty, (CLOSE if state != START else "") + f"{OPEN}{empty}\n"))
        state = empty
    out.append((action, role, JOINT + text if action == "merge" else (CLOSE if state != START else "") + f"{OPEN}{role}\n{text}"))
    return out


_PLACE = ["turn", "role_key", "role", "text"]
RESULT = "conv_id long, chunk long, part int, place int, turn long, role string, action string, new_role string, rendered string"


def per_group(df: DataFrame, keys: list[str], order: list[str], ddl: str, work) -> DataFrame:
    """work(key, rows) for each group of rows, sorted; groups are read one after the other from sorted partitions."""
    names = [part.split()[0] for part in ddl.split(", ")]
    schema = to_arrow_schema(StructType.fromDDL(ddl))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        rows = (row for batch in batches for row in batch.to_pylist())
        for key, group in itertools.groupby(rows, lambda row: tuple(row[k] for k in keys)):
            held += [dict(zip(names, made)) for made in work(key, list(group))]
            if len(held) >= 2000:
                yield pa.RecordBatch.from_pylist(held, schema=schema)
                held = []
        if held:
            yield pa.RecordBatch.from_pylist(held, schema=schema)

    dealt = df.repartition(parts(df.sparkSession), *keys).sortWithinPartitions(*keys, *order)
    return arrays(dealt, ddl, run)


def matrices(key: tuple, rows: list[dict]) -> list[tuple]:
    return [(*key, effect([row["role_key"] for row in rows]).ravel().tolist())]


def chained(key: tuple, rows: list[dict]) -> list[tuple]:
    entry, last = cut_states([np.array(row["costs"]).reshape((len(STATES),) * 2) for row in rows])
    ends = zip(rows, entry, [*entry[1:], last])
    return [(*key, row["chunk"], row["part"], a, z, row is rows[-1]) for row, a, z in ends]


def rendered(key: tuple, rows: list[dict]) -> list[tuple]:
    entry, leave, final = rows[0]["entry"], rows[0]["leave"], rows[0]["final"]
    state, out = STATES[entry], []
    for row, step in zip(rows, cheapest([row["role_key"] for row in rows], entry, leave)):
        *empty, own = render(state, step, harmless(row["text"] or ""))
        out += [(None, None, *e) for e in empty] + [(row["turn"], row["role"], *own)]
        state = step[3]
    if final:
        out += [(None, None, "insert", role, f"{CLOSE}{OPEN}{role}\n") for role in ending(state)[1]]
        out[-1] = (*out[-1][:4], out[-1][4] + CLOSE)
    return [(*key, place, *made) for place, made in enumerate(out)]


def repair_chats(conversations: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """One row per turn of (conv_id, turn, role, text), inserted ones included: action, new_role and the rendered piece."""
    given = conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"), F.col("text").cast("string"))
    placed = given.filter("conv_id is not null and turn is not null").distinct().withColumn("role_key", F.coalesce(F.lower(F.trim("role")), F.lit(""))) \
        .withColumn("chunk", F.floor(F.col("turn") / chunk))
    # Turn numbers bound a chunk unless many rows share one; the count of rows bounds it then.
    order = Window.partitionBy("conv_id", "chunk").orderBy(*[F.asc_nulls_first(c) for c in _PLACE])
    rows = written(placed.withColumn("row", F.row_number().over(order) - 1).withColumn("part", F.floor(F.col("row") / chunk).cast("int")), "chat-turns")
    key = ["conv_id", "chunk", "part"]

    effects = per_group(rows.select(*key, "row", "role_key"), key, ["row"], "conv_id long, chunk long, part int, costs array<double>", matrices)
    states = written(per_group(
        effects, ["conv_id"], ["chunk", "part"], "conv_id long, chunk long, part int, entry int, leave int, final boolean", chained), "chat-states")
    repaired = per_group(rows.join(states, key), key, ["row"], RESULT, rendered)
    lost = given.filter("conv_id is null or turn is null").select(
        "conv_id", F.lit(None).cast("long").alias("chunk"), F.lit(None).cast("int").alias("part"), F.lit(None).cast("int").alias("place"), "turn", "role",
        F.lit("unplaced").alias("action"), F.lit(None).cast("string").alias("new_role"), F.lit("").alias("rendered"))
    return repaired.unionByName(lost)
