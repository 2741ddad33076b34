"""Chat formatting in budgeted windows.

Prefix sums of turn tokens choose spans of whole turns that fit a budget. Each window begins with the conversation's
first system turn and a limited history of earlier turns; what is repeated there is masked, so every assistant text
is a training target exactly once.

A turn is written `### role: text</turn>` and a line break. In texts and roles a backslash goes before each backslash,
`###` and `</turn>`, and in roles before each colon, so that `read_windows` gets every turn back.

A conversation of more than SEGMENT tokens is cut into segments by distributed prefix sums, so that one that holds a third
of all rows is many tasks' work. A segment gets the turns before it that its history may repeat, and the system turn.
Other conversations are one row each, after one shuffle.

Defined results: null texts and roles are empty; turns go by (turn, role, text), nulls first (texts that share their first
200 characters go by a hash); repeated rows are turns of their own; rows with a null conversation id are one conversation;
a turn above the budget, however long, has a window of its own; an empty table gives no rows; other columns, whatever
their names, are not used.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

from finlake.llm.common import WORD, cut, n_words_of, named, per_batch, placed

#: Tokens of a segment, and long conversations up to which their ids are broadcast.
SEGMENT, FEW = 1 << 16, 20_000
WINDOW = "struct<text: string, history: int, loss: array<struct<start: int, end: int>>>"
_TEXT, _ROLE = re.compile(r"\\|###|</turn>"), re.compile(r"\\|###|</turn>|:")
_ESCAPED = re.compile(r"\\(\\|###|</turn>|:)")
_TURN = re.compile(r"### ((?:[^\\:]|\\.)*+): ((?:[^\\<]|\\.|<(?!/turn>))*+)</turn>\n", re.DOTALL)
_WORDS = re.compile(WORD)


@dataclass(frozen=True)
class Budget:
    """Tokens (words, and 4 for a turn's marks) of a window and of its repeated history; the role that is learned."""

    window: int = 1024
    history: int = 192
    target: str = "assistant"


def escaped(text: str, pattern: re.Pattern = _TEXT) -> str:
    return pattern.sub(lambda m: "\\" + m[0], text)


def unescaped(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def windows(turns: list[tuple[str, str]], budget: Budget = Budget(), first: int = 0) -> list[dict]:
    """Windows over (role, text) turns from the `first` on (those before it are another segment's): text, history (how many
    leading turns are repeated) and loss spans."""
    cost = np.array([len(_WORDS.findall(text)) + 4 for _, text in turns], dtype="int64")
    sums = np.concatenate([[0], np.cumsum(cost)])
    system = next((i for i, (role, _) in enumerate(turns) if role == "system"), None)
    fixed = int(cost[system]) if system is not None else 0
    out, at = [], first
    while at < len(turns):
        head = [system] if system is not None and system < at else []
        back = int(np.searchsorted(sums, sums[at] - budget.history, "left"))
        room = budget.window - (fixed if head else 0) - int(sums[at] - sums[back])
        end = int(np.searchsorted(sums, sums[at] + room, "right")) - 1
        if end <= at:  # the next turn doesn't fit beside the history
            back, end = at, max(at + 1, int(np.searchsorted(sums, sums[at] + budget.window - (fixed if head else 0), "right")) - 1)
        shown = head + [i for i in range(back, at) if i not in head]
        parts, loss, size = [], [], 0
        for k, i in enumerate(shown + list(range(at, end))):
            role, text = turns[i]
            lead, body = f"### {escaped(role, _ROLE)}: ", escaped(text)
            if k >= len(shown) and role == budget.target:
                loss.append((size + len(lead), size + len(lead) + len(body)))
            parts.append(f"{lead}{body}</turn>\n")
            size += len(parts[-1])
        out.append({"text": "".join(parts), "history": len(shown), "loss": [{"start": a, "end": b} for a, b in loss]})
        at = end
    return out


def _rows(df: DataFrame) -> DataFrame:
    text = F.coalesce(named("text"), F.lit(""))
    return df.select(named("conv_id").alias("conv_id"), named("turn").alias("turn"), F.coalesce(named("role"), F.lit("")).alias("role"), text.alias("text"), (n_words_of(text) + 4).alias("cost"))


def _long_segments(rows: DataFrame, budget: Budget, size: int) -> DataFrame:
    """conv_id, segment, and turns: (at, lead, role, text) in order, lead turns being those of segments before."""
    order = ["conv_id", "turn", "role", F.substring("text", 1, 200), F.xxhash64("text"), "file", "row"]
    rows = placed(rows, *map(F.col, rows.columns)).repartitionByRange(*order).sortWithinPartitions(*order)
    rows = cut(rows.select("conv_id", "role", "text", "cost", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")))

    # Costs are added up within parts and then over them, without the texts.
    costs = rows.select("conv_id", "part", "at", "cost")
    parts = costs.groupBy("conv_id", "part").agg(F.sum("cost").alias("n"))
    parts = parts.select("conv_id", "part", (F.sum("n").over(Window.partitionBy("conv_id").orderBy("part")) - F.col("n")).alias("before"))
    inside = F.sum("cost").over(Window.partitionBy("conv_id", "part").orderBy("at")) - F.col("cost")
    here = costs.withColumn("inside", inside).alias("r")
    same = F.col("r.conv_id").eqNullSafe(F.col("p.conv_id"))
    begin = F.col("before") + F.col("inside")
    begins = here.join(parts.alias("p"), same & (F.col("r.part") == F.col("p.part"))).select("at", begin.alias("begin"), F.floor(begin / size).alias("segment"))
    dealt = cut(rows.drop("part", "cost").join(begins, "at"))

    # Turns that the next segment's history may repeat, and the system turn for all segments after its own.
    tail = dealt.where(F.col("begin") >= (F.col("segment") + 1) * size - budget.history).withColumn("segment", F.col("segment") + 1)
    system = dealt.where("role = 'system'").groupBy("conv_id").agg(F.min(F.struct("at", "segment", "role", "text", "begin")).alias("s"))
    later = dealt.where("segment > 0").select("conv_id", "segment").distinct().alias("d")
    lead = later.join(system.alias("t"), F.col("d.conv_id").eqNullSafe(F.col("t.conv_id"))).where("d.segment > s.segment")
    # Not twice, where it is in the tail as well.
    lead = lead.where((F.col("d.segment") > F.col("s.segment") + 1) | (F.col("s.begin") < F.col("d.segment") * size - budget.history))
    lead = lead.select("d.conv_id", "d.segment", "s.at", "s.role", "s.text")
    columns = ["conv_id", "segment", "at", "role", "text"]
    every = dealt.select(*columns, F.lit(False).alias("lead"))
    for more in (tail.select(*columns), lead.select(*columns)):
        every = every.unionByName(more.withColumn("lead", F.lit(True)))
    turns = F.sort_array(F.collect_list(F.struct("at", "lead", "role", "text")))
    found = every.groupBy("conv_id", "segment").agg(turns.alias("turns")).where(F.exists("turns", lambda x: ~x["lead"]))
    return found.withColumn("turns", F.transform("turns", lambda x: F.struct(x["lead"].alias("lead"), x["role"].alias("role"), x["text"].alias("text"))))


def _windowed(found: DataFrame, budget: Budget) -> DataFrame:
    """conv_id, segment and its windows, from turns."""
    schema = StructType([found.schema["conv_id"], *StructType.fromDDL(f"segment long, windows array<{WINDOW}>").fields])
    kinds = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, len(batch), 64):
                part = batch.slice(k, 64)
                made = []
                for turns in part.column(2).to_pylist():
                    made.append(windows([(t["role"], t["text"]) for t in turns], budget, sum(t["lead"] for t in turns)))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(made, kinds.field("windows").type)], names=kinds.names)

    return per_batch(found, run, schema)


def format_chat(df: DataFrame, budget: Budget = Budget(), size: int = SEGMENT) -> tuple[DataFrame, DataFrame | None]:
    """(whole, long): conv_id, segment and windows, in order. `whole` has a row for each conversation up to `size` tokens,
    `long` the segments of longer ones, and is None where there are none."""
    rows = _rows(df)
    long = cut(rows.groupBy("conv_id").agg(F.sum("cost").alias("n")).where(F.col("n") > size).select(F.col("conv_id").alias("long_id")))
    n_long = long.count()
    short = rows
    if n_long:
        long = F.broadcast(long) if n_long <= FEW else long
        same = F.col("conv_id").eqNullSafe(F.col("long_id"))
        short, rest = rows.join(long, same, "left_anti"), rows.join(long, same, "left_semi")
    turns = F.sort_array(F.collect_list(F.struct("turn", "role", F.substring("text", 1, 200).alias("head"), F.xxhash64("text").alias("hash"), "text")))
    turns = F.transform(turns, lambda x: F.struct(F.lit(False).alias("lead"), x["role"].alias("role"), x["text"].alias("text")))
    whole = short.groupBy("conv_id").agg(turns.alias("turns")).select("conv_id", F.lit(0).cast("long").alias("segment"), "turns")
    return _windowed(whole, budget), _windowed(_long_segments(rest, budget, size), budget) if n_long else None


def chat_windows(df: DataFrame, budget: Budget = Budget(), size: int = SEGMENT) -> DataFrame:
    """One row per window: conv_id, segment and window (from 0, in order), text, history, loss."""
    whole, long = format_chat(df, budget, size)
    made = whole if long is None else whole.unionByName(long)
    return made.select("conv_id", "segment", F.posexplode("windows").alias("window", "w")).select("conv_id", "segment", "window", "w.*")


def read_windows(made: list[dict]) -> tuple[list[tuple[str, str]], list[str]]:
    """The turns and the learned texts that windows hold, each once."""
    turns, learned = [], []
    for w in made:
        found = [(unescaped(m[1]), unescaped(m[2])) for m in _TURN.finditer(w["text"])]
        turns += found[w["history"] :]
        learned += [unescaped(w["text"][s["start"] : s["end"]]) for s in w["loss"]]
    return turns, learned


class _Digests:
    """What a conversation's windows hold, window by window."""

    def __init__(self) -> None:
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.chars = self.n_windows = 0

    def add(self, window: dict) -> None:
        turns, learned = read_windows([window])
        for role, text in turns:
            self.turns.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
        for text in learned:
            self.loss.update(text.encode("utf-8", "surrogatepass"))
            self.loss_chars += len(text)
        self.n_turns += len(turns)
        self.chars += len(window["text"])
        self.n_windows += 1


def read_back(whole: DataFrame, long: DataFrame | None = None) -> DataFrame:
    """Digests of what the windows of `format_chat` hold, one row per conversation. Those of a long conversation are read in
    order by one task, since a digest of all its text is asked for; it holds a segment at a time."""
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
    more = StructType.fromDDL("n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_windows long")
    schema = StructType([StructField("conv_id", whole.schema["conv_id"].dataType), *more.fields])

    def rows(convs: list[pa.Array], held: list[_Digests]) -> pa.RecordBatch:
        values = zip(*((d.n_turns, d.turns.hexdigest(), d.loss_chars, d.loss.hexdigest(), d.chars, d.n_windows) for d in held), strict=True)
        return pa.RecordBatch.from_arrays([pa.concat_arrays(convs), *(pa.array(v, k) for v, k in zip(values, kinds, strict=True))], names=schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, convs, held = None, [], []
        for batch in batches:
            for k, i in enumerate(batch.column(0).to_pylist()):
                if not held or i != now:
                    if len(held) >= 256:
                        yield rows(convs, held)
                        convs, held = [], []
                    now = i
                    convs.append(batch.column(0).slice(k, 1))
                    held.append(_Digests())
                for window in batch.column(2)[k].as_py():
                    held[-1].add(window)
        if held:
            yield rows(convs, held)

    out = per_batch(whole, run, schema)
    if long is None:
        return out
    return out.unionByName(per_batch(long.repartition("conv_id").sortWithinPartitions("conv_id", "segment"), run, schema))
