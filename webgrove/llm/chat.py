"""Chat formatting in budgeted windows.

Every turn has a token cost; prefix sums of the costs along a conversation choose
turn-aligned spans that fit a budget.  Each window repeats the system turn and as many
earlier turns as a history budget holds.  Only assistant texts that a window is the
first to show count for the loss; what it repeats is masked.

Long conversations are cut into segments by their prefix sums, so that no task needs
to hold a whole one; each segment carries its system turn and the turns before it.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from webgrove.llm.common import in_batches, rows_of, runs, shuffle_partitions, stored
from webgrove.llm.packing import tokenizer

BUDGET = 2048
HISTORY = 512
#: A segment holds the turns that begin in so many budgets' worth of tokens.
SEGMENT_BUDGETS = 32
#: Turns summed up together before the sums of a conversation are.
CELL_TURNS = 256

#: Strings that some chat template reads as control: their first characters are escaped.
_CONTROL = re.compile(r"~|[<\[|](?=\|)|<(?=/?s>|<SYS>>|</SYS>>)|\[(?=/?INST\]|/?AVAILABLE_TOOLS\]|/?TOOL_)|\|(?=>)")
_ESCAPES = {"~": "~0", "<": "~1", "[": "~2", "|": "~3"}
_PLAIN = {v: k for k, v in _ESCAPES.items()}
_ESCAPED = re.compile("~[0-3]")
END = "<|end|>\n"


def escape(text: str) -> str:
    """The text without control strings; ``unescape`` gives it back."""
    return _CONTROL.sub(lambda m: _ESCAPES[m[0]], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: _PLAIN[m[0]], text)


def render(role: str, text: str) -> tuple[str, int, int]:
    """A formatted turn, and where its content begins and ends in it."""
    head = f"<|{escape(role).replace(chr(10), '~4')}|>\n"
    body = escape(text)
    return head + body + END, len(head), len(head) + len(body)


def parse(formatted: str) -> Iterator[tuple[str, str, int, int]]:
    """``role, text, start, end`` of the turns in a formatted window; the place is that of the content."""
    at = 0
    while at < len(formatted):
        head = formatted.index("|>\n", at)
        end = formatted.index(END, head)
        yield unescape(formatted[at + 2:head].replace("~4", "\n")), unescape(formatted[head + 3:end]), head + 3, end
        at = end + len(END)


def _costs(json_file: str, rank_file: str):
    """Adds every turn's tokens once formatted."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = tokenizer(json_file, rank_file).packed
        for batch in batches:
            cost = [len(ids_of(render(r, t)[0])) // 4 for r, t in rows_of(iter((batch,)), "role", "text")]
            columns = [*batch.columns, pa.array(cost, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "cost"])
    return run


def _prefix_sums(turns: DataFrame) -> DataFrame:
    """Adds ``pos`` and ``before``, the turns and the tokens in front of each turn.

    Sums run over cells of neighbouring turn numbers first and over cells then, so that
    the turns of one conversation need not meet in one task.
    """
    cell = F.floor(F.coalesce("turn", F.lit(-1)) / CELL_TURNS)
    order = [F.col("turn").asc_nulls_first(), "role", "text"]
    rows = turns.withColumn("_cell", cell)
    inside = Window.partitionBy("conv_id", "_cell").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    across = Window.partitionBy("conv_id").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = rows.groupBy("conv_id", "_cell").agg(F.count("*").alias("_n"), F.sum("cost").alias("_cost")).select(
        F.col("conv_id").alias("_conv"), F.col("_cell").alias("_of"),
        F.coalesce(F.sum("_n").over(across), F.lit(0)).alias("_turns"), F.coalesce(F.sum("_cost").over(across), F.lit(0)).alias("_tokens"))
    own = rows.withColumns({"_pos": F.count("*").over(inside), "_before": F.coalesce(F.sum("cost").over(inside), F.lit(0))})
    return own.join(cells, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("_cell") == F.col("_of"))).select(
        "conv_id", "role", "text", "cost", (F.col("_pos") + F.col("_turns")).alias("pos"), (F.col("_before") + F.col("_tokens")).alias("before"))


def plan_windows(costs: list[int], system: int | None, carried: int, budget: int, history: int) -> Iterator[tuple[int, int, int]]:
    """``first shown, first new, end`` of each window over a segment's turns.

    ``system`` is the place of the system turn, the first ``carried`` turns belong to
    earlier segments.  A window that cannot hold one new turn within the budget drops
    its history, and then exceeds the budget by that turn alone.
    """
    sums = [0, *accumulate(costs)]
    start = carried
    while start < len(costs):
        kept = costs[system] if system is not None and system < start else 0
        floor = system + 1 if kept else 0
        shown = start
        while shown > floor and sums[start] - sums[shown - 1] <= history:
            shown -= 1
        if kept + sums[start + 1] - sums[shown] > budget:
            shown = start
        end = max(start + 1, bisect_right(sums, budget - kept + sums[shown]) - 1)
        yield shown, start, end
        start = end


def chat_windows(
    turns: DataFrame, *, json_file: str, rank_file: str, budget: int = BUDGET, history: int = HISTORY
) -> DataFrame:
    """``conv_id, window, text, n_context, n_new, n_tokens, loss``, a row per window.

    ``turns`` has ``conv_id, turn, role, text``.  Turns are taken by number, ties by role
    and text, null numbers first; repeated rows are turns of their own.  Null roles and
    texts are empty; null ids form one conversation.  ``text`` shows ``n_context`` turns
    that were shown before (the first system turn, then history) and ``n_new`` new
    ones; ``loss`` are the character ranges of new assistant contents.  ``window`` grows
    along a conversation.  No turn is cut: one above the budget has a window to
    itself.  Other columns are not read.  An empty table gives no windows.
    """
    if not 0 <= history < budget:
        raise ValueError("history must be smaller than the budget")
    parts = shuffle_partitions(turns.sparkSession)
    id_name = turns.schema["conv_id"].dataType.simpleString()
    id_type = turns.limit(0).select("conv_id").toArrow().schema.field(0).type
    plain = turns.select(
        "conv_id", F.col("turn").cast("bigint").alias("turn"), *(F.expr(f"make_valid_utf8(coalesce({c}, ''))").alias(c) for c in ("role", "text")))
    costed = plain.mapInArrow(_costs(json_file, rank_file), f"conv_id {id_name}, turn long, role string, text string, cost long")
    span = SEGMENT_BUDGETS * budget
    placed = stored(_prefix_sums(costed).withColumn("segment", F.floor(F.col("before") / span)), "turns")     # read by several branches
    # kinds of a segment's rows: 0 its system turn from an earlier segment, 1 turns before it, 2 its own
    system = placed.where("role = 'system'").groupBy("conv_id").agg(F.min(F.struct("pos", "segment", "role", "text", "cost")).alias("s"))
    later = placed.where("segment > 0").select(F.col("conv_id").alias("_conv"), F.col("segment").alias("_to")).distinct()
    brought = later.join(system, F.col("_conv").eqNullSafe(F.col("conv_id"))).where("s.segment < _to").select(
        "conv_id", F.col("_to").alias("segment"), F.lit(0).alias("kind"), F.col("s.pos").alias("pos"), "s.role", "s.text", "s.cost")
    own = placed.withColumn("kind", F.lit(2))
    ends = F.col("before") + F.col("cost")
    carried = placed.where(ends >= (F.col("segment") + 1) * span - history).select(
        "conv_id", (F.col("segment") + 1).alias("segment"), F.lit(1).alias("kind"), "pos", "role", "text", "cost")
    names = ("conv_id", "segment", "kind", "pos", "role", "text", "cost")
    rows = own.select(*names).unionByName(carried.select(*names)).unionByName(brought.select(*names))
    result = pa.schema([("conv_id", id_type), ("window", pa.int64()), ("text", pa.string()), ("n_context", pa.int64()), ("n_new", pa.int64()),
                        ("n_tokens", pa.int64()), ("loss", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def windows() -> Iterator[tuple]:
            for (conv_id, segment), run in runs(rows_of(batches, "conv_id", "segment", "kind", "pos", "role", "text", "cost"), 2):
                listed, seen = [], set()
                for row in run:
                    if row[3] not in seen:           # a system turn may also be carried as history
                        seen.add(row[3])
                        listed.append(row)
                known = sum(row[2] < 2 for row in listed)
                costs = [row[6] for row in listed]
                at = next((i for i, row in enumerate(listed) if row[4] == "system"), None)
                for number, (shown, start, end) in enumerate(plan_windows(costs, at, known, budget, history)):
                    context = ([at] if at is not None and at < start else []) + [i for i in range(shown, start) if i != at]
                    text, loss, used = [], [], 0
                    size = 0
                    for i in [*context, *range(start, end)]:
                        shape, a, b = render(listed[i][4], listed[i][5])
                        if i >= start and listed[i][4] == "assistant":
                            loss.append({"start": size + a, "end": size + b})
                        text.append(shape)
                        size += len(shape)
                        used += costs[i]
                    yield conv_id, (segment << 20) + number, "".join(text), len(context), end - start, used, loss

        yield from in_batches(windows(), result)

    return (rows.repartition(parts, "conv_id", "segment").sortWithinPartitions("conv_id", "segment", "kind", "pos")
            .mapInArrow(build, f"conv_id {id_name}, window long, text string, n_context long, n_new long, n_tokens long, "
                               "loss array<struct<start:long,end:long>>"))


def read_back(windows: DataFrame) -> DataFrame:
    """``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars`` from formatted windows.

    A digest runs over a conversation in order, so its windows pass through one task;
    they stream, and only one window and the digests' states are held.
    """
    id_name = windows.schema["conv_id"].dataType.simpleString()
    result = pa.schema([("conv_id", windows.limit(0).select("conv_id").toArrow().schema.field(0).type), ("n_turns", pa.int64()),
                        ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for (conv_id,), run in runs(rows_of(batches, "conv_id", "text", "n_context", "loss"), 1):
                turns, masked = hashlib.sha256(), hashlib.sha256()
                n_turns = loss_chars = chars = 0
                for _, text, n_context, loss in run:
                    chars += len(text)
                    for i, (role, content, _, _) in enumerate(parse(text)):
                        if i >= n_context:
                            turns.update(f"{role}\n{content}\n".encode())
                            n_turns += 1
                    for place in loss:
                        content = unescape(text[place["start"]:place["end"]])
                        masked.update(content.encode())
                        loss_chars += len(content)
                yield conv_id, n_turns, turns.hexdigest(), loss_chars, masked.hexdigest(), chars

        yield from in_batches(rows(), result)

    return (windows.select("conv_id", "window", "text", "n_context", "loss").repartition(shuffle_partitions(windows.sparkSession), "conv_id")
            .sortWithinPartitions("conv_id", "window")
            .mapInArrow(read, f"conv_id {id_name}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"))
