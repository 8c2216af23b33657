"""Chat formatting of reply trees: paths by iterative self-joins, ranked, one text each."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapdiff.session import cut_lineage

START, END = "<|im_start|>", "<|im_end|>\n"
ASSISTANT = "assistant"
#: Strings that must not appear as such inside a text, and their first character's escape.
CONTROL = ["<|", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"]
CIRCLE = "messages reply to one another in a circle"
ESCAPES = {"<": "&lt;", "[": "&#91;"}


def escape(text: Column) -> Column:
    """Reversible: ``&`` becomes ``&amp;``, a control string loses its first character to an escape."""
    out = F.replace(text, F.lit("&"), F.lit("&amp;"))
    for mark in CONTROL:
        out = F.replace(out, F.lit(mark), F.lit(ESCAPES[mark[0]] + mark[1:]))
    return out


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("&#10;"))


def unescape(text: str) -> str:
    return text.replace("&#10;", "\n").replace("&#91;", "[").replace("&lt;", "<").replace("&amp;", "&")


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a formatted conversation, unescaped."""
    out = []
    for turn in formatted.split(END)[:-1]:
        role, _, text = turn.removeprefix(START).partition("\n")
        out.append((unescape(role), unescape(text)))
    return out


def masked(formatted: str, spans: list[dict]) -> list[str]:
    """The unescaped text under each span of the loss mask."""
    return [unescape(formatted[s["start"] : s["start"] + s["length"]]) for s in spans]


def reply_paths(messages: DataFrame) -> DataFrame:
    """``tree, leaf, rank, message``: every root-to-leaf path, message by message.

    ``messages``: ``tree, message, parent`` (null for a root); (tree, message)
    is unique and a parent lies in the same tree. A message whose parent is missing
    is a root; messages that reply to one another in a circle raise a ``ValueError``.
    ``rank`` counts from 0 at the root.

    Runs of only children are folded first: each message points to its parent
    while it is the parent's only reply, and the pointers double by self-joins
    until they reach the head of the run, so a conversation of n turns takes
    log n rounds. Leaves then climb from run to run, one self-join for each
    branching above them.
    """
    rows = messages.select("tree", "message", "parent")
    ids = rows.select(F.col("tree").alias("pt"), F.col("message").alias("pm"))
    replies = rows.where(F.col("parent").isNotNull()).groupBy("tree", "parent").agg(F.count(F.lit(1)).alias("replies"))
    up = rows.join(ids, F.col("tree").eqNullSafe(F.col("pt")) & (F.col("parent") == F.col("pm")), "left").select(
        "tree", "message", F.col("pm").alias("parent"))
    r = replies.select(F.col("tree").alias("rt"), F.col("parent").alias("rm"), "replies")
    up = up.join(r, F.col("tree").eqNullSafe(F.col("rt")) & (F.col("parent") == F.col("rm")), "left")
    has = replies.select(F.col("tree").alias("ht"), F.col("parent").alias("hm"))
    up = up.join(has, F.col("tree").eqNullSafe(F.col("ht")) & (F.col("message") == F.col("hm")), "left")
    # jump: where the pointer stands now; steps: messages passed
    state = cut_lineage(up.select(
        "tree", "message", "parent", F.col("hm").isNull().alias("leaf"),
        F.when(F.col("replies") == 1, F.col("parent")).alias("jump"),
        F.when(F.col("replies") == 1, 1).otherwise(0).cast("long").alias("steps"), F.col("message").alias("head")))
    before = None
    while left := state.where(F.col("jump").isNotNull()).count():
        if left == before:  # each round ends a run's next messages; only a circle has none
            raise ValueError(CIRCLE)
        before = left
        other = state.select(F.col("tree").alias("ot"), F.col("message").alias("om"), F.col("jump").alias("oj"),
                             F.col("steps").alias("os"), F.col("head").alias("oh"))
        # only messages that have not reached the head of their run take part
        moving = state.where(F.col("jump").isNotNull())
        moved = moving.join(other, F.col("tree").eqNullSafe(F.col("ot")) & (F.col("jump") == F.col("om")), "left").select(
            "tree", "message", "parent", "leaf", F.col("oj").alias("jump"),
            (F.col("steps") + F.coalesce("os", F.lit(0))).alias("steps"), F.coalesce("oh", "head").alias("head"))
        state = cut_lineage(state.where(F.col("jump").isNull()).unionByName(moved))
    # runs: head, the message above it, and the run's members by their distance from the head
    members = state.select("tree", "head", "message", "steps")
    heads = state.where(F.col("message") == F.col("head")).select(
        F.col("tree").alias("ht"), F.col("head").alias("hh"), F.col("parent").alias("above"))
    whole = state.select(F.col("tree").alias("at"), F.col("message").alias("am"), F.col("head").alias("ah"), F.col("steps").alias("asteps"))

    def place(df: DataFrame) -> DataFrame:
        """(tree, leaf, message, down) -> with the run it stands in and the message above the run."""
        df = df.join(whole, F.col("tree").eqNullSafe(F.col("at")) & (F.col("message") == F.col("am")))
        df = df.join(heads, F.col("tree").eqNullSafe(F.col("ht")) & (F.col("ah") == F.col("hh")))
        return df.select("tree", "leaf", F.col("ah").alias("head"), F.col("asteps").alias("length"), "down", "above")

    step = cut_lineage(place(state.where("leaf").select("tree", F.col("message").alias("leaf"), "message", F.lit(0).cast("long").alias("down"))))
    parts = [step]
    longest = state.groupBy("tree").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0]
    while True:
        higher = step.where(F.col("above").isNotNull())
        down = higher.agg(F.max("down")).first()[0]
        if down is None:
            break
        if down >= longest:  # a path longer than its tree has messages
            raise ValueError(CIRCLE)
        step = cut_lineage(place(higher.select("tree", "leaf", F.col("above").alias("message"),
                                               (F.col("down") + F.col("length") + 1).alias("down"))))
        parts.append(step)
    runs = parts[0]
    for part in parts[1:]:
        runs = runs.union(part)
    total = Window.partitionBy("tree", "leaf")
    runs = runs.withColumn("depth", F.max(F.col("down") + F.col("length")).over(total)).select(
        F.col("tree").alias("rt"), "leaf", F.col("head").alias("rh"), "length", "down", "depth")
    # a member counts if it is not below the point where the path entered its run
    joined = members.join(runs, F.col("tree").eqNullSafe(F.col("rt")) & (F.col("head") == F.col("rh")))
    return joined.where(F.col("steps") <= F.col("length")).select(
        "tree", "leaf", (F.col("depth") - F.col("down") - F.col("length") + F.col("steps")).alias("rank"), "message")


def format_trees(messages: DataFrame, best: int | None = None) -> DataFrame:
    """One row for each chosen path: ``tree, leaf, path_rank, path_score, n_turns, formatted, loss_spans``.

    ``messages``: ``tree, message, parent, role, text, score``. The paths of a
    tree are ranked by their messages' mean score (null scores count as 0),
    best first; ties: the least leaf. ``best`` keeps the first so many of each
    tree (None: all). Null roles and texts are empty. A turn is
    ``<|im_start|>role\\ntext<|im_end|>\\n`` with control strings inside roles and
    texts escaped; ``loss_spans`` (start, length in code points of
    ``formatted``) covers exactly each assistant turn's text. A conversation is
    one output row, so a group holds one conversation's turns. An empty table
    gives an empty table.
    """
    paths = reply_paths(messages)
    body = messages.select(
        F.col("tree").alias("mt"), F.col("message").alias("mm"),
        escape_role(F.coalesce("role", F.lit(""))).alias("role"), escape(F.coalesce("text", F.lit(""))).alias("text"),
        F.coalesce(F.col("role") == ASSISTANT, F.lit(False)).alias("learned"),
        F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"))
    scored = paths.join(body.select("mt", "mm", "score"), F.col("tree").eqNullSafe(F.col("mt")) & (F.col("message") == F.col("mm")))
    ranking = Window.partitionBy("tree").orderBy(F.desc("path_score"), "leaf")
    chosen = scored.groupBy("tree", "leaf").agg(F.avg("score").alias("path_score"), F.count(F.lit(1)).alias("n_turns"))
    chosen = chosen.withColumn("path_rank", F.row_number().over(ranking))
    if best is not None:
        chosen = chosen.where(F.col("path_rank") <= best)
    chosen = chosen.select(F.col("tree").alias("ct"), F.col("leaf").alias("cl"), "path_score", "path_rank", "n_turns")
    turns = paths.join(chosen, F.col("tree").eqNullSafe(F.col("ct")) & (F.col("leaf") == F.col("cl")))
    turns = turns.join(body, F.col("tree").eqNullSafe(F.col("mt")) & (F.col("message") == F.col("mm")))
    front = F.concat(F.lit(START), F.col("role"), F.lit("\n"))
    turns = turns.withColumn("piece", F.concat(front, F.col("text"), F.lit(END)))
    before = Window.partitionBy("tree", "leaf").orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    begin = F.coalesce(F.sum(F.length("piece")).over(before), F.lit(0)) + F.length(front)
    turns = turns.withColumn("span", F.when(F.col("learned"), F.struct(
        begin.cast("long").alias("start"), F.length("text").cast("long").alias("length"))))
    return turns.groupBy("tree", "leaf", "path_rank", "path_score", "n_turns").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "piece"))), lambda t: t["piece"]), "").alias("formatted"),
        F.array_sort(F.collect_list("span")).alias("loss_spans"))


def linear_messages(turns: DataFrame, conv: str = "conv_id") -> DataFrame:
    """The rows of linear conversations as ``tree, message, parent, role, text, score``.

    Each row replies to the one before it by ``turn``; rows with equal turns
    (repeated rows too) follow one another by role and text, nulls first.
    """
    order = Window.partitionBy(conv).orderBy("turn", "role", "text")
    return turns.select(F.col(conv).alias("tree"), F.row_number().over(order).cast("long").alias("message"), "role", "text").select(
        "tree", "message", F.when(F.col("message") > 1, F.col("message") - 1).alias("parent"), "role", "text", F.lit(0.0).alias("score"))


def read_back(formatted: DataFrame) -> DataFrame:
    """What the formatted texts and loss masks say: ``tree, n_turns, turns_sha256,
    loss_chars, loss_sha256, formatted_chars``, from these two columns alone."""
    kind = formatted.schema["tree"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                turns, learned = parse(text), "".join(masked(text, spans))
                said = "".join(f"{role}\n{body}\n" for role, body in turns)
                rows.append((len(turns), hashlib.sha256(said.encode()).hexdigest(), len(learned),
                             hashlib.sha256(learned.encode()).hexdigest(), len(text)))
            columns = list(zip(*rows)) if rows else [[]] * 5
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(list(c), k) for c, k in zip(columns, kinds))],
                names=["tree", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    return formatted.select("tree", "formatted", "loss_spans").mapInArrow(
        run, f"tree {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
