"""Reply trees to training text: root-to-leaf paths by self-joins, ranked branches, one formatted conversation each."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadcast.llm.common import Steps
from roadcast.skew import neighbour_window

OPEN, HEAD_END, CLOSE = "<|turn|>", "<|text|>\n", "<|end|>\n"
# Openings of control strings, of this template and of others in use; a backslash after the first character disarms them.
CONTROL = ["<|", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"]
_CONTROL = re.compile("|".join(re.escape(c) for c in CONTROL))
_ESCAPED = re.compile(r"\\(.)", re.S)
_TURN = re.compile(r"<\|turn\|>(.*?)<\|text\|>\n(.*?)<\|end\|>\n", re.S)


def escape(text: str) -> str:
    """Reversible: backslashes are doubled, then each control string gets one after its first character."""
    return _CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def linear_trees(rows: DataFrame, steps: Steps, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Conversations as trees with one branch: each turn answers the one before it.

    Order is turn (null first), then role and text, so repeated turns have a defined order.  Conversations that hold a large part of
    all rows are cut into blocks.
    """
    picked = rows.select(F.col(conv_col).alias("tree"), F.col(turn_col).alias("turn"), F.coalesce(role_col, F.lit("")).alias("role"), F.coalesce(text_col, F.lit("")).alias("text"))
    nodes = steps.write(picked.withColumn("node", F.monotonically_increasing_id()))
    narrow = nodes.select("tree", "turn", "role", F.md5(F.col("text").cast("binary")).alias("_t"), "node")
    linked = neighbour_window(narrow, ["tree"], ["turn", "role", "_t", "node"], lambda df, w: df.withColumn("parent", F.lag("node").over(w)), 1, 0)
    return linked.select("node", "parent").join(nodes, "node").withColumn("score", F.lit(0.0))


def reply_paths(nodes: DataFrame, steps: Steps, branches: int | None = None) -> DataFrame:
    """Rows (tree, leaf, rank, up, node) of every root-to-leaf path; ``up`` counts steps from the leaf.

    Self-joins double the reach of a jump table until no node has an ancestor so far up; walking the tables back from the longest
    jump gives each leaf every ancestor exactly once.  Branches rank within their tree by mean score (null as 0), ties by leaf; ``branches``
    keeps the best few, None all.  A parent that does not exist makes a root.  Parents in a circle raise.
    """
    slim = steps.write(nodes.select("tree", "node", "parent", F.coalesce("score", F.lit(0.0)).cast("double").alias("score")))
    known = slim.select(F.col("node").alias("parent"))
    jump, sums = steps.write_and_sum(slim.filter("parent IS NOT NULL").select("node", "parent").join(known, "parent").select("node", F.col("parent").alias("anc")), n=F.lit(1))
    jumps, most = [], sums["n"]
    while sums["n"]:
        if 1 << len(jumps) > most:
            raise ValueError("parents form a circle")
        jumps.append(jump)
        on = jump.select(F.col("node").alias("anc"), F.col("anc").alias("_next"))
        jump, sums = steps.write_and_sum(jump.join(on, "anc").select("node", F.col("_next").alias("anc")), n=F.lit(1))
    parents = slim.select(F.col("parent").alias("node"))
    at = slim.join(parents, "node", "left_anti").select(F.col("tree"), F.col("node").alias("leaf"), "node", F.lit(0).alias("up"))
    for k in reversed(range(len(jumps))):
        here, there = F.struct("node", "up"), F.struct(F.col("anc").alias("node"), (F.col("up") + (1 << k)).alias("up"))
        both = at.join(jumps[k], "node", "left")
        both = both.select("tree", "leaf", F.explode(F.when(F.col("anc").isNull(), F.array(here)).otherwise(F.array(here, there))).alias("_s"))
        at = both.select("tree", "leaf", F.col("_s.node").alias("node"), F.col("_s.up").alias("up"))
    at = steps.write(at)
    mean = at.join(slim.select("node", "score"), "node").groupBy("tree", "leaf").agg(F.avg("score").alias("_mean"))
    ranked = mean.withColumn("rank", F.row_number().over(Window.partitionBy("tree").orderBy(F.desc("_mean"), "leaf")))
    if branches is not None:
        ranked = ranked.filter(F.col("rank") <= branches)
    return at.join(ranked.select("leaf", "rank"), "leaf")


FORMATTED = "tree long, leaf long, rank int, formatted string, mask array<struct<start:long,stop:long>>"
_FORMATTED = pa.schema([("tree", pa.int64()), ("leaf", pa.int64()), ("rank", pa.int32()), ("formatted", pa.string()), ("mask", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])))])


def format_turns(turns: list[tuple[str, str]], trained: str = "assistant") -> tuple[str, list[tuple[int, int]]]:
    """One text of all turns and the spans (in code points) that are trained on: exactly the texts of ``trained`` turns."""
    pieces, mask, at = [], [], 0
    for role, text in turns:
        head, body = OPEN + escape(role) + HEAD_END, escape(text)
        if role == trained:
            mask.append((at + len(head), at + len(head) + len(body)))
        pieces += [head, body, CLOSE]
        at += len(head) + len(body) + len(CLOSE)
    return "".join(pieces), mask


def parse_turns(formatted: str) -> list[tuple[str, str]]:
    return [(unescape(role), unescape(text)) for role, text in _TURN.findall(formatted)]


def _write_paths(batches) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by path and depth; only one conversation is held at a time."""
    current, turns, done = None, [], []

    def batch():
        cols = [[d[n] for d in done] for n in range(5)]
        done.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _FORMATTED)], schema=_FORMATTED)

    def close():
        text, mask = format_turns(turns)
        done.append((*current, text, [{"start": a, "stop": b} for a, b in mask]))
        return len(text)

    held = 0
    for rows in batches:
        for tree, leaf, rank, role, text in zip(*(rows.column(c).to_pylist() for c in ("tree", "leaf", "rank", "role", "text"))):
            if (tree, leaf, rank) != current:
                if current is not None:
                    held += close()
                    if held > 4 << 20:
                        held = 0
                        yield batch()
                current, turns = (tree, leaf, rank), []
            turns.append((role, text))
    if current is not None:
        close()
    if done:
        yield batch()


def format_conversations(nodes: DataFrame, steps: Steps, branches: int | None = None) -> DataFrame:
    """One row per chosen path: tree, leaf, rank, formatted, mask.  ``nodes``: tree, node, parent, role, text, score.

    Null roles and texts count as empty; a null tree is a tree of its own; an empty table gives no rows.
    """
    paths = reply_paths(nodes, steps, branches)
    said = nodes.select("node", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = paths.select(F.col("tree").cast("long").alias("tree"), "leaf", "rank", "up", "node").join(said, "node")
    sorted_rows = rows.repartition("leaf").sortWithinPartitions("tree", "leaf", F.desc("up")).select("tree", "leaf", "rank", "role", "text")
    return sorted_rows.mapInArrow(_write_paths, FORMATTED)


READ_BACK = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, leaf long, rank int"


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of what the formatted texts and masks say."""

    def run(batches):
        for batch in batches:
            cols: list[list] = [[] for _ in range(6)]
            for tree, text, mask in zip(*(batch.column(c).to_pylist() for c in ("tree", "formatted", "mask"))):
                turns = parse_turns(text)
                loss = "".join(unescape(text[m["start"] : m["stop"]]) for m in mask)
                said = hashlib.sha256()
                for role, words in turns:
                    said.update(f"{role}\n{words}\n".encode())
                for col, value in zip(cols, (tree, len(turns), said.hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(text))):
                    col.append(value)
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(cols, kinds)] + [batch.column("leaf"), batch.column("rank")],
                names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "leaf", "rank"],
            )

    return formatted.select("tree", "leaf", "rank", "formatted", "mask").mapInArrow(run, READ_BACK)
