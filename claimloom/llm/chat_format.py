"""Reply trees as formatted conversations, and back.

Messages (tree, id, parent, role, text, score) form reply trees. Root-to-leaf paths are found by iterative
self-joins: a table holds for each message its ancestor 2^k steps up, and each round extends all paths
by that table and then joins the table with itself, so d turns take log2(d) rounds. Branches are ranked by
the sum of their scores; each chosen path becomes one conversation.

Template: per turn ``<|role|>``, a line break, the text, ``</s>`` and a line break. Inside roles and texts a backslash is
doubled and every control string gets a backslash after its first character, so taking one backslash off each
escape restores them exactly. The loss mask holds (start, length) in code points of each assistant text.

Null roles and texts count as empty, null scores as 0, a null tree id as a tree of its own, a parent that is not
in the tree as none. Messages are told apart by tree and id, which must be unique; ``chains`` numbers plain
rows, equal ones too, so there it always holds. A reply cycle raises an error.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimloom.sources import scratch

OPEN, SHUT, END = "<|", "|>\n", "</s>\n"
#: Strings that have a meaning in common chat templates.
CONTROL = ("<|", "|>", "</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")


def escaped(text: Column) -> Column:
    text = F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\\\"))
    for control in CONTROL:
        text = F.replace(text, F.lit(control), F.lit(control[0] + "\\" + control[1:]))
    return text


def unescaped(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


def chains(turns: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) as reply trees without branches: each row answers the one before it, by turn,
    then role and text."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    numbered = turns.select("conv_id", "role", "text", F.row_number().over(order).cast("long").alias("id"))
    parent = F.when(F.col("id") > 1, F.col("id") - 1)
    return numbered.select(F.col("conv_id").alias("tree"), "id", parent.alias("parent"), "role", "text", F.lit(0.0).alias("score"))


def paths(messages: DataFrame) -> DataFrame:
    """(tree, leaf, id, up): every message of every root-to-leaf path, ``up`` steps above the leaf. ``tree`` is a struct,
    so that a null id is a value like any other."""
    nodes = messages.select(F.struct("tree").alias("tree"), "id", "parent")
    have = nodes.select("tree", F.col("id").alias("parent"))
    jump = nodes.select("tree", "id", "parent").join(have, ["tree", "parent"]).select("tree", "id", F.col("parent").alias("above"))
    jump = scratch.written(jump, "jumps")
    inner = jump.select("tree", F.col("above").alias("id"))
    leaves = nodes.select("tree", "id").join(inner, ["tree", "id"], "left_anti")
    found = scratch.written(leaves.select("tree", F.col("id").alias("leaf"), "id", F.lit(0).cast("long").alias("up")), "paths")
    limit, step = None, 1
    while jump.limit(1).count():
        if limit is None:
            limit = jump.count()
        if step > limit:
            raise ValueError("replies form a cycle")
        further = found.join(jump, ["tree", "id"]).select("tree", "leaf", F.col("above").alias("id"), (F.col("up") + step).alias("up"))
        found = scratch.written(found.union(further), "paths")
        higher = jump.select("tree", F.col("id").alias("above"), F.col("above").alias("higher"))
        jump = scratch.written(jump.join(higher, ["tree", "above"]).select("tree", "id", F.col("higher").alias("above")), "jumps")
        step *= 2
    return found


def conversations(messages: DataFrame, keep: int = 1) -> DataFrame:
    """For each tree its ``keep`` best branches (by summed score, then the smaller leaf id): tree, leaf, rank, n_turns,
    formatted, loss (start and length of every assistant text in ``formatted``)."""
    found = paths(messages).join(
        messages.select(F.struct("tree").alias("tree"), "id", "role", "text", F.coalesce("score", F.lit(0.0)).alias("score")), ["tree", "id"]
    )
    ranked = found.groupBy("tree", "leaf").agg(F.sum("score").alias("total"))
    best = Window.partitionBy("tree").orderBy(F.col("total").desc(), "leaf")
    ranked = ranked.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= keep).select("tree", "leaf", "rank")
    head = F.concat(F.lit(OPEN), escaped(F.col("role")), F.lit(SHUT))
    turns = found.join(ranked, ["tree", "leaf"]).withColumn("head", head).withColumn("body", escaped(F.col("text")))
    turns = turns.withColumn("turn", F.concat("head", "body", F.lit(END)))
    down = Window.partitionBy("tree", "leaf").orderBy(F.col("up").desc())
    turns = turns.withColumn("start", F.sum(F.length("turn")).over(down) - F.length("turn") + F.length("head"))
    mark = F.when(F.col("role") == "assistant", F.struct(F.col("start"), F.length("body").cast("long").alias("length")))
    rows = turns.groupBy("tree", "leaf", "rank").agg(
        F.sort_array(F.collect_list(F.struct((-F.col("up")).alias("place"), "turn", mark.alias("mark")))).alias("turns")
    )
    return rows.select(
        F.col("tree.tree").alias("tree"),
        "leaf",
        "rank",
        F.size("turns").cast("long").alias("n_turns"),
        F.array_join("turns.turn", "").alias("formatted"),
        F.filter("turns.mark", lambda m: m.isNotNull()).alias("loss"),
    )


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """Role and text of every turn of a formatted conversation."""
    turns = []
    for piece in formatted.split(END)[:-1]:
        role, _, text = piece.removeprefix(OPEN).partition(SHUT)
        turns.append((unescaped(role), unescaped(text)))
    return turns


def masked(formatted: str, loss: list[dict]) -> str:
    """All text under the loss mask, without escapes."""
    return "".join(unescaped(formatted[m["start"] : m["start"] + m["length"]]) for m in loss)


def _read(batches):
    for batch in batches:
        out = []
        for text, loss in zip(batch.column("formatted").to_pylist(), batch.column("loss").to_pylist(), strict=True):
            turns, under = read_turns(text), masked(text, loss)
            told = "".join(f"{role}\n{words}\n" for role, words in turns)
            digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
            out.append((len(turns), digest(told), len(under), digest(under), len(text)))
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
        columns = [pa.array([x[k] for x in out], kind) for k, kind in enumerate(kinds)]
        yield pa.record_batch(
            [batch.column("tree"), *columns],
            names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
        )


def digests(formatted: DataFrame) -> DataFrame:
    """What reading the output back gives, per conversation: n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars."""
    kind = formatted.schema["tree"].dataType.simpleString()
    return formatted.select("tree", "formatted", "loss").mapInArrow(
        _read, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    )
