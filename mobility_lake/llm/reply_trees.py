"""Reply trees as training conversations.

Messages point at the one they answer. Root-to-leaf paths are enumerated by iterative
self-joins that double the reach of every step, so a thread of n messages takes log2(n)
rounds; every round is written to the shared folder. Branches are ranked within their tree by
mean score, and each chosen branch becomes one formatted conversation with a loss mask.

Template, per turn: `<|role|>` line end, text, `<|end|>` line end. Inside roles and texts a
backslash is doubled, `<|` becomes `<\\|` and `|>` becomes `|\\>`, so a control string in a text can neither open nor
close a turn and reading back gives the text exactly.

Defined results: null texts and roles are empty; a null score is 0; null tree ids are one tree.
A message that answers itself or one that is not in its tree starts a path. Messages on a
cycle have no root and are left out. A message id that occurs twice in a tree counts once, the smallest row by
(parent, role, text, score). Ties in rank go to the smaller leaf id. An empty table has no paths.
The columns are named by parameters; others are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mobility_lake.llm.common import written

OPEN, CLOSE, END = "<|", "|>\n", "<|end|>\n"
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<|", "<\\|").replace("|>", "|\\>")


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def format_turns(turns: list[tuple[str, str]], learned: str = "assistant") -> tuple[str, list[tuple[int, int]]]:
    """The formatted conversation and the spans of the texts to learn, in code points."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = OPEN + escape(role) + CLOSE, escape(text)
        if role == learned:
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += (head, body, END)
        at += len(head) + len(body) + len(END)
    return "".join(parts), spans


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """What `format_turns` was given."""
    turns, at = [], 0
    while at < len(formatted):
        head = formatted.index(CLOSE, at + len(OPEN))
        end = formatted.index(END, head + len(CLOSE))
        turns.append((unescape(formatted[at + len(OPEN) : head]), unescape(formatted[head + len(CLOSE) : end])))
        at = end + len(END)
    return turns


def paths(messages: DataFrame) -> DataFrame:
    """(tree, leaf, message, up): every message of every root-to-leaf path, `up` steps above the leaf.

    `messages` has unique (tree, message) and a null parent for a root.
    """
    size = messages.groupBy("tree").count().agg(F.max("count")).first()[0] or 0
    nodes, links = messages.select("tree", "message"), messages.filter("parent is not null")
    links = links.select("tree", "message", F.col("parent").alias("above"))
    parents = links.select(F.col("tree").alias("t"), F.col("above").alias("m")).distinct()
    leaves = nodes.join(
        parents, nodes["tree"].eqNullSafe(F.col("t")) & (nodes["message"] == F.col("m")), "left_anti"
    )
    reached = written(
        leaves.select("tree", F.col("message").alias("leaf"), "message", F.lit(0).alias("up")), "paths"
    )
    step = 1
    links = written(links, "links")
    while step < size and not links.isEmpty():
        further = links.select(F.col("tree").alias("t"), F.col("message").alias("m"), F.col("above").alias("a"))
        higher = reached.join(
            further, reached["tree"].eqNullSafe(F.col("t")) & (reached["message"] == F.col("m"))
        ).select("tree", "leaf", F.col("a").alias("message"), (F.col("up") + step).alias("up"))
        links = written(
            links.join(further, links["tree"].eqNullSafe(F.col("t")) & (links["above"] == F.col("m"))).select(
                "tree", "message", F.col("a").alias("above")
            ),
            "links",
        )
        reached = written(reached.unionByName(higher), "paths")
        step *= 2
    return reached


def conversations(
    messages: DataFrame,
    tree: str,
    message: str,
    parent: str,
    role: str,
    text: str,
    score: str | None = None,
    branches: int | None = None,
    learned: str = "assistant",
) -> DataFrame:
    """One row per chosen path: tree, leaf, rank, score, `formatted` and `loss_spans`.

    `branches` keeps the best so many paths of a tree, None keeps all.
    """
    rows = messages.select(
        F.col(tree).alias("tree"),
        F.col(message).alias("message"),
        F.when(F.col(parent) != F.col(message), F.col(parent)).alias("parent"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
        (F.coalesce(F.col(score), F.lit(0.0)) if score else F.lit(0.0)).cast("double").alias("score"),
    )
    rows = (
        rows.groupBy("tree", "message")
        .agg(F.min(F.struct("parent", "role", "text", "score")).alias("row"))
        .select("tree", "message", "row.*")
    )
    above = rows.select(F.col("tree").alias("t"), F.col("message").alias("m"))
    known = rows.select("tree", "message", "parent", "score").join(
        above, rows["tree"].eqNullSafe(F.col("t")) & (rows["parent"] == F.col("m")), "left"
    )
    known = written(known.select("tree", "message", F.col("m").alias("parent"), "score"), "messages")

    inside = paths(known)
    steps = inside.join(
        known.select(F.col("tree").alias("t"), F.col("message").alias("m"), "parent", "score"),
        inside["tree"].eqNullSafe(F.col("t")) & (inside["message"] == F.col("m")),
    ).drop("t", "m")
    ranked = (
        steps.groupBy("tree", "leaf")
        .agg(F.avg("score").alias("score"), F.max(F.col("parent").isNull()).alias("rooted"))
        .filter("rooted")
        .drop("rooted")
        .withColumn(
            "rank", F.row_number().over(Window.partitionBy("tree").orderBy(F.desc("score"), "leaf"))
        )
    )
    if branches is not None:
        ranked = ranked.filter(F.col("rank") <= branches)
    chosen = ranked.select(F.col("tree").alias("t"), F.col("leaf").alias("l"), "rank", "score")
    texts = rows.select(F.col("tree").alias("rt"), F.col("message").alias("m"), "role", "text")
    turns = (
        inside.join(chosen, inside["tree"].eqNullSafe(F.col("t")) & (inside["leaf"] == F.col("l")))
        .join(texts, inside["tree"].eqNullSafe(F.col("rt")) & (inside["message"] == F.col("m")))
        .groupBy("tree", "leaf", "rank", "score")
        .agg(F.sort_array(F.collect_list(F.struct((-F.col("up")).alias("at"), "role", "text"))).alias("turns"))
    )
    kept = ["tree", "leaf", "rank", "score"]
    kinds = ", ".join(f"{c} {dict(turns.dtypes)[c]}" for c in kept)
    span = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):  # a conversation at a time: their lengths have no bound
                one = batch.slice(at, 1)
                said = [(t["role"], t["text"]) for t in one.column("turns")[0].as_py()]
                formatted, spans = format_turns(said, learned)
                yield pa.record_batch(
                    [
                        *(one.column(c) for c in kept),
                        pa.array([formatted]),
                        pa.array([[{"start": a, "stop": b} for a, b in spans]], span),
                    ],
                    names=[*kept, "formatted", "loss_spans"],
                )

    return turns.mapInArrow(
        run, f"{kinds}, formatted string, loss_spans array<struct<start: bigint, stop: bigint>>"
    )
