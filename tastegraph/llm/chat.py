"""Reply trees to conversations in a chat template.

Messages point to the message they answer. Self-joins that double their reach find depth
and score of every root-to-leaf path in about log2(depth) rounds; the paths chosen per
tree are then enumerated by going back through the tables of those rounds, largest step
first, which meets each message of a path once. Each chosen path becomes one formatted
conversation with the spans of its loss mask.

Template, per turn: ``<|turn|>`` role ``\\n`` text ``<|end|>\\n``. In roles and texts ``&``,
``<`` and ``[`` are written as ``&amp;``, ``&lt;`` and ``&#91;`` (and a line end in a role
as ``&#10;``), so no text can hold a control string of this or a bracketed template, and
every text comes back as it was.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tastegraph.llm.common import stage

OPEN, CLOSE = "<|turn|>", "<|end|>\n"


def escape(text: str) -> str:
    return text.replace("&", "&amp;").replace("<", "&lt;").replace("[", "&#91;")


def unescape(text: str) -> str:
    return text.replace("&#91;", "[").replace("&lt;", "<").replace("&amp;", "&")


def format_turns(turns: list[tuple[str, str]]) -> tuple[str, list[int], list[int]]:
    """(text, starts, ends): the spans of the assistant texts in code points."""
    parts, starts, ends, at = [], [], [], 0
    for role, text in turns:
        head, body = OPEN + escape(role).replace("\n", "&#10;") + "\n", escape(text)
        if role == "assistant":
            starts.append(at + len(head))
            ends.append(at + len(head) + len(body))
        parts += [head, body, CLOSE]
        at += len(head) + len(body) + len(CLOSE)
    return "".join(parts), starts, ends


def parse_turns(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) turns of a formatted conversation."""
    turns = []
    for part in formatted.split(CLOSE)[:-1]:
        if not part.startswith(OPEN):
            raise ValueError("a turn does not begin with its mark")
        role, _, text = part[len(OPEN) :].partition("\n")
        turns.append((unescape(role.replace("&#10;", "\n")), unescape(text)))
    return turns


def _climb(nodes: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """((tree, node, depth, score) of nodes that reach a root, ancestor tables by power of two).

    ``nodes`` has tree, node, parent and score. A parent that is missing counts as none.
    Nodes in a circle of replies, and those that answer them, reach no root.
    """
    known = nodes.select("tree", F.col("node").alias("parent"), F.lit(True).alias("there"))
    now = nodes.join(known, ["tree", "parent"], "left").select(
        "tree",
        "node",
        F.when(F.col("there"), F.col("parent")).alias("above"),
        F.lit(1).cast("long").alias("depth"),
        F.col("score").cast("double").alias("score"),
    )
    now, steps, done = stage(now, "climb"), [], []
    most = max(1, nodes.count())
    while (1 << len(steps)) <= 2 * most:
        done.append(now.where("above IS NULL"))
        # Only nodes that have not reached their root climb on.
        still = now.where("above IS NOT NULL")
        if still.isEmpty():
            break
        steps.append(still.select("tree", "node", "above"))
        known = now if len(done) == 1 else _all(done[:-1]).unionByName(now)
        up = known.select(
            "tree",
            F.col("node").alias("above"),
            F.col("above").alias("next"),
            F.col("depth").alias("up_depth"),
            F.col("score").alias("up_score"),
        )
        now = still.join(up, ["tree", "above"]).select(
            "tree",
            "node",
            F.col("next").alias("above"),
            (F.col("depth") + F.col("up_depth")).alias("depth"),
            (F.col("score") + F.col("up_score")).alias("score"),
        )
        now = stage(now, "climb")
    return _all(done).drop("above"), steps


def _all(tables: list[DataFrame]) -> DataFrame:
    out = tables[0]
    for table in tables[1:]:
        out = out.unionByName(table)
    return out


def best_paths(messages: DataFrame, per_tree: int = 1) -> DataFrame:
    """(tree, leaf, rank, place, node): the messages of the best ``per_tree`` branches.

    ``messages`` has tree, node, parent and score (null: 0). Branches rank by the sum of
    their scores, then by length, then by the smaller leaf. (tree, node) must be unique.
    """
    nodes = messages.select("tree", "node", "parent", F.coalesce("score", F.lit(0.0)).alias("score"))
    reached, steps = _climb(nodes)
    answered = nodes.where("parent IS NOT NULL").select("tree", F.col("parent").alias("node")).distinct()
    leaves = reached.join(answered, ["tree", "node"], "left_anti")
    order = Window.partitionBy("tree").orderBy(F.desc("score"), F.desc("depth"), "node")
    leaves = leaves.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= per_tree)
    paths = stage(leaves.select("tree", F.col("node").alias("leaf"), "rank", F.col("depth").alias("place"), "node"), "paths")
    for power in reversed(range(len(steps))):
        up = paths.join(steps[power], ["tree", "node"]).select(
            "tree", "leaf", "rank", (F.col("place") - (1 << power)).alias("place"), F.col("above").alias("node")
        )
        paths = stage(paths.unionByName(up), "paths")
    return paths


def format_paths(messages: DataFrame, per_tree: int = 1) -> DataFrame:
    """(tree, rank, formatted, starts, ends) per chosen path.

    Null roles and texts are empty. Other columns are ignored.
    """
    paths = best_paths(messages, per_tree)
    said = messages.select("tree", "node", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    turns = paths.join(said, ["tree", "node"]).groupBy("tree", "rank").agg(
        F.sort_array(F.collect_list(F.struct("place", "role", "text"))).alias("turns")
    )

    def work(batches):
        for batch in batches:
            for low in range(0, len(batch), 256):
                part = batch.slice(low, 256)
                made = [format_turns([(t["role"], t["text"]) for t in turns]) for turns in part.column("turns").to_pylist()]
                texts, starts, ends = zip(*made, strict=True)
                longs = pa.list_(pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column("tree"), part.column("rank"), pa.array(texts), pa.array(starts, longs), pa.array(ends, longs)],
                    ["tree", "rank", "formatted", "starts", "ends"],
                )

    kind = turns.schema["tree"].dataType.simpleString()
    return turns.mapInArrow(work, f"tree {kind}, rank int, formatted string, starts array<long>, ends array<long>")


def read_back(formatted: DataFrame) -> DataFrame:
    """(tree, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars) from the output alone."""

    def work(batches):
        for batch in batches:
            rows = []
            for text, starts, ends in zip(*(batch.column(c).to_pylist() for c in ("formatted", "starts", "ends")), strict=True):
                turns = parse_turns(text)
                whole = "".join(f"{role}\n{said}\n" for role, said in turns)
                loss = "".join(unescape(text[a:b]) for a, b in zip(starts, ends, strict=True))
                sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
                rows.append((len(turns), sha(whole), len(loss), sha(loss), len(text)))
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column("tree"), *[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]],
                ["tree", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
            )

    kind = formatted.schema["tree"].dataType.simpleString()
    fields = f"tree {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return formatted.mapInArrow(work, fields)


def turns_to_replies(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Messages of plain conversations: each turn answers the one before.

    Equal turns stand in order of role and text, missing turns first; repeated rows are
    turns of their own. Rows without an id form one conversation.
    """
    rows = turns.select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("tree"),
        F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    place = F.row_number().over(Window.partitionBy("tree").orderBy("turn", "role", "text"))
    rows = stage(rows.withColumn("node", place.cast("long")), "turns")
    above = F.when(F.col("node") > 1, F.col("node") - 1)
    return rows.select("tree", "node", above.alias("parent"), F.lit(0.0).alias("score"), "role", "text")
