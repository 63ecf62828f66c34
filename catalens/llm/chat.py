"""Chat formatting over reply trees.

A conversation is a path from the root of a reply tree to a leaf. Iterative self-joins climb 1, 2, 4, ... replies at
a time: a first climb gives every leaf its root, length and score, branches are ranked in their tree, and a second one
lists the messages of the chosen paths. The rounds grow with the logarithm of the longest path.

Each path becomes one text. Turns are marked by control strings; such strings inside a text are broken by a backslash
after their first letter (one more where backslashes stand there already), which reading back takes out again.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from catalens.llm.tasks import map_batches
from catalens.operators.dedup import first_per_key
from catalens.operators.sequence import number_within
from catalens.staging import stage

# The template. Roles without an entry stand by name between [ROLE] and [/ROLE].
START = "<s>"
MARKS = {"user": ("[INST] ", " [/INST]"), "system": ("<<SYS>>\n", "\n<</SYS>>\n\n"), "assistant": (" ", " </s>")}
OTHER = ("[ROLE]", "[/ROLE]", "[/TURN]")
# What follows the first letter of a control string.
_REST = r"/?s>|/?INST\]|/?ROLE\]|/TURN\]|<SYS>>|</SYS>>"
LEARNED = "assistant"  # the role under the loss mask

_TURN = re.compile(
    "|".join(f"{re.escape(a)}(?P<{role}>.*?){re.escape(b)}" for role, (a, b) in MARKS.items())
    + "|" + "{}(?P<name>.*?){}(?P<other>.*?){}".format(*map(re.escape, OTHER)),
    re.S,
)
_ESCAPED = re.compile(rf"([<\[]\\*)\\(?={_REST})")


def escape(text: Column) -> Column:
    """``text`` without control strings; ``unescape`` gives it back."""
    return F.regexp_replace(text, rf"([<\[]\\*)(?={_REST})", r"$1\\")


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of the turns of one formatted conversation."""
    if not formatted.startswith(START):
        raise ValueError("no start mark")
    at, turns = len(START), []
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if m is None:
            raise ValueError(f"no turn at character {at}")
        role = m.lastgroup
        turns.append((unescape(m["name"]) if role == "other" else role, unescape(m[role])))
        at = m.end()
    return turns


def _keyed(messages: DataFrame, msg_id: str, parent_id: str, score: str | None, parts: Sequence[str]) -> DataFrame:
    """Messages with ``_node`` and ``_parent`` keys that are never null for a node, one row a node."""
    rating = F.coalesce(F.col(score).cast("double"), F.lit(0.0)) if score else F.lit(0.0)
    content = F.sha2(F.to_json(F.struct(parent_id, *parts), {"ignoreNullFields": "false"}), 256)
    keyed = messages.select(
        "*",
        F.coalesce(F.concat(F.lit("="), F.col(msg_id).cast("string")), F.concat(F.lit("?"), content)).alias("_node"),
        F.concat(F.lit("="), F.col(parent_id).cast("string")).alias("_parent"),
        F.when(F.isnan(rating), 0.0).otherwise(rating).alias("_rating"),
    )
    return first_per_key(keyed, ["_node"], [F.col(c) for c in ("_parent", *parts, "_rating")])


def _climb(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """(open rounds, finished) with columns node, up, n, total, root.

    In round k ``up`` is the 2^k-th message above; ``n`` and ``total`` count the messages below ``up`` and add their
    scores. A node whose root is nearer is finished, with all messages to its root counted, and is joined no more.
    """
    known = nodes.select(F.col("_node").alias("_parent"), F.lit(True).alias("known"))
    now = stage(nodes.join(known, "_parent", "left").select(
        F.col("_node").alias("node"), F.when(F.col("known"), F.col("_parent")).alias("up"), F.lit(1).cast("long").alias("n"),
        F.col("_rating").alias("total"), F.when(F.col("known").isNull(), F.col("_node")).alias("root"),
    ))
    rows, left = now.agg(F.count("*"), F.count("up")).first()
    rounds, finished = [now.filter("up is not null")], now.filter("up is null")
    while left and 1 << len(rounds) <= 2 * rows:  # longer climbs go round in a circle
        above = rounds[-1].unionByName(finished).select(*[F.col(c).alias(f"a_{c}") for c in now.columns])
        now = stage(rounds[-1].join(above, F.col("up") == F.col("a_node")).select(
            "node", F.col("a_up").alias("up"), (F.col("n") + F.col("a_n")).alias("n"),
            (F.col("total") + F.col("a_total")).alias("total"), F.col("a_root").alias("root"),
        ))
        rounds.append(now.filter("up is not null"))
        finished = finished.unionByName(now.filter("up is null"))
        left = rounds[-1].count()
    return rounds, finished


def branches(messages: DataFrame, msg_id: str, parent_id: str, score: str | None = None, keep: int | None = None, parts: Sequence[str] = ()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(messages by node, paths, steps) of the reply trees.

    ``paths`` has ``path`` (its leaf's node), ``root``, ``n_turns``, ``score`` (mean of its messages' scores, null and
    NaN being 0) and ``rank`` among the paths of its tree: by score descending, then by leaf; ``keep`` leaves the
    first ones of each tree. ``steps`` has a row (path, node, depth) for each message of a path, the root at depth 1.

    A message whose parent is null or absent is a root. Of rows with one id the first by parent, ``parts`` and score
    counts; rows without id are messages that nobody answers, equal ones once. Messages whose parents go round in a
    circle have no root and are on no path. An empty table has no paths.
    """
    nodes = stage(_keyed(messages, msg_id, parent_id, score, parts))
    rounds, finished = _climb(nodes.select("_node", "_parent", "_rating"))
    parents = rounds[0].select(F.col("up").alias("node")).distinct()
    leaves = finished.join(parents, "node", "left_anti")
    found = leaves.select(F.col("node").alias("path"), "root", F.col("n").alias("n_turns"), (F.col("total") / F.col("n")).alias("score"))
    paths = number_within(found, ["root"], [F.desc("score"), F.asc("path")], "rank").drop("_position")
    if keep is not None:
        paths = paths.filter(F.col("rank") <= keep)
    paths = stage(paths)
    reached = [stage(paths.select("path", F.col("path").alias("node"), F.col("n_turns").alias("depth")))]
    for k, climb in enumerate(rounds):
        so_far = reduce(DataFrame.unionByName, reached).filter(F.col("depth") > 1 << k)
        reached.append(stage(so_far.join(climb.select("node", "up"), "node").select("path", F.col("up").alias("node"), (F.col("depth") - (1 << k)).alias("depth"))))
    return nodes, paths, reduce(DataFrame.unionByName, reached)


def format_conversations(
    messages: DataFrame, msg_id: str, parent_id: str, role: str = "role", text: str = "text", score: str | None = None,
    keep: int | None = None, carry: Sequence[str] = (),
) -> DataFrame:
    """(path, rank, score, n_turns, formatted, loss, and ``carry`` columns of the leaf): a row for each chosen path.

    ``loss`` lists the (start, end) of the assistant texts in ``formatted``, in code points. A null text or role is
    an empty one. See ``branches`` for trees, ties and ids. Columns that are not named are not read and may have any
    name. Texts stand whole: a path is one cell, whatever its length.
    """
    chosen = messages.select(
        F.col(msg_id).alias("_id"), F.col(parent_id).alias("_up"), F.coalesce(F.col(role).cast("string"), F.lit("")).alias("_role"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_text"), (F.col(score) if score else F.lit(0.0)).alias("_score"),
        *[F.col(c).alias(f"_c{i}") for i, c in enumerate(carry)],
    )
    nodes, paths, steps = branches(chosen, "_id", "_up", "_score", keep, ["_role", "_text"])
    before = F.concat(F.lit(OTHER[0]), escape(F.col("_role")), F.lit(OTHER[1]))
    after = F.lit(OTHER[2])
    for name, (a, b) in MARKS.items():
        before, after = F.when(F.col("_role") == name, a).otherwise(before), F.when(F.col("_role") == name, b).otherwise(after)
    shown = nodes.select(F.col("_node").alias("node"), "_role", before.alias("before"), escape(F.col("_text")).alias("shown"), after.alias("after"), *[f"_c{i}" for i in range(len(carry))])
    turns = steps.join(shown, "node").withColumn("turn", F.concat("before", "shown", "after"))
    earlier = Window.partitionBy("path").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.char_length("turn")).over(earlier), F.lit(0)) + len(START) + F.char_length("before")
    turns = turns.withColumn("start", start).withColumn(
        "span", F.when(F.col("_role") == LEARNED, F.struct("start", (F.col("start") + F.char_length("shown")).alias("end")))
    )
    made = turns.groupBy("path").agg(
        F.array_sort(F.collect_list(F.struct("depth", "turn"))).alias("turns"), F.array_sort(F.collect_list("span")).alias("loss"),
        *[F.max_by(f"_c{i}", "depth").alias(f"_c{i}") for i in range(len(carry))],
    )
    formatted = F.concat(F.lit(START), F.array_join(F.transform("turns", lambda t: t["turn"]), ""))
    return made.join(paths, "path").select(
        *[F.col(f"_c{i}").alias(c) for i, c in enumerate(carry)], "path", "rank", "score", "n_turns", formatted.alias("formatted"), "loss"
    )


def threads(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows of linear conversations as messages: ``msg_id``, and ``parent_id``, the message before in the same
    conversation, by turn (nulls first), then role, then text. A null conversation id is a conversation of its own."""
    rows = conversations.select(conv_id, turn, role, text)
    placed = number_within(rows, [conv_id], [F.col(turn), F.col(role), F.col(text)], "_place", "msg_id")
    return placed.withColumn("parent_id", F.when(F.col("_place") > 1, F.col("msg_id") - 1)).drop("_place")


def read_back(df: DataFrame, formatted: str = "formatted", loss: str = "loss") -> DataFrame:
    """``df`` with ``turns`` (array of role and text) and ``loss_text`` (the texts under the loss mask, one after the
    other), both read from the formatted text alone."""
    at, mask = df.columns.index(formatted), df.columns.index(loss)
    schema = StructType.fromDDL("turns array<struct<role: string, text: string>>, loss_text string")

    def run(batches):
        for b in batches:
            turns, learned = [], []
            for whole, spans in zip(b.column(at), b.column(mask)):
                whole = whole.as_py()
                turns.append([{"role": r, "text": t} for r, t in read_turns(whole)])
                learned.append("".join(unescape(whole[s["start"] : s["end"]]) for s in spans.as_py()))
            made = [pa.array(turns, pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))), pa.array(learned, pa.string())]
            yield pa.RecordBatch.from_arrays([*b.columns, *made], names=[*b.schema.names, "turns", "loss_text"])

    return map_batches(df, run, StructType([*df.schema.fields, *schema.fields]))
