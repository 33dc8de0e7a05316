"""Chat formatting of reply trees: paths by iterative self-joins, ranked, one conversation each.

Messages answer messages. Pointers of every message to the message 1, 2, 4, …
replies above are built by joining the pointers to themselves, so a tree of
depth d takes log2(d) rounds whatever its size. The same rounds add up scores
from the root. Of each tree the leaves with the best paths are chosen, and only
their paths are enumerated, by following the pointers from the longest to the
shortest. Each path becomes one formatted text with the spans a loss is taken on.

Template: every turn stands between marks of its role. Inside a text a
backslash is doubled and the marks get a backslash after their first character,
so no text can end its turn, and dropping the backslashes restores it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowbridge.common import column, stage

# Marks around the turns; roles without marks of their own are written out.
USER, SYSTEM, ASSISTANT, OTHER = ("[INST]", "[/INST]"), ("<<SYS>>", "<</SYS>>"), ("<s>", "</s>"), ("<|turn|>", "<|end|>")
ROLE_END = "<|text|>"
MARKS = {"user": USER, "system": SYSTEM, "assistant": ASSISTANT}
_INSIDE = r"([\[<])(?=/?INST\]|/?s>|</?SYS>>|\|turn\|>|\|end\|>|\|text\|>)"
_TURN = r"(?s)(\[INST\]|<<SYS>>|<s>|<\|turn\|>)(.*?)(\[/INST\]|<</SYS>>|</s>|<\|end\|>)"


def escape(text: Column) -> Column:
    doubled = F.regexp_replace(text, r"\\", r"\\\\")
    return F.regexp_replace(doubled, _INSIDE, r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _turn(role: Column, text: Column) -> tuple[Column, Column, Column]:
    """What stands before, inside and after a turn."""
    before, after = F.concat(F.lit(OTHER[0]), escape(role), F.lit(ROLE_END)), F.lit(OTHER[1])
    for name, (opening, closing) in MARKS.items():
        before = F.when(role == name, F.lit(opening)).otherwise(before)
        after = F.when(role == name, F.lit(closing)).otherwise(after)
    return before, escape(text), after


def linear(messages: DataFrame, conversation: str, turn: str, role: str, text: str) -> DataFrame:
    """Messages of plain conversations as trees of one branch: each turn answers the one before.

    Turns are ordered by ``turn``, nulls last; equal turns by role and text, and
    repeated rows are turns of their own. A null conversation is one as well.
    """
    ordered = Window.partitionBy("tree").orderBy(F.col("turn").asc_nulls_last(), "role", "text")
    rows = messages.select(
        F.struct(column(conversation).alias("id")).alias("tree"),
        column(turn).alias("turn"),
        F.coalesce(column(role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(column(text).cast("string"), F.lit("")).alias("text"),
    ).withColumn("message", F.row_number().over(ordered).cast("long"))
    parent = F.when(F.col("message") > 1, F.col("message") - 1)
    return rows.select("tree", "message", parent.alias("parent"), "role", "text", F.lit(0.0).alias("score"))


def best_paths(messages: DataFrame, paths_per_tree: int | None = None) -> DataFrame:
    """Messages of the root-to-leaf paths in rank order: (tree, path rank, place from the root, role, text).

    All paths, or the ``paths_per_tree`` best ones.

    ``messages`` has (tree, message, parent, role, text, score). A message whose
    parent is null or missing is a root; messages that only answer each other in
    a circle have no root and are in no path. Paths are ranked by mean score per
    message, the longer and then the smaller leaf first; a null score counts 0.
    A repeated (tree, message) is one message: the smallest (role, text).
    """
    told = stage(
        messages.groupBy("tree", "message").agg(
            F.min(F.struct("parent", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"), F.coalesce("score", F.lit(0.0)).alias("score"))).alias("m")
        ).select("tree", "message", "m.*"),
        "chat-messages",
    )
    # A parent is real if it is a message of the tree.
    real = told.select("tree", F.col("message").alias("parent"), F.lit(True).alias("known"))
    up = told.join(real, ["tree", "parent"], "left").select(
        "tree", "message", F.when(F.col("known"), F.col("parent")).alias("above"),
        F.col("score").alias("sum"), F.lit(1).cast("long").alias("n"),
    )
    levels = [stage(up, "chat-pointers")]
    # n counts the messages from this one up to, and without, ``above``.
    limit = told.count().bit_length() + 1
    while len(levels) <= limit and levels[-1].where("above is not null").head() is not None:
        here = levels[-1]
        there = here.select(
            "tree", F.col("message").alias("above"), F.col("above").alias("next"), F.col("sum").alias("sum2"), F.col("n").alias("n2")
        )
        joined = here.join(there, ["tree", "above"], "left").select(
            "tree", "message", F.col("next").alias("above"),
            (F.col("sum") + F.coalesce("sum2", F.lit(0.0))).alias("sum"), (F.col("n") + F.coalesce("n2", F.lit(0))).alias("n"),
        )
        levels.append(stage(joined, "chat-pointers"))
    rooted = levels[-1].where("above is null")
    inner = levels[0].where("above is not null").select("tree", F.col("above").alias("message")).distinct()
    leaves = rooted.join(inner, ["tree", "message"], "left_anti")
    rank = Window.partitionBy("tree").orderBy((F.col("sum") / F.col("n")).desc(), F.col("n").desc(), "message")
    chosen = leaves.withColumn("path", F.row_number().over(rank))
    if paths_per_tree is not None:
        chosen = chosen.where(F.col("path") <= paths_per_tree)
    members = stage(chosen.select("tree", "path", F.col("message"), F.col("n").alias("place")), "chat-leaves")
    for power in range(len(levels) - 1, -1, -1):
        # The pointers of this power lead 2**power messages up, or to the root's top, which is null.
        pointer = levels[power].where("above is not null").select("tree", "message", "above")
        above = members.join(pointer, ["tree", "message"]).select(
            "tree", "path", F.col("above").alias("message"), (F.col("place") - (1 << power)).alias("place")
        )
        members = stage(members.unionByName(above), "chat-members")
    return members.join(told, ["tree", "message"]).select("tree", "path", "place", "role", "text")


def format_paths(paths: DataFrame) -> DataFrame:
    """One row per path: (tree, path, formatted, loss_spans, n_turns).

    ``loss_spans`` are the [start, end) code points of assistant texts as they
    stand in ``formatted``.
    """
    before, inside, after = _turn(F.col("role"), F.col("text"))
    turns = paths.select(
        "tree", "path", "place",
        F.struct("place", (F.col("role") == "assistant").alias("loss"), before.alias("b"), inside.alias("i"), after.alias("a")).alias("turn"),
    )
    gathered = turns.groupBy("tree", "path").agg(F.array_sort(F.collect_list("turn")).alias("turns"))
    spans = F.array().cast("array<struct<start:int,end:int>>")
    walked = F.aggregate(
        F.transform("turns", lambda t: F.struct(
            t["loss"].alias("loss"), F.length(t["b"]).alias("b"), F.length(t["i"]).alias("i"), F.length(t["a"]).alias("a"))),
        F.struct(F.lit(0).alias("at"), spans.alias("spans")),
        lambda acc, t: F.struct(
            (acc["at"] + t["b"] + t["i"] + t["a"]).alias("at"),
            F.when(
                t["loss"],
                F.concat(acc["spans"], F.array(F.struct((acc["at"] + t["b"]).alias("start"), (acc["at"] + t["b"] + t["i"]).alias("end")))),
            ).otherwise(acc["spans"]).alias("spans"),
        ),
        lambda acc: acc["spans"],
    )
    return gathered.select(
        "tree", "path",
        F.array_join(F.transform("turns", lambda t: F.concat(t["b"], t["i"], t["a"])), "").alias("formatted"),
        walked.alias("loss_spans"),
        F.size("turns").cast("long").alias("n_turns"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted text as (role, text), unescaped."""
    marks = F.regexp_extract_all(formatted, F.lit(_TURN), F.lit(1))
    bodies = F.regexp_extract_all(formatted, F.lit(_TURN), F.lit(2))

    def read(x: Column) -> Column:
        mark, body = x["mark"], x["body"]
        cut = F.instr(body, ROLE_END)
        role = F.substring(body, F.lit(1), cut - 1)
        text = F.substring(body, cut + len(ROLE_END), F.length(body))
        for name, (opening, _) in MARKS.items():
            role = F.when(mark == opening, F.lit(name)).otherwise(role)
            text = F.when(mark == opening, body).otherwise(text)
        return F.struct(unescape(role).alias("role"), unescape(text).alias("text"))

    return F.transform(F.arrays_zip(marks.alias("mark"), bodies.alias("body")), read)


def loss_texts(formatted: Column, spans: Column) -> Column:
    """The texts under the loss mask, unescaped, in order."""
    return F.transform(spans, lambda s: unescape(F.substring(formatted, s["start"] + 1, s["end"] - s["start"])))
