"""Reply trees as training conversations.

Messages point to the message they answer. Iterative self-joins enumerate the paths from every leaf to its root; the
branches of a tree are ranked by score, and each chosen path becomes one formatted conversation with a loss mask.

The joins double the reach in every round, so a thread of depth d takes about log2(d) rounds, and the rows made are the
messages on the paths, no more. All of it is DataFrame expressions, and rounds hand over through written tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyframe.llm.common import via_table

ASSISTANT = "assistant"
HEADER, HEADER_END, TURN_END = "### ", ":\n", "\n</turn>\n"

#: A backslash, each # of a run of three or more, and the < of a closing mark.
_CONTROL = r"(\\|#(?=##)|(?<=#)#(?=#)|(?<=##)#|<(?=/turn>))"
_CONTROL_OR_BREAK = r"(\\|\n|#(?=##)|(?<=#)#(?=#)|(?<=##)#|<(?=/turn>))"


def escape(text: Column) -> Column:
    """The text with a backslash before whatever could be read as a mark of the template."""
    return F.regexp_replace(text, _CONTROL, r"\\$1")


def escape_role(role: Column) -> Column:
    """As ``escape``, and line breaks too, so that the header line ends where the template ends it."""
    return F.regexp_replace(role, _CONTROL_OR_BREAK, r"\\$1")


def unescape(text: Column) -> Column:
    """What ``escape`` and ``escape_role`` were given."""
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _jumps(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame | None]:
    """Tables of ancestors at distance 1, 2, 4, …, until none is left; and the nodes that never reach a root.

    The last are in or below a circle: then a round leaves as many rows as the one before, which no tree does.
    """
    parents = nodes.select("tree", F.col("id").alias("up"))
    jump = via_table(nodes.filter("parent IS NOT NULL").select("tree", "id", F.col("parent").alias("up")).join(parents, ["tree", "up"], "left_semi").select("tree", "id", "up"), "replies-jump")
    tables, rows = [], jump.count()
    while rows:
        tables.append(jump)
        further = jump.select("tree", F.col("id").alias("up"), F.col("up").alias("above"))
        jump = via_table(jump.join(further, ["tree", "up"]).select("tree", "id", F.col("above").alias("up")), "replies-jump")
        before, rows = rows, jump.count()
        if rows == before:
            return tables, jump.select("tree", "id")
    return tables, None


def root_to_leaf_paths(messages: DataFrame) -> DataFrame:
    """``tree, leaf, id, distance`` (from the leaf) for every message on the path of every leaf.

    ``messages`` has tree, id and parent, none of them NULL but the parent of a root; (tree, id) is unique. A message
    whose parent is missing is a root. Messages in or below a circle of replies have no root and so no path.
    """
    nodes = messages.select("tree", "id", "parent")
    jumps, lost = _jumps(nodes)
    answered = nodes.filter("parent IS NOT NULL").select("tree", F.col("parent").alias("id"))
    leaves = nodes.select("tree", "id").join(answered, ["tree", "id"], "left_anti")
    if lost is not None:
        leaves = leaves.join(lost, ["tree", "id"], "left_anti")
    paths = via_table(leaves.select("tree", F.col("id").alias("leaf"), "id", F.lit(0).alias("distance")), "replies-paths")
    for k, jump in enumerate(jumps):
        longer = paths.join(jump, ["tree", "id"]).select("tree", "leaf", F.col("up").alias("id"), (F.col("distance") + (1 << k)).alias("distance"))
        paths = via_table(paths.unionByName(longer), "replies-paths")
    return paths


def best_branches(paths: DataFrame, messages: DataFrame, per_tree: int) -> DataFrame:
    """``tree, leaf, score, branch`` of the ``per_tree`` branches with the highest mean score, ties to the smaller leaf.
    A NULL score counts as 0."""
    scores = paths.join(messages.select("tree", "id", "score"), ["tree", "id"])
    branches = scores.groupBy("tree", "leaf").agg(F.avg(F.coalesce("score", F.lit(0.0))).alias("score"))
    order = Window.partitionBy("tree").orderBy(F.desc("score"), "leaf")
    return branches.withColumn("branch", F.row_number().over(order)).filter(F.col("branch") <= per_tree)


def formatted_text(turns: Column) -> Column:
    return F.array_join(F.transform(turns, _turn_text), "")


def _turn_text(turn: Column) -> Column:
    return F.concat(F.lit(HEADER), escape_role(turn["role"]), F.lit(HEADER_END), escape(turn["text"]), F.lit(TURN_END))


def loss_spans(turns: Column) -> Column:
    """``array<struct<start, length>>``: where assistants' texts stand in the formatted text, in code points."""
    sizes = F.transform(
        turns,
        lambda t: F.struct(
            (F.lit(len(HEADER) + len(HEADER_END)) + F.length(escape_role(t["role"]))).alias("before"),
            F.length(escape(t["text"])).alias("length"),
            (t["role"] == ASSISTANT).alias("learned"),
        ),
    )
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))

    def add(done: Column, turn: Column) -> Column:
        span = F.struct((done["at"] + turn["before"]).alias("start"), turn["length"].alias("length"))
        after = done["at"] + turn["before"] + turn["length"] + F.lit(len(TURN_END))
        return F.struct(after.alias("at"), F.when(turn["learned"], F.concat(done["spans"], F.array(span))).otherwise(done["spans"]).alias("spans"))

    return F.aggregate(sizes, start, add, lambda done: done["spans"])


def parsed_turns(formatted: Column) -> Column:
    """Read turns back from a formatted text. A turn's end cannot stand inside an escaped text, so a split finds them."""
    pieces = F.filter(F.split(formatted, TURN_END), lambda piece: piece != "")

    def turn(piece: Column) -> Column:
        end = F.instr(piece, HEADER_END)
        role = F.substring(piece, F.lit(len(HEADER) + 1), end - (len(HEADER) + 1))
        text = F.substring(piece, end + len(HEADER_END), F.length(piece))
        return F.struct(unescape(role).alias("role"), unescape(text).alias("text"))

    return F.transform(pieces, turn)


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substring(formatted, s["start"] + 1, s["length"]))), "")


def reply_conversations(messages: DataFrame, per_tree: int = 1) -> DataFrame:
    """``tree, leaf, branch, score, formatted, loss`` for each chosen branch: the whole conversation in one row.

    ``messages`` has tree, id, parent, score, role and text. NULL texts and roles are empty; text is kept whole.
    """
    paths = root_to_leaf_paths(messages)
    chosen = best_branches(paths, messages, per_tree)
    said = messages.select("tree", "id", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = paths.join(chosen, ["tree", "leaf"]).join(said, ["tree", "id"])
    turn = F.struct((-F.col("distance")).alias("order"), "role", "text")
    turns = rows.groupBy("tree", "leaf", "branch", "score").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    return turns.select("tree", "leaf", "branch", "score", formatted_text(F.col("turns")).alias("formatted"), loss_spans(F.col("turns")).alias("loss"))


def threads(rows: DataFrame) -> DataFrame:
    """Messages of plain conversations (conv_id, turn, role, text): each turn answers the one before.

    Rows stand by turn; rows with the same turn by role and then text, and repeated rows all stay. A NULL conv_id is a
    conversation of its own. ``tree`` holds conv_id as text with a mark before it.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    place = rows.select("conv_id", "role", "text", F.row_number().over(order).alias("id"))
    tree = F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("NULL"))
    parent = F.when(F.col("id") > 1, F.col("id") - 1)
    return place.select("conv_id", tree.alias("tree"), "id", parent.alias("parent"), F.lit(1.0).alias("score"), "role", "text")


def conversation_report(rows: DataFrame) -> DataFrame:
    """Format every conversation and read the result back: sizes and digests of turns and of learned text."""
    messages = via_table(threads(rows), "replies-messages")
    out = via_table(reply_conversations(messages), "replies-formatted")
    names = messages.groupBy("tree").agg(F.first("conv_id").alias("conv_id"))
    turns = F.transform(F.col("turns"), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    read = out.withColumns({"turns": parsed_turns(F.col("formatted")), "learned": loss_text(F.col("formatted"), F.col("loss"))})
    return read.join(names, "tree").select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(turns, ""), 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
