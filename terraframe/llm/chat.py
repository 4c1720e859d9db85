"""Chat formatting on a prefix tree: conversations that begin with the same turns share what they share.

In the order of their formatted text, conversations are the leaves of a prefix tree in depth-first order, and a node
belongs to the first conversation that passes through it. The stream holds every node's text once; a conversation is
the list of the intervals of its nodes, which are also all that a node may attend to. Positions count from the start
of the conversation, so they are the same on every path through a node. Units are characters of the formatted text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .text import settle

# The control strings of the template.
START, END = "<|im_start|>", "<|im_end|>"
TRAINED = "assistant"
_END = r"<\|im_end\|>\n"


def escape(text: Column) -> Column:
    """Put one more backslash between ``<`` and ``|``, so that no control string is left."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", "<$1|")


def escape_role(role: Column) -> Column:
    """A role is one line: line ends become ``\\n`` and backslashes are doubled."""
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def unescape_role(role: Column) -> Column:
    """Between doubled backslashes, which are one, ``\\n`` is a line end."""
    parts = F.split(unescape(role), r"\\\\")
    return F.array_join(F.transform(parts, lambda s: F.replace(s, F.lit("\\n"), F.lit("\n"))), "\\")


def format_conversations(
    turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """The stream of nodes and the index of conversations.

    ``stream``: ``node, start, length, position, depth, content, loss_start, loss_length``; in the order of ``start`` the contents
    are the tree in depth-first order, each node once. ``index``: ``conv, depth, node, start, length``: the nodes of each
    conversation; those up to a depth are the attention intervals of the node at that depth.

    Turns are ordered by (turn, role, text), nulls first, and repeated rows are turns of their own. Null roles and texts count as
    empty. A null conversation id is a conversation. An empty table gives empty tables; further columns are ignored.
    """
    own = turns.select(
        F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("said"),
    )
    head = F.concat(F.lit(START), escape_role(F.col("role")), F.lit("\n"))
    own = own.select("conv", "turn", "role", "said", head.alias("head"), escape(F.col("said")).alias("body"))
    part = F.struct(
        F.concat("head", "body", F.lit(END + "\n")).alias("content"), F.char_length("head").alias("loss_start"),
        F.when(F.col("role") == TRAINED, F.char_length("body")).otherwise(0).alias("loss_length"),
    )
    grouped = own.groupBy("conv").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("turn", "role", "said", part.alias("part")))), lambda t: t["part"]).alias("parts")
    )
    # A node is the hash of the path to it.
    path = F.aggregate(
        "parts", F.array().cast("array<string>"),
        lambda seen, p: F.array_append(seen, F.sha2(F.concat(F.coalesce(F.get(seen, F.size(seen) - 1), F.lit("")), p["content"]), 256)),
    )
    grouped = grouped.select("conv", "parts", path.alias("path"))
    text = F.array_join(F.transform("parts", lambda p: p["content"]), "")
    ordered = grouped.withColumn("formatted", text).repartitionByRange("formatted", "conv").sortWithinPartitions("formatted", "conv")
    convs = settle(ordered.select("conv", "parts", "path", F.monotonically_increasing_id().alias("place")), "chat-conversations")
    steps = convs.select("conv", "place", F.posexplode("path").alias("depth", "node"))
    owners = steps.groupBy("node").agg(F.min("place").alias("place"))
    # All that a conversation owns lies at the end of its path: below the nodes it shares with the one before.
    owned = owners.groupBy("place").agg(F.count("*").alias("new"))
    leaves = convs.join(owned, "place").withColumn("shared", F.size("path") - F.col("new"))
    nodes = leaves.select(
        "place", "path", "shared",
        F.transform("parts", lambda p: F.char_length(p["content"])).alias("lengths"), "parts",
    )
    added = F.aggregate(F.slice("lengths", F.col("shared").cast("int") + 1, F.size("lengths")), F.lit(0).cast("long"), lambda a, x: a + x)
    chunk = F.shiftright("place", 33)  # the partition that wrote the conversation
    sums = settle(nodes.select("place", chunk.alias("chunk"), added.alias("added")), "chat-lengths")
    chunks = sums.groupBy("chunk").agg(F.sum("added").alias("added"))
    earlier = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("added").over(earlier(Window.orderBy("chunk"))), F.lit(0))  # a row per written partition
    firsts = chunks.select("chunk", before.alias("first"))
    within = F.coalesce(F.sum("added").over(earlier(Window.partitionBy("chunk").orderBy("place"))), F.lit(0))
    starts = sums.withColumn("within", within).join(firsts, "chunk").select("place", (F.col("first") + F.col("within")).alias("base"))
    placed = nodes.join(starts, "place")
    ends = F.transform(F.sequence(F.lit(0), F.size("lengths") - 1), lambda i: F.aggregate(
        F.slice("lengths", 1, i), F.lit(0).cast("long"), lambda a, x: a + x))
    items = F.arrays_zip(F.col("path").alias("node"), F.col("parts").alias("part"), F.col("lengths").alias("length"), ends.alias("position"))
    stream = placed.withColumn("items", items).select("base", "shared", F.posexplode("items").alias("depth", "item"), ends.alias("e"))
    stream = stream.where(F.col("depth") >= F.col("shared")).select(
        F.col("item.node").alias("node"),
        (F.col("base") + F.col("item.position") - F.get("e", F.col("shared").cast("int"))).alias("start"),
        F.col("item.length").cast("long").alias("length"), F.col("item.position").alias("position"), "depth",
        F.col("item.part.content").alias("content"), F.col("item.part.loss_start").alias("loss_start"),
        F.col("item.part.loss_length").alias("loss_length"),
    )
    stream = settle(stream, "chat-stream")
    index = settle(steps.drop("place").join(stream.select("node", "start", "length"), "node"), "chat-index")
    return stream, index


def read_back(stream: DataFrame, index: DataFrame) -> DataFrame:
    """Conversations from the output: ``conv, turns`` (role, text), ``loss`` (texts under the mask), ``formatted_chars``."""
    parts = index.select("conv", "depth", "start").join(stream.drop("node", "length", "position", "depth"), "start")
    whole = parts.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("depth", "content", "loss_start", "loss_length"))).alias("p"))
    formatted = F.array_join(F.transform("p", lambda p: p["content"]), "")
    whole = whole.select("conv", "p", formatted.alias("formatted"))
    pieces = F.split("formatted", _END)
    said = F.transform(
        F.slice(pieces, 1, F.size(pieces) - 1),
        lambda s: F.struct(
            unescape_role(F.substring_index(F.substr(s, F.lit(len(START) + 1)), "\n", 1)).alias("role"),
            unescape(F.substr(s, F.locate("\n", s) + 1)).alias("text"),
        ),
    )
    masked = F.transform(
        F.filter("p", lambda p: p["loss_length"] > 0),
        lambda p: unescape(F.substr(p["content"], p["loss_start"] + 1, p["loss_length"])),
    )
    return whole.select("conv", said.alias("turns"), masked.alias("loss"), F.char_length("formatted").cast("long").alias("formatted_chars"))


def digests(conversations: DataFrame) -> DataFrame:
    """What identifies a conversation that was read back."""
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("loss", "")
    return conversations.select(
        F.col("conv").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"), F.sha2(turns, 256).alias("turns_sha256"),
        F.char_length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"), "formatted_chars",
    )
