"""Reply trees to training conversations (DataFrame functions only).

Messages name their parent.  Self-joins that double their reach list each root-to-leaf path after
log2(depth) rounds; a tree's paths are ranked by the sum of their messages' scores and each chosen one is
formatted as a conversation, with the spans of the assistant's texts as loss mask.

Template: ``<|im_start|>ROLE\\nTEXT<|im_end|>\\n`` per turn.  Roles are url-encoded.  A control string inside
a text gets a backslash after its first character, one that has backslashes there gets one more; reading
removes one, so that every text comes back and no control string is left inside a text.

Defined results: a null text or role is empty; a message whose parent isn't there is a root; messages that
lead into a cycle reach no root and are in no path; of messages with the same id the first by (parent,
role, text) stands; an empty table gives no conversations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.shared import stored

START, END = "<|im_start|>", "<|im_end|>"
# Control strings of common chat templates, without their first character.
_REST = r"(\|im_start\|>|\|im_end\|>|\|endoftext\|>|/?s>|</?SYS>>|/?INST\])"
_ANY = r"([<\[])(\\*)" + _REST
_ESCAPED = r"([<\[])(\\*)\\" + _REST


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _ANY, r"$1$2\\$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPED, "$1$2$3")


def paths(messages: DataFrame) -> DataFrame:
    """(leaf, id, back): the messages of each root-to-leaf path, ``back`` steps before its leaf.

    ``messages``: id, parent (null or absent: a root), ids distinct.  After round k a path has its last
    2^k messages.  Each round is written, so lineage stays short and lost executors cost one round.
    """
    m = messages.select("id", "parent")
    up = stored(m.join(m.select(F.col("id").alias("parent")), "parent").select("id", F.col("parent").alias("to")), "tree-up")
    roots = stored(m.join(up, "id", "left_anti").select("id"), "tree-roots")
    found = stored(m.join(up.select(F.col("to").alias("id")).distinct(), "id", "left_anti").select(
        F.col("id").alias("leaf"), "id", F.lit(0).cast("long").alias("back")), "tree-paths")
    limit, reach = m.count(), 1
    while reach <= limit and not up.isEmpty():
        step = found.join(up, "id").select("leaf", F.col("to").alias("id"), (F.col("back") + reach).alias("back"))
        found = stored(found.unionByName(step), "tree-paths")
        up = stored(up.join(up.select(F.col("id").alias("to"), F.col("to").alias("next")), "to").select("id", F.col("next").alias("to")), "tree-up")
        reach *= 2
    ended = found.join(roots, "id", "left_semi").select("leaf")
    return found.join(ended, "leaf", "left_semi")


def chosen(found: DataFrame, messages: DataFrame, top: int | None) -> DataFrame:
    """(leaf, root, branch): each path's rank in its tree by the sum of scores (then leaf), up to ``top``."""
    s = found.join(messages.select("id", "score"), "id").groupBy("leaf").agg(
        F.max_by("id", "back").alias("root"), F.sum("score").alias("score"))
    s = s.withColumn("branch", F.row_number().over(Window.partitionBy("root").orderBy(F.desc("score"), "leaf")))
    return (s if top is None else s.where(F.col("branch") <= top)).select("leaf", "root", "branch")


def format_paths(messages: DataFrame, top: int | None = 1) -> DataFrame:
    """(root, leaf, branch, formatted, loss): ``messages`` has id, parent, role, text, score.

    ``loss``: spans (start, length) in code points of ``formatted``, those of the assistant's texts in order.
    """
    first = F.row_number().over(Window.partitionBy("id").orderBy("parent", "role", "text"))
    m = messages.where(F.col("id").isNotNull()).withColumn("__n", first).where("__n = 1").drop("__n")
    m = stored(m.select("id", "parent", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
                        F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score")), "messages")
    found = stored(paths(m), "tree-found")
    pick = chosen(found, m, top)
    turns = found.join(pick, "leaf").join(m.select("id", "role", "text"), "id")
    turns = turns.select("leaf", "root", "branch", "back", "role", F.concat(F.lit(START), F.url_encode("role"), F.lit("\n")).alias("head"),
                         escape(F.col("text")).alias("body"))
    turns = turns.withColumn("piece", F.concat("head", "body", F.lit(END + "\n")))
    before = F.sum(F.length("piece")).over(Window.partitionBy("leaf").orderBy(F.desc("back"))) - F.length("piece")
    turns = turns.withColumn("span", F.when(F.col("role") == "assistant", F.struct(
        (before + F.length("head")).cast("long").alias("start"), F.length("body").cast("long").alias("length"))))
    path = F.sort_array(F.collect_list(F.struct((-F.col("back")).alias("at"), "piece", "span")))  # one conversation each
    out = turns.groupBy("leaf").agg(F.first("root").alias("root"), F.first("branch").alias("branch"), path.alias("path"))
    return out.select("root", "leaf", "branch", F.array_join("path.piece", "").alias("formatted"),
                      F.filter("path.span", lambda s: s.isNotNull()).alias("loss"))


def read_back(formatted: Column) -> Column:
    """Array of (role, text) of a formatted conversation."""
    parts = F.slice(F.split(formatted, r"<\|im_start\|>"), 2, 1 << 30)
    return F.transform(parts, lambda p: F.struct(
        F.url_decode(F.substring_index(p, "\n", 1)).alias("role"),
        unescape(F.regexp_extract(p, r"(?s)^[^\n]*\n(.*)<\|im_end\|>\n$", 1)).alias("text")))


def masked_text(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped, one span after another."""
    return F.array_join(F.transform(loss, lambda s: unescape(F.substring(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")


def chains(conversations: DataFrame) -> DataFrame:
    """Messages (id, parent, role, text, score, conv_id) of linear conversations: each row answers the one
    before it by (turn, role, text).  A null conv_id is a conversation of its own."""
    n = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "text"))
    c = conversations.select("conv_id", "turn", "role", "text").withColumn("n", n)
    name = F.coalesce(F.col("conv_id").cast("string"), F.lit("null"))
    return c.select(F.concat_ws(":", name, F.col("n")).alias("id"), F.when(F.col("n") > 1, F.concat_ws(":", name, F.col("n") - 1)).alias("parent"),
                    "role", "text", F.length(F.coalesce("text", F.lit(""))).alias("score"), "conv_id")


def conversation_id(message_id: Column) -> Column:
    """conv_id of an id made by ``chains``."""
    return F.substring_index(message_id, ":", 1).try_cast("long")
