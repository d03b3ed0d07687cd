"""Chat formatting of reply trees.

Messages point to their parents.  Self-joins that double their reach find
every message's depth, branch score and ancestors at distances of powers of
two, so a thread of n messages takes about log2(n) joins.  Branches (leaves)
are ranked by total score within their tree; the paths of the chosen ones are
enumerated with the ancestor tables, each message once a path, and formatted as
one conversation.

Template: a turn under the loss is ``<s>role\\ntext</s>``, any other
``[INST]role\\ntext[/INST]``.  Control strings inside a text get a backslash
after their first character (``<\\/s>``, one more where there are some), and
lose it when read; a role's backslashes and newlines are written ``\\b``, ``\\n``.

Defined results: null text or role: empty; a null tree is a tree of its own; a
parent that does not exist makes a root; messages on a cycle hang from no root
and are in no path; equal scores rank longer branches first, then the smaller
leaf; rows that repeat a (tree, node) are not allowed in trees, while the query
numbers its rows, so repeated turns stay turns of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common as C

LOSS_ROLE = "assistant"
TURN = r"(?s)(?:<s>|\[INST\])(.*?)(?:</s>|\[/INST\])"


def escaped(text: Column) -> Column:
    text = F.regexp_replace(text, r"<(\\*)(/?s>)", r"<\\$1$2")
    return F.regexp_replace(text, r"\[(\\*)(/?INST\])", r"[\\$1$2")


def unescaped(text: Column) -> Column:
    text = F.regexp_replace(text, r"<\\(\\*)(/?s>)", r"<$1$2")
    return F.regexp_replace(text, r"\[\\(\\*)(/?INST\])", r"[$1$2")


def written_role(role: Column) -> Column:
    return escaped(F.replace(F.replace(role, F.lit("\\"), F.lit("\\b")), F.lit("\n"), F.lit("\\n")))


def read_role(role: Column) -> Column:
    return F.replace(F.replace(unescaped(role), F.lit("\\n"), F.lit("\n")), F.lit("\\b"), F.lit("\\"))


def root_to_leaf_paths(messages: DataFrame, branches: int | None = 1) -> DataFrame:
    """(tree, path, node, depth) for the ``branches`` best leaves of every tree
    (all if None).  messages: tree, node, parent, score."""
    C.prepare(messages.sparkSession)
    nodes = messages.select("tree", "node", "parent", F.coalesce("score", F.lit(0.0)).cast("double").alias("score"))
    present = nodes.select("tree", F.col("node").alias("parent"), F.lit(True).alias("known"))
    state = nodes.join(present, ["tree", "parent"], "left").select(
        "tree", "node", F.when(F.col("known"), F.col("parent")).alias("up"), F.lit(1).cast("long").alias("depth"),
        "score").checkpoint()
    parents = state.where("up is not null").select("tree", F.col("up").alias("node")).distinct()
    most = state.groupBy("tree").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    reach = []
    while (1 << len(reach)) <= 2 * most:
        ups = state.where("up is not null").select("tree", "node", "up")
        if ups.isEmpty():
            break
        reach.append(ups)
        above = state.select("tree", F.col("node").alias("up"), F.col("up").alias("up2"),
                             F.col("depth").alias("depth2"), F.col("score").alias("score2"))
        # roots are finished; only the others go on
        state = (state.where("up is not null").join(above, ["tree", "up"])
                 .select("tree", "node", F.col("up2").alias("up"), (F.col("depth") + F.col("depth2")).alias("depth"),
                         (F.col("score") + F.col("score2")).alias("score"))
                 .unionByName(state.where("up is null")).checkpoint())
    best = Window.partitionBy("tree").orderBy(F.desc("score"), F.desc("depth"), "node")
    leaves = state.where("up is null").join(parents, ["tree", "node"], "left_anti").withColumn("k", F.row_number().over(best))
    if branches is not None:
        leaves = leaves.where(F.col("k") <= branches)
    members = leaves.select("tree", F.col("k").alias("path"), "node").checkpoint()
    for ups in reversed(reach):
        members = members.unionByName(members.join(ups, ["tree", "node"]).select("tree", "path", F.col("up").alias("node"))
                                      ).checkpoint()
    return members.join(state.select("tree", "node", "depth"), ["tree", "node"])


def format_conversations(messages: DataFrame, branches: int | None = 1, loss_role: str = LOSS_ROLE) -> DataFrame:
    """tree, path, formatted, loss: code point spans [start, end) of the text under the loss."""
    key = messages.withColumn("tree", F.coalesce(F.concat(F.lit("="), F.col("tree").cast("string")), F.lit("")))
    paths = root_to_leaf_paths(key.select("tree", "node", "parent", "score"), branches)
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    loss = role == loss_role
    head = F.concat(F.when(loss, "<s>").otherwise("[INST]"), written_role(role), F.lit("\n"))
    body, tail = escaped(text), F.when(loss, "</s>").otherwise("[/INST]")
    pieces = (paths.join(key.select("tree", "node", "role", "text"), ["tree", "node"])
              .select("tree", "path", "depth", loss.alias("loss"), F.concat(head, body, tail).alias("piece"),
                      F.length(head).alias("head"), F.length(body).alias("body")))
    before = Window.partitionBy("tree", "path").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    at = F.coalesce(F.sum(F.length("piece")).over(before), F.lit(0)) + F.col("head")
    turns = pieces.withColumn("span", F.struct(at.alias("start"), (at + F.col("body")).alias("end")))
    return (turns.groupBy("tree", "path").agg(F.array_sort(F.collect_list(F.struct("depth", "piece", "loss", "span"))).alias("t"))
            .select(F.expr("substring(tree, 2)").alias("tree"), (F.col("tree") == "").alias("null_tree"), "path",
                    F.array_join(F.transform("t", lambda x: x["piece"]), "").alias("formatted"),
                    F.transform(F.filter("t", lambda x: x["loss"]), lambda x: x["span"]).alias("loss")))


def read_back(formatted: Column) -> Column:
    """Array of (role, text) of a formatted conversation."""
    def turn(body):
        role = F.substring_index(body, "\n", 1)
        return F.struct(read_role(role).alias("role"),
                        unescaped(F.substring(body, F.length(role) + 2, F.length(body))).alias("text"))
    return F.transform(F.regexp_extract_all(formatted, F.lit(TURN), F.lit(1)), turn)


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every formatted conversation, read back from the output."""
    turns = C.read(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("long").alias("tree"), F.col("turn").cast("long").alias("turn"), "role", "text")
    said = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)],
                                 "tree long, turn long, role string, text string")
    order = Window.partitionBy("tree").orderBy("turn", "role", "text")
    rows = turns.unionByName(more).withColumn("node", F.row_number().over(order).cast("long"))
    messages = C.stored(rows.select("tree", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"),
                                    F.lit(1.0).alias("score"), "role", "text"))
    out = format_conversations(messages)
    back = read_back(F.col("formatted"))
    loss = F.array_join(F.transform("loss", lambda s: unescaped(
        F.substring("formatted", (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))), "")
    turns_text = F.array_join(F.transform("back", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return (out.withColumns({"back": back, "loss_text": loss})
            .select(F.when(~F.col("null_tree"), F.col("tree").cast("long")).alias("conv_id"),
                    F.size("back").cast("long").alias("n_turns"), F.sha2(turns_text, 256).alias("turns_sha256"),
                    F.length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"),
                    F.length("formatted").cast("long").alias("formatted_chars")))
