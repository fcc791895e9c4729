"""Chat formatting: reply trees to conversations under a reversible template.

Messages form trees by their parent ids.  Iterative self-joins enumerate the root-to-leaf
paths: every message points to its parent, and each round joins the pointers with
themselves, so that they reach twice as far (a tree of depth d takes log2 d rounds).  The
sums carried along give the score of each leaf's path; the best branches of a tree are
chosen by score, and the pointers of all rounds, applied from the longest to the shortest,
list the messages of the chosen paths.  Each path is formatted as one conversation.
DataFrame functions only.

The template writes a turn as ``<s>[INST]role[/INST]text</s>``.  Inside roles and texts a
backslash is doubled and one is put into every control string, so none of them remains;
removing backslashes restores the text.  The loss mask covers the texts of assistants, in
the first chosen path that holds them.

Joins are on message ids, which do not repeat, so a tree that holds a third of all messages
is spread like any other; one conversation is one row of the result and must fit a task.

Defined cases: null texts and roles are empty; a parent that does not exist makes a root;
messages on a cycle or below one belong to no path; equal scores go to the smaller leaf id;
rows of a conversation that share a turn are ordered by role and text; rows with a null
conversation id form one conversation; an empty table gives no rows.  Other columns do not
pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitrail.llm.common import NO_ID, table, text_of, written

#: Fixed values of the template.
START, HEAD, BODY, END = "<s>", "[INST]", "[/INST]", "</s>"
#: A backslash, or the first character of a control string.
CONTROL = r"(\\|<(?=/?s>)|\[(?=/?INST\]))"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, CONTROL, r"$1\\")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


# ------------------------------------------------------------------ trees

def by_turn(conversations: DataFrame) -> DataFrame:
    """(tree, node, parent, role, text, score): each turn replies to the one before it."""
    rows = conversations.select(
        F.coalesce(F.col("conv_id"), F.lit(NO_ID)).cast("long").alias("tree"), "turn",
        text_of("role").alias("role"), text_of("text").alias("text"))
    at = F.row_number().over(Window.partitionBy("tree").orderBy("turn", "role", "text"))
    rows = rows.withColumn("node", at.cast("long"))
    return rows.select("tree", "node", F.when(F.col("node") > 1, F.col("node") - 1)
                       .alias("parent"), "role", "text", F.lit(1.0).alias("score"))


def pointers(messages: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """The pointers of every round, (tree, node, above), and the messages that a root
    reaches: (tree, node, depth, total), total being the score of the path so far."""
    ids = messages.select("tree", F.col("node").alias("parent"), F.lit(True).alias("there"))
    now = messages.select("tree", "node", "parent", "score").join(
        ids, ["tree", "parent"], "left").select(
        "tree", "node", F.when(F.col("there"), F.col("parent")).alias("above"),
        F.lit(0).cast("long").alias("depth"), F.col("score").alias("total"))
    # depth counts the steps made so far; a step is made where there is a message above
    now = written(now.withColumn("depth", F.when(F.col("above").isNull(), 0).otherwise(1)
                                 .cast("long")), "chat-step")
    rounds, open_before = [], None
    at_root, open_ = now.where(F.col("above").isNull()), now.where(F.col("above").isNotNull())
    while True:
        open_now = open_.count()
        if open_now == 0 or open_now == open_before:
            break  # all at a root, or only cycles are left
        rounds.append(open_.select("tree", "node", "above"))
        open_before = open_now
        # from the message above: how far it has come, and what its path adds up to; only
        # messages that are not yet at a root take part in a round
        far = at_root.unionAll(open_).select(
            "tree", F.col("node").alias("above"), F.col("above").alias("next"),
            F.col("depth").alias("more"), F.col("total").alias("gain"))
        now = written(open_.join(far, ["tree", "above"]).select(
            "tree", "node", F.col("next").alias("above"),
            (F.col("depth") + F.col("more")).alias("depth"),
            (F.col("total") + F.col("gain")).alias("total")), "chat-step")
        at_root = at_root.unionAll(now.where(F.col("above").isNull()))
        open_ = now.where(F.col("above").isNotNull())
    return rounds, at_root.select("tree", "node", "depth", "total")


def chosen_paths(messages: DataFrame, branches: int = 1) -> DataFrame:
    """(tree, branch, node, depth, first): the messages of the ``branches`` best paths of
    each tree; ``first`` marks a message in the first chosen path that holds it."""
    rounds, reached = pointers(messages)
    parents = messages.where(F.col("parent").isNotNull()).select(
        "tree", F.col("parent").alias("node")).distinct()
    leaves = reached.join(parents, ["tree", "node"], "left_anti")
    best = Window.partitionBy("tree").orderBy(F.desc("total"), "node")
    path = leaves.withColumn("branch", F.row_number().over(best)).where(
        F.col("branch") <= branches).select("tree", "branch", "node")
    for step in reversed(rounds):
        above = path.join(step, ["tree", "node"]).select(
            "tree", "branch", F.col("above").alias("node"))
        path = written(path.unionAll(above), "chat-path")
    path = path.join(reached.select("tree", "node", "depth"), ["tree", "node"])
    if branches == 1:
        return path.withColumn("first", F.lit(True))
    once = Window.partitionBy("tree", "node").orderBy("branch")
    return path.withColumn("first", F.row_number().over(once) == 1)


# ------------------------------------------------------------------ template

def format_paths(messages: DataFrame, paths: DataFrame, learner: str = "assistant") -> DataFrame:
    """(tree, branch, formatted, segments): one conversation per path; ``segments`` are the
    consecutive parts of ``formatted`` with a flag for those under the loss mask."""
    rows = paths.join(messages.select("tree", "node", "role", "text"), ["tree", "node"])
    rows = rows.select("tree", "branch", F.struct(
        "depth", escaped(F.col("role")).alias("role"), escaped(F.col("text")).alias("text"),
        ((F.col("role") == learner) & F.col("first")).alias("loss")).alias("turn"))
    told = rows.groupBy("tree", "branch").agg(F.sort_array(F.collect_list("turn")).alias("turns"))

    def parts(t: Column) -> Column:
        return F.array(
            F.struct(F.concat(F.lit(START + HEAD), t["role"], F.lit(BODY)).alias("text"),
                     F.lit(False).alias("loss")),
            F.struct(t["text"].alias("text"), t["loss"].alias("loss")),
            F.struct(F.lit(END).alias("text"), F.lit(False).alias("loss")))

    told = told.withColumn("segments", F.flatten(F.transform("turns", parts)))
    return told.select("tree", "branch", F.array_join("segments.text", "").alias("formatted"),
                       "segments")


def turns_of(formatted: str) -> Column:
    """The (role, text) pairs of a formatted conversation, read back by its marks alone."""
    turns = F.split(formatted, END)
    return F.transform(F.slice(turns, 1, F.size(turns) - 1), lambda t: F.struct(
        unescaped(F.substring_index(t, BODY, 1).substr(
            F.lit(len(START + HEAD) + 1), F.length(t))).alias("role"),
        unescaped(F.substring_index(t, BODY, -1)).alias("text")))


def loss_text(segments: str) -> Column:
    """All text under the loss mask, as it was before escaping."""
    learned = F.filter(segments, lambda s: s["loss"])
    return F.array_join(F.transform(learned, lambda s: unescaped(s["text"])), "")


#: A conversation whose texts consist of control strings.
PROBE = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


def op3_chat_format(spark, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame(PROBE, "conv_id long, turn long, role string, text string")
    messages = written(by_turn(rows.unionByName(probe)), "chat-messages")
    told = format_paths(messages, chosen_paths(messages))
    told = told.withColumn("turns", turns_of("formatted")).withColumn(
        "learned", loss_text("segments"))
    said = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return told.select(
        F.when(F.col("tree") != NO_ID, F.col("tree")).alias("conv_id"),
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(said, "").cast("binary"), 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2(F.col("learned").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


OP3_SQL = r"""
WITH rows_ AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text))
         AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text)
                       FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(20 + length(regexp_replace(role, '(\\|</?s>|\[/?INST\])', '\0.', 'g'))
              + length(regexp_replace(text, '(\\|</?s>|\[/?INST\])', '\0.', 'g')))::BIGINT
         AS formatted_chars
FROM rows_ GROUP BY conv_id
"""
