"""Inputs derived from the driver tables (adapter rows of the blueprint).

The driver tables have no preference pairs, log-probabilities, model answers or
judge scores; these functions derive them with Spark so that every downstream
job reads data whose size grows with the given tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from prefweave.functions.conversation import final_assistant_index, message_at
from prefweave.operators.conversations import turns_to_messages
from prefweave.operators.flat_turns import conversation_bounds, final_assistant_turns, number_turns
from prefweave.operators.keyed import join_by_key
from prefweave.sources.tables import stored

PREFIX_EDIT_EVERY = 13      # conversations whose id is a multiple get turn 0 edited
PREFIX_EDIT_SUFFIX = " (edited)"


def pairs_from_conversations(conversations: DataFrame) -> DataFrame:
    """One pair per conversation: chosen = the conversation; rejected = the same
    with its last assistant text replaced by that of the next conversation
    (``(conv_id + 1) mod #conversations``; its own text if that one has no
    assistant turn), and turn 0 edited for every 13th id to force a prefix
    mismatch. One shuffle folds the turns; the next-text lookup shuffles only
    ids and one text per conversation.
    """
    # Turns without a conversation id belong to no pair. Filtering them up
    # front keeps both uses of the fold identical, so Spark shuffles the turns
    # once and reuses that exchange for the next-text lookup; the count and the
    # id list are pruned by Catalyst to a distinct over conv_id alone.
    turns = conversations.where(F.col("conv_id").isNotNull())
    convs = turns_to_messages(turns).select(
        "conv_id", "messages", final_assistant_index("messages").alias("fi"))
    n_convs = convs.select(F.count(F.lit(1))).scalar()
    # The lookup moves only narrow (id, id) and (id, text) rows; the result
    # joins back on conv_id, the key the fold already partitioned the
    # conversations by, so the message arrays are shuffled once.
    last_text = convs.select(
        F.col("conv_id").alias("next_id"),
        message_at("messages", "fi").content.alias("alt_text"))
    alt = (convs.select("conv_id", ((F.col("conv_id") + 1) % n_convs).alias("next_id"))
           .join(last_text, "next_id").select("conv_id", "alt_text"))
    with_alt = convs.join(alt, "conv_id", "left")

    fi = F.col("fi")
    edit = (F.col("conv_id") % PREFIX_EDIT_EVERY == 0)

    def rejected_message(x, i):
        content = (F.when(i == fi, F.coalesce(F.col("alt_text"), x.content))
                   .when(edit & (i == 0) & (fi > 0), F.concat(x.content, F.lit(PREFIX_EDIT_SUFFIX)))
                   .otherwise(x.content))
        return F.struct(x.role.alias("role"), content.alias("content"))

    return with_alt.select(
        F.col("conv_id").alias("pair_id"),
        F.col("messages").alias("chosen"),
        F.transform("messages", rejected_message).alias("rejected"))


def varied_pairs(pairs: DataFrame) -> DataFrame:
    """The pairs with faults of every kind put in by ``pair_id % 16``: 1 a null
    conversation, 2 the last answer alone, 3 an unknown role in the second turn,
    4 a null role first, 5 a null content first, 6 a null content in the rejected
    answer, 7 an answer first. Both sides alike, so that prefixes still agree,
    but for 1 and 6."""
    kind, fi = F.col("pair_id") % 16, final_assistant_index("chosen")

    def faulty(side: str):
        def message(x, i):
            first = i == 0
            role = (F.when((kind == 3) & (i == 1) & (fi > 1), F.lit("tool"))
                    .when((kind == 4) & first & (fi > 0), F.lit(None).cast("string"))
                    .when((kind == 7) & first & (fi > 0), F.lit("assistant")).otherwise(x.role))
            content = F.when((kind == 5) & first & (fi > 0), F.lit(None).cast("string")).otherwise(x.content)
            if side == "rejected":
                content = F.when((kind == 6) & (i == fi), F.lit(None).cast("string")).otherwise(content)
            return F.struct(role.alias("role"), content.alias("content"))

        whole = F.transform(side, message)
        if side == "chosen":
            whole = F.when(kind != 1, whole)
        return F.when((kind == 2) & fi.isNotNull(), F.slice(side, fi + 1, 1)).otherwise(whole)

    return pairs.select("pair_id", faulty("chosen").alias("chosen"), faulty("rejected").alias("rejected"))


def flat_pairs_from_conversations(conversations: DataFrame) -> DataFrame:
    """The same pairs as flat turns ``pair_id, side, turn, role, text``, without
    an array per conversation: the last assistant text of the next conversation
    and the place of each turn come from narrow tables, one row a conversation."""
    key = ["conv_id"]
    numbered = number_turns(conversations.where(F.col("conv_id").isNotNull()), key)
    last = final_assistant_turns(numbered, key)
    n_convs = last.select(F.count(F.lit(1))).scalar()
    alt = last.select(F.col("conv_id").alias("next_id"), F.col("final_content").alias("alt_text"))
    bounds = conversation_bounds(numbered, key)
    per_conv = (bounds.withColumn("next_id", (F.col("conv_id") + 1) % n_convs).join(alt, "next_id", "left")
                .drop("next_id"))
    rows = join_by_key(numbered, stored(per_conv, "bounds"), key, "n_turns")
    fi, idx = F.col("_last") - F.col("_first"), F.col("_at") - F.col("_first")
    edited = (F.when(idx == fi, F.coalesce("alt_text", "text"))
              .when((F.col("conv_id") % PREFIX_EDIT_EVERY == 0) & (idx == 0) & (fi > 0),
                    F.concat("text", F.lit(PREFIX_EDIT_SUFFIX))).otherwise(F.col("text")))

    def side(name: str, text) -> DataFrame:
        return rows.select(F.col("conv_id").alias("pair_id"), F.lit(name).alias("side"), "turn", "role", text.alias("text"))

    return side("chosen", F.col("text")).unionByName(side("rejected", edited))


def logprobs_from_embeddings(embeddings: DataFrame) -> DataFrame:
    """Stand-in log-probabilities: four consecutive vectors per step; the four
    values of a pair are a hundred times the sums of its vector's quarters."""
    quarter = F.floor(F.size("embedding") / 4).cast("int")

    def total(i: int):
        part = F.slice("embedding", quarter * i + 1, quarter)
        return F.aggregate(part, F.lit(0.0), lambda s, x: s + x.cast("double")) * 100

    return embeddings.select(
        F.expr("vec_id div 4 + 1").alias("step"),
        F.col("vec_id").alias("pair_id"),
        *[total(i).alias(name) for i, name in enumerate(("pol_c", "pol_r", "ref_c", "ref_r"))])


def answers_from_documents(documents: DataFrame) -> DataFrame:
    """Each source plays a model; each block of 40 documents is a question, its
    halves the question's two turns."""
    return documents.select(
        F.expr("doc_id div 40").alias("question_id"),
        F.expr("cast(doc_id div 20 % 2 + 1 as int)").alias("turn"),
        F.col("source").alias("model"),
        F.col("n_chars"))


def judge_by_length(matchups: DataFrame) -> DataFrame:
    """Invented judge: the longer answer wins, within 10 % is a tie."""
    a, b = F.col("n_chars_a"), F.col("n_chars_b")
    winner = (F.when(F.abs(a - b) * 10 <= F.greatest(a, b), F.lit("tie"))
              .when(a > b, F.lit("a")).otherwise(F.lit("b")))
    return matchups.select("question_id", "model_a", "model_b", winner.alias("winner"))


def scores_from_labels(documents: DataFrame, labels: DataFrame) -> DataFrame:
    d = documents.select("doc_id", F.col("source").alias("model"))
    score = (1 + 6 * F.col("quality") + 3 * (1 - F.col("toxic"))).cast("double")
    return d.join(labels, "doc_id").select("model", F.lit(1).alias("turn"), score.alias("score"))


def prompts_from_benchmark(benchmark: DataFrame) -> DataFrame:
    return benchmark.select(F.col("item_id").alias("pos"), F.col("text").alias("prompt"))
