"""Chat logs that hold a conversation once per turn collapse to the longest snapshot, which is
then rendered; DataFrame functions only.

A conversation's prefixes are told apart by rolling hashes: sums over the turns so far of hashes
of (position, role, text), so they come from running sums and need no conversation in one place.
A conversation goes if its whole hash is the hash of a proper prefix of another one, or of a
whole one with a smaller id. Of equal ones the smallest id stays. Equality rests on the number of
turns and three sums of 32-bit hashes; texts are not compared. Sums hold for 2^31 turns a conversation.

Turns are ordered by ``turn``, NULL first, then by role, then by a hash of the text; repeated
turns are turns. NULL roles and texts count as empty. Rows without ``conv_id`` are left out: they
belong to no conversation. An empty table gives no rows, and columns beside these four are ignored,
whatever their names. A very long conversation is never in one place: its turns are worked on in chunks, by turn
numbers and, where many turns share one, by role and text. Only ``documents`` puts it into one string. Copies of one
turn (number, role and text) stay in one chunk.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from herald.scale import keyed_join, settle

#: Turn numbers per chunk: a long conversation is worked on in chunks.
CHUNK = 256
#: Turns of a chunk above which it is dealt out further, by number, role and text.
CROWD = 4096
#: The rolling hashes, one seed each.
HASHES = ("h1", "h2", "h3")
START, END = "<|im_start|>", "<|im_end|>\n"


def chunked(rows: DataFrame) -> DataFrame:
    """Turns with their chunk. Chunks of a conversation compare as their turns do."""
    rows = rows.withColumn("span", F.coalesce(F.floor(F.col("turn") / CHUNK), F.lit(-(1 << 60))))
    crowded = (rows.groupBy("conv_id", "span").agg(F.count(F.lit(1)).alias("turns"))
               .filter(F.col("turns") > CROWD).select("conv_id", "span", F.lit(True).alias("crowded")))
    rows = keyed_join(rows, settle(crowded, "chat-crowded"), ["conv_id", "span"], "left")
    fine = lambda value, other: F.when(F.col("crowded"), value).otherwise(other)
    return rows.withColumn("chunk", F.struct(
        "span", fine(F.coalesce("turn", F.lit(0)), F.lit(0)).alias("turn"), fine(F.col("role"), F.lit("")).alias("role"),
        fine(F.shiftright("tie", 56), F.lit(0)).alias("tie"))).drop("span", "crowded")


def positions(conversations: DataFrame) -> DataFrame:
    """(conv_id, chunk, position, n_turns, role, text, h1, h2, h3, offset): every turn with its place
    from 1, its conversation's turns, the rolling hashes up to it and the characters rendered before it.

    Running sums go over a chunk; what precedes a chunk is a running sum over
    the chunks of a conversation, which are few beside its turns."""
    empty = F.lit("")
    rows = conversations.filter(F.col("conv_id").isNotNull()).select(
        "conv_id", F.col("turn").cast("bigint").alias("turn"),
        F.coalesce(F.col("role").cast("string"), empty).alias("role"),
        F.coalesce(F.col("text").cast("string"), empty).alias("text"))
    rows = chunked(rows.withColumn("tie", F.xxhash64("text")))
    chunk = ["conv_id", "chunk"]
    inside = (Window.partitionBy(*chunk).orderBy(F.asc_nulls_first("turn"), "role", "tie")
              .rowsBetween(Window.unboundedPreceding, 0))
    every = Window.partitionBy("conv_id")
    before = every.orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy(*chunk).agg(F.count(F.lit(1)).alias("turns"))
    offsets = sizes.select(*chunk, F.coalesce(F.sum("turns").over(before), F.lit(0)).alias("skip"),
                           F.sum("turns").over(every).alias("n_turns"))
    rows = rows.join(offsets, chunk).withColumn("position", F.col("skip") + F.count(F.lit(1)).over(inside))
    for seed, name in enumerate(HASHES, 1):
        rows = rows.withColumn(name, F.shiftrightunsigned(F.xxhash64(F.lit(seed), "position", "role", "text"), 32))
    rows = rows.withColumn("long", F.length(render()))
    summed = [*HASHES, "long"]
    sums = rows.groupBy(*chunk).agg(*[F.sum(c).alias(c) for c in summed])
    sums = sums.select(*chunk, *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"b_{c}") for c in summed])
    rows = rows.join(sums, chunk)
    run = lambda c: F.col(f"b_{c}") + F.sum(c).over(inside)
    return rows.select(*chunk, "position", "n_turns", "role", "text", *[run(h).alias(h) for h in HASHES],
                       (run("long") - F.col("long")).alias("offset"))


def maximal(turns: DataFrame) -> DataFrame:
    """(conv_id, n_turns) of the conversations that stay. A conversation's last turn has the hashes of
    the whole, all others those of its proper prefixes."""
    key = ["position", *HASHES]
    last = F.col("position") == F.col("n_turns")
    # equal conversations are one row before they meet the prefixes, prefixes are distinct too
    classes = turns.filter(last).groupBy(*key).agg(F.min("conv_id").alias("conv_id"))
    proper = turns.filter(~last).select(*key).distinct()
    return classes.join(proper, key, "left_anti").select("conv_id", F.col("position").alias("n_turns"))


def render():
    """One turn in chat markup."""
    return F.concat(F.lit(START), F.col("role"), F.lit("\n"), F.col("text"), F.lit(END))


def render_maximal(conversations: DataFrame) -> DataFrame:
    """(conv_id, n_turns, position, start, rendered): the kept conversations' turns in markup, with
    the place in code points at which each begins. Joined in order they are the conversation;
    ``documents`` does that."""
    turns = settle(positions(conversations), "chat-turns")
    chunk = ["conv_id", "chunk"]
    kept = turns.select(*chunk).distinct().join(maximal(turns).select("conv_id"), "conv_id", "left_semi")
    rows = turns.join(kept, chunk, "left_semi")
    return rows.select("conv_id", "n_turns", "position", F.col("offset").alias("start"),
                       render().alias("rendered"))


def documents(rendered: DataFrame) -> DataFrame:
    """(conv_id, n_turns, text): one string per conversation, which has to fit one row."""
    parts = F.array_sort(F.collect_list(F.struct("position", "rendered")))
    return rendered.groupBy("conv_id", "n_turns").agg(
        F.array_join(F.transform(parts, lambda p: p["rendered"]), "").alias("text"))
