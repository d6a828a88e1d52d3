"""Chat formatting over a prefix tree of conversations.

Conversations that share their first turns share nodes: a node is the sequence of turns up to it. A
node's text is emitted once, in depth-first order of its tree, with the position it has inside a
conversation and the intervals of the layout that its ancestors take, which it may attend to.

A node is named by running sums of hashes of its turns and their places, so nodes are found by a
window and grouping, and nothing of a conversation's length squared is ever made. Distinct paths are
sorted; a node belongs to the first path that holds it, and the order of (path, depth) is depth-first
order. What a path owns is one run of the layout, so the ancestors of a node are a few runs. The
offsets are sums over the range-partitioned sort: no tree has to fit into one task, however many
conversations share its first turn.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridseries.llm.common import cut

#: Fixed values of the template. In texts and roles the backslash and the first character of every
#: control string are escaped, so no control string occurs in an escaped text.
OPEN, NAME_END, CLOSE = "### ", ": ", "</turn>\n"
ESCAPES = [("\\", "\\\\"), ("<", "\\l"), ("#", "\\h"), (":", "\\c")]
#: Turns of these roles are under the loss mask.
TRAINED_ROLES = ("assistant",)

TRAP = "\\### Assistant: </turn> ok"


def escape(text: Column) -> Column:
    for raw, coded in ESCAPES:
        text = F.replace(text, F.lit(raw), F.lit(coded))
    return text


def format_turn(role: Column, text: Column) -> Column:
    return F.concat(F.lit(OPEN), escape(role), F.lit(NAME_END), escape(text), F.lit(CLOSE))


def _named(turns: DataFrame) -> DataFrame:
    """Rows with ``idx`` (0, 1, ... in the conversation), ``node`` and ``parent`` (null for a first turn)."""
    rows = turns.select(
        F.col("conv_id").alias("conv"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )
    order = Window.partitionBy("conv").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    rows = rows.withColumn("idx", (F.row_number().over(order) - 1).cast("long"))
    running = order.rowsBetween(Window.unboundedPreceding, 0)
    # two independent 64-bit hashes; as decimals their sums neither overflow nor depend on the engine's checks
    total = lambda seed: F.sum(F.xxhash64("idx", "role", "text", F.lit(seed)).cast("decimal(20,0)")).over(running).cast("string")
    rows = rows.withColumn("node", F.concat_ws("|", "idx", total(1), total(2)))
    return rows.withColumn("parent", F.lag("node").over(order)).drop("turn")


def _offsets(frame: DataFrame, size: str) -> DataFrame:
    """``part, base``: sum of ``size`` over the parts before, one row per part (the only sums that meet in one task)."""
    totals = frame.groupBy("part").agg(F.sum(size).alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).cast("long").alias("base"))


def format_conversations(turns: DataFrame, trained_roles: tuple[str, ...] = TRAINED_ROLES, partitions: int | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(nodes, paths, conversations).

    ``nodes``: ``node, parent, depth, text`` (formatted), ``start`` and ``end`` in the layout of all
    trees, ``position`` of its first token inside a conversation, ``ancestors`` (array of ``start,
    end``, merged where they touch), ``loss_start`` and ``loss_end`` in the layout (null without a
    loss). Tokens are code points. ``paths``: ``leaf, idx, node`` of every distinct conversation.
    ``conversations``: ``conv_id, leaf``.

    Rows are ordered by turn, null turns first; rows of one turn are ordered by role and text, and
    repeated rows are turns of their own. Null texts and roles count as empty. Rows with a null
    ``conv_id`` make one conversation. Other columns are ignored; an empty table gives none.
    """
    rows = cut(_named(turns))
    leaves = rows.groupBy("conv").agg(F.max_by("node", "idx").alias("leaf"))
    conversations = cut(leaves)
    one = conversations.groupBy("leaf").agg(F.min_by("conv", F.struct(F.col("conv").isNotNull(), "conv")).alias("of"))
    # the layout is made of lengths; every node's text is joined to it once, at the end
    lengths = rows.select(
        "conv", "idx", "node", "parent", F.col("role").isin(*trained_roles).alias("trained"),
        F.length(F.concat(F.lit(OPEN), escape(F.col("role")), F.lit(NAME_END))).alias("lead"), F.length(escape(F.col("text"))).alias("inner"),
    )
    paths = lengths.join(one, lengths["conv"].eqNullSafe(one["of"])).select("leaf", "idx", "node", "parent", "trained", "lead", "inner")
    # distinct paths in order
    count = partitions or max(1, int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    trails = paths.groupBy("leaf").agg(F.transform(F.array_sort(F.collect_list(F.struct("idx", "node"))), lambda x: x["node"]).alias("trail"))
    ranked = cut(
        trails.repartitionByRange(count, "trail").sortWithinPartitions("trail")
        .select("leaf", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("rank"))
    )
    paths = cut(paths.join(ranked, "leaf"))
    # a node belongs to the first path that holds it
    nodes = paths.groupBy("node").agg(
        F.min_by(F.struct("part", "leaf", "idx", "parent", "trained", "lead", "inner"), "rank").alias("x"), F.min("rank").alias("rank")
    ).select("node", "rank", "x.*")
    nodes = cut(nodes.select(
        "node", "parent", F.col("idx").alias("depth"), "part", "rank", F.col("leaf").alias("owner"),
        F.when(F.col("trained"), F.struct("lead", "inner")).alias("loss"),
        (F.col("lead") + F.col("inner") + len(CLOSE)).cast("long").alias("size"),
    ))
    within = Window.partitionBy("part").orderBy("rank", "depth").rowsBetween(Window.unboundedPreceding, -1)
    laid = (
        nodes.join(_offsets(nodes, "size"), "part")
        .withColumn("start", F.col("base") + F.coalesce(F.sum("size").over(within), F.lit(0)))
        .withColumn("end", F.col("start") + F.col("size"))
    )
    laid = cut(laid.select("node", "parent", "depth", "owner", "start", "end", "loss"))
    # the runs of other owners on each path: these come before what the path owns itself
    spans = laid.select("node", "owner", "start", "end")
    before = (
        paths.select("leaf", "node").join(spans, "node").where("owner <> leaf")
        .groupBy("leaf", "owner").agg(F.min("start").alias("start"), F.max("end").alias("end"))
        .groupBy("leaf").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("before"))
    )
    runs = laid.groupBy("owner").agg(F.min("start").alias("run")).join(before, F.col("owner") == F.col("leaf"), "left").drop("leaf")
    empty = F.array().cast("array<struct<start:bigint,end:bigint>>")
    own = F.when(F.col("run") < F.col("start"), F.array(F.struct(F.col("run").alias("start"), F.col("start").alias("end")))).otherwise(empty)

    def merge(have: Column, span: Column) -> Column:
        last = F.try_element_at(have, F.lit(-1))
        grown = F.concat(F.slice(have, 1, F.greatest(F.size(have) - 1, F.lit(0))), F.array(F.struct(last["start"].alias("start"), span["end"].alias("end"))))
        return F.when(last["end"] == span["start"], grown).otherwise(F.concat(have, F.array(span)))

    texts = rows.dropDuplicates(["node"]).select("node", format_turn(F.col("role"), F.col("text")).alias("text"))
    out = laid.join(runs, "owner").withColumn("spans", F.concat(F.coalesce("before", empty), own)).join(texts, "node").select(
        "node", "parent", "depth", "text", "start", "end",
        F.aggregate("spans", F.lit(0).cast("long"), lambda s, x: s + x["end"] - x["start"]).alias("position"),
        F.aggregate("spans", empty, merge).alias("ancestors"),
        (F.col("start") + F.col("loss.lead")).alias("loss_start"),
        (F.col("start") + F.col("loss.lead") + F.col("loss.inner")).alias("loss_end"),
    )
    return out, paths.select("leaf", "idx", "node"), conversations.select(F.col("conv").alias("conv_id"), "leaf")


_PARSE = re.compile(re.escape(OPEN) + "(.*?)" + re.escape(NAME_END) + "(.*)" + re.escape(CLOSE), re.DOTALL)
_UNDO = {coded: raw for raw, coded in ESCAPES}


def undo(text: str) -> str:
    return re.sub(r"\\.", lambda m: _UNDO[m[0]], text, flags=re.DOTALL)


def read_back(nodes: DataFrame, paths: DataFrame, conversations: DataFrame) -> DataFrame:
    """The conversations as the formatted output has them: digests and lengths of each.

    Works on the emitted texts, positions and loss spans alone: the nodes of a path are put in order of
    their positions and parsed by the template. A task streams over the turns of its paths, so a
    conversation of any length takes the memory of a batch.
    """
    emitted = nodes.select("node", "position", "text", (F.col("loss_start") - F.col("start")).alias("loss_at"), (F.col("loss_end") - F.col("start")).alias("loss_to"))
    ordered = (
        paths.select("leaf", "node").join(emitted, "node").drop("node")
        .repartition("leaf").sortWithinPartitions("leaf", "position")
    )

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leaf, state = None, None
        schema = pa.schema([("leaf", pa.string()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])

        def row() -> tuple:
            return leaf, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]

        for batch in batches:
            done = []
            columns = (batch.column(c).to_pylist() for c in ("leaf", "position", "text", "loss_at", "loss_to"))
            for of, position, text, at, to in zip(*columns, strict=True):
                if of != leaf:
                    if state:
                        done.append(row())
                    leaf, state = of, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                if position != state[4]:
                    raise ValueError("the positions of a conversation leave a gap")
                role, body = map(undo, _PARSE.fullmatch(text).groups())
                state[0] += 1
                state[1].update(f"{role}\n{body}\n".encode())
                if at is not None:
                    trained = undo(text[at:to])
                    state[2] += len(trained)
                    state[3].update(trained.encode())
                state[4] += len(text)
            if done:
                yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in done], schema=schema)
        if state:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, row(), strict=True))], schema=schema)

    read = ordered.mapInArrow(digest, "leaf string, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
    return conversations.join(read, "leaf").drop("leaf")


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every conversation, read back from its formatted output."""
    given = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    trap = spark.createDataFrame([(-7, 0, "user", TRAP), (-7, 1, "assistant", TRAP)], "conv_id long, turn long, role string, text string")
    return read_back(*format_conversations(given.unionByName(trap)))


_SQL_ESCAPED = "replace(replace(replace(replace({0}, '\\', '\\\\'), '<', '\\l'), '#', '\\h'), ':', '\\c')"
ORACLE = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{TRAP}' UNION ALL SELECT -7, 1, 'assistant', '{TRAP}'
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
       sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn NULLS FIRST, role, text)) AS loss_sha256,
       sum(4 + length({_SQL_ESCAPED.format('role')}) + 2 + length({_SQL_ESCAPED.format('text')}) + 8)::BIGINT AS formatted_chars
FROM turns GROUP BY conv_id
"""
