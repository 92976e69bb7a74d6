r"""Chat formatting as a prefix tree.

Conversations that share their first turns share those turns' nodes: a node is
a distinct prefix of (role, text) turns, named by a digest chained along the
path.  Each node's formatted text is emitted once, in depth-first order, with

* ``position``: the place of its first character on its own path, so position
  ids run on from its ancestors wherever the node stands in the stream;
* ``offset``: its place in the emitted stream;
* the attention intervals of its ancestors, [offset, offset + length) each.

Depth-first order is the order of the paths: conversations are range-sorted by
path and a node belongs to the first conversation that has it.  Paths are
compared by a digest of each prefix, so a hot first turn or a conversation
repeated thousands of times is dealt over ranges; nodes are found by a map-side
combined minimum; stream offsets are running sums over ranges of ranks.  No task
holds a whole tree.

Template, one turn: ``### role: text</turn>`` and a line feed.  Inside roles and
texts every ``\``, ``#``, ``<`` and (roles only) ``:`` gets a backslash before it, so
no control string can appear and reading is exact.  Loss is on assistant texts.

Defined results: null text and null role are empty; the rows of a conversation
are ordered by turn (null first), then role, then text, and repeated rows are
turns of their own; conversations with a null id form one; empty texts are
turns; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import table, written

HEAD, MIDDLE, TAIL = "### ", ": ", "</turn>\n"
ASSISTANT = "assistant"
PATH_BYTES = 6              # of each prefix digest in a path's sort key
RANKS_PER_RANGE = 4096


def escape(text: str, extra: str = "") -> str:
    for ch in "\\#<" + extra:
        text = text.replace(ch, "\\" + ch)
    return text


def unescape(text: str) -> str:
    out, at = [], 0
    while (i := text.find("\\", at)) >= 0:
        out.append(text[at:i])
        out.append(text[i + 1:i + 2])
        at = i + 2
    return "".join(out) + text[at:]


def format_turn(role: str, text: str) -> str:
    return f"{HEAD}{escape(role, ':')}{MIDDLE}{escape(text)}{TAIL}"


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a formatted conversation."""
    turns, at = [], 0
    while at < len(formatted):
        if not formatted.startswith(HEAD, at):
            raise ValueError(f"no turn starts at {at}")
        middle = _plain_index(formatted, MIDDLE, at + len(HEAD))
        tail = _plain_index(formatted, TAIL, middle + len(MIDDLE))
        turns.append((unescape(formatted[at + len(HEAD):middle]), unescape(formatted[middle + len(MIDDLE):tail])))
        at = tail + len(TAIL)
    return turns


def _plain_index(text: str, mark: str, at: int) -> int:
    """Where ``mark`` stands first from ``at`` on without a backslash that
    escapes it."""
    while True:
        found = text.index(mark, at)
        run = found
        while run > 0 and text[run - 1] == "\\":
            run -= 1
        if (found - run) % 2 == 0:
            return found
        at = found + 1


PATH = ("conv_id long, path binary, nodes array<struct<node: binary, depth: int, position: long, length: long, "
        "role: string, body: string>>")


def conversation_paths(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
                       text: str = "text") -> DataFrame:
    """One row per conversation: its path's sort key and its formatted turns."""
    rows = turns.select(F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).alias("turn"),
                        F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    talks = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("node", pa.binary()), ("depth", pa.int32()), ("position", pa.int64()),
                                   ("length", pa.int64()), ("role", pa.string()), ("body", pa.string())]))
        for batch in batches:
            paths, nodes = [], []
            for talk in batch.column(1):
                node, position, own, path = b"", 0, [], b""
                for depth, t in enumerate(talk):
                    r, x = t["role"].as_py(), t["text"].as_py()
                    body = format_turn(r, x)
                    node = hashlib.blake2b(node + body.encode("utf-8", "surrogatepass"), digest_size=16).digest()
                    path += node[:PATH_BYTES]
                    own.append({"node": node, "depth": depth, "position": position, "length": len(body), "role": r, "body": body})
                    position += len(body)
                paths.append(path)
                nodes.append(own)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(paths, pa.binary()), pa.array(nodes, kind)],
                                             names=["conv_id", "path", "nodes"])

    return talks.mapInArrow(run, PATH)


def prefix_tree(turns: DataFrame, **columns) -> tuple[DataFrame, DataFrame]:
    """(emitted, paths).

    ``emitted``: one row per node: node, depth, position, length, role, body,
    offset, rank (of the first conversation that has it).  Ordered by offset it
    is the depth-first stream.  ``paths``: one row per conversation turn:
    conv_id, depth, node.
    """
    talks = conversation_paths(turns, **columns)
    ranked = written(talks.repartitionByRange("path", "conv_id").sortWithinPartitions("path", "conv_id")
                     .withColumn("rank", F.monotonically_increasing_id()), "chat-ranked")
    steps = ranked.select("conv_id", "rank", F.explode("nodes").alias("n")).select("conv_id", "rank", "n.*")
    owners = steps.groupBy("node").agg(F.min("rank").alias("rank"))
    mine = steps.join(owners.withColumnRenamed("rank", "first_rank"), "node").where("rank = first_rank")
    mine = mine.dropDuplicates(["node"]).drop("first_rank", "conv_id")
    # running sums: ranges of ranks, ranks, then the nodes of one conversation
    area = (F.col("rank") / RANKS_PER_RANGE).cast("long")
    per_rank = written(mine.groupBy("rank").agg(F.sum("length").alias("chars")).withColumn("area", area), "chat-ranks")
    sums = per_rank.groupBy("area").agg(F.sum("chars").alias("chars"))
    coarse = sums.withColumn("zone", (F.col("area") / RANKS_PER_RANGE).cast("long"))
    zones = coarse.groupBy("zone").agg(F.sum("chars").alias("chars"))
    before = lambda *by: Window.partitionBy(*by[:-1]).orderBy(by[-1]).rowsBetween(Window.unboundedPreceding, -1)
    prior = lambda w: F.coalesce(F.sum("chars").over(w), F.lit(0))
    zones = zones.withColumn("zone_base", prior(before("zone"))).drop("chars")
    coarse = coarse.withColumn("area_base", prior(before("zone", "area"))).join(zones, "zone")
    base = (per_rank.withColumn("rank_base", prior(before("area", "rank")))
            .join(coarse.select("area", (F.col("area_base") + F.col("zone_base")).alias("area_base")), "area")
            .select("rank", (F.col("rank_base") + F.col("area_base")).alias("base")))
    inside = Window.partitionBy("rank").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    emitted = (mine.join(base, "rank")
               .withColumn("offset", (F.col("base") + F.coalesce(F.sum("length").over(inside), F.lit(0))).cast("long"))
               .select("node", "depth", "position", "length", "role", "body", "offset", "rank"))
    return written(emitted, "chat-emitted"), steps.select("conv_id", "depth", "node")


def attention(emitted: DataFrame, paths: DataFrame) -> DataFrame:
    """One row per conversation: conv_id and its turns in order, each with the
    interval [offset, offset + length) it attends to, its position and body.
    The intervals before a turn are those of its ancestors."""
    rows = paths.join(emitted, ["node", "depth"])
    turns = F.array_sort(F.collect_list(F.struct("depth", "offset", "length", "position", "role", "body")))
    return rows.groupBy("conv_id").agg(turns.alias("turns"))


READ = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, "
        "intervals array<struct<offset: long, length: long>>")


def read_back(emitted: DataFrame, paths: DataFrame) -> DataFrame:
    """Digests of each conversation as read from the emitted stream."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("offset", pa.int64()), ("length", pa.int64())]))
        for batch in batches:
            out: list[tuple] = []
            for conv, turns in zip(batch.column(0).to_pylist(), batch.column(1)):
                turns = turns.as_py()
                body = "".join(t["body"] for t in turns)
                read, loss = read_turns(body), []
                if len(read) != len(turns) or any(t["position"] != at for t, at in zip(turns, _starts(turns))):
                    raise ValueError(f"conversation {conv} does not read back")
                whole = hashlib.sha256()
                for r, x in read:
                    whole.update(f"{r}\n{x}\n".encode("utf-8", "surrogatepass"))
                    if r == ASSISTANT:
                        loss.append(x)
                text = "".join(loss)
                out.append((conv, len(read), whole.hexdigest(), len(text),
                            hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest(), len(body),
                            [{"offset": t["offset"], "length": t["length"]} for t in turns]))
            cols = list(zip(*out)) if out else [()] * 7
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), kind)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                             names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256",
                                                    "formatted_chars", "intervals"])

    return attention(emitted, paths).mapInArrow(run, READ)


def _starts(turns: list[dict]) -> list[int]:
    at, out = 0, []
    for t in turns:
        out.append(at)
        at += t["length"]
    return out


def op5(spark, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = r"\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", hard), (-7, 1, ASSISTANT, hard)], "conv_id long, turn long, role string, text string")
    emitted, paths = prefix_tree(turns.unionByName(extra))
    return read_back(emitted, paths).drop("intervals")
