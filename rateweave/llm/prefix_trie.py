"""The prefix trie of conversations, built as a burst trie.

Turns get ids (128 bits of a SHA-256 of role and text); a conversation is the
string of its turns' ids, so the texts are read once.  Copies are counted as
one sequence.  All sequences begin in the container under the root's head; a
container with more than ``CONTAINER`` sequences is burst: its head grows to
the turns that all of them share, and they go on to containers by their next
turn id, until none is too large.  The remaining containers are dealt to
shards by head, sorted, and each is swept once, with a stack as deep as a path,
into its nodes.  The burst heads are then completed from below, round by round
backwards; there is one for ``CONTAINER`` sequences at most.
"""

from __future__ import annotations

import hashlib
import os
from functools import reduce

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from rateweave.llm._common import stored

#: Conversations that share their first turns: those of a hundred neighbouring ids.
NEIGHBOURS, MOST_SHARED = 100, 6
#: Sequences that a container holds at most before it is burst.
CONTAINER = 256
#: Characters of a turn's id.
ID = 32
EMPTY = hashlib.sha256(b"").hexdigest()
_NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def turn_id(role: Column, text: Column) -> Column:
    """The same for turns of equal role and text only."""
    said = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return F.substring(F.sha2(said.cast("binary"), 256), 1, ID)


def rebuilt(
    conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """``(conv_id, path, chars)``: every conversation rebuilt, as its turns' ids in a row and their lengths.

    Turns are ordered by number (null first, equal ones by id); a null role or
    text is empty; rows without a conversation are left out.  Conversation
    ``c`` begins with the first ``h`` turns of ``c - c % 100``, as many as
    there are, and goes on with its own after its first ``h``;
    ``h = crc32(c) % 6``; a remainder has its dividend's sign, as in SQL.  A
    conversation is one row of 36 bytes a turn.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in (role_col, text_col))
    turn = F.struct(F.col(turn_col).alias("turn"), turn_id(role, text).alias("id"), F.length(text).alias("chars"))
    known = conversations.where(F.col(conv_col).isNotNull()).select(F.col(conv_col).alias("conv_id"), turn.alias("t"))
    own = stored(known.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns")), "trie-turns")
    base = F.col("conv_id") - F.col("conv_id") % NEIGHBOURS
    heads = own.where(F.col("conv_id") == base).select(F.col("conv_id").alias("base"), F.slice("turns", 1, MOST_SHARED).alias("lead"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % MOST_SHARED).cast("int")
    rows = own.select("conv_id", "turns", base.alias("base"), h.alias("h")).join(heads, "base", "left")
    lead = F.coalesce(F.slice("lead", F.lit(1), F.col("h")), F.slice("turns", 1, 0))
    turns = F.concat(lead, F.slice("turns", F.col("h") + 1, F.size("turns")))
    rows = rows.select("conv_id", turns.alias("turns"))
    path = F.array_join(F.transform("turns", lambda t: t["id"]), "")
    return rows.select("conv_id", path.alias("path"), F.transform("turns", lambda t: t["chars"]).alias("chars"))


def _ends(members: DataFrame) -> DataFrame:
    """``(key, n, conv_id, ends)`` of each distinct path: its conversations, the smallest, and the digest of their ids in order.

    Ids are first put together by ranges, so that many copies of one path
    reach the task that digests them as a few rows.
    """

    def together(batches):
        for batch in batches:
            found: dict[str, list] = {}
            for own_id, key in zip(batch.column("conv_id").to_pylist(), batch.column("key").to_pylist()):
                found.setdefault(key, []).append(own_id)
            rows = [(k, ids[0], len(ids), ",".join(map(str, ids))) for k, ids in found.items()]
            columns = list(zip(*rows)) or [()] * 4
            types = [pa.string(), batch.column("conv_id").type, pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["key", "conv_id", "n", "ids"])

    def digested(batches):
        now, out, digest = None, [], None
        id_type = pa.int64()
        for batch in batches:
            id_type = batch.column("conv_id").type
            for key, own_id, n, ids in zip(*(batch.column(c).to_pylist() for c in ("key", "conv_id", "n", "ids"))):
                if now is None or key != now[0]:
                    if now is not None:
                        out.append((*now, digest.hexdigest()))
                    now, digest = [key, 0, own_id], hashlib.sha256()
                else:
                    digest.update(b",")
                digest.update(ids.encode())
                now[1] += n
            yield _batch(out, id_type)
            out = []
        if now is not None:
            yield _batch([(*now, digest.hexdigest())], id_type)

    def _batch(rows, id_type):
        columns = list(zip(*rows)) or [()] * 4
        types = [pa.string(), pa.int64(), id_type, pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["key", "n", "conv_id", "ends"])

    id_type = members.schema["conv_id"].dataType.simpleString()
    ordered = members.select("conv_id", "key").repartitionByRange(_ranges(members), "conv_id").sortWithinPartitions("conv_id")
    pieces = stored(ordered.mapInArrow(together, f"key string, conv_id {id_type}, n bigint, ids string"), "trie-members")
    pieces = pieces.repartition(_ranges(members), "key").sortWithinPartitions("key", "conv_id")
    return pieces.mapInArrow(digested, f"key string, n bigint, conv_id {id_type}, ends string")


def _ranges(df: DataFrame) -> int:
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def sequences(members: DataFrame) -> DataFrame:
    """``(path, chars, n, conv_id, ends)``, one row for each distinct path; written once."""
    keyed = stored(members.select("*", F.sha2(F.col("path").cast("binary"), 256).alias("key")), "trie-rebuilt")
    paths = keyed.groupBy("key").agg(F.any_value("path").alias("path"), F.any_value("chars").alias("chars"))
    return stored(paths.join(_ends(keyed), "key").drop("key"), "trie-sequences")


@F.pandas_udf(IntegerType())
def _shared(least: pd.Series, most: pd.Series) -> pd.Series:
    """Turns that two paths share."""
    return pd.Series([len(os.path.commonprefix(pair)) // ID for pair in zip(least, most)], dtype="int32")


def _chars(depth) -> Column:
    """The code points of the last text at a depth; none at the root."""
    return F.when(depth > 0, F.get("chars", depth - 1)).otherwise(0).cast("bigint")


def _burst(active: DataFrame, limit: int) -> tuple[list[DataFrame], list[tuple[DataFrame, DataFrame]]]:
    """The containers that are small enough, and of each round the burst heads with what ends at them."""
    small, rounds = [], []
    while True:
        heads = active.groupBy("head", "depth", "parent").agg(
            F.count("*").alias("held"), F.min("path").alias("least"), F.max("path").alias("most"),
            F.sum("n").alias("n"), F.min("conv_id").alias("conv_id"), F.min_by("chars", "path").alias("chars"),
        )
        grown = heads.where(F.col("held") > limit).select("head", "depth", "parent", "n", "conv_id", "chars", _shared("least", "most").alias("to"))
        grown = stored(grown, "trie-heads")
        if grown.isEmpty():
            return [*small, active], rounds
        large = grown.select("head", "to")
        small.append(active.join(large, "head", "left_anti"))
        inside = active.join(large, "head")
        done = F.length("path") == F.col("to") * ID
        ended = stored(inside.where(done).select("head", "ends"), "trie-ended")
        rounds.append((grown, ended))
        deeper = (F.col("to") + 1).alias("depth")
        prefix = F.col("path").substr(F.lit(1), (F.col("to") + 1) * ID)
        below = inside.where(~done).select(
            F.sha2(prefix.cast("binary"), 256).alias("head"), deeper, F.col("head").alias("parent"), "path", "chars", "n", "conv_id", "ends"
        )
        active = stored(below, "trie-active")


def swept(rows: list[tuple], emit) -> None:
    """The nodes of one container, from its ``(depth, path, chars, n, conv_id, ends)`` sorted by path.

    ``emit(node, parent_conv_id)`` gets every node, the container's own last,
    with ``None``; a node is ``[depth, chars, n_convs, conv_id, n_children,
    n_leaves, saved, ends, its children]``.
    """
    stack: list[list] = []

    def close() -> None:
        node = stack.pop()
        depth, chars, n, own_id, children, leaves = node[:6]
        node[5] = leaves or 1
        node[6] += (n - 1) * chars
        for child in node[8]:
            emit(child, own_id)
        node[8] = []
        if stack:
            above = stack[-1]
            above[2] += n
            above[3] = own_id if above[3] is None else min(above[3], own_id)
            above[4] += 1
            above[5] += node[5]
            above[6] += node[6]
            above[8].append(node)
        else:
            emit(node, None)

    last = None
    for top, path, chars, n, own_id, ends in rows:
        length = len(path) // ID
        shared = top - 1 if last is None else len(os.path.commonprefix((last, path))) // ID
        while stack and stack[-1][0] > shared:
            close()
        for depth in range(max(shared + 1, top), length + 1):
            stack.append([depth, int(chars[depth - 1]) if depth else 0, 0, None, 0, 0, 0, EMPTY, []])
        end = stack[-1]
        end[2], end[7] = end[2] + n, ends
        end[3] = own_id if end[3] is None else min(end[3], own_id)
        last = path
    while stack:
        close()


def _swept(containers: DataFrame) -> DataFrame:
    """The nodes of all containers, and for each container's own one its head and its parent's head."""
    id_type = containers.schema["conv_id"].dataType.simpleString()
    names = ["head", "parent", *_NODE]

    def run(batches):
        held: list[tuple] = []
        now, own_type = (None, None), pa.int64()

        def nodes():
            out: list[tuple] = []

            def emit(node, above):
                depth, _, n, own_id, children, leaves, saved, ends, _ = node
                head, parent = now if above is None else (None, None)
                out.append((head, parent, own_id, depth, above, n, children, leaves, saved, ends))

            swept(held, emit)
            columns = list(zip(*out)) or [()] * len(names)
            kinds = [pa.string(), pa.string(), own_type, pa.int64(), own_type, *[pa.int64()] * 4, pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names)

        fields = ("head", "parent", "depth", "path", "n", "conv_id", "ends")
        for batch in batches:
            own_type = batch.column("conv_id").type
            columns = [batch.column(c).to_pylist() for c in fields]
            for head, parent, depth, path, n, own_id, ends, chars in zip(*columns, batch.column("chars")):
                if held and head != now[0]:
                    yield nodes()
                    held = []
                now = head, parent
                held.append((depth, path, chars.values.to_numpy(), n, own_id, ends))
        if held:
            yield nodes()

    shards = containers.repartition(_ranges(containers), "head").sortWithinPartitions("head", "path")
    schema = (
        f"head string, parent string, conv_id {id_type}, depth bigint, parent_conv_id {id_type}, n_convs bigint, "
        "n_children bigint, n_leaves bigint, saved_tokens bigint, ends_sha256 string"
    )
    return stored(shards.mapInArrow(run, schema), "trie-nodes")


def trie(
    conversations: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    container: int = CONTAINER,
) -> DataFrame:
    """One row a node of the trie of the ``rebuilt`` conversations: the root, and every distinct
    sequence of first turns.

    ``conv_id`` (the smallest conversation that begins with it), ``depth``,
    ``parent_conv_id`` (null for the root), ``n_convs``, ``n_children``,
    ``n_leaves`` (nodes without a child in its subtree, itself included),
    ``saved_tokens`` (over its subtree, each node's other conversations times
    the code points of its last text), ``ends_sha256`` (the digest of the ids,
    in order, of the conversations that end there).  An empty table has no
    node; repeated rows are turns of their own.
    """
    members = rebuilt(conversations, conv_col, turn_col, role_col, text_col)
    found = sequences(members)
    root = F.sha2(F.lit("").cast("binary"), 256)
    active = found.select(
        root.alias("head"), F.lit(0).alias("depth"), F.lit(None).cast("string").alias("parent"), "path", "chars", "n", "conv_id", "ends"
    )
    # Written, or the optimiser would see one constant head and join without a key.
    active = stored(active, "trie-active")
    small, rounds = _burst(active, container)
    nodes = _swept(reduce(DataFrame.unionByName, small))
    below = nodes.where(F.col("head").isNotNull()).select("head", "parent", "n_leaves", "saved_tokens")
    chains = []
    for grown, ended in reversed(rounds):
        children = below.groupBy(F.col("parent").alias("head")).agg(
            F.count("*").alias("branches"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("under")
        )
        rows = grown.join(children, "head").join(ended, "head", "left")
        # The head's turns beyond its first node have one child each, and the same conversations.
        at = rows.select("*", F.explode(F.sequence("depth", "to")).alias("at"))
        later = F.slice("chars", F.greatest(F.col("at"), F.lit(1)), F.col("to") - F.greatest(F.col("at"), F.lit(1)) + 1)
        points = F.when(F.col("to") > 0, F.aggregate(later, F.lit(0).cast("bigint"), lambda s, x: s + x)).otherwise(0)
        last = F.col("at") == F.col("to")
        chain = at.select(
            F.when(F.col("at") == F.col("depth"), F.col("head")).alias("head"),
            F.when(F.col("at") == F.col("depth"), F.col("parent")).alias("parent"),
            F.col("head").alias("chain"),
            "conv_id",
            F.col("at").cast("bigint").alias("depth"),
            F.when(F.col("at") > F.col("depth"), F.col("conv_id")).alias("parent_conv_id"),
            F.col("n").alias("n_convs"),
            F.when(last, F.col("branches")).otherwise(1).cast("bigint").alias("n_children"),
            "n_leaves",
            (F.col("under") + (F.col("n") - 1) * points).alias("saved_tokens"),
            F.when(last, F.coalesce("ends", F.lit(EMPTY))).otherwise(EMPTY).alias("ends_sha256"),
        )
        chain = stored(chain, "trie-chain")
        chains.append(chain)
        tops = chain.where(F.col("head").isNotNull()).select("head", "parent", "n_leaves", "saved_tokens")
        below = below.unionByName(tops)
    every = reduce(DataFrame.unionByName, [nodes, *(c.drop("chain") for c in chains)])
    if not chains:
        return every.select(_NODE)
    owners = reduce(DataFrame.unionByName, chains).select(F.col("chain").alias("parent"), F.col("conv_id").alias("above")).distinct()
    inner = every.where(F.col("parent").isNull())
    tops = every.where(F.col("parent").isNotNull()).join(owners, "parent").withColumn("parent_conv_id", F.col("above")).drop("above")
    return inner.unionByName(tops).select(_NODE)
