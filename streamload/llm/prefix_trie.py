"""Prefix trie of conversations by time-forward processing (operator 13).

Conversations that begin with the same turns share the nodes of a trie; every node gets what its subtree sums up to.

* **Turns become numbers first.**  A turn is reduced to a SHA-256 of role and text and its text's bytes, so no text is
  shuffled.  Places inside a conversation are dealt by ranges (:mod:`places`).  A prefix is named by the XOR of 128-bit
  hashes of (depth, turn): equal names stand for equal prefixes.  XOR can be summed in pieces, so a conversation of any
  length is worked on in pieces of 1,024 turns.
* **Nodes** are one aggregation over the names, partly summed before the shuffle: a first turn that a third of all
  conversations share is one row a task.
* **Shards** are whole subtrees of at most ``SHARD_ROWS`` turns of members; the nodes above them (those with more, an
  ancestor-closed top of the trie, since a parent always has more than its child) are joined as a tree of their own.
* **Time-forward processing.**  A shard's nodes are sorted by Spark in reverse level order (its sort spills).  Each node
  takes from a priority queue what its children sent, and sends its own totals forward to its parent, which comes later in
  that order.  The queue holds at most ``QUEUE`` messages in memory and writes the rest to sorted runs in files of the task.
  The totals of shard roots are summed by parent and join the top's nodes, which are processed the same way, by their
  first turn; the root takes one sum over the first turns.
* **Members that end at a node** are dealt by ranges of (node, conv_id); each task writes runs of decimal ids as one text,
  and only these texts meet, in order, in a running SHA-256.  No list of members is ever held.

Defined results: rows without conv_id belong to no conversation.  Null role and text are empty; a null turn comes first;
rows of equal turn follow in the order of their hashes, so repeated rows are turns of their own.  ``c - c % 5`` rounds
towards zero.  A conversation that is left without turns is a member of the root only.  An empty table has no nodes.  Empty
and very long texts are turns like others.
"""

from __future__ import annotations

import hashlib
import heapq
import pickle
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialize, table
from .merkle import CRC, CRC_TABLE
from .places import with_places

#: Rows of members in the subtree of a shard's root, at most.
SHARD_ROWS = 4_000
#: Messages that the queue of a task holds in memory.
QUEUE = 200_000
#: Turns of one conversation that are named together.
CHUNK = 1_024
#: Member ids in one text.
PIECE = 10_000
#: Top nodes that are sent to all tasks (56 bytes each); with more, they are joined.
MAX_BROADCAST = 10_000
EMPTY = hashlib.sha256(b"").hexdigest()
NODE = ["depth", "k1", "k2"]


def read_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, pos (from 0), t (hash of role and text), bytes (of the text) of every turn with a conversation."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn",
        F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)).alias("t"),
        F.octet_length(text).cast("long").alias("bytes"))
    placed = with_places(materialize(rows, "trie-turns"), "conv_id", ["turn", "t"], "pos", "trie-places")
    return materialize(placed.select("conv_id", "pos", "t", "bytes"), "trie-own")


def head_length(conv_id: Column) -> Column:
    return F.crc32(conv_id.cast("string").cast("binary")) % 9


def rebuild(own: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns of the rebuilt conversations (conv_id, depth from 1, t, bytes), and conversations (conv_id, n_turns)."""
    lengths = own.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    convs = lengths.withColumn("h", head_length(F.col("conv_id"))).withColumn("base", F.col("conv_id") - F.col("conv_id") % 5)
    of_base = lengths.where("conv_id % 5 = 0").select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    convs = convs.join(of_base, "base", "left").select(
        "conv_id", "base", "h", F.least("h", F.coalesce("n_base", F.lit(0))).alias("head"), "n")
    convs = materialize(convs.withColumn("n_turns", F.col("head") + F.greatest(F.col("n") - F.col("h"), F.lit(0))), "trie-convs")
    heads = own.where("conv_id % 5 = 0 AND pos < 8").select(F.col("conv_id").alias("base"), "pos", "t", "bytes") \
        .join(convs.select("conv_id", "base", "h", "n_turns"), "base").where("pos < h") \
        .select("conv_id", (F.col("pos") + 1).alias("depth"), "t", "bytes", "n_turns")
    tails = own.join(convs.select("conv_id", "h", "head", "n_turns"), "conv_id").where("pos >= h") \
        .select("conv_id", (F.col("head") + F.col("pos") - F.col("h") + 1).alias("depth"), "t", "bytes", "n_turns")
    return heads.unionByName(tails), convs.select("conv_id", "n_turns")


def name_prefixes(turns: DataFrame) -> DataFrame:
    """``turns`` with the names k1, k2 of the prefix that ends there and p1, p2 of the one before."""
    rows = turns.withColumn("chunk", F.shiftright(F.col("depth") - 1, CHUNK.bit_length() - 1))
    for i in (1, 2):
        rows = rows.withColumn(f"x{i}", F.xxhash64(F.lit(i), "depth", "t"))
    rows = rows.drop("t")
    upto = Window.partitionBy("conv_id", "chunk").orderBy("depth")
    named = rows.withColumns({f"k{i}": F.bit_xor(f"x{i}").over(upto) for i in (1, 2)})
    # only conversations longer than a chunk have a second one
    chunks = rows.where(F.col("n_turns") > CHUNK).groupBy("conv_id", "chunk").agg(*[F.bit_xor(f"x{i}").alias(f"c{i}") for i in (1, 2)])
    before = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = chunks.select("conv_id", "chunk", *[F.bit_xor(f"c{i}").over(before).alias(f"b{i}") for i in (1, 2)]).where("chunk > 0")
    named = named.join(chunks, ["conv_id", "chunk"], "left")
    for i in (1, 2):
        named = named.withColumn(f"k{i}", F.col(f"k{i}").bitwiseXOR(F.coalesce(f"b{i}", F.lit(0).cast("long"))))
    return named.select("conv_id", "depth", "k1", "k2", *[F.col(f"k{i}").bitwiseXOR(F.col(f"x{i}")).alias(f"p{i}") for i in (1, 2)],
                        "bytes", "n_turns")


# --------------------------------------------------------------------------- time-forward processing

class SpillingQueue:
    """A priority queue of (place, ...) tuples whose larger part lies in sorted runs in files."""

    def __init__(self, limit: int):
        self.limit, self.memory, self.heads, self.runs = limit, [], [], []

    def push(self, item: tuple) -> None:
        heapq.heappush(self.memory, item)
        if len(self.memory) > self.limit:
            self._spill()

    def _spill(self) -> None:
        file = tempfile.TemporaryFile()
        items = sorted(self.memory)
        for k in range(0, len(items), 1000):
            pickle.dump(items[k:k + 1000], file)
        file.seek(0)
        self.memory = []
        self.runs.append(self._read(file))
        self._advance(len(self.runs) - 1)

    @staticmethod
    def _read(file) -> Iterator[tuple]:
        with file:
            while True:
                try:
                    yield from pickle.load(file)
                except EOFError:
                    return

    def _advance(self, run: int) -> None:
        item = next(self.runs[run], None)
        if item is not None:
            heapq.heappush(self.heads, (item, run))

    def take(self, place: tuple) -> Iterator[tuple]:
        """All items of ``place``, which must be the smallest place that is still to come."""
        while self.memory and self.memory[0][0] == place:
            yield heapq.heappop(self.memory)
        while self.heads and self.heads[0][0][0] == place:
            item, run = heapq.heappop(self.heads)
            self._advance(run)
            yield item

    def __bool__(self) -> bool:
        return bool(self.memory or self.heads)


KEPT = "depth long, k1 long, k2 long, p1 long, p2 long, conv_id long, n_convs long"
TOTALS = KEPT + ", n_children long, n_leaves long, saved_tokens long"


def _time_forward(queue_size: int):
    """Nodes sorted by shard and reverse level, in; the same with the totals of their subtrees, out."""
    names = [c.split()[0] for c in KEPT.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queue, shard = SpillingQueue(queue_size), None
        for batch in batches:
            totals: tuple[list, list, list] = ([], [], [])
            columns = (batch.column(c).to_pylist() for c in ("s1", "s2", "depth", "k1", "k2", "p1", "p2", "saved", "children", "leaves"))
            for s1, s2, depth, k1, k2, p1, p2, saved, children, leaves in zip(*columns):
                if shard != (s1, s2):
                    assert not queue, "a message for a node that is not in its shard"
                    shard = (s1, s2)
                for _, more, under in queue.take((-depth, k1, k2)):
                    children, leaves, saved = children + 1, leaves + under, saved + more
                leaves = leaves if children else 1
                if (k1, k2) != shard:
                    queue.push(((1 - depth, p1, p2), saved, leaves))
                for column, value in zip(totals, (children, leaves, saved)):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), *(pa.array(x, pa.int64()) for x in totals)],
                                             names=[*names, "n_children", "n_leaves", "saved_tokens"])
        assert not queue, "a message for a node that is not in its shard"
    return run


def subtree_totals(nodes: DataFrame, name: str) -> DataFrame:
    """Totals of every node from its shard's nodes: s1 and s2 (names of the shard's root), own values, and what came from
    other shards (children, leaves, saved)."""
    order = ["s1", "s2", F.desc("depth"), "k1", "k2"]
    dealt = nodes.repartition("s1", "s2").sortWithinPartitions(*order)
    return materialize(dealt.mapInArrow(_time_forward(QUEUE), TOTALS), name)


def _small(df: DataFrame, n: int) -> DataFrame:
    return F.broadcast(df) if n <= MAX_BROADCAST else df


# --------------------------------------------------------------------------- members that end at a node

def _id_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of at most PIECE ids of one node in a sorted partition, each as one comma-joined text."""
    node, ids = None, []

    def text():
        return (*node, ids[0], ",".join(map(str, ids)))

    def out(rows):
        return pa.RecordBatch.from_pylist([dict(zip(("depth", "k1", "k2", "first", "ids"), r)) for r in rows],
                                          schema=pa.schema([(c, pa.int64()) for c in ("depth", "k1", "k2", "first")] + [("ids", pa.string())]))
    for batch in batches:
        rows = []
        for depth, k1, k2, c in zip(*(batch.column(x).to_pylist() for x in (*NODE, "conv_id"))):
            if node != (depth, k1, k2) or len(ids) >= PIECE:
                if ids:
                    rows.append(text())
                node, ids = (depth, k1, k2), []
            ids.append(c)
        if rows:
            yield out(rows)
    if ids:
        yield out([text()])


def _id_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The SHA-256 of each node's texts, in order, joined by commas."""
    node, state = None, None
    names = [*NODE, "ends_sha256"]
    schema = pa.schema([(c, pa.int64()) for c in NODE] + [("ends_sha256", pa.string())])
    for batch in batches:
        rows = []
        for depth, k1, k2, ids in zip(*(batch.column(x).to_pylist() for x in (*NODE, "ids"))):
            if node == (depth, k1, k2):
                state.update(b",")
            else:
                if node is not None:
                    rows.append(dict(zip(names, (*node, state.hexdigest()))))
                node, state = (depth, k1, k2), hashlib.sha256()
            state.update(ids.encode())
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=schema)
    if node is not None:
        yield pa.RecordBatch.from_pylist([dict(zip(names, (*node, state.hexdigest())))], schema=schema)


def ends_of_nodes(ends: DataFrame) -> DataFrame:
    """depth, k1, k2 and ends_sha256 of the nodes at which members (conv_id) end."""
    order = [*NODE, "conv_id"]
    texts = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order) \
        .mapInArrow(_id_texts, "depth long, k1 long, k2 long, first long, ids string")
    return texts.repartition(*NODE).sortWithinPartitions(*NODE, "first") \
        .mapInArrow(_id_hashes, "depth long, k1 long, k2 long, ends_sha256 string")


# --------------------------------------------------------------------------- the trie

def build_trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """The nodes of the trie of ``turns`` (conv_id, depth, t, bytes, n_turns) of ``convs`` (conv_id, n_turns).

    conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.
    """
    chain = materialize(name_prefixes(turns), "trie-chain")
    nodes = materialize(chain.groupBy(*NODE).agg(
        F.max("p1").alias("p1"), F.max("p2").alias("p2"), F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"),
        F.max("bytes").alias("bytes"), F.sum(F.col("n_turns") - F.col("depth") + 1).alias("weight")), "trie-nodes")
    own = nodes.withColumns({"saved": (F.col("n_convs") - 1) * F.col("bytes"), "children": F.lit(0).cast("long"),
                             "leaves": F.lit(0).cast("long")})
    light, top = own.where(F.col("weight") <= SHARD_ROWS), own.where(F.col("weight") > SHARD_ROWS)
    first = chain.where("depth = 1").select("conv_id", F.col("k1").alias("s1"), F.col("k2").alias("s2"))
    n_top = top.count()
    shards = first
    if n_top:
        # a conversation's shard begins below the last top node on its way
        above = chain.join(_small(top.select(*NODE), n_top), NODE).groupBy("conv_id").agg(F.count(F.lit(1)).alias("above"))
        shards = chain.join(above, "conv_id", "left").where(F.col("depth") == F.coalesce("above", F.lit(0)) + 1) \
            .select("conv_id", F.col("k1").alias("s1"), F.col("k2").alias("s2"))
    done = subtree_totals(light.join(shards, "conv_id"), "trie-shards")
    if n_top:
        sent = done.join(_small(top.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), (F.col("depth") + 1).alias("depth")), n_top),
                         ["depth", "p1", "p2"]) \
            .groupBy("depth", "p1", "p2").agg(F.count(F.lit(1)).alias("m_children"), F.sum("n_leaves").alias("m_leaves"),
                                              F.sum("saved_tokens").alias("m_saved")) \
            .select((F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2"), "m_children", "m_leaves", "m_saved")
        more = top.drop("children", "leaves").join(sent, NODE, "left").join(first, "conv_id") \
            .withColumns({"saved": F.col("saved") + F.coalesce("m_saved", F.lit(0)), "children": F.coalesce("m_children", F.lit(0)),
                          "leaves": F.coalesce("m_leaves", F.lit(0))})
        done = done.unionByName(subtree_totals(more, "trie-top"))

    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"))
    sums = done.where("depth = 1").agg(F.count(F.lit(1)).alias("n_children"), F.coalesce(F.sum("n_leaves"), F.lit(0)).alias("n_leaves"),
                                       F.coalesce(F.sum("saved_tokens"), F.lit(0)).alias("saved_tokens"))
    at, totals = root.collect()[0], sums.collect()[0]  # the root is one row
    spark = chain.sparkSession
    roots = [] if at["conv_id"] is None else [(0, 0, 0, at["conv_id"], None, at["n_convs"], totals["n_children"],
                                               max(1, totals["n_leaves"]), totals["saved_tokens"])]
    row = spark.createDataFrame(roots, "depth long, k1 long, k2 long, conv_id long, parent_conv_id long, n_convs long, "
                                       "n_children long, n_leaves long, saved_tokens long")

    # the parents: the root, top nodes (which may have any number of children) and nodes of shards
    parent = [F.col("k1").alias("p1"), F.col("k2").alias("p2"), (F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("parent_conv_id")]
    rows = done.where("depth = 1").withColumn("parent_conv_id", F.lit(at["conv_id"]).cast("long"))
    below = done.where("depth > 1")
    key = ["depth", "p1", "p2"]
    rows = rows.unionByName(below.join(light.select(*parent), key).select(*rows.columns))
    if n_top:
        rows = rows.unionByName(below.join(_small(top.select(*parent), n_top), key).select(*rows.columns))
    rows = rows.select(*row.columns).unionByName(row)
    ends = chain.where("depth = n_turns").select(*NODE, "conv_id").unionByName(convs.where("n_turns = 0").select(
        *[F.lit(0).cast("long").alias(c) for c in NODE], "conv_id"))
    return rows.join(ends_of_nodes(ends), NODE, "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    talks = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return build_trie(*rebuild(read_turns(talks)))


OP13_SQL = f"""
WITH RECURSIVE {CRC_TABLE},
o AS (SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
             row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(octet_length(encode(coalesce(role, ''))) || ':' || coalesce(role, '') || coalesce(text, ''))) - 1 AS pos
      FROM conversations WHERE conv_id IS NOT NULL),
n AS (SELECT c, count(*) AS n, ({CRC.format(x='c')}) % 9 AS h FROM o, crc GROUP BY c, crc.t),
v AS (SELECT n.c, n.h, least(n.h, coalesce(b.n, 0)) AS head FROM n LEFT JOIN n b ON b.c = n.c - n.c % 5),
r AS (SELECT v.c, o.pos + 1 AS d, o.role, o.text FROM v JOIN o ON o.c = v.c - v.c % 5 AND o.pos < v.h
      UNION ALL
      SELECT v.c, v.head + o.pos - v.h + 1, o.role, o.text FROM v JOIN o ON o.c = v.c AND o.pos >= v.h),
s AS (SELECT v.c, coalesce(max(r.d), 0) AS len FROM v LEFT JOIN r ON r.c = v.c GROUP BY v.c),
chain AS (
  SELECT c, 0 AS d, sha256('') AS k, CAST(0 AS BIGINT) AS bytes, CAST(NULL AS VARCHAR) AS p FROM s
  UNION ALL
  SELECT r.c, r.d, sha256(x.k || octet_length(encode(r.role)) || ':' || r.role || r.text), octet_length(encode(r.text)), x.k
  FROM chain x JOIN r ON r.c = x.c AND r.d = x.d + 1),
node AS (SELECT d, k, any_value(p) AS p, min(c) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(bytes) AS saved FROM chain GROUP BY d, k),
kids AS (SELECT p, count(*) AS n_children FROM node WHERE p IS NOT NULL GROUP BY p),
sums AS (SELECT x.k, sum(u.saved) AS saved_tokens, count(*) FILTER (WHERE kids.p IS NULL) AS n_leaves
         FROM node u JOIN chain x ON x.c = u.conv_id AND x.d <= u.d LEFT JOIN kids ON kids.p = u.k GROUP BY x.k),
ends AS (SELECT x.k, string_agg(CAST(x.c AS VARCHAR), ',' ORDER BY x.c) AS ids FROM chain x JOIN s ON s.c = x.c AND s.len = x.d GROUP BY x.k)
SELECT a.conv_id, CAST(a.d AS BIGINT) AS depth, b.conv_id AS parent_conv_id, a.n_convs, coalesce(kids.n_children, 0) AS n_children,
       sums.n_leaves, CAST(sums.saved_tokens AS BIGINT) AS saved_tokens, sha256(coalesce(ends.ids, '')) AS ends_sha256
FROM node a LEFT JOIN node b ON b.k = a.p AND b.d = a.d - 1 LEFT JOIN kids ON kids.p = a.k JOIN sums ON sums.k = a.k LEFT JOIN ends ON ends.k = a.k
"""
