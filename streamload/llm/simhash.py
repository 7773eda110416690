"""SimHash near-duplicates with BK-trees (operator 9).

A fingerprint is 64 majority bits over the XXH64 hashes of word shingles.  Two fingerprints link at
``radius`` or fewer differing bits; the result is the component of each document.

Distinct fingerprints are dealt to shards, and each shard is a BK-tree that all of its fingerprints are searched in:
children are keyed by their integer Hamming distance to the parent, and a search follows only edges within the radius of
the distance to the parent.  A shard's tree is made where the queries of the shard arrive; it is not sent through the
driver, which would then hold the fingerprints of all documents.

Two fingerprints within the radius have at least one of ``radius + 1`` blocks of the 64 bits in common.  So a shard is a
value of the first bits of one of the blocks, of as many bits as make a shard some ``SHARD`` fingerprints: none for a small
table, which is one tree, one more whenever the table doubles.  The bits only say which trees are searched; which
fingerprints link is decided in the trees.  When a block's bits are used up, or a value is hot (``HOT`` times the size), the
shard is dealt again by the blocks of the other bits, of which one must agree as well; and what is still too large is cut
into parts, of which each pair is a group of its own, one part searched in the tree of the other, so no task holds it whole.
Only a spanning forest of each tree's links leaves a task; components come from label propagation with
pointer jumping over those links, written to the shared folder round by round.

Defined results: null and empty text have fingerprint zero and link like any other; fewer words than a
shingle make one shingle; copies of a document, and rows of equal doc_id, share their fingerprint's
component; rows without doc_id link like others but never name a component (its id is null if no row has one).
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_batches, materialize, table, whole_text

SHINGLE, RADIUS = 3, 3
#: Fingerprints of a shard, on average; and how many times that makes it hot.
SHARD, HOT = 1_024, 16
_hash = partial(xxhash.xxh64_intdigest, seed=42)


def fingerprint(raw: bytes, shingle: int = SHINGLE) -> int:
    """Majority bits of the shingles' hashes; ``raw`` is UTF-8."""
    words = raw.lower().split()
    if not words:
        return 0
    n = max(len(words) - shingle + 1, 1)
    grams = map(b" ".join, zip(*(words[k:] for k in range(shingle)))) if len(words) >= shingle else [b" ".join(words)]
    hashes = np.fromiter(map(_hash, grams), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for k in range(0, n, 1 << 16):
        part = hashes[k:k + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, key (hash of the text), fp (as a signed long), one row per input row."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(2).cast(pa.binary()).to_pylist()
        fps = np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64)
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fps)], ["doc_id", "key", "fp"])
    text = whole_text(docs)
    return map_batches(docs.select("doc_id", F.xxhash64(text).alias("key"), text.alias("text")), run,
                       f"doc_id {kind}, key long, fp long")


def hex16(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


# --------------------------------------------------------------------------- BK-trees of one task

class BKForest:
    """BK-trees over ``values``, one for each distinct ``tree``, built and searched level by level in numpy.

    Every node is the first value that reached its place; the others move on to the child keyed by their
    distance to it.
    """

    def __init__(self, values: np.ndarray, tree: np.ndarray):
        self.values = values
        _, group = np.unique(tree, return_inverse=True)
        self.first = group
        rest, base = np.arange(len(values)), 0
        roots, keys, kids = [], [], []
        while len(rest):
            n = int(group.max()) + 1
            root = np.full(n, len(values), np.int64)
            np.minimum.at(root, group, rest)
            roots.append(root)
            below = rest != root[group]
            rest, group = rest[below], group[below]
            if not len(rest):
                break
            key = group * 65 + np.bitwise_count(values[rest] ^ values[root[group]]).astype(np.int64)
            edges, group = np.unique(key, return_inverse=True)
            keys.append(edges + base * 65)
            kids.append(np.arange(len(edges)) + base + n)
            base += n
        self.roots = np.concatenate(roots) if roots else np.array([], np.int64)
        self.keys = np.concatenate(keys) if keys else np.array([], np.int64)
        self.kids = np.concatenate(kids) if kids else np.array([], np.int64)

    def search(self, queries: np.ndarray, start: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """(position in queries, position in values) of every value within the radius."""
        at, node = np.arange(len(queries)), start
        found = []
        while len(at):
            d = np.bitwise_count(queries[at] ^ self.values[self.roots[node]]).astype(np.int64)
            hit = d <= radius
            found.append((at[hit], self.roots[node[hit]]))
            low = np.searchsorted(self.keys, node * 65 + np.maximum(d - radius, 0), "left")
            many = np.searchsorted(self.keys, node * 65 + np.minimum(d + radius, 64), "right") - low
            at = np.repeat(at, many)
            step = np.arange(len(at)) - np.repeat(np.cumsum(many) - many, many)
            node = self.kids[np.repeat(low, many) + step]
        if not found:
            return np.array([], np.int64), np.array([], np.int64)
        return np.concatenate([a for a, _ in found]), np.concatenate([b for _, b in found])


def _spanning(queries: np.ndarray, values: np.ndarray, q_tree: np.ndarray, v_tree: np.ndarray, radius: int):
    """A spanning forest of the links between queries and values of the same tree, as pairs of fingerprints."""
    names, inverse = np.unique(np.concatenate([queries, values]), return_inverse=True)
    q_name, v_name = inverse[:len(queries)], inverse[len(queries):]
    forest = BKForest(values, v_tree)
    trees, sizes = np.unique(v_tree, return_counts=True)
    start = np.searchsorted(trees, q_tree)
    label = np.arange(len(names))

    def find(x: int) -> int:
        while label[x] != x:
            label[x] = label[label[x]]
            x = label[x]
        return x
    block = max(64, 2_000_000 // int(sizes.max()))
    for k in range(0, len(queries), block):
        a, b = forest.search(queries[k:k + block], start[k:k + block], radius)
        a, b = q_name[k + a], v_name[b]
        while (up := label[label]).tolist() != label.tolist():
            label = up
        pairs = np.unique(np.column_stack([label[a], label[b]])[label[a] != label[b]], axis=0)
        for x, y in pairs.tolist():
            x, y = find(x), find(y)
            if x != y:
                label[max(x, y)] = min(x, y)
    top = np.array([find(x) for x in range(len(names))], np.int64) if len(names) else label
    moved = np.flatnonzero(top != np.arange(len(names)))
    return names[moved], names[top[moved]]


def _mask(bits) -> int:
    """The bits as a signed long."""
    m = sum(1 << int(b) for b in bits)
    return m - (1 << 64) if m >> 63 else m


def block_masks(radius: int, bits: int) -> list[int]:
    """Masks under one of which any two fingerprints within the radius agree: the first ``bits`` of each block."""
    if bits == 0:
        return [0]
    return [_mask(block[:bits]) for block in np.array_split(np.arange(64), radius + 1)]


def finer_masks(radius: int) -> list[list[int]]:
    """For each block, the masks of it with each block of the other bits; two that agree on it agree under one of them."""
    blocks = np.array_split(np.arange(64), radius + 1)
    out = []
    for i, own in enumerate(blocks):
        rest = np.concatenate([b for k, b in enumerate(blocks) if k != i])
        out.append([_mask(np.concatenate([own, sub])) for sub in np.array_split(rest, radius + 1)])
    return out


def shard_bits(n: int, shard: int, radius: int) -> int:
    """Bits of a block that make shards of some ``shard`` fingerprints out of ``n``, as far as a block goes."""
    return min(max(0, (n - 1) // shard).bit_length(), 64 // (radius + 1))


def links(nodes: DataFrame, radius: int = RADIUS, shard: int = SHARD) -> DataFrame:
    """A spanning set of links (u, v) between the distinct fingerprints in ``nodes.fp``."""
    limit = HOT * shard
    masks = block_masks(radius, shard_bits(nodes.count(), shard, radius))
    fp = F.col("fp")
    rows = nodes.select("fp", F.posexplode(F.array(*[fp.bitwiseAND(F.lit(m)) for m in masks])).alias("t", "v")) \
        .withColumn("s", F.lit(-1))
    sizes = materialize(_sizes(rows), "simhash-shards")
    hot = sizes.where(F.col("n") > limit)
    total, largest = _totals(sizes)
    dealt = rows.join(sizes, ["t", "v", "s"])
    if largest > limit:
        # of a hot shard (a table of one shard has none): by its whole block and a block of the rest
        sub = F.array(*[F.array(*[fp.bitwiseAND(F.lit(m)) for m in under]) for under in finer_masks(radius)])
        again = rows.join(hot.drop("n"), ["t", "v", "s"]).select("fp", "t", F.posexplode(F.get(sub, F.col("t"))).alias("s", "v"))
        again_sizes = materialize(_sizes(again), "simhash-hot-shards")
        more, largest = _totals(again_sizes)
        total += more
        dealt = dealt.where(F.col("n") <= limit).unionByName(again.join(again_sizes, ["t", "v", "s"]))
    one = F.lit(0).cast("int")
    if largest > limit:
        parts = F.ceil(F.col("n") / F.lit(limit)).cast("int")
        own = F.pmod(F.xxhash64("fp"), parts).cast("int")
        dealt = dealt.withColumn("own", own).withColumn("other", F.explode(F.sequence(one, parts - 1))).select(
            "t", "v", "s", "fp", "own", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"))
        total *= -(-largest // limit)
    else:
        dealt = dealt.select("t", "v", "s", "fp", one.alias("own"), one.alias("low"), one.alias("high"))
    n_buckets = int(total) // 50_000 + 1
    dealt = dealt.withColumn("bucket", F.pmod(F.xxhash64("t", "v", "s", "low", "high"), F.lit(n_buckets)))

    def run(group: pa.Table) -> pa.Table:
        t, v, s, fp, own, low, high = (group.column(c).to_numpy() for c in ("t", "v", "s", "fp", "own", "low", "high"))
        tree = np.unique(np.rec.fromarrays([t, v, s, low, high]), return_inverse=True)[1]
        fp, queries, members = fp.view(np.uint64), own == low, own == high
        has = queries & np.isin(tree, tree[members])
        u, w = _spanning(fp[has], fp[members], tree[has], tree[members], radius)
        return pa.table({"u": u.view(np.int64), "v": w.view(np.int64)})
    return dealt.groupBy("bucket").applyInArrow(run, "u long, v long")


def _sizes(rows: DataFrame) -> DataFrame:
    return rows.groupBy("t", "v", "s").agg(F.count("*").alias("n")).where(F.col("n") > 1)


def _totals(sizes: DataFrame) -> tuple[int, int]:
    row = sizes.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0))).collect()[0]
    return int(row[0]), int(row[1])


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node reachable, for every node that has an edge."""
    both = edges.union(edges.select("v", "u")).toDF("u", "v").distinct()
    both = materialize(both, "component-edges")
    label = materialize(both.groupBy("u").agg(F.min("v").alias("v"))
                        .select(F.col("u").alias("node"), F.least("u", "v").alias("label")), "component-labels")
    while True:
        near = both.join(label.withColumnRenamed("node", "v"), "v").groupBy(F.col("u").alias("node")) \
            .agg(F.min("label").alias("near"))
        new = label.join(near, "node").select("node", "label", F.least("label", "near").alias("new"))
        up = label.select(F.col("node").alias("new"), F.col("label").alias("up"))
        after = materialize(new.join(up, "new").select("node", F.least("new", "up").alias("label"),
                                                       (F.col("label") != F.least("new", "up")).alias("moved")),
                            "component-labels")
        if after.where("moved").isEmpty():
            return after.select("node", "label")
        label = after.select("node", "label")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, shard: int = SHARD) -> DataFrame:
    """doc_id, key, fp, component_id and keeper (the key of the row that names the component) for each row."""
    fps = materialize(fingerprints(docs, shingle), "simhash-fingerprints")
    # one row per fingerprint before anything else: exact copies end here
    least = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "key")))
    nodes = materialize(fps.groupBy("fp").agg(least.alias("least"), F.min("key").alias("any_key")), "simhash-nodes")
    label = components(links(nodes, radius, shard))
    named = nodes.join(label, nodes["fp"] == label["node"], "left") \
        .select("fp", "least", "any_key", F.coalesce("label", "fp").alias("label"))
    top = named.groupBy("label").agg(F.min("least").alias("least"), F.min("any_key").alias("any_key"))
    per_fp = named.select("fp", "label").join(top, "label").select(
        F.col("fp").alias("node_fp"), F.col("least.doc_id").alias("component_id"),
        F.coalesce("least.key", "any_key").alias("keeper"))
    return fps.join(per_fp, fps["fp"] == F.col("node_fp")).drop("node_fp")


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_duplicates(docs).select("doc_id", hex16(F.col("fp")).alias("fingerprint"), "component_id")


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: one row of each group stays, the others go.

    It is a row of the smallest doc_id; in a group without ids, of the least text hash.  Of several rows with that id and
    text (repeated rows, copies without an id) the least by all columns stays.  Null and empty texts are one group.
    """
    found = near_duplicates(docs)
    stays = materialize(found.where(F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("key") == F.col("keeper")))
                        .groupBy(F.col("doc_id").alias("__llm_id"), F.col("key").alias("__llm_key"))
                        .agg(F.count(F.lit(1)).alias("__llm_n")), "simhash-stays")
    keyed = docs.withColumn("__llm_hash", F.xxhash64(whole_text(docs)))
    same = keyed["doc_id"].eqNullSafe(F.col("__llm_id")) & (F.col("__llm_hash") == F.col("__llm_key"))
    alone = keyed.join(stays.where("__llm_n = 1").hint("shuffle_hash"), same, "left_semi").select(*docs.columns)
    repeated = stays.where("__llm_n > 1")
    if repeated.isEmpty():
        return alone
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    kinds = {f.dataType.typeName() for f in docs.schema.fields}
    least = F.min_by(row, F.to_json(row)) if kinds & {"map", "variant"} else F.min(row)
    one = keyed.join(repeated, same, "left_semi").groupBy("doc_id", "__llm_hash").agg(least.alias("__llm_row"))
    return alone.unionByName(one.select(*[F.col("__llm_row").getField(c).alias(c) for c in docs.columns]))
