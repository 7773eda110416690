"""Merkle manifest of a dataset with octopus multiproofs (operator 12).

Every row is a leaf; the leaves of a group in ascending order are a binary tree (an odd last node becomes the hash of
itself), and the groups' roots in order are the leaves of the tree above them.  Nodes are lowercase hex SHA-256.

How it is spread over a cluster:

* Only hashes move, never texts.  Leaves get their places by ranges (:mod:`places`), so a group that holds a third of all
  rows, or all of them, is many tasks' work.
* Leaf partitions are aligned runs of 2^10 places of one tree.  A run's nodes depend on nothing else, so each becomes one
  root; these roots are the leaves of the next layer, and so on until a tree is one run.  The driver sees one number a
  layer (the largest tree).
* Proofs go down again.  What a run's leaves lack together is the union of the siblings that stand outside it: for an
  aligned run one coordinate a level at most, the neighbours of its own ancestors (:func:`missing`).  The layer above has
  them: each of its runs derives its interior once and hands every run below the nodes of its union, one row a run.  So
  nodes are fetched once a run, by an equi join of unique keys, and never once a leaf; a coordinate near the root is
  derived once in the run above and handed down, not joined by half of all runs.
* A run then derives its interior nodes once and expands the proofs of its leaves from them and the fetched ones.

Defined results: nulls are ``-`` in a leaf.  Rows without doc_id come first in their group, rows of equal doc_id follow in
the order of their leaves, so repeated rows are separate leaves and any order of reading gives the same nodes.  A null lang
is a group of its own, before all others.  Empty and very long texts are values like others.  An empty table has no leaf and
no rows.  A row that ``changed`` gives another leaf is folded from that leaf with the original siblings.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_batches, materialize, table
from .places import with_places

#: Levels of a leaf partition: runs of 1,024 leaves.
LEVELS = 10
#: Groups whose sizes and paths (some 2 kB each) are broadcast; with more, they are joined.
MAX_BROADCAST = 10_000


def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(values: Sequence[Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*[field(v) for v in values]), 256))


def depth(n: int) -> int:
    """Levels above the leaves of a tree of ``n``."""
    return (n - 1).bit_length()


def parents(nodes: list[str]) -> list[str]:
    return [digest(*nodes[k:k + 2]) for k in range(0, len(nodes), 2)]


def interior(nodes: list[str], levels: int) -> list[list[str]]:
    """The nodes of a run, level by level, from its leaves to its root."""
    out = [nodes]
    for _ in range(levels):
        out.append(parents(out[-1]))
    return out


def missing(n: int, low: int, high: int, base: int = 0) -> list[tuple[int, int]]:
    """Coordinates (level, index) that the proofs of places ``low`` to ``high - 1`` need and cannot derive themselves.

    ``n`` is the number of nodes at level ``base``, to which the places belong.
    """
    out, last = [], high - 1
    for level in range(base, base + depth(n)):
        if low & 1:
            out.append((level, low - 1))
        if not last & 1 and last + 1 < n:
            out.append((level, last + 1))
        low, last, n = low >> 1, last >> 1, (n + 1) >> 1
    return out


def fold(node: str, place: int, levels: int, siblings: dict[tuple[int, int], str]) -> tuple[str, list[str]]:
    """The root that a leaf and its siblings give, and the siblings on the way, from the bottom up."""
    proof = []
    for level in range(levels):
        other = siblings.get((level, place ^ 1))
        if other is None:
            node = digest(node)
        else:
            proof.append(other)
            node = digest(other, node) if place & 1 else digest(node, other)
        place >>= 1
    return node, proof


# --------------------------------------------------------------------------- the runs, layer by layer

ROOT = "tree string, place long, node binary, n long"
FETCHED = "tree string, run long, fetched array<struct<level: int, place: long, node: string>>"


def _root_of_run(key, rows):
    """A run's root; a tree of one run stops where one node is left, a run of a larger tree at its full height."""
    tree, run = key[0].as_py(), key[1].as_py()
    n = rows.column("n")[0].as_py()
    nodes = [b.hex() for b in rows.sort_by("place").column("node").to_pylist()]
    levels = min(LEVELS, depth(n))
    root = interior(nodes, levels)[-1][0]
    return pa.table({"tree": [tree], "place": pa.array([run], pa.int64()), "node": [bytes.fromhex(root)],
                     "n": pa.array([(n + (1 << levels) - 1) >> levels], pa.int64())})


def _known(nodes: list[str], first: int, base: int, levels: int) -> dict[tuple[int, int], str]:
    """The interior of a run by coordinates."""
    return {(base + k, (first >> k) + i): node for k, row in enumerate(interior(nodes, levels)) for i, node in enumerate(row)}


def _hand_down(base: int):
    """For a layer at level ``base``: what each node's run, one layer below, lacks of the siblings above it."""
    def run(key, rows, above):
        rows = rows.sort_by("place")
        places, n = rows.column("place").to_pylist(), rows.column("n")[0].as_py()
        levels = min(LEVELS, depth(n))
        known = _known([b.hex() for b in rows.column("node").to_pylist()], places[0], base, levels)
        for x in above.column("fetched").to_pylist()[0] if above.num_rows else []:
            known[x["level"], x["place"]] = x["node"]
        lacks = [[{"level": c[0], "place": c[1], "node": known[c]} for c in missing(n, p, p + 1, base)] for p in places]
        return pa.table({"tree": rows.column("tree"), "run": pa.array(places, pa.int64()),
                         "fetched": pa.array(lacks, pa.list_(pa.struct([("level", pa.int32()), ("place", pa.int64()),
                                                                        ("node", pa.string())])))})
    return run


def layers(leaves: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """All layers (tree, place, node, n) from the leaves up, and the trees' roots (tree, node).

    ``leaves`` has tree, place, node and n (leaves of the tree), read from files.
    """
    out, roots = [leaves.select("tree", "place", "node", "n")], None
    while True:
        runs = out[-1].withColumn("run", F.shiftright("place", LEVELS)).groupBy("tree", "run").applyInArrow(_root_of_run, ROOT)
        runs = materialize(runs, f"merkle-layer-{len(out)}")
        done = runs.where("n = 1").select("tree", "node")
        roots = done if roots is None else roots.unionByName(done)
        up = runs.where("n > 1")
        if up.isEmpty():
            return out, roots
        out.append(up)


def _with_above(rows: DataFrame, above: DataFrame | None, fn, schema: str) -> DataFrame:
    """``fn`` over each run of ``rows`` beside what was fetched for it; nothing was, if its tree is one run."""
    if above is None:
        above = rows.sparkSession.createDataFrame([], FETCHED)
    return rows.groupBy("tree", "run").cogroup(above.groupBy("tree", "run")).applyInArrow(fn, schema)


def fetched(trees: list[DataFrame]) -> DataFrame | None:
    """(tree, run, fetched) for the runs of the lowest layer: the nodes of their unions; None if every tree is one run."""
    given = None
    for k in range(len(trees) - 1, 0, -1):
        rows = trees[k].withColumn("run", F.shiftright("place", LEVELS))
        given = materialize(_with_above(rows, given, _hand_down(k * LEVELS), FETCHED), f"merkle-fetch-{k}")
    return given


def _proofs(key, rows, above):
    """The proof of every leaf of a run, and the root it gives with the leaf (its tampered form where there is one)."""
    rows = rows.sort_by("place")
    places, n = rows.column("place").to_pylist(), rows.column("n")[0].as_py()
    nodes = [b.hex() for b in rows.column("node").to_pylist()]
    known = _known(nodes, places[0], 0, min(LEVELS, depth(n)))
    for x in above.column("fetched").to_pylist()[0] if above.num_rows else []:
        known[x["level"], x["place"]] = x["node"]
    proofs, folded = [], []
    for place, node, changed in zip(places, nodes, rows.column("changed").to_pylist()):
        root, proof = fold(node if changed is None else changed.hex(), place, depth(n), known)
        proofs.append("".join(proof))
        folded.append(root)
    return pa.table({"tree": rows.column("tree"), "id": rows.column("id"), "node": pa.array(nodes, pa.string()),
                     "proof": pa.array(proofs, pa.string()), "folded": pa.array(folded, pa.string())})


def prove(leaves: DataFrame, trees: list[DataFrame]) -> DataFrame:
    """tree, id, node, proof (siblings from the bottom up, as one text) and folded (the tree's root by it) of each leaf."""
    rows = leaves.select("tree", "place", "node", "n", "changed", "id").withColumn("run", F.shiftright("place", LEVELS))
    return _with_above(rows, fetched(trees), _proofs, "tree string, id long, node string, proof string, folded string")


STEPS = "array<struct<left: string, right: string>>"


def _steps(batch: pa.RecordBatch) -> pa.RecordBatch:
    """What stands left and right of each group's node on the way to the root, level by level."""
    out = []
    for place, n, known in zip(*(batch.column(c).to_pylist() for c in ("place", "n", "fetched"))):
        siblings = {(x["level"], x["place"]): x["node"] for x in known}
        steps = []
        for level in range(depth(n)):
            other = siblings.get((level, (place >> level) ^ 1), "")
            odd = place >> level & 1
            steps.append({"left": other if odd else "", "right": "" if odd else other})
        out.append(steps)
    kind = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))
    return pa.RecordBatch.from_arrays([batch.column("place"), pa.array(out, kind)], names=["place", "steps"])


def group_paths(roots: DataFrame) -> DataFrame:
    """tree, subroot, root of all, and the steps from one to the other, of each group."""
    roots = materialize(roots.select("tree", "node").withColumn("all", F.lit("all")), "merkle-subroots")
    n = roots.count()
    placed = with_places(roots, "all", ["tree"], "place", "merkle-groups")
    top = materialize(placed.select(F.col("all").alias("tree"), "place", "node", F.lit(n).cast("long").alias("n"),
                                    F.col("tree").alias("name")), "merkle-top")
    trees, root = layers(top)
    own = trees[0].withColumn("run", F.shiftright("place", LEVELS))
    known = _with_above(own, fetched(trees), _hand_down(0), FETCHED)
    steps = map_batches(known.select(F.col("run").alias("place"), F.lit(n).cast("long").alias("n"), "fetched"),
                        _steps, f"place long, steps {STEPS}")
    # the root is one row
    return top.join(steps, "place").join(F.broadcast(root.select("tree", F.col("node").alias("root"))), "tree").select(
        F.col("name").alias("tree"), F.lower(F.hex("node")).alias("subroot"), F.lower(F.hex("root")).alias("root"), "steps")


def by_tree(rows: DataFrame, groups: DataFrame, n_groups: int) -> DataFrame:
    """``rows`` with their group's columns; a third of them may be of one group, so few groups are sent to all tasks."""
    return rows.join(F.broadcast(groups) if n_groups <= MAX_BROADCAST else groups, "tree")


def manifest(rows: DataFrame, group: str, key: str, values: Sequence[str], changed: Column | None = None) -> DataFrame:
    """Key, leaf, subroot, root, proof (from the bottom up), folded_root and verified of every row.

    ``changed`` is the leaf (binary) of a row as it is found now, null where it is as it was.
    """
    changed = F.lit(None).cast("binary") if changed is None else changed
    # a tree's name sorts like its group: null first, then bytewise
    named = rows.select(F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("-")).alias("tree"),
                        F.col(key).cast("long").alias("id"), leaf([F.col(v) for v in values]).alias("node"),
                        changed.alias("changed"))
    named = materialize(named, "merkle-leaves")
    sizes = materialize(named.groupBy("tree").agg(F.count(F.lit(1)).alias("n")), "merkle-sizes")
    n_groups = sizes.count()
    placed = with_places(named, "tree", ["id", "node"], "place", "merkle-places")
    leaves = by_tree(placed, sizes, n_groups)
    trees, roots = layers(leaves)
    top = by_tree(prove(leaves, trees), materialize(group_paths(roots), "merkle-paths"), n_groups)
    up = F.aggregate("steps", F.col("folded"), lambda node, s: F.sha2(F.concat(s["left"], node, s["right"]), 256))
    top = top.withColumn("folded_root", up)
    siblings = F.aggregate("steps", F.col("proof"), lambda text, s: F.concat(text, s["left"], s["right"]))
    return top.select(F.col("id").alias(key), F.col("node").alias("leaf"), "subroot", "root", siblings.alias("proof"),
                      "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(*FIELDS)
    tampered = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    more = (F.col("n_chars").cast("decimal(20,0)") + 1).cast("string")
    changed = F.when(tampered & F.col("n_chars").isNotNull(),
                     leaf([more if c == "n_chars" else F.col(c) for c in FIELDS]))
    return manifest(docs, "lang", "doc_id", FIELDS, changed).select(
        "doc_id", "leaf", "subroot", "root", F.sha2("proof", 256).alias("proof_sha256"), "folded_root", "verified")


#: The CRC-32 table by its rule, and its checksum of a decimal number x, for DuckDB.
CRC_TABLE = r"""bits AS (
  SELECT n, n AS v, 0 AS k FROM range(256) AS t(n)
  UNION ALL
  SELECT n, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, k + 1 FROM bits WHERE k < 8),
crc AS (SELECT list(v ORDER BY n) AS t FROM bits WHERE k = 8)"""
CRC = r"""xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST({x} AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
                        lambda c, b: xor(c >> 8, crc.t[(xor(c, b) & 255) + 1])), 4294967295)"""

OP12_SQL = f"""
WITH RECURSIVE {CRC_TABLE},
d AS (SELECT doc_id, source, lang, n_chars, text,
        {CRC.format(x='doc_id')} % 7 = 0 AS hit
      FROM documents, crc),
f AS (SELECT doc_id, lang, hit AND n_chars IS NOT NULL AS hit,
        coalesce(octet_length(encode(CAST(doc_id AS VARCHAR))) || ':' || doc_id, '-')
          || coalesce(octet_length(encode(source)) || ':' || source, '-')
          || coalesce(octet_length(encode(lang)) || ':' || lang, '-') AS a,
        coalesce(octet_length(encode(CAST(n_chars AS VARCHAR))) || ':' || n_chars, '-') AS b,
        coalesce(octet_length(encode(CAST(n_chars + 1 AS VARCHAR))) || ':' || (n_chars + 1), '-') AS b1,
        coalesce(octet_length(encode(text)) || ':' || text, '-') AS c
      FROM d),
l AS (SELECT doc_id, lang, sha256(a || b || c) AS leaf, sha256(a || CASE WHEN hit THEN b1 ELSE b END || c) AS found,
        row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, sha256(a || b || c)) - 1 AS place FROM f),
tree AS (
  SELECT lang, 0 AS level, place, leaf AS node, count(*) OVER (PARTITION BY lang) AS n FROM l
  UNION ALL
  SELECT lang, level + 1, place // 2, sha256(string_agg(node, '' ORDER BY place)), any_value((n + 1) // 2)
  FROM tree WHERE n > 1 GROUP BY lang, level, place // 2),
subs AS (SELECT lang, level AS height, node AS subroot, row_number() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS sub_place,
         count(*) OVER () AS n_subs FROM tree WHERE n = 1),
top AS (
  SELECT 0 AS level, sub_place AS place, subroot AS node, n_subs AS n FROM subs
  UNION ALL
  SELECT level + 1, place // 2, sha256(string_agg(node, '' ORDER BY place)), any_value((n + 1) // 2)
  FROM top WHERE n > 1 GROUP BY level, place // 2),
walk AS (
  SELECT doc_id, l.lang, leaf, place, 0 AS level, found AS node, '' AS proof, FALSE AS up,
         s.height, s.sub_place FROM l JOIN subs s ON l.lang IS NOT DISTINCT FROM s.lang
  UNION ALL
  SELECT w.doc_id, w.lang, w.leaf, CASE WHEN w.up OR w.level < w.height THEN w.place // 2 ELSE w.sub_place END,
         CASE WHEN w.up OR w.level < w.height THEN w.level + 1 ELSE 0 END,
         CASE WHEN NOT w.up AND w.level = w.height THEN w.node
              WHEN w.place % 2 = 1 THEN sha256(coalesce(t.node, p.node, '') || w.node)
              ELSE sha256(w.node || coalesce(t.node, p.node, '')) END,
         w.proof || CASE WHEN NOT w.up AND w.level = w.height THEN '' ELSE coalesce(t.node, p.node, '') END,
         w.up OR w.level = w.height, w.height, w.sub_place
  FROM walk w
  LEFT JOIN tree t ON NOT w.up AND w.level < w.height AND t.lang IS NOT DISTINCT FROM w.lang AND t.level = w.level AND t.place = xor(w.place, 1)
  LEFT JOIN top p ON w.up AND p.level = w.level AND p.place = xor(w.place, 1)
  WHERE NOT w.up OR w.level < (SELECT max(level) FROM top)),
r AS (SELECT node AS root, level AS height FROM top WHERE n = 1)
SELECT w.doc_id, w.leaf, s.subroot, r.root, sha256(w.proof) AS proof_sha256, w.node AS folded_root, w.node = r.root AS verified
FROM walk w, r, subs s WHERE w.up AND w.level = r.height AND s.lang IS NOT DISTINCT FROM w.lang
"""
