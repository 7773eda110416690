"""What operators 3 and 6 share: documents in blocks, and the anchors that tell which parts can repeat at all.

An anchor of a window is the least hash of the short grams inside it.  Equal windows have equal anchors, so a
window whose anchor occurs in one place only has no copy anywhere: anchors (about one in eighteen positions)
are compared over the whole corpus first, and only windows of repeated anchors go on to the method itself.
Nothing is lost by that: it is a necessary condition, not a sample.

Documents are dealt once to blocks by a hash.  A block is what one Python call holds; inside it documents
are put in a fixed order, so that (block, position) names a document in every later step.  The plan
uses the same exchange of texts for each step, and Spark runs it once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, sliding_min, whole_text

CHUNK = 1 << 20
#: Documents of a block, whatever they hold.
BLOCK_ROWS = 2_000
#: Bytes of text per bucket of anchors.
ANCHOR_BYTES = 32 << 20
_LAST = np.iinfo(np.int64).max


def blocks(docs: DataFrame, block_bytes: int, copies_together: bool = False) -> tuple[DataFrame, int]:
    """(block, doc_id, text) and the bytes of all texts; as many blocks as their bytes or their number ask for.

    ``copies_together`` deals equal texts to one block, or to several if they fill more than half a block: the few texts
    of so many copies are counted first, and Spark decides by their size how to join them.
    """
    text = whole_text(docs)
    total, rows = docs.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0)), F.count(F.lit(1))).first()
    n = F.lit(max(total // block_bytes, rows // BLOCK_ROWS) + 1)
    base = docs.select(docs["doc_id"], text.alias("text"))
    if not copies_together:
        return base.select(F.pmod(F.xxhash64("doc_id", "text"), n).cast("int").alias("block"), "doc_id", "text"), total
    size = F.sum(F.octet_length("text"))
    many = materialize(base.groupBy(F.xxhash64("text").alias("copy")).agg(F.ceil(2 * size / block_bytes).cast("int").alias("parts"))
                       .where("parts > 1"), "copies")
    dealt = base.withColumn("copy", F.xxhash64("text")).join(many, "copy", "left")
    part = F.pmod(F.xxhash64("doc_id"), F.coalesce("parts", F.lit(1)))
    return dealt.select(F.pmod(F.xxhash64("copy", part), n).cast("int").alias("block"), "doc_id", "text"), total


def later_copies(table: pa.Table) -> np.ndarray:
    """Which texts of a block also belong to a document that comes before theirs."""
    code = pc.dictionary_encode(table.column("text").combine_chunks()).indices.to_numpy() if table.num_rows else np.zeros(0, int)
    rank = ranks(table)
    least = np.full(int(code.max()) + 1 if len(code) else 0, _LAST)
    np.minimum.at(least, code, rank)
    return rank > least[code]


def in_order(table: pa.Table) -> pa.Table:
    """Rows of a block in an order that does not depend on how they arrived."""
    return table.take(pc.sort_indices(table, [("doc_id", "ascending"), ("text", "ascending")])) \
        if table.num_rows > 1 else table


def raw_texts(table: pa.Table) -> list[bytes]:
    return table.column("text").cast(pa.large_string()).cast(pa.large_binary()).to_pylist()


def ranks(table: pa.Table) -> np.ndarray:
    """doc_id as an order; rows without one come after all."""
    return pc.fill_null(table.column("doc_id").cast(pa.int64()), _LAST).to_numpy()


def chunks(sizes: np.ndarray, most: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Ranges of documents of about ``most`` units together."""
    a = total = 0
    for k, size in enumerate(sizes):
        if total and total + size > most:
            yield a, k
            a, total = k, 0
        total += size
    if a < len(sizes):
        yield a, len(sizes)


def valid_windows(sizes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Of the windows over documents laid end to end: does it lie in one document; the document it starts in."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    starts = owner[:max(len(owner) - width + 1, 0)]
    return starts == owner[width - 1:] if len(starts) else np.zeros(0, bool), starts


def anchors(grams: np.ndarray, valid: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray]:
    """(anchor of every window, positions of grams that are an anchor); ``span`` grams make a window."""
    least = sliding_min(grams, span)
    edge = np.zeros(span - 1, np.uint64)
    most = ~sliding_min(~np.concatenate([edge, np.where(valid, least, np.uint64(0)), edge]), span)
    return least, np.flatnonzero((most == grams) & (most != 0))


def runs(keys: np.ndarray, ok: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal ranges [a, b) of consecutive positions that are ok and agree in key and owner."""
    at = np.flatnonzero(ok)
    if not len(at):
        return at, at
    new = np.concatenate(([True], (np.diff(at) != 1) | (keys[at[1:]] != keys[at[:-1]]) | (owner[at[1:]] != owner[at[:-1]])))
    first = np.flatnonzero(new)
    return at[first], at[np.concatenate((first[1:] - 1, [len(at) - 1]))] + 1


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """starts[0] .. starts[0] + sizes[0] - 1, starts[1] .., as one array of indices."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def times(keys: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """For each key: the summed weights of its equals."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    out = np.empty(len(keys), np.int64)
    out[order] = np.repeat(np.add.reduceat(weight[order], first), np.diff(np.append(first, len(keys))))
    return out


def repeated_anchors(found: DataFrame, total: int, anchor_bytes: int = ANCHOR_BYTES, limit: int = 1 << 62) -> DataFrame:
    """(block, h, frequent) of the anchors that occur in several places; ``found`` has (block, h, n), once per block.

    ``frequent`` tells those of more than ``limit`` places.  A block sends each anchor once, with the number of its places,
    so an anchor has a row per block here.
    """
    def run(group: pa.Table) -> pa.Table:
        h, block, n = (group.column(c).to_numpy() for c in ("h", "block", "n"))
        seen = times(h.view(np.uint64), n.astype(np.int64)) if len(h) else np.zeros(0, np.int64)
        again = seen > 1
        return pa.table({"block": block[again], "h": h[again], "frequent": (seen > limit)[again]})
    bucket = F.pmod(F.shiftrightunsigned("h", 32), F.lit(total // anchor_bytes + 1)).cast("int")
    return found.withColumn("bucket", bucket).groupBy("bucket").applyInArrow(run, "block int, h long, frequent boolean")


def among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Is each value in the sorted array ``known``?"""
    if not len(known):
        return np.zeros(len(values), bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def per_block(dealt: DataFrame, fn: Callable[[pa.Table], pa.Table], schema: str) -> DataFrame:
    return dealt.groupBy("block").applyInArrow(lambda t: fn(in_order(t)), schema)


def with_blocks(dealt: DataFrame, other: DataFrame, fn: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
    return dealt.groupBy("block").cogroup(other.groupBy("block")).applyInArrow(lambda a, b: fn(in_order(a), b), schema)


def spans_by_document(found: pa.Table, n: int, width: int) -> list[list[tuple[int, int]]]:
    """Per document of a block: the merged spans that windows starting in [start, stop) cover."""
    out: list[list[tuple[int, int]]] = [[] for _ in range(n)]
    doc, start, stop = (found.column(c).to_numpy() for c in ("doc", "start", "stop"))
    order = np.lexsort((start, doc))
    for d, a, b in zip(doc[order].tolist(), start[order].tolist(), stop[order].tolist()):
        spans, b = out[d], b - 1 + width
        if spans and a <= spans[-1][1]:
            spans[-1] = (spans[-1][0], max(spans[-1][1], b))
        else:
            spans.append((a, b))
    return out
