"""Substring de-duplication by level-wise doubling (operator 6).

Word windows are compared at 8 words, and only windows of repeated ones are extended to 16, to 32 and at
last to 35 words.  A window's name at twice the length is the hash of the two names of half the length, and
the 35 words are two overlapping windows of 32.  The eight-word level looks at the anchors of ``repeats``; the
candidates that are left are dealt by their eight-word and sixteen-word anchors, so that equal windows meet, and are
extended there.  Candidates whose eight-word anchor is in more than ``FREQUENT`` places (as at the edges of a passage in a
third of all documents, which reach into different words in each) are dealt one by one, by the name of their 35 words.

Copies of one surrounding, or of one such window, inside a block are known to repeat without asking further: one of them
goes on as the witness for other blocks.  So no key is dealt more than ``FREQUENT`` surroundings, or one window a block.

Defined results: null and empty text have no words; texts shorter than a window lose nothing; every row is a
text of its own, so repeated rows (equal doc_id too) are copies of each other and lose all windows;
rows without doc_id are handled like others.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import mix, pair, table
from .repeats import (among, anchors, blocks, chunks, per_block, ranges, raw_texts, repeated_anchors, runs,
                      spans_by_document, valid_windows, with_blocks)

WINDOW, LEVELS = 35, (8, 16, 32)
#: Bytes of text per block, per bucket of anchors and per shard of candidate windows.
BLOCK_BYTES, ANCHOR_BYTES, SHARD_BYTES = 16 << 20, 128 << 20, 8 << 20
#: Places of an eight-word anchor beyond which its windows are dealt by their names: its names fill a quarter of a shard.
FREQUENT = 1 << 14


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def _words(texts: list[bytes]):
    """Per chunk of documents: (first document, words per document, hash of every word)."""
    known = _WordHashes()
    split = [t.split() for t in texts]
    sizes = np.fromiter(map(len, split), np.int64, len(split))
    for a, b in chunks(sizes, 1 << 18):
        if len(known) > 300_000:
            known.clear()
        yield a, sizes[a:b], np.fromiter((known[w] for words in split[a:b] for w in words), np.uint64, int(sizes[a:b].sum()))


def _doubled(names: np.ndarray, times: int, width: int = 1) -> np.ndarray:
    """Names of windows of ``width * 2 ** times`` words from those of ``width`` words."""
    for _ in range(times):
        names, width = pair(names[:-width], names[width:]) if len(names) > width else names[:0], 2 * width
    return names


def _first_level(texts: pa.Table) -> pa.Table:
    seen = [np.zeros(0, np.uint64)]
    for _, sizes, words in _words(raw_texts(texts)):
        if len(words) >= WINDOW:
            valid, _ = valid_windows(sizes, WINDOW)
            names = _doubled(words, 3)
            seen.append(names[anchors(names, valid, WINDOW - LEVELS[0] + 1)[1]])
    h, times = np.unique(np.concatenate(seen), return_counts=True)
    block = texts.column("block")[0].as_py()
    return pa.table({"block": pa.array(np.full(len(h), block, np.int32)), "h": h.view(np.int64), "n": times.astype(np.int32)})


_ROWS = "bucket int, known boolean, many boolean, inner boolean, a long, block int, doc int, start int, size int, names binary"


def _extend(texts: pa.Table, repeated: pa.Table, shards: int) -> pa.Table:
    """Candidate windows in runs of one pair of anchors, or alone, with the 32-word names that they need."""
    known = repeated.column("h").to_numpy().view(np.uint64)
    frequent = np.sort(known[repeated.column("frequent").to_numpy(zero_copy_only=False)])
    known = np.sort(known)
    more = WINDOW - LEVELS[2]
    cols: dict[str, list] = {k: [] for k in ("a", "deal", "doc", "start", "size", "names", "inner")}
    for first, sizes, words in _words(raw_texts(texts)) if len(known) else ():
        if len(words) < WINDOW:
            continue
        valid, owner = valid_windows(sizes, WINDOW)
        eight = _doubled(words, 3)
        first_anchor = anchors(eight, valid, WINDOW - LEVELS[0] + 1)[0]
        ok = valid & among(first_anchor, known)
        sixteen = _doubled(eight, 1, 8)
        wide = _doubled(sixteen, 1, 16)
        least = anchors(sixteen, valid, WINDOW - LEVELS[1] + 1)[0]
        both = pair(first_anchor, least)
        alone = among(first_anchor, frequent)
        deal = np.where(alone, pair(wide[:-more], wide[more:]), both)
        a, b = runs(np.where(alone, mix(np.arange(len(both), dtype=np.uint64)), both), ok, owner)
        if not len(a):
            continue
        size = b - a + WINDOW - LEVELS[1]  # an anchor that a run holds twice can repeat inside the run
        same = (sixteen[ranges(a, size)] == np.repeat(least[a], size)).astype(np.int64)
        twice = np.add.reduceat(same, np.cumsum(size) - size) > 1
        size = b - a + more
        data, ends = wide[ranges(a, size)], np.concatenate(([0], np.cumsum(size))) * 8
        buffers = [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(data)]
        names = pa.Array.from_buffers(pa.large_binary(), len(a), buffers)
        cols["a"].append(both[a])
        cols["deal"].append(deal[a])
        cols["size"].append((b - a).astype(np.int32))
        cols["inner"].append(twice)
        cols["doc"].append((first + owner[a]).astype(np.int32))
        cols["start"].append((a - (np.cumsum(sizes) - sizes)[owner[a]]).astype(np.int32))
        cols["names"].append(names.cast(pa.binary()))
    if not cols["a"]:
        return pa.table({c.split()[0]: [] for c in _ROWS.split(", ")}, pa.schema(
            [("bucket", pa.int32()), ("known", pa.bool_()), ("many", pa.bool_()), ("inner", pa.bool_()), ("a", pa.int64()),
             ("block", pa.int32()), ("doc", pa.int32()), ("start", pa.int32()), ("size", pa.int32()), ("names", pa.binary())]))
    a, deal, doc, start, size, inner = (np.concatenate(cols[k]) for k in ("a", "deal", "doc", "start", "size", "inner"))
    names = pa.chunked_array(cols["names"]).combine_chunks()
    block = texts.column("block")[0].as_py()
    code = pc.dictionary_encode(names).indices.to_numpy()
    order = np.lexsort((start, doc, code, a))
    new = np.concatenate(([True], (a[order][1:] != a[order][:-1]) | (code[order][1:] != code[order][:-1])))
    group = np.cumsum(new) - 1
    alike = np.empty(len(a), np.int64)
    alike[order] = np.bincount(group)[group]
    witness = np.empty(len(a), bool)
    witness[order] = new
    asked = pa.table({"bucket": (deal % np.uint64(shards)).astype(np.int32), "known": ~witness, "many": alike > 1, "inner": inner,
                      "a": a.view(np.int64), "block": np.full(len(a), block, np.int32), "doc": doc, "start": start, "size": size,
                      "names": names}).filter(pa.array(witness))
    # what is known to repeat needs no names, and goes as one range where it is adjacent
    doc, start, size = doc[~witness], start[~witness], size[~witness]
    order = np.lexsort((start, doc))
    doc, start, size = doc[order], start[order], size[order]
    new = np.flatnonzero(np.concatenate(([True], (doc[1:] != doc[:-1]) | (start[1:] != (start + size)[:-1])))[:len(doc)])
    doc, start, size = doc[new], start[new], np.add.reduceat(size, new) if len(new) else size
    bucket = (doc.astype(np.uint64) + np.uint64(block)) % np.uint64(shards)
    yes, no = np.ones(len(doc), bool), np.zeros(len(doc), bool)
    sure = pa.table({"bucket": bucket.astype(np.int32), "known": yes, "many": no, "inner": no, "a": np.zeros(len(doc), np.int64),
                     "block": np.full(len(doc), block, np.int32), "doc": doc, "start": start, "size": size.astype(np.int32),
                     "names": pa.array([b""] * len(doc), pa.binary())})
    return pa.concat_tables([asked, sure]).combine_chunks()


def _repeated(names: np.ndarray, a: np.ndarray) -> np.ndarray:
    """Which pairs of name and anchors occur more than once."""
    if not len(names):
        return np.zeros(0, bool)
    _, inverse, times = np.unique(np.column_stack([names, a]), axis=0, return_inverse=True, return_counts=True)
    return times[inverse.ravel()] > 1


def _last_level(group: pa.Table) -> pa.Table:
    """Windows that occur elsewhere, as ranges of starts (block, doc, start, stop)."""
    known, many, inner = (group.column(c).to_numpy() for c in ("known", "many", "inner"))
    a = group.column("a").to_numpy().view(np.uint64)
    block, doc, start = (group.column(c).to_numpy() for c in ("block", "doc", "start"))
    sizes = group.column("size").to_numpy()
    sure = known | many
    out = [(block[sure], doc[sure], start[sure], start[sure] + sizes[sure])]
    # sixteen words: an anchor in one place ends here; the others are extended to 32 words
    _, inverse, times = np.unique(a[~known], return_inverse=True, return_counts=True)
    more = np.flatnonzero(~known)[(times[inverse] > 1) | inner[~known]] if len(times) else np.zeros(0, np.int64)
    if len(more):
        wide = [np.frombuffer(x.as_py(), np.uint64) for x in group.column("names").take(pa.array(more))]
        names, ends = np.concatenate([w[:-3] for w in wide]), np.concatenate([w[3:] for w in wide])
        row = np.repeat(more, sizes[more])
        at = ranges(start[more].astype(np.int64), sizes[more].astype(np.int64))
        # 32 words: a window whose first 32 stand nowhere else ends here; the others are extended to 35
        again = _repeated(names, a[row])
        names, ends, row, at = names[again], ends[again], row[again], at[again]
        hit = _repeated(pair(names, ends), a[row]) & ~many[row]
        first, last = runs(row, hit, row)
        out.append((block[row[first]], doc[row[first]], at[first], at[last - 1] + 1))
    block, doc, start, stop = (np.concatenate(x) for x in zip(*out))
    return pa.table({"block": block.astype(np.int32), "doc": doc.astype(np.int32), "start": start.astype(np.int32),
                     "stop": stop.astype(np.int32)})


def _without(texts: pa.Table, found: pa.Table) -> pa.Table:
    n_words, kept = [], []
    raw = raw_texts(texts)
    for text, spans in zip(raw, spans_by_document(found, len(raw), WINDOW)):
        words = text.split()
        n_words.append(len(words))
        for a, b in reversed(spans):
            del words[a:b]
        kept.append((len(words), b" ".join(words)))
    return pa.table({"doc_id": texts.column("doc_id"), "n_words": pa.array(n_words, pa.int64()),
                     "n_removed": pa.array([n - k for n, (k, _) in zip(n_words, kept)], pa.int64()),
                     "text": pa.array([t for _, t in kept], pa.binary()).cast(pa.string())})


def drop_repeated_windows(docs: DataFrame, frequent: int = FREQUENT) -> DataFrame:
    """doc_id, n_words, n_removed and text (the words that stay, joined by one blank), one row per input row."""
    dealt, total = blocks(docs, BLOCK_BYTES)
    shards = total // SHARD_BYTES + 1
    found = per_block(dealt, _first_level, "block int, h long, n int")
    again = repeated_anchors(found, total, ANCHOR_BYTES, frequent)
    candidates = with_blocks(dealt, again, lambda t, r: _extend(t, r, shards), _ROWS)
    windows = candidates.groupBy("bucket").applyInArrow(_last_level, "block int, doc int, start int, stop int")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return with_blocks(dealt, windows, _without, f"doc_id {kind}, n_words long, n_removed long, text string")


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return drop_repeated_windows(docs).select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


OP6_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
w AS (SELECT r, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM d),
g AS (SELECT r, i, array_to_string(words[i:i + 34], ' ') AS s FROM (SELECT r, words, unnest(range(1, len(words) - 33)) AS i FROM d)),
hit AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY s) AS n FROM g) WHERE n > 1),
m AS (SELECT w.r, w.i, w.word, max(hit.i) OVER (PARTITION BY w.r ORDER BY w.i ROWS 34 PRECEDING) IS NOT NULL AS gone
      FROM w LEFT JOIN hit ON w.r = hit.r AND w.i = hit.i),
k AS (SELECT r, count(*) FILTER (WHERE gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (WHERE NOT gone) AS kept FROM m GROUP BY r)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (r)
"""
