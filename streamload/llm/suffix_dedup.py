"""Exact substring de-duplication by a difference-cover suffix sort (operator 3).

A byte goes if a 50-byte string that covers it also starts in a document of smaller doc_id.

Texts are first reduced to surroundings that can repeat (``repeats``), which are dealt by their anchor, so that
equal 50-byte strings meet in one shard.  Anchors repeat if their gram stands elsewhere between the same 21 bytes on one side.

Frequent grams (of more than some ``FREQUENT`` texts) are told beforehand, from one text in ``SAMPLE``: which grams are
called frequent decides only how windows are dealt, never which are compared, so an estimate does.  A frequent gram is
counted with the bytes before it and with those after it, as two keys, of each of which a block sends one; and its windows
are dealt by it and the 21 bytes on that side of it which lies wholly inside the window, and if those are as frequent, by
their own 50 bytes: each of these is a function of the window's bytes alone, so equal strings still meet.  If there are more
than ``MAX_GRAMS`` frequent grams, all are treated so.  So no key has more than some ``FREQUENT`` texts' anchors or
surroundings, or one key or window a block; only that a text has a window several times, or that rows of equal doc_id or
without one have it, is not merged in a block.  Each shard sorts its suffixes by the difference cover {1, 2} modulo 3:

1. the suffixes at positions 1 and 2 modulo 3 are sorted by triples of eight-byte characters (each first replaced by its
   place among all, so that pairs of them are one number), which names them;
2. triples of names are sorted in turn (one recursion reaches 72 bytes, more than the 50 that matter);
3. the remaining suffixes are sorted by their first byte and the name of the next one, and merged into the
   others by the same comparison;
4. adjacent suffixes whose first 50 bytes agree form a class, whose least doc_id decides.

Equal texts are dealt to one block (many of them to several), where all but the smallest document's go as a whole.
Equal surroundings inside a block, and then inside a shard, are one string with the least of their doc_ids, so a
passage in a third of all documents is sorted once.  On the small tables (sf0.01) copies of whole texts are 47 % of the
bytes that go, and of the other windows 79 % are decided by equal surroundings of their block; the sort decides the rest,
and every window that stays.

Defined results: null and empty text have no bytes; texts under 50 bytes lose nothing; rows of equal doc_id do
not remove each other's bytes; rows without doc_id count as larger than all others and equal among themselves.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import mix, sliding_min, table, whole_text
from .repeats import (ANCHOR_BYTES, among, anchors, blocks, chunks, later_copies, per_block, ranges, ranks, raw_texts, runs,
                      spans_by_document, times, valid_windows, with_blocks)

WIDTH, GRAM = 50, 8
#: Bytes of text per block and per shard, and units that numpy works on at once.
BLOCK_BYTES, SHARD_BYTES, CHUNK = 8 << 20, 3 << 20, 1 << 18
#: Documents of one key beyond which its windows are dealt by more of their bytes: surroundings of them fill a shard.
FREQUENT = SHARD_BYTES // (2 * WIDTH - GRAM)
SIDE = (WIDTH - GRAM) // 2
#: One text in how many tells the frequent grams, and how many of those are broadcast (8 bytes each) at most.
SAMPLE, MAX_GRAMS = 64, 1_000_000
#: What two anchors have in common whose windows are equal: the gram with the bytes before it, or with those after it.
GRAM_MASK, BEFORE_MASK, AFTER_MASK = 0xFFFF_FFFF_0000_0000, 0xFFFF_FFFF_FFFF_0000, 0xFFFF_FFFF_0000_FFFF


def eight_bytes(text: np.ndarray) -> np.ndarray:
    """The eight bytes at every position as one number of the same order; the text is followed by zeros."""
    x = np.concatenate([text, np.zeros(8, np.uint8)]).astype(np.uint64)
    x = (x[:-1] << np.uint64(8)) | x[1:]
    x = (x[:-2] << np.uint64(16)) | x[2:]
    return ((x[:-4] << np.uint64(32)) | x[4:])[:len(text)]


def _grams(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes, the eight-byte word at each of them, and the hash of the gram that starts there."""
    text = np.frombuffer(b"".join(raw), np.uint8)
    eight = eight_bytes(text)
    return text, eight, mix(eight)[:max(len(text) - GRAM + 1, 0)]


def _keys(eight: np.ndarray, grams: np.ndarray, at: np.ndarray) -> np.ndarray:
    """32 bits of the gram, 16 of the 21 bytes before it and 16 of the 21 bytes after it.

    Two places that share a 50-byte window around the gram agree in the gram and, as 42 more bytes agree, in 21 bytes on
    one side.  (At the ends of a text the side that is not there is not the one that agrees.)
    """
    padded = np.concatenate([np.zeros(SIDE, np.uint64), eight, np.zeros(2 * WIDTH, np.uint64)])
    low = np.uint64(0xFFFF)
    before, after = _hash(padded, at, SIDE) & low, _hash(padded, at + SIDE + GRAM, SIDE) & low
    return (grams[at] & np.uint64(GRAM_MASK)) | (before << np.uint64(16)) | after


def _hash(eight: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` bytes from each place on."""
    out = mix(eight[at])
    for k in (*range(8, size - 8, 8), size - 8):
        out = mix(out ^ eight[at + k])
    return out


def _is_frequent(keys: np.ndarray, grams_of: np.ndarray | None) -> np.ndarray:
    """Are the keys' (or grams') grams among the frequent ones?  None: all are."""
    return np.ones(len(keys), bool) if grams_of is None else among(keys & np.uint64(GRAM_MASK), grams_of)


class _Known:
    """What a block was told of its anchors: keys that repeat; of frequent grams those with one side, and the frequent ones."""

    def __init__(self, repeated: pa.Table, grams_of: np.ndarray | None):
        kind, h, frequent = (repeated.column(c).to_numpy() for c in ("kind", "h", "frequent"))
        h = h.view(np.uint64)
        self.grams_of = grams_of
        self.whole, self.before, self.after = (np.sort(h[kind == k]) for k in range(3))
        self.often_before, self.often_after = (np.sort(h[(kind == k) & frequent]) for k in (1, 2))

    def __len__(self) -> int:
        return len(self.whole) + len(self.before) + len(self.after)

    def repeats(self, keys: np.ndarray) -> np.ndarray:
        sides = among(keys & np.uint64(BEFORE_MASK), self.before) | among(keys & np.uint64(AFTER_MASK), self.after)
        return np.where(_is_frequent(keys, self.grams_of), sides, among(keys, self.whole))


def _dealt(eight: np.ndarray, grams: np.ndarray, places: np.ndarray, least: np.ndarray, ok: np.ndarray,
           known: _Known) -> tuple[np.ndarray, np.ndarray]:
    """(hash that each window is dealt by, key of the run that it may be in); windows found not to repeat leave ``ok``.

    ``places`` are all anchors.  All that decides is inside the window: the first place of its anchor, and the side with the
    more bytes.
    """
    deal, run = least.copy(), least.copy()
    s = np.flatnonzero(ok)
    s = s[_is_frequent(least[s], known.grams_of)]
    if not len(s):
        return deal, run
    k = np.searchsorted(places, s)
    while len(behind := np.flatnonzero(grams[places[k]] != least[s])):
        k[behind] += 1
    at = places[k]
    keys = _keys(eight, grams, at)
    again = known.repeats(keys)  # equal windows agree in the first place of their anchor too
    ok[s[~again]] = False
    s, at, keys = s[again], at[again], keys[again]
    padded = np.concatenate([np.zeros(SIDE, np.uint64), eight, np.zeros(2 * WIDTH, np.uint64)])
    left = at - s >= SIDE
    deal[s] = mix(grams[at] ^ _hash(padded, np.where(left, at, at + SIDE + GRAM), SIDE) ^ left.astype(np.uint64))
    run[s] = mix((2 * at + left).astype(np.uint64))
    s = s[np.where(left, among(keys & np.uint64(BEFORE_MASK), known.often_before),
                   among(keys & np.uint64(AFTER_MASK), known.often_after))]
    deal[s] = _hash(padded, s + SIDE, WIDTH)
    run[s] = mix(~s.astype(np.uint64))
    return deal, run


def _without_copies(texts: pa.Table) -> list[bytes]:
    """The texts of a block, empty for copies of a smaller document's text: those go as a whole."""
    return [b"" if copy else text for text, copy in zip(raw_texts(texts), later_copies(texts))]


def _anchor_keys(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(key, document) of every anchor of the texts, each pair once, in order."""
    seen, docs = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    sizes = np.fromiter(map(len, raw), np.int64, len(raw))
    for a, b in chunks(sizes, CHUNK):
        text, eight, grams = _grams(raw[a:b])
        if len(text) >= WIDTH:
            valid, _ = valid_windows(sizes[a:b], WIDTH)
            at = anchors(grams, valid, WIDTH - GRAM + 1)[1]
            seen.append(_keys(eight, grams, at))
            docs.append(a + np.searchsorted(np.cumsum(sizes[a:b]), at, "right"))
    h, doc = np.concatenate(seen), np.concatenate(docs)
    order = np.lexsort((doc, h))
    h, doc = h[order], doc[order]
    once = np.concatenate(([True], (h[1:] != h[:-1]) | (doc[1:] != doc[:-1]))) if len(h) else np.zeros(0, bool)
    return h[once], doc[once]


def _summed(h: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    names, inverse = np.unique(h, return_inverse=True)
    return names, np.bincount(inverse, n, len(names)).astype(np.int64)


def _first_level(texts: pa.Table, grams_of: np.ndarray | None) -> pa.Table:
    """Keys of a block's anchors, and how many of its documents have each; frequent grams with the bytes on either side."""
    h, n = np.unique(_anchor_keys(_without_copies(texts))[0], return_counts=True)
    often = _is_frequent(h, grams_of)
    kinds = [(h[~often], n[~often]), *(_summed(h[often] & np.uint64(m), n[often]) for m in (BEFORE_MASK, AFTER_MASK))]
    block = texts.column("block")[0].as_py()
    kind = np.repeat(np.arange(3, dtype=np.int32), [len(x) for x, _ in kinds])
    h, n = (np.concatenate(x) for x in zip(*kinds))
    return pa.table({"block": np.full(len(h), block, np.int32), "kind": kind, "h": h.view(np.int64), "n": n.astype(np.int32)})


def _gram_counts(texts: pa.Table) -> pa.Table:
    """Grams of a block's anchors, and how many of its different texts have each."""
    h, doc = _anchor_keys([t.encode() for t in pc.unique(texts.column("text")).to_pylist()])
    pairs = np.unique(np.column_stack([h & np.uint64(GRAM_MASK), doc.astype(np.uint64)]), axis=0) if len(h) else np.zeros((0, 2), np.uint64)
    grams, n = np.unique(pairs[:, 0], return_counts=True)
    return pa.table({"gram": grams.view(np.int64), "n": n.astype(np.int64)})


def frequent_grams(docs: DataFrame, total: int, frequent: int, sample: int) -> np.ndarray | None:
    """The grams (upper 32 bits of their hash) that are anchors in more than about ``frequent`` texts; None: too many to send.

    A gram of more than ``frequent`` texts is in more than half of as many of the sampled ones as can be expected.
    """
    text = whole_text(docs)
    some = docs.select(docs["doc_id"], text.alias("text")).where(F.pmod(F.xxhash64(text), F.lit(sample)) == 0)
    n = total // sample // BLOCK_BYTES + 1
    counts = per_block(some.withColumn("block", F.pmod(F.xxhash64(F.lit(1), "text"), F.lit(n)).cast("int")), _gram_counts, "gram long, n long")
    found = counts.groupBy("gram").agg(F.sum("n").alias("n")).where(2 * sample * F.col("n") > frequent).select("gram")
    rows = found.limit(MAX_GRAMS + 1).toPandas()["gram"].to_numpy(np.int64)
    return None if len(rows) > MAX_GRAMS else np.sort(rows.view(np.uint64))


def repeated_keys(found: DataFrame, total: int, frequent: int) -> DataFrame:
    """(block, kind, h, frequent) of the keys that occur in several places; ``found`` has (block, kind, h, n), once per block.

    Whole keys (kind 0) are dealt by their gram, and repeat if they agree with another one on either side; keys of one side
    are dealt by themselves.
    """
    def run(group: pa.Table) -> pa.Table:
        kind, h, block, n = (group.column(c).to_numpy() for c in ("kind", "h", "block", "n"))
        h, n = h.view(np.uint64), n.astype(np.int64)
        again, often = np.zeros(len(h), bool), np.zeros(len(h), bool)
        whole = np.flatnonzero(kind == 0)
        for mask in (BEFORE_MASK, AFTER_MASK) if len(whole) else ():
            again[whole] |= times(h[whole] & np.uint64(mask), n[whole]) > 1
        for k in (1, 2):
            own = np.flatnonzero(kind == k)
            if len(own):
                seen = times(h[own], n[own])
                again[own], often[own] = seen > 1, seen > frequent
        return pa.table({"block": block[again], "kind": kind[again], "h": h[again].view(np.int64), "frequent": often[again]})
    deal = F.when(F.col("kind") == 0, F.shiftrightunsigned("h", 32)).otherwise(F.xxhash64("kind", "h"))
    return found.withColumn("bucket", F.pmod(deal, F.lit(total // ANCHOR_BYTES + 1)).cast("int")) \
        .groupBy("bucket").applyInArrow(run, "block int, kind int, h long, frequent boolean")


_ROWS = pa.schema([("bucket", pa.int32()), ("known", pa.bool_()), ("block", pa.int32()), ("doc", pa.int32()),
                   ("start", pa.int32()), ("rank", pa.int64()), ("part", pa.binary())])
_DDL = "bucket int, known boolean, block int, doc int, start int, rank long, part binary"


def _surroundings(texts: pa.Table, repeated: pa.Table, shards: int, grams_of: np.ndarray | None) -> pa.Table:
    """Runs of windows of one repeated anchor, with the bytes that they cover."""
    known = _Known(repeated, grams_of)
    raw = _without_copies(texts)
    sizes = np.fromiter(map(len, raw), np.int64, len(raw))
    cols: dict[str, list] = {k: [] for k in ("h", "doc", "start", "part")}
    for first, last in chunks(sizes, CHUNK) if len(known) else ():
        text, eight, grams = _grams(raw[first:last])
        if len(text) < WIDTH:
            continue
        valid, owner = valid_windows(sizes[first:last], WIDTH)
        least, places = anchors(grams, valid, WIDTH - GRAM + 1)
        open_at = np.full(len(grams), ~np.uint64(0))
        at = places[known.repeats(_keys(eight, grams, places))]
        open_at[at] = grams[at]
        ok = valid & (least == sliding_min(open_at, WIDTH - GRAM + 1))
        deal, run = _dealt(eight, grams, places, least, ok, known)
        a, b = runs(run, ok, owner)
        if not len(a):
            continue
        size = b - a + WIDTH - 1
        data, ends = text[ranges(a, size)], np.concatenate(([0], np.cumsum(size)))
        buffers = [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(data)]
        part = pa.Array.from_buffers(pa.large_binary(), len(a), buffers)
        cols["h"].append(deal[a])
        cols["doc"].append((first + owner[a]).astype(np.int32))
        cols["start"].append((a - (np.cumsum(sizes[first:last]) - sizes[first:last])[owner[a]]).astype(np.int32))
        cols["part"].append(part.cast(pa.binary()))
    if not cols["h"]:
        return _ROWS.empty_table()
    h, doc, start = (np.concatenate(cols[k]) for k in ("h", "doc", "start"))
    part = pa.chunked_array(cols["part"]).combine_chunks()
    rank = ranks(texts)[doc]
    code = pc.dictionary_encode(part).indices.to_numpy()
    least_rank = np.full(code.max() + 1, np.iinfo(np.int64).max)
    np.minimum.at(least_rank, code, rank)
    sure = rank > least_rank[code]
    block = texts.column("block")[0].as_py()
    size = pc.binary_length(part).to_numpy() - WIDTH + 1
    asked = pa.table({"bucket": (h % np.uint64(shards)).astype(np.int32), "known": sure, "block": np.full(len(h), block, np.int32),
                      "doc": doc, "start": start, "rank": rank, "part": part}, _ROWS).filter(pa.array(~sure))
    # what is known to go needs its size only, and goes as one range where it is adjacent
    doc, start, size, rank = doc[sure], start[sure], size[sure], rank[sure]
    order = np.lexsort((start, doc))
    doc, start, size, rank = doc[order], start[order], size[order], rank[order]
    new = np.flatnonzero(np.concatenate(([True], (doc[1:] != doc[:-1]) | (start[1:] != (start + size)[:-1])))[:len(doc)])
    doc, start, rank, size = doc[new], start[new], rank[new], np.add.reduceat(size, new) if len(new) else size
    bucket = (doc.astype(np.uint64) + np.uint64(block)) % np.uint64(shards)
    gone = pa.table({"bucket": bucket.astype(np.int32), "known": np.ones(len(doc), bool), "block": np.full(len(doc), block, np.int32),
                     "doc": doc, "start": start, "rank": rank,
                     "part": pa.array([x.to_bytes(4, "little") for x in size.tolist()], pa.binary())}, _ROWS)
    return pa.concat_tables([asked, gone]).combine_chunks()


def _names(key: np.ndarray) -> np.ndarray:
    """Each row's name: equal keys have equal, larger keys larger names, from 1."""
    order = np.argsort(key)
    in_order = key[order]
    name = np.empty(len(key), np.int64)
    name[order] = np.cumsum(np.concatenate(([True], in_order[1:] != in_order[:-1])))[:len(key)]
    return name


def _triples(first: np.ndarray, second: np.ndarray, third: np.ndarray) -> np.ndarray:
    """Names of triples of names: two passes, each over pairs that fit one number."""
    return _names((_names((first << 32) | second) << 32) | third)


def suffix_order(text: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The ``wanted`` positions in the order of their suffixes (to 72 bytes at least)."""
    n = len(text)
    padded = np.concatenate([text, np.zeros(80, np.uint8)])
    word = _names(eight_bytes(padded))
    sample = np.flatnonzero(np.arange(n + 3) % 3)
    name = _triples(word[sample], word[sample + 8], word[sample + 16])
    names = np.zeros(n + 128, np.int64)
    names[sample] = name
    if name.max() < len(sample):  # recurse on the names while some are equal
        names[sample] = _triples(name, names[sample + 24], names[sample + 48])
    one, two, rest = (wanted[wanted % 3 == r] for r in (1, 2, 0))
    one, two = one[np.argsort(names[one])], two[np.argsort(names[two])]
    byte = padded.astype(np.int64)
    by_next = lambda p: (byte[p] << 40) | names[p + 1]
    by_second = lambda p: (byte[p] << 48) | (byte[p + 1] << 40) | names[p + 2]
    rest = rest[np.argsort(by_next(rest))]
    sampled = np.concatenate([one, two])
    sampled = sampled[np.argsort(names[sampled])]
    place = (np.arange(len(rest)) + np.searchsorted(by_next(one), by_next(rest))
             + np.searchsorted(by_second(two), by_second(rest)))
    merged = np.empty(len(wanted), np.int64)
    taken = np.zeros(len(wanted), bool)
    place = np.maximum.accumulate(place - np.arange(len(rest))) + np.arange(len(rest)) if len(rest) else place
    taken[place] = True
    merged[taken], merged[~taken] = rest, sampled
    return merged


def classes(text: np.ndarray, wanted: np.ndarray, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """(positions in suffix order, class of each): one class for equal strings of ``width`` bytes."""
    order = suffix_order(text, wanted)
    eight = eight_bytes(np.concatenate([text, np.zeros(width, np.uint8)]))
    differs = np.zeros(len(order), bool)
    for k in (*range(0, width - 8, 8), width - 8):
        word = eight[order + k]
        differs[1:] |= word[1:] != word[:-1]
    return order, np.cumsum(differs)


def _decide(group: pa.Table) -> pa.Table:
    """Windows whose string starts in a smaller document, as ranges of starts."""
    known = group.column("known").to_numpy()
    block, doc, start, rank = (group.column(c).to_numpy() for c in ("block", "doc", "start", "rank"))
    parts = group.column("part").combine_chunks()
    sure = np.flatnonzero(known)
    size = np.array([int.from_bytes(x, "little") for x in parts.take(pa.array(sure)).to_pylist()], np.int64)
    out = [(block[sure], doc[sure], start[sure].astype(np.int64), start[sure] + size)]
    asked = np.flatnonzero(~known)
    if len(asked):
        coded = pc.dictionary_encode(parts.take(pa.array(asked)))
        code, strings = coded.indices.to_numpy(), coded.dictionary
        length = pc.binary_length(strings).to_numpy().astype(np.int64)
        text = np.frombuffer(b"".join(strings.to_pylist()), np.uint8)
        least = np.full(len(strings), np.iinfo(np.int64).max)
        np.minimum.at(least, code, rank[asked])
        windows = length - WIDTH + 1
        begins = np.cumsum(length) - length
        wanted = ranges(begins, windows)
        owner = np.zeros(len(text), np.int32)
        owner[wanted] = np.repeat(np.arange(len(strings), dtype=np.int32), windows)
        order, cls = classes(text, wanted)
        rank_of = least[owner[order]]
        smallest = np.full(int(cls[-1]) + 1, np.iinfo(np.int64).max)
        np.minimum.at(smallest, cls, rank_of)
        goes = np.zeros(len(text), bool)
        goes[order] = smallest[cls] < rank_of
        # a surrounding that an equal one in a smaller document precedes goes as a whole
        whole = rank[asked] > least[code]
        at = asked[whole]
        out.append((block[at], doc[at], start[at].astype(np.int64), start[at] + windows[code[whole]]))
        a, b = runs(owner[wanted], goes[wanted], owner[wanted])
        first, last = wanted[a] - begins[owner[wanted[a]]], wanted[b - 1] - begins[owner[wanted[a]]] + 1
        of = owner[wanted[a]]
        own = asked[~whole]
        order = np.argsort(code[~whole], kind="stable")
        sorted_code = code[~whole][order]
        low, high = np.searchsorted(sorted_code, of, "left"), np.searchsorted(sorted_code, of, "right")
        row = own[order[ranges(low, high - low)]]
        first, last = np.repeat(first, high - low), np.repeat(last, high - low)
        out.append((block[row], doc[row], start[row] + first, start[row] + last))
    block, doc, start, stop = (np.concatenate(x) for x in zip(*out))
    return pa.table({"block": block.astype(np.int32), "doc": doc.astype(np.int32), "start": start.astype(np.int32),
                     "stop": stop.astype(np.int32)})


def _without(texts: pa.Table, found: pa.Table) -> pa.Table:
    raw = raw_texts(texts)
    all_spans = [[(0, len(t))] if copy and len(t) >= WIDTH else spans for t, copy, spans in
                 zip(raw, later_copies(texts), spans_by_document(found, len(raw), WIDTH))]
    kept = []
    for text, spans in zip(raw, all_spans):
        parts, end = [], 0
        for a, b in spans:
            parts.append(text[end:a])
            end = b
        kept.append(b"".join([*parts, text[end:]]) if spans else text)
    return pa.table({"doc_id": texts.column("doc_id"), "n_bytes": pa.array(map(len, raw), pa.int64()),
                     "kept": pa.array(kept, pa.binary()),
                     "spans": pa.array([[{"start": a, "end": b} for a, b in s] for s in all_spans],
                                       pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))})


def drop_repeated_bytes(docs: DataFrame, frequent: int = FREQUENT, sample: int = SAMPLE) -> DataFrame:
    """doc_id, n_bytes, kept (the bytes that stay) and spans (maximal removed runs), one row per input row."""
    dealt, total = blocks(docs, BLOCK_BYTES, copies_together=True)
    shards = total // SHARD_BYTES + 1
    grams = docs.sparkSession.sparkContext.broadcast(frequent_grams(docs, total, frequent, sample))
    found = per_block(dealt, lambda t: _first_level(t, grams.value), "block int, kind int, h long, n int")
    again = repeated_keys(found, total, frequent)
    parts = with_blocks(dealt, again, lambda t, r: _surroundings(t, r, shards, grams.value), _DDL)
    windows = parts.groupBy("bucket").applyInArrow(_decide, "block int, doc int, start int, stop int")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return with_blocks(dealt, windows, _without,
                       f"doc_id {kind}, n_bytes long, kept binary, spans array<struct<start:long,end:long>>")


def op3_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return drop_repeated_bytes(docs).select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


OP3_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(doc_id, 9223372036854775807) AS rank, doc_id,
                  hex(encode(coalesce(text, ''))) AS h FROM documents),
p AS (SELECT r, rank, o, len(h) // 2 AS n, substr(h, 2 * o + 1, 2098) AS part
      FROM (SELECT r, rank, h, unnest(range(0, len(h) // 2, 1000)) AS o FROM d)),
b AS (SELECT r, rank, o + j AS i, substr(part, 2 * j + 1, 2) AS c, CASE WHEN o + j + 50 <= n THEN substr(part, 2 * j + 1, 100) END AS s
      FROM (SELECT *, unnest(range(least(1000, n - o))) AS j FROM p)),
f AS (SELECT s, min(rank) AS first FROM b WHERE s IS NOT NULL GROUP BY s HAVING count(*) > 1),
hit AS (SELECT r, i FROM b JOIN f USING (s) WHERE first < rank),
m AS (SELECT b.r, b.i, b.c, max(hit.i) OVER (PARTITION BY b.r ORDER BY b.i ROWS 49 PRECEDING) IS NOT NULL AS gone
      FROM b LEFT JOIN hit ON b.r = hit.r AND b.i = hit.i),
e AS (SELECT r, i, c, gone, coalesce(lag(gone) OVER (PARTITION BY r ORDER BY i), FALSE) AS before FROM m),
k AS (SELECT r, count(*) AS n_bytes, count(*) FILTER (WHERE gone) AS n_removed, count(*) FILTER (WHERE gone AND NOT before) AS n_spans,
             string_agg(c, '' ORDER BY i) FILTER (WHERE NOT gone) AS kept FROM e GROUP BY r)
SELECT doc_id, coalesce(n_bytes, 0) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM d LEFT JOIN k USING (r)
"""
