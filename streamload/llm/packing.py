"""Sum-of-squares online packing (operator 1).

Each task tokenizes its documents and packs them as they come.  Whole windows of a long document are
sequences of their own; the rest of it goes to the fill level h for which the sum of the squared numbers of
open windows per level grows least.  The level array holds those numbers, so a placement looks at levels, not
at windows.  When a task ends, the fullest of the windows that are still open stay as the levels chose them, as many as all the
open ids fill; the pieces of the others are cut to fill their gaps, and what remains goes into sequences of power-of-two
length, which need no padding.  So no id is padding, and what the levels decided is undone only for the emptiest windows.

Nothing is shuffled: packing is local to a task, a task holds only the ids of its open windows, and sequence
ids come from the task's partition number, so that a task that is run again gives the same rows.

Defined results: null and empty text are one piece with the end id alone; repeated rows and rows without
doc_id are packed like any other; an empty table has no pieces.
"""

from __future__ import annotations

import struct
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from .common import table, whole_text

WINDOW, END_ID, TOKENIZER = 2048, 1, "word_bpe_49k.json"
#: Bound on the words whose ids a worker keeps (in each of two generations).
CACHE_WORDS = 400_000
_TASK_BITS = 40
_TRAILING = b".,;:!?"


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable ones for themselves, the rest from 256 on."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + k) for k, b in enumerate(others)}


class WordIds(dict):
    """Word (UTF-8, ASCII letters lower case) to its token ids as little-endian unsigned 32-bit bytes.

    The tokenizer's normaliser and splitter never join characters across ASCII white space, lower-case everything but
    the two special tokens, and always cut between a letter or digit and the punctuation after it.  So a text's ids are
    those of its lower-case words, each without and with the signs that trail it.  A word of letters alone is one unit to
    the splitter and goes to the tokenizer's BPE model as it is; any other word takes the tokenizer's whole way.
    Two generations of words are kept: what the current one does not use again is forgotten with the old.
    """

    def __init__(self, path: str | None):
        from tokenizers import Tokenizer
        if path is None:
            import public_tokenizers
            path = public_tokenizers.path(TOKENIZER)
        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.letters = _byte_letters()
        self.packed = [struct.pack("<I", k) for k in range(self.tokenizer.get_vocab_size())]
        self.old: dict[bytes, bytes] = {}

    def encode(self, text: bytes) -> bytes:
        if len(self) > CACHE_WORDS:
            self.old = dict(self)
            self.clear()
        return b"".join(map(self.__getitem__, (text if b"<|" in text else text.lower()).split()))

    def __missing__(self, word: bytes) -> bytes:
        ids = self.old.get(word)
        if ids is None:
            core = word.rstrip(_TRAILING)
            if core and len(core) < len(word) and core.decode()[-1].isalnum():
                ids = self[core] + self[word[len(core):]]
            else:
                ids = self._tokenized(word)
        self[word] = ids
        return ids

    def _tokenized(self, word: bytes) -> bytes:
        letters = word.decode()
        if not (word.isalpha() and word.islower()):  # not small ASCII letters alone
            letters = unicodedata.normalize("NFC", letters).lower()
            if not letters.isalpha() or "\u03c2" in letters:  # a final sigma depends on its place
                return b"".join([self.packed[k] for k in self.tokenizer.encode(word.decode(), add_special_tokens=False).ids])
            letters = letters.encode().decode("latin-1").translate(self.letters)
        return b"".join([self.packed[t.id] for t in self.model.tokenize(letters)])


Piece = tuple[object, int, bytes, int]  # doc_id, start, ids, doc_tokens


class SumOfSquaresPacker:
    """Open windows by fill level; ``place`` gives finished sequences as lists of pieces."""

    def __init__(self, window: int = WINDOW):
        self.window = window
        self.count = np.zeros(window + 1, np.int64)  # the level array
        self.open: list[list[list[Piece]]] = [[] for _ in range(window)]
        self.chosen = 0  # ids that ended where the levels put them

    def level_for(self, size: int) -> int:
        """The level (0: a new window) to put ``size`` ids on; the fullest one among equals."""
        levels = np.flatnonzero(self.count[:self.window - size + 1])
        levels = np.concatenate(([0], levels))
        after = self.count[levels + size]
        grown = np.where(levels + size < self.window, 2 * after + 1, 0) - np.where(levels > 0, 2 * self.count[levels] - 1, 0)
        return int(levels[len(levels) - 1 - grown[::-1].argmin()])

    def place(self, piece: Piece) -> list[Piece] | None:
        size = len(piece[2]) // 4
        level = self.level_for(size)
        items = self.open[level].pop() if level else []
        self.count[level] -= 1 if level else 0
        items.append(piece)
        if level + size == self.window:
            self.chosen += self.window
            return items
        self.open[level + size].append(items)
        self.count[level + size] += 1
        return None

    def rest(self) -> Iterator[list[Piece]]:
        """What is open at the end, without padding: as many windows as all of it fills stay as the levels chose them, the
        fullest, and only the pieces of the others are cut, to fill their gaps; then power-of-two sequences."""
        windows = [(level, items) for level in reversed(range(self.window)) for items in self.open[level]]
        left = sum(level for level, _ in windows)
        stay = left // self.window
        self.chosen += sum(level for level, _ in windows[:stay])
        supply = [p for _, items in windows[stay:] for p in items][::-1]

        def take(room: int) -> list[Piece]:
            out = []
            while room:
                doc, start, ids, total = supply.pop()
                size = min(room, len(ids) // 4)
                out.append((doc, start, ids[:4 * size], total))
                if size < len(ids) // 4:
                    supply.append((doc, start + size, ids[4 * size:], total))
                room -= size
            return out
        for level, items in windows[:stay]:
            yield items + take(self.window - level)
        left %= self.window
        while left:
            room = 1 << (left.bit_length() - 1)
            left -= room
            yield take(room)


COLUMNS = ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def pack(docs: DataFrame, window: int = WINDOW, tokenizer_path: str | None = None) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    end = struct.pack("<I", END_ID)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, packer = WordIds(tokenizer_path), SumOfSquaresPacker(window)
        number = TaskContext.get().partitionId() << _TASK_BITS
        rows: list[tuple] = []
        id_type = pa.int64()

        def close(pieces: list[Piece]) -> None:
            nonlocal number
            offset = 0
            for doc, start, ids, total in pieces:
                rows.append((doc, start, len(ids) // 4, zlib.crc32(ids), total, number, offset))
                offset += len(ids) // 4
            number += 1

        def flush() -> pa.RecordBatch:
            doc, *rest = zip(*rows)
            rows.clear()
            return pa.RecordBatch.from_arrays([pa.array(doc, id_type), *(pa.array(x, pa.int64()) for x in rest)],
                                              ["doc_id", *COLUMNS])
        for batch in batches:
            id_type = batch.column(0).type
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            for doc, ids in zip(batch.column(0).to_pylist(), map(ids_of.encode, texts)):
                ids += end
                total = len(ids) // 4
                whole = total - total % window
                for start in range(0, whole, window):
                    close([(doc, start, ids[4 * start:4 * (start + window)], total)])
                if total > whole and (full := packer.place((doc, whole, ids[4 * whole:], total))):
                    close(full)
            if rows:
                yield flush()
        for pieces in packer.rest():
            close(pieces)
        if rows:
            yield flush()
    return docs.select("doc_id", whole_text(docs).alias("text")).mapInArrow(
        run, f"doc_id {kind}, " + ", ".join(f"{c} long" for c in COLUMNS))


def op1_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the pieces of the remaining documents.

    Every row is packed, repeated ones and ones without an id too; null and empty text are the end id alone.
    """
    return pack(docs)
