"""Plain single-machine versions of the operators, for comparison."""

import hashlib
import re
import struct
import zlib
from collections import Counter, defaultdict

import public_tokenizers
import xxhash
from tokenizers import Tokenizer

BLANK = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return BLANK.findall(text or "")


def substring_bytes(rows, width=50):
    """rows: (doc_id, text) -> (doc_id, n_bytes, n_removed, n_spans, sha256) per row."""
    first = {}
    last = float("inf")
    raw = [(last if d is None else d, (t or "").encode()) for d, t in rows]
    for d, b in raw:
        for i in range(len(b) - width + 1):
            s = b[i:i + width]
            first[s] = min(first.get(s, last), d)
    out = []
    for (doc, _), (d, b) in zip(rows, raw):
        gone = bytearray(len(b))
        for i in range(len(b) - width + 1):
            if first[b[i:i + width]] < d:
                gone[i:i + width] = b"\1" * width
        kept = bytes(c for c, g in zip(b, gone) if not g)
        spans = len(re.findall(rb"\x01+", bytes(gone)))
        out.append((doc, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def substring_words(rows, width=35):
    split = [words(t) for _, t in rows]
    seen = Counter(tuple(w[i:i + width]) for w in split for i in range(len(w) - width + 1))
    out = []
    for (doc, _), w in zip(rows, split):
        gone = [False] * len(w)
        for i in range(len(w) - width + 1):
            if seen[tuple(w[i:i + width])] > 1:
                gone[i:i + width] = [True] * width
        kept = [x for x, g in zip(w, gone) if not g]
        out.append((doc, len(w), sum(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return out


def fingerprint(text, n=3):
    w = [x for x in words("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))]
    if not w:
        return 0
    grams = [" ".join(w[i:i + n]) for i in range(len(w) - n + 1)] or [" ".join(w)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_duplicates(rows, radius=3):
    fps = [fingerprint(t) for _, t in rows]
    label = list(range(len(rows)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x
    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                a, b = find(i), find(j)
                label[max(a, b)] = min(a, b)
    least = defaultdict(lambda: None)
    for i, (d, _) in enumerate(rows):
        r = find(i)
        if d is not None and (least[r] is None or d < least[r]):
            least[r] = d
    return [(d, f"{fps[i]:016x}", least[find(i)]) for i, (d, _) in enumerate(rows)]


def token_ids(text, tokenizer=None):
    tokenizer = tokenizer or Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]


def crc(ids):
    return zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))


def base_counts(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    w = words(text)
    lines = [x for x in text.split("\n") if words(x)]
    seen = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    covered = set()
    for i in range(len(w) - 7):
        if seen[tuple(w[i:i + 8])] > 1:
            covered.update(range(i, i + 8))
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def _luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def personal(text):
    """Base spans (start, rank, end) of a text by the patterns as they are given."""
    text = text or ""
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((m.start(), 0, m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m[0])
        if 14 <= len(d) <= 19 and _luhn(d):
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def best_distance(pattern, text):
    """Least edit distance of the pattern to any substring."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(pattern, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (c != d)))
        row = new
    return min(row)


def private_terms(rows, support=3, disclosure=0.8, min_term=3):
    """{(doc_id, text): term spans} of (doc_id, text) rows, by counting every word of every document."""
    import math
    from collections import defaultdict

    import regex

    def term(word):
        return regex.sub(r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", "", word).lower()

    def entity(rank, value):
        return (rank, "".join(c for c in value if c in "0123456789") if rank in (2, 3) else value.lower())
    holds, words, vocabulary = defaultdict(set), {}, defaultdict(set)
    docs = {(d, t or "") for d, t in rows}
    for doc in docs:
        text = doc[1]
        blanked = list(text)
        for start, rank, end in personal(text):
            holds[entity(rank, text[start:end])].add(doc)
            blanked[start:end] = " " * (end - start)
        found = [(m.start(), m.end(), term(m[0])) for m in regex.finditer(r"[^\x20\x09-\x0D]+", "".join(blanked))]
        terms = [None] * 3 + [x[2] for x in found] + [None] * 3
        words[doc] = [(a, b, t, tuple(terms[k:k + 3]), tuple(terms[k + 4:k + 7])) for k, (a, b, t) in enumerate(found)
                      if len(t) >= min_term and regex.search(r"\p{L}", t)]
        for w in regex.split(r"[\x20\x09-\x0D]+", text):
            vocabulary[term(w)].add(doc)
    out = defaultdict(set)
    for e, where in holds.items():
        if len(where) < support:
            continue
        by_term = defaultdict(lambda: (set(), set(), set()))
        for doc in where:
            for _, _, t, *around in words[doc]:
                for found, x in zip(by_term[t], (doc, *around)):
                    found.add(x)
        for t, (seen_in, before, after) in by_term.items():
            seen = min(len(before), len(after))
            if len(seen_in) < support or seen < support or 2 * seen < len(seen_in) or len(where) == len(docs):
                continue
            pmi = math.log2(len(seen_in) * len(docs) / (len(vocabulary[t]) * len(where)))
            if pmi >= disclosure * math.log2(len(docs) / len(where)) - 1e-12:
                for doc in where:
                    out[doc] |= {(a, 4, b) for a, b, x, *_ in words[doc] if x == t}
    return out
