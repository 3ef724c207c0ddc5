"""Plain single-process versions of the training-data operators, to compare with."""

from __future__ import annotations

import array
import hashlib
import re
import zlib
from collections import Counter, defaultdict

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def blank_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def shingle_set(text):
    words = blank_words((text or "").translate(LOWER))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)}


def jaccard_components(docs, percent=75):
    """{position: (set size, least linked id)} for a list of (doc_id, text)."""
    sets = [shingle_set(t) for _, t in docs]
    parent = list(range(len(docs)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            holders[g].append(i)
    common = Counter()
    for held in holders.values():
        for a in range(len(held)):
            for b in range(a):
                common[held[b], held[a]] += 1
    for (a, b), n in common.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            parent[find(b)] = find(a)
    least = {}
    for i, (doc_id, _) in enumerate(docs):
        root = find(i)
        least[root] = doc_id if root not in least else min(least[root], doc_id)
    return [(doc_id, len(sets[i]), least[find(i)]) for i, (doc_id, _) in enumerate(docs)]


def quality_statistics(text):
    words = blank_words(text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    times = Counter(windows)
    covered = {j for i, w in enumerate(windows) if times[w] > 1 for j in range(i, i + 3)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if blank_words(line):
            dup += line in seen
            seen.add(line)
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in text or ""),
        "n_dup_lines": dup, "n_repeat_words": len(covered), "base_failed": len(words) < 50 or 100 * len(covered) > 50 * len(words),
    }


def item_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def contamination(docs, items, window=13):
    windows = defaultdict(set)
    for item_id, text in items:
        words = item_words(text)
        size = min(window, len(words))
        for i in range(len(words) - size + 1):
            if words:
                windows[tuple(words[i:i + size])].add(str(item_id))
    sizes = sorted({len(w) for w in windows})
    out = []
    for doc_id, text in docs:
        words, hit, found = item_words(text), set(), set()
        for size in sizes:
            for i in range(len(words) - size + 1):
                owners = windows.get(tuple(words[i:i + size]))
                if owners:
                    found |= owners
                    hit.update(range(i, i + size))
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc_id, len(words), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(words)))
    return out


def packed_bytes(ids):
    return array.array("I", ids).tobytes()


def check_pieces(docs, rows, encode, seq_len=1024):
    """Assert that the piece rows hold every id of every document once; the share of padding."""
    pieces = defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
    for doc_id, text in docs:
        ids = [*encode(text or ""), 0]
        own = sorted(pieces.pop(doc_id), key=lambda r: r["start"])
        assert [r["start"] for r in own] == [sum(x["length"] for x in own[:i]) for i in range(len(own))]
        assert sum(r["length"] for r in own) == len(ids) and {r["doc_tokens"] for r in own} == {len(ids)}
        for r in own:
            assert zlib.crc32(packed_bytes(ids[r["start"]:r["start"] + r["length"]])) == r["ids_crc32"]
    assert not pieces
    used = defaultdict(list)
    for r in rows:
        used[r["sequence_id"]].append((r["offset"], r["length"]))
    padding = total = 0
    for spans in used.values():
        end = 0
        for offset, length in sorted(spans):
            assert offset == end
            end += length
        assert 0 < end <= seq_len
        total += end
        padding += 0 if end & (end - 1) == 0 else seq_len - end
    return padding / max(1, total)
