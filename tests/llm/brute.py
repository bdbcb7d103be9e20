"""Plain Python versions of the queries' contracts, one row at a time."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def op1(docs):
    out = {}
    for doc_id, text in docs:
        text = text or ""
        words = WORD.findall(text)
        grams = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
        hit = set()
        for i in range(len(words) - 2):
            if grams[tuple(words[i : i + 3])] > 1:
                hit |= {i, i + 1, i + 2}
        seen, dup = set(), 0
        for line in text.split("\n"):
            if WORD.search(line):
                dup += line in seen
                seen.add(line)
        failed = len(words) < 50 or 100 * len(hit) > 50 * len(words)
        out[doc_id] = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit), failed)
    return out


KINDS = (
    ("assign", re.compile(r"""((?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 2, 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 24),
)


MORE_KINDS = (
    ("pem", re.compile(r"-----BEGIN [A-Z ]*PRIVATE KEY-----"), 0, 20),
    ("jwt", re.compile(r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"), 0, 24),
    ("prefixed", re.compile(r"(?:gh[opsu]_|xox[abps]-|sk_live_)[A-Za-z0-9-]+"), 0, 20),
)


def op2(docs, kinds=KINDS):
    out = {}
    for doc_id, text in docs:
        found = []
        for order, (kind, pattern, group, least) in enumerate(kinds):
            found += [(m.start(), order, kind, m.end()) for m in pattern.finditer(text or "") if len(m[group]) >= least]
        spans = ",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted(found))
        out[doc_id] = (*(sum(x[2] == k for x in found) for k, *_ in kinds), sha(spans), spans)
    return out


def op5(docs):
    least: dict = {}
    cut = [(d, WORD.findall(t or "")) for d, t in docs]
    for d, words in cut:
        for i in range(len(words) - 12):
            key = tuple(words[i : i + 13])
            if d is not None:
                least[key] = min(least.get(key, d), d)
    out = []
    for d, words in cut:
        gone = set()
        for i in range(len(words) - 12):
            if d is not None and least[tuple(words[i : i + 13])] < d:
                gone |= set(range(i, i + 13))
        out.append((d, len(words), len(gone), sha(" ".join(w for i, w in enumerate(words) if i not in gone))))
    return out


def shingles(text):
    words = WORD.findall(lower(text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def op8(docs):
    sets = [(d, shingles(t)) for d, t in docs]
    parent = {d: d for d, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, s) in enumerate(sets):
        for b, t in sets[:i]:
            if s and t and 100 * len(s & t) >= 85 * len(s | t):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {d: (len(s), root(d), root(d) == d) for d, s in sets}


def op9(docs, items):
    windows: dict = {}
    for item, text in items:
        words = ALNUM.findall(lower(text or ""))
        for i in range(max(1, len(words) - 12) if words else 0):
            windows.setdefault(tuple(words[i : i + 13]), set()).add(str(item))
    lengths = {len(w) for w in windows}
    out = {}
    for d, text in docs:
        words = ALNUM.findall(lower(text or ""))
        hit, found = set(), set()
        for n in lengths:
            for i in range(len(words) - n + 1):
                got = windows.get(tuple(words[i : i + n]))
                if got:
                    hit |= set(range(i, i + n))
                    found |= got
        out[d] = (len(words), len(hit), len(found), sha(",".join(sorted(found))), len(hit) > 0 and 20 * len(hit) >= len(words))
    return out


def op4(rows):
    convs: dict = {}
    for conv, turn, role, text in rows:
        convs.setdefault(conv, []).append((turn, role or "", text or ""))
    out = {}
    for conv, turns in convs.items():
        turns.sort()
        loss = "".join(t for _, r, t in turns if r == "assistant")
        out[conv] = (len(turns), sha("".join(f"{r}\n{t}\n" for _, r, t in turns)), len(loss), sha(loss))
    return out


def op7_pieces(docs, encode):
    out = {}
    for d, text in docs:
        ids = [*encode(text or ""), 0]
        size = len(ids) % 2048 or 2048
        start = piece = 0
        while start < len(ids):
            part = ids[start : start + size]
            raw = b"".join(x.to_bytes(4, "little") for x in part)
            out[d, piece] = (start, len(part), zlib.crc32(raw))
            start, piece, size = start + size, piece + 1, 2048
    return out
