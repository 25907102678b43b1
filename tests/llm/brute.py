"""Plain reference versions of the operators, for small inputs."""

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ASCII_LOWER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return WORD.findall(text or "")


def base_rules(text):
    t = text or ""
    w = words(t)
    wins = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    n = Counter(wins)
    covered = {i + k for i, x in enumerate(wins) if n[x] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in t.split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    return {
        "n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": sum(c in "#*$%&|<>" for c in t), "n_dup_lines": dup, "n_repeat_words": len(covered),
        "base_failed": len(w) < 50 or 100 * len(covered) > 50 * len(w),
    }


def line_dedup(rows):
    """[(id, text)] -> {id: (n_lines, n_dropped, kept text)} for distinct ids."""
    key = lambda s: s.strip(" \t\n\x0b\x0c\r").translate(ASCII_LOWER)
    owner = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            k = key(line)
            if i is not None and len(k) >= 10:
                owner[k] = min(owner.get(k, i), i)
    out = {}
    for i, t in rows:
        lines = (t or "").split("\n")
        left = [x for x in lines if owner.get(key(x), i) == i or i is None]
        out[i] = (len(lines), len(lines) - len(left), "\n".join(left))
    return out


def shingle_set(text, size=5):
    w = [x for x in words((text or "").translate(ASCII_LOWER))]
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + size]) for i in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)])


def near_components(rows, num=85, den=100):
    sets = {i: shingle_set(t) for i, t in rows}
    up = {i: i for i in sets}

    def head(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                n = len(sets[a] & sets[b])
                if den * n >= num * (len(sets[a]) + len(sets[b]) - n):
                    x, y = head(a), head(b)
                    up[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), head(i), head(i) == i) for i in ids}


def repeats(texts, length):
    """Per text: (bytes, removed, spans, sha256 of the rest)."""
    data = [(t or "").encode() for t in texts]
    n = Counter(d[i:i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if n[d[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((len(d), sum(gone), spans, hashlib.sha256(bytes(c for c, g in zip(d, gone) if not g)).hexdigest()))
    return out


def edit_search(item, text):
    """Least edit distance of item to any substring of text."""
    row = list(range(len(item) + 1))
    best = row[-1]
    for c in text:
        new = [0]
        for j, x in enumerate(item, 1):
            new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (x != c)))
        row = new
        best = min(best, row[-1])
    return best


def best_fit(pieces, capacity):
    """Least room that is enough and free of conflicts, by looking at all bins; ties by bin number."""
    bins, out = [], []
    for length, source, cluster in pieces:
        fit = [(b["room"], k) for k, b in enumerate(bins) if b["room"] >= length and b["room"] > 0
               and (source is None or source not in b["s"]) and (cluster is None or cluster not in b["c"])]
        k = min(fit)[1] if fit else len(bins)
        if not fit:
            bins.append({"room": capacity, "s": set(), "c": set()})
        out.append((k, capacity - bins[k]["room"]))
        bins[k]["room"] -= length
        bins[k]["s"].add(source)
        bins[k]["c"].add(cluster)
    return out


def ngram_counts(texts):
    out = defaultdict(int)
    for t in texts:
        w = words(t)
        for g in [*((x,) for x in w), *zip(w, w[1:])]:
            out[g] += 1
    return out
