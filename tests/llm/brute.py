"""Slow, plain versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
_FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall(text or "")


def folded(text):
    return words((text or "").translate(_FOLD))


def base_quality(text):
    t = text or ""
    w = words(t)
    lines = [x for x in t.split("\n") if words(x)]
    windows = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
    counts, covered = Counter(windows), set()
    for i, x in enumerate(windows):
        if counts[x] > 1:
            covered.update(range(i, i + 8))
    failed = len(w) < 20 or 100 * len(covered) > 30 * len(w)
    return len(w), sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered), failed


def shingles(text, k):
    w = folded(text)
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def components(ids, links):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def near_duplicates(rows, k, percent):
    """{id: (n, component)} of (id, text) rows with unique ids."""
    sets = {i: shingles(t, k) for i, t in rows}
    ids = sorted(sets)
    links = [(a, b) for x, a in enumerate(ids) for b in ids[x + 1:]
             if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    found = components(ids, links)
    return {i: (len(sets[i]), found[i]) for i in ids}


def repeats(rows, length=100):
    """{id: (n, removed, spans, digest)} of (id, text) rows with unique ids."""
    seen, out = set(), {}
    for i, t in sorted(rows, key=lambda r: r[0]):
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            s = b[p:p + length]
            if s in seen:
                gone[p:p + length] = b"\1" * length
            seen.add(s)
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for p in range(len(b)) if gone[p] and not (p and gone[p - 1]))
        out[i] = (len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def _luhn(digits):
    d = [int(x) for x in digits][::-1]
    return (sum(d[0::2]) + sum(sum(divmod(2 * x, 10)) for x in d[1::2])) % 10 == 0


def personal_data(text):
    t, out = text or "", []
    out += [(m.start(), 0, m.end()) for m in _EMAIL.finditer(t)]
    out += [(m.start(), 1, m.end()) for m in _IP.finditer(t) if all(int(x) <= 255 for x in m.group().split("."))]
    for m in _CARD.finditer(t):
        digits = re.sub("[^0-9]", "", m.group())
        if 14 <= len(digits) <= 19 and _luhn(digits):
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in _PHONE.finditer(t) if 10 <= len(re.sub("[^0-9]", "", m.group())) <= 15]
    return sorted(out)


def unigram(rows):
    """{id: (held_out, n_tokens, n_known, N, score)} of (id, text) rows."""
    def held(i):
        return zlib.crc32(str(i).encode()) % 7 == 2

    train = [t for i, t in rows if not held(i)]
    counts = Counter(w for t in train for w in folded(t))
    n, v = sum(counts.values()) + len(train), len(counts) + bool(train)
    out = {}
    for i, t in rows:
        w = folded(t)
        score = sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in w) + math.log10((len(train) + 1) / (n + v + 1))
        out[i] = (held(i), len(w) + 1, sum(x in counts for x in w) + bool(train), n, score)
    return out


_UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def fill_middle(doc_id, text):
    """(n, form, prefix chars, middle chars, output)."""
    t = text or ""
    units = _UNIT.findall(t)
    n, h = len(units), hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[k:k + 8], 16) for k in (0, 8, 16, 24))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not t or any(x in t for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return n, "plain", None, None, t
    if h4 % 100 < 80:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def common_lines(rows, min_chars=1, min_docs=10):
    """[(id, n, dropped, rest)] of (id, text) rows; NULL ids count by text."""
    def key(line):
        return line.strip(" \t\n\v\f\r").translate(_FOLD)

    holders = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders.setdefault(key(line), set()).add((i, t if i is None else None))
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        rest = [x for x in lines if len(holders.get(key(x), ())) < min_docs]
        out.append((i, len(lines), len(lines) - len(rest), "\n".join(rest)))
    return out


def collocations(rows, least=100, longest=5, top=2000):
    """[(lang, rank, phrase, a, l, r, n, score)] of (lang, text) rows."""
    counts, totals = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(_FOLD)):
            w = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(w)
            own = counts.setdefault(lang, Counter())
            for k in range(1, longest + 1):
                own.update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, f in counts.items():
        n, found = totals[lang], {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        gone = {q for p, a in found.items() for k in range(2, len(p)) for i in range(len(p) - k + 1) for q in [p[i:i + k]] if a >= f[q]}
        ranked = []
        for p, a in found.items():
            if p not in gone:
                score, _k, l, r = min((1000 * a * n // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
                ranked.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(ranked)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, n, -score))
    return out
