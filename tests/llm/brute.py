"""Plain versions of the operators: one text at a time, with the words of the contracts."""

import base64
import hashlib
import heapq
import math
import re
import zlib
from collections import Counter

import xxhash

ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SOLID = re.compile(r"[^\x20\x09-\x0D]+")


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def remainder(key, modulus):
    return zlib.crc32(("" if key is None else str(key)).encode()) % modulus


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def decontamination(docs, items, size=10):
    windows = []
    for item, text in items:
        words = ALNUM.findall(low(text))
        for k in range(max(1, len(words) - size + 1) if words else 0):
            windows.append((tuple(words[k : k + size]), str(item)))
    by_length = {}
    for w, item in windows:
        by_length.setdefault(len(w), {}).setdefault(w, set()).add(item)
    out = []
    for key, text in docs:
        words = ALNUM.findall(low(text))
        hit, found = set(), set()
        for n, known in by_length.items():
            for k in range(len(words) - n + 1):
                owners = known.get(tuple(words[k : k + n]))
                if owners:
                    hit.update(range(k, k + n))
                    found |= owners
        out.append((key, len(words), len(hit), len(found), sha(",".join(sorted(found))), bool(hit)))
    return out


def fingerprint(text, size=4):
    words = SOLID.findall(low(text))
    if not words:
        return 0
    shingles = [" ".join(words[k : k + size]) for k in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def simhash(docs, bits=4):
    prints = [fingerprint(t) for _, t in docs]
    distinct = sorted(set(prints))
    root = {f: f for f in distinct}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for k, a in enumerate(distinct):
        for b in distinct[:k]:
            if (a ^ b).bit_count() <= bits:
                root[find(a)] = find(b)
    least = {}
    for (key, _), f in zip(docs, prints, strict=True):
        if key is not None:
            least[find(f)] = min(key, least.get(find(f), key))
    return [(key, f"{f:016x}", least.get(find(f))) for (key, _), f in zip(docs, prints, strict=True)]


ASSIGN = re.compile(
    r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.A
)


def base_spans(text):
    text = text or ""
    spans = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    spans += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    spans += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(spans)


def listed(spans):
    return ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in spans)


def secrets(docs):
    out = []
    for key, text in docs:
        spans = base_spans(text)
        counts = [sum(s[3] == k for s in spans) for k in ("assign", "access", "hex")]
        out.append((key, *counts, sha(listed(spans))))
    return out


def warc(pages):
    groups = {}
    for key, html in pages:
        groups.setdefault(html or "", []).append(key)
    out = []
    for html, keys in groups.items():
        data = html.encode()
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        first, *others = sorted(keys, key=lambda k: (k is not None, k), reverse=True)
        out.append((first, len(data), digest, "response", None))
        out += [(k, len(data), digest, "revisit", first) for k in others]
    return out


def quality_base(text):
    words = SOLID.findall(text or "")
    windows = [tuple(words[k : k + 5]) for k in range(len(words) - 4)]
    times = Counter(windows)
    covered = {k + j for k, w in enumerate(windows) if times[w] > 1 for j in range(5)}
    lines = [x for x in (text or "").split("\n") if SOLID.search(x)]
    n = len(words)
    return (
        n,
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text or ""),
        len(lines) - len(set(lines)),
        len(covered),
        n < 10 or 100 * len(covered) > 20 * n,
    )


PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}


def licenses(docs):
    out = []
    for key, text in docs:
        words, places, labels = ALNUM.findall(low(text)), [], set()
        for phrase, label in PHRASES.items():
            p = phrase.split()
            found = [k for k in range(len(words)) if words[k : k + len(p)] == p]
            places += found
            labels |= {label} if found else set()
        ends = (min(places), max(places)) if places else (None, None)
        out.append((key, len(words), len(places), *ends, ",".join(sorted(labels))))
    return out


def lm(docs, weight=8.0):
    """Base scores, and scores without rounding of probabilities."""
    sequences = [SOLID.findall(low(t)) + [" "] for _, t in docs]
    held = [remainder(k, 7) == 2 for k, _ in docs]
    counts, pairs = Counter(), Counter()
    for s, out in zip(sequences, held, strict=True):
        if not out:
            counts.update(s)
            pairs.update(zip([" ", *s], s, strict=False))
    n, v = sum(counts.values()), len(counts)
    rows = []
    for (key, _), s, out in zip(docs, sequences, held, strict=True):
        alone = [(counts[w] + 1) / (n + v + 1) for w in s]
        given = [
            (pairs[a, b] + weight * p) / (counts[a] + weight)
            for a, b, p in zip([" ", *s], s, alone, strict=False)
        ]
        known = sum(counts[w] > 0 for w in s)
        rows.append(
            (key, out, len(s), known, n, sum(map(math.log10, alone)), sum(map(math.log10, given)))
        )
    return rows


# ---- shingle sets


def jaccard(rows, size=5, percent=80):
    """doc_id, shingles, least id reachable; a pair of sets is compared if it shares a shingle."""
    sets = []
    for _, text in rows:
        words = SOLID.findall(low(text))
        shingles = [tuple(words[k : k + size]) for k in range(max(len(words) - size + 1, 1))]
        sets.append(frozenset(shingles) if words else frozenset())
    distinct = [s for s in dict.fromkeys(sets) if s]
    parent = {s: s for s in distinct}

    def root(s):
        while parent[s] is not s:
            s = parent[s]
        return s

    holders = {}
    for n, s in enumerate(distinct):
        for x in s:
            holders.setdefault(x, []).append(n)
    for n, s in enumerate(distinct):
        shared = Counter(m for x in s for m in holders[x] if m > n)
        for m, both in shared.items():
            if 100 * both >= percent * (len(s) + len(distinct[m]) - both):
                a, b = root(s), root(distinct[m])
                if a is not b:
                    parent[a] = b
    least = {}
    for (doc_id, _), s in zip(rows, sets):
        if s and doc_id is not None:
            least[root(s)] = min(least.get(root(s), doc_id), doc_id)
    return [(d, len(s), least.get(root(s)) if s else d) for (d, _), s in zip(rows, sets)]


# ---- hard negatives


def negatives(rows):
    """rows: (id, label, vector), labels as they are to be used."""
    good = {}
    for i, label, v in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        row = (label, [math.floor(256 * x) for x in v])
        good[i] = min(good.get(i, row), row)
    out = []
    for a, (label, v) in good.items():
        if a % 100:
            continue
        ranked = sorted((-sum(x * y for x, y in zip(v, w)), i) for i, (_, w) in good.items() if i != a)
        for s, p in [(-s, i) for s, i in ranked if good[i][0] == label][:5]:
            others = [(i, -n) for n, i in ranked if good[i][0] != label and 80 * s <= -100 * n <= 100 * s]
            out += [(a, p, k, i, s, n) for k, (i, n) in enumerate(others[:5], 1)]
    return out


# ---- conversations


def damaged(rows):
    """The rows of each conversation, in order, after the faults of the test."""
    found = {}
    for conv, turn, role, text in rows:
        held = found.setdefault(conv, [])
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        if kind:
            held += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    for held in found.values():
        held.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    return found


def repair(rows):
    """Cheapest repair of ordered (turn, role, text) by a search forward over rows and last roles."""
    seen, faults = set(), []
    for _, role, text in rows:
        bare = text.strip(" \t\n\x0b\x0c\r")
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else ""
        faults.append(fault or ("" if bare[-1] in ".!?" else "truncated"))
        seen.add((role, text))
    full = {"u": "user", "a": "assistant"}
    heap, done = [(0, "", 0, "", ())], set()
    while True:
        cost, audit, at, last, lines = heapq.heappop(heap)
        if (at, last) in done:
            continue
        done.add((at, last))
        if at == len(rows) and last in ("", "a"):
            break
        new = "a" if last == "u" else "u"
        heapq.heappush(heap, (cost + 5, audit + "I", at, new, (*lines, full[new] + ":")))
        if at == len(rows):
            continue
        _, role, text = rows[at]
        heapq.heappush(heap, (cost + 2, audit + "D", at + 1, last, lines))
        if faults[at] in ("blank", "duplicate"):
            continue
        more = 5 if faults[at] else 0
        heapq.heappush(heap, (cost + 1 + more, audit + "R", at + 1, new, (*lines, f"{full[new]}:{text}")))
        if role[:1] == new or (role[:1] == "s" and not last):
            heapq.heappush(heap, (cost + more, audit + "K", at + 1, role[:1], (*lines, f"{role}:{text}")))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
    digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return gaps, *counts, sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, digest


def conversations(rows):
    return [(conv, *repair(held)) for conv, held in damaged(rows).items()]
