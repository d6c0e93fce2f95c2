"""Plain versions of the operators, written from their definitions, for small inputs."""

import hashlib
import re
import zlib
from collections import Counter
from functools import cache

import regex
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(x):
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


def repeated(sequences, length):
    """``sequences``: (id or None, sequence). Marks of members covered by a window that a smaller id has."""
    first = {}
    for i, s in sequences:
        if i is not None:
            for k in range(len(s) - length + 1):
                w = tuple(s[k : k + length])
                first[w] = min(i, first.get(w, i))
    out = []
    for i, s in sequences:
        marks = [False] * len(s)
        for k in range(len(s) - length + 1):
            d = first.get(tuple(s[k : k + length]))
            if d is not None and (i is None or d < i):
                marks[k : k + length] = [True] * length
        out.append(marks)
    return out


def byte_rows(docs, length=50):
    raw = [(i, (t or "").encode()) for i, t in docs]
    rows = []
    for (i, b), marks in zip(raw, repeated(raw, length)):
        spans = sum(m and not n for m, n in zip(marks, [False, *marks]))
        rows.append((i, len(b), sum(marks), spans, sha(bytes(x for x, m in zip(b, marks) if not m))))
    return rows


def phrase_rows(docs, length=13):
    words = [(i, WORD.findall(t or "")) for i, t in docs]
    return [
        (i, len(w), sum(m), sha(" ".join(x for x, y in zip(w, m) if not y)))
        for (i, w), m in zip(words, repeated(words, length))
    ]


def fingerprint(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(docs):
    """(id, fingerprint, smallest id reachable) of each row."""
    prints = [fingerprint(t) for _, t in docs]
    group = list(range(len(docs)))
    changed = True
    while changed:
        changed = False
        for a in range(len(docs)):
            for b in range(len(docs)):
                if (prints[a] ^ prints[b]).bit_count() <= 2 and group[b] < group[a]:
                    group[a], changed = group[b], True
    least = {}
    for (i, _), g in zip(docs, group):
        if i is not None:
            least[g] = min(i, least.get(g, i))
    return [(i, f"{p:016x}", least.get(g)) for (i, _), p, g in zip(docs, prints, group)]


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        x = int(c) * (1 + k % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def private_spans(text):
    out = []
    out += [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def secret_spans(text):
    assign = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    out = [(m.start(), 0, m.end()) for m in re.finditer(assign, text, re.I | re.A) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


def written(spans, kinds):
    return ",".join(f"{kinds[k]}:{s}:{e}" for s, k, e in spans)


def quality(text):
    words = WORD.findall(text or "")
    n = len(words)
    windows = [tuple(words[i : i + 5]) for i in range(n - 4)]
    count = Counter(windows)
    again = len({i + k for i, w in enumerate(windows) if count[w] > 1 for k in range(5)})
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    base = n < 10 or 100 * again > 20 * n
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), again, base


def periodic_runs(words):
    """(start, length, period) of all runs, by trying every period."""
    n, out = len(words), []
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            end = i + q
            least = not any(all(words[k] == words[k + p] for k in range(start, end - p)) for p in range(1, q))
            if i > start and end - start >= max(12, 2 * q) and least:
                out.append((start, end - start, q))
            i += 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def period_row(doc_id, text):
    words = WORD.findall(text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = periodic_runs(words)
    top = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    return doc_id, len(runs), *top, 1000 * top[1] // top[2] if runs else None, sha(listed), sha(kept)


SPACE = " \t\n\v\f\r"


def damage(rows):
    """Rows (conv_id, turn, role, text) with the faults their checksum chooses."""
    out = []
    for conv, turn, role, text in rows:
        h = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if h == 0:
            continue
        text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
        out += [(conv, turn, "user" if h == 4 else role, text)] * (2 if h == 3 else 1)
    return out


def repaired(rows):
    """Faults, cheapest cost, first letters and lines of one conversation, by trying all edits."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
    faults, seen = [], set()
    for _, _, role, text in rows:
        shown = text.strip(SPACE)
        faults.append("blank" if not shown else "duplicate" if (role, text) in seen else None if shown[-1] in ".!?" else "truncated")
        seen.add((role, text))
    turns = [r[1] for r in rows if r[1] is not None]
    initials = [r[2][:1] for r in rows]
    follow = {"": "su", "s": "u", "u": "a", "a": "u"}

    @cache
    def best(i, last, inserts):
        ways = [(0, "", ())] if i == len(rows) and last in ("", "a") else []
        for x in follow[last]:
            if x in "ua" and inserts < 3:
                rest = best(i, x, inserts + 1)
                ways += [(2 + rest[0], "I" + rest[1], (("user:" if x == "u" else "assistant:"), *rest[2]))] if rest else []
        if i < len(rows):
            rest = best(i + 1, last, 0)
            ways += [(3 + rest[0], "D" + rest[1], rest[2])] if rest else []
            late = faults[i] == "truncated"
            for x in follow[last] if faults[i] not in ("blank", "duplicate") else "":
                rest = best(i + 1, x, 0)
                if rest and initials[i] == x:
                    ways.append((late + rest[0], "K" + rest[1], (f"{rows[i][2]}:{rows[i][3]}", *rest[2])))
                if rest and x in "ua":
                    ways.append((2 + late + rest[0], "R" + rest[1], (("user:" if x == "u" else "assistant:") + rows[i][3], *rest[2])))
        return min(ways) if ways else None

    cost, audit, lines = best(0, "", 0)
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    return gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, sha("\n".join(lines))


def repair_rows(rows):
    by = {conv: [] for conv, *_ in rows}
    for row in damage(rows):
        by[row[0]].append(row)
    return {conv: repaired(found) for conv, found in by.items()}


def exact_rows(docs):
    """(doc_id, keep_id, group_size, text digest) of each row."""
    texts = [(i, re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) for i, t in docs]
    ids = {}
    for i, t in texts:
        ids.setdefault(t, []).append(i)
    return [(i, max((x for x in ids[t] if x is not None), default=None), len(ids[t]), sha(t)) for i, t in texts]


INSIDE = r"[^\x20\x09-\x0D\"'<>,;:=()\[\]{}|]"


def context_words(before):
    if len(before) > 400:  # three words are mostly near
        near = context_words(before[-300:])
        if len(near) == 3 and sum(map(len, near)) < 250:
            return near
    plain = regex.sub("[0-9]+", "9", regex.sub(r"[^\p{L}\p{N}]+", " ", before.lower()))
    return plain.split()[-3:]


def context_patterns(value, before):
    """(pattern, weight) of an identifier after a context."""
    words = context_words(before)
    outline = re.sub("[0-9]", "9", regex.sub(r"\p{L}+", "a", value))
    out = []
    for n, shaped in ((1, True), (2, True), (2, False), (3, False)):
        if len(words) >= n:
            out.append((" ".join(words[-n:]) + (f" | {outline}" if shaped else ""), 1.0 if shaped else 0.8))
    return out


def private_all(rows, rounds=3):
    """All spans (start, kind, end) per row: base ones, and those that contexts teach."""
    based = [private_spans(t or "") for _, t in rows]
    others = []
    for (_, t), spans in zip(rows, based):
        found = [(m.start(), m.end()) for m in re.finditer(rf"(?<!{INSIDE})(?={INSIDE}*?[0-9@]){INSIDE}+(?<![.!?])", t or "")]
        others.append([(a, b) for a, b in found if not any(s < b and a < e for s, _, e in spans)])
    pairs, weight = {}, {}
    for (_, t), spans, more in zip(rows, based, others):
        for a, b, known in [(s, e, True) for s, _, e in spans] + [(a, b, False) for a, b in more]:
            for p, w in context_patterns(t[a:b], t[:a]):
                pairs[p, t[a:b]] = pairs.get((p, t[a:b]), False) or known
                weight[p] = w
    seeds = {v for (_, v), known in pairs.items() if known}
    scores = dict.fromkeys(seeds, 1.0)
    gained = {}
    for _ in range(rounds):
        good, n = Counter(), Counter()
        for p, v in pairs:
            good[p] += scores.get(v, 0.0)
            n[p] += 1
        trust = {p: weight[p] * good[p] / (n[p] + 1) for p in n if good[p] >= 3 and good[p] >= 0.8 * n[p]}
        gained = {}
        for p, v in pairs:
            if v not in seeds and p in trust:
                gained[v] = gained.get(v, 1.0) * (1 - trust[p])
        gained = {v: 1 - x for v, x in gained.items()}
        scores = dict.fromkeys(seeds, 1.0) | gained
    new = {v for v, x in gained.items() if x >= 0.8}
    return [sorted(spans + [(a, 4, b) for a, b in more if t[a:b] in new]) if t else [] for (_, t), spans, more in zip(rows, based, others)]
