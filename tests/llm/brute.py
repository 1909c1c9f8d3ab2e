"""Plain versions of the contracts, one row at a time."""

import base64
import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

SPACE = " \t\n\x0b\x0c\r"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def lower(text):
    return (text or "").translate(LOWER)


def line_dedup(docs, least=10):
    keys = [[lower(x.strip(SPACE)) for x in (t or "").split("\n")] for _, t in docs]
    held = Counter(k for doc in keys for k in set(doc) if k)
    out = []
    for (i, t), doc in zip(docs, keys):
        lines = (t or "").split("\n")
        kept = [x for x, k in zip(lines, doc) if not (k and held[k] >= least)]
        out.append((i, len(lines), len(lines) - len(kept), sha("\n".join(kept))))
    return out


def contamination(docs, items, window=13):
    windows = defaultdict(set)
    for i, t in items:
        w = ALNUM.findall(lower(t))
        n = min(len(w), window)
        for k in range(len(w) - n + 1 if w else 0):
            windows[tuple(w[k:k + n])].add(str(i))
    sizes = sorted({len(w) for w in windows})
    out = []
    for i, t in docs:
        w, hit, found = ALNUM.findall(lower(t)), set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) in windows:
                    hit.update(range(k, k + n))
                    found |= windows[tuple(w[k:k + n])]
        out.append((i, len(w), len(hit), len(found), sha(",".join(sorted(found))),
                    len(hit) > 0 and 20 * len(hit) >= len(w)))
    return out


def without_spans(docs, items, max_span, coverage=None, window=13):
    """Texts without hit spans of more than ``max_span`` words, and without any
    where a ``coverage``-th of the words is hit."""
    windows = set()
    for _, t in items:
        w = ALNUM.findall(lower(t))
        n = min(len(w), window)
        windows |= {tuple(w[k:k + n]) for k in range(len(w) - n + 1 if w else 0)}
    sizes, out = sorted({len(w) for w in windows}), []
    for i, t in docs:
        low, hit = lower(t), set()
        at = [m.span() for m in ALNUM.finditer(low)]
        w = [low[a:b] for a, b in at]
        for n in sizes:
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) in windows:
                    hit.update(range(k, k + n))
        text, over = t, coverage and hit and coverage * len(hit) >= len(w)
        for b in sorted((k for k in hit if k + 1 not in hit), reverse=True):
            a = b
            while a - 1 in hit:
                a -= 1
            if over or b + 1 - a > max_span:
                text = text[:at[a][0]] + text[at[b][1]:]
        out.append((i, text))
    return out


def base_rules(text):
    text = text or ""
    w = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if line in seen:
            dup += 1
        elif WORD.search(line):
            seen.add(line)
    at = defaultdict(list)
    for k in range(len(w) - 2):
        at[tuple(w[k:k + 3])].append(k)
    hit = {k + j for ks in at.values() if len(ks) > 1 for k in ks for j in range(3)}
    failed = len(w) < 50 or 100 * len(hit) > 50 * len(w)
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit), failed)


def shingle_set(text, n=5):
    w = WORD.findall(lower(text))
    if len(w) < n:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[k:k + n]) for k in range(len(w) - n + 1))


def near_duplicates(docs, percent=85):
    sets = {i: shingle_set(t) for i, t in docs}
    holders = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, s in sets.items():
        shared = Counter(j for x in s for j in holders[x] if j < i)
        for j, both in shared.items():
            if 100 * both >= percent * (len(s) + len(sets[j]) - both):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [(i, len(s), find(i), find(i) == i) for i, s in sets.items()]


def base_scores(docs):
    def out(i):
        return zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2

    count, n = Counter(), 0
    for i, t in docs:
        if not out(i):
            w = [*WORD.findall(lower(t)), None]
            count.update(w)
            n += len(w)
    rows = []
    for i, t in docs:
        w = [*WORD.findall(lower(t)), None]
        rows.append((i, out(i), len(w), sum(count[x] > 0 for x in w), n,
                     sum(math.log10((count[x] + 1) / (n + len(count) + 1)) for x in w)))
    return rows


def ppm_scores(docs, order):
    """PPM over the tokens joined by one space and an end mark, byte by byte."""
    def stream(t):
        return b"\n" * order + " ".join(WORD.findall(lower(t))).encode() + b"\n"

    counts = [defaultdict(Counter) for _ in range(order + 1)]
    for i, t in docs:
        if zlib.crc32(("" if i is None else str(i)).encode()) % 7 != 2:
            s = stream(t)
            for p in range(order, len(s)):
                for k in range(order + 1):
                    counts[k][s[p - k:p]][s[p]] += 1
    out = []
    for i, t in docs:
        s, total = stream(t), 0.0
        for p in range(order, len(s)):
            banned: set = set()
            for k in range(order, -1, -1):
                seen = counts[k].get(s[p - k:p])
                if seen is None:
                    continue
                free = {x: c for x, c in seen.items() if x not in banned}
                if s[p] in free:
                    total += math.log10(free[s[p]] / (sum(free.values()) + len(free)))
                    break
                if free:
                    total += math.log10(len(free) / (sum(free.values()) + len(free)))
                banned |= set(seen)
            else:
                total -= math.log10(256 - len(banned))
        out.append((i, total))
    return out


def warc(pages):
    first = {}
    for i, _, h in pages:
        raw = (h or "").encode()
        if i is not None:
            first[raw] = min(i, first.get(raw, i))
    out = []
    for i, _, h in pages:
        raw = (h or "").encode()
        of = first.get(raw)
        revisit = of is not None and of != i
        out.append((i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(),
                    "revisit" if revisit else "response", of if revisit else None))
    return out


def chats(rows):
    told = defaultdict(list)
    for conv, turn, role, text in rows:
        told[conv].append((turn, role or "", text or ""))
    out = []
    for conv, turns in told.items():
        turns.sort()
        loss = "".join(t for _, r, t in turns if r == "assistant")
        out.append((conv, len(turns), sha("".join(f"{r}\n{t}\n" for _, r, t in turns)), len(loss), sha(loss)))
    return out


def rule_verdicts(rows, max_docs=100, min_left=0.1):
    """kept of (id, host, text) rows: base rules, then lines with more than
    ``max_docs`` distinct neighbourhoods within their host."""
    keyed = [[lower(x.strip(SPACE)) for x in (t or "").split("\n")] for _, _, t in rows]
    around, first = defaultdict(set), {}
    for (i, host, _), keys in zip(rows, keyed):
        for k, key in enumerate(keys):
            if key:
                around[host, key].add((keys[k - 1] if k else "", keys[k + 1] if k + 1 < len(keys) else ""))
                if i is not None:
                    first[host, key] = min(i, first.get((host, key), i))
    out = []
    for (i, host, t), keys in zip(rows, keyed):
        words, chars, *_, failed = base_rules(t)
        gone = sum(len(re.sub(r"[ \t\n\x0b\x0c\r]", "", k)) for k in keys
                   if k and len(around[host, k]) > max_docs and first.get((host, k)) != i)
        out.append((i, gone, not failed and (gone == 0 or chars - gone >= min_left * chars)))
    return out


PIECE_END = re.compile(r"[.,;:!?\x0A-\x0D]")


def collocations(docs, max_words=3, least=10, percent=50, top=2000):
    """docs: (lang, text)."""
    f, n = defaultdict(Counter), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in PIECE_END.split(lower(text)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for size in range(1, max_words + 1):
                f[lang].update(tuple(w[i:i + size]) for i in range(len(w) - size + 1))
    out = []
    for lang, counts in f.items():
        cands = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        covered = defaultdict(int)
        for p, a in cands.items():
            for i in range(len(p)):
                for j in range(i + 2, len(p) + 1):
                    if j - i < len(p):
                        covered[p[i:j]] = max(covered[p[i:j]], a)
        rows = []
        for p, a in cands.items():
            if 100 * covered[p] >= percent * a and p in covered and covered[p]:
                continue
            score, k = min((10**6 * a * a // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        out += [(lang, i, p.decode(), -a, left, right, n[lang], -s)
                for i, (s, a, p, left, right) in enumerate(sorted(rows)[:top], 1)]
    return out


def prefix_trie(rows, every=20, heads=4):
    """rows: (conv_id, turn, role, text)."""
    def key(r, t):
        return hashlib.md5(f"{len(r)}:{r}{t}".encode()).digest()

    convs = defaultdict(list)
    for c, turn, r, t in rows:
        r, t = r or "", t or ""
        convs[c].append(((turn is not None, turn or 0), key(r, t), (r, t)))
    own = {c: [x[2] for x in sorted(v)] for c, v in convs.items()}
    nodes = defaultdict(lambda: [[], []])  # members, ends
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % heads if c is not None else 0
        base = own.get(c - int(math.fmod(c, every)), []) if c is not None else []
        path = tuple(base[:h] + turns[h:])
        for d in range(len(path) + 1):
            nodes[path[:d]][0].append(c)
        nodes[path][1].append(c)
    kids = Counter(p[:-1] for p in nodes if p)
    leaves, saved = Counter(), Counter()
    for p, (members, _) in nodes.items():
        value = (len(members) - 1) * len(WORD.findall(p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += not kids[p]
            saved[p[:d]] += value

    def least(p):
        return min((c for c in nodes[p][0] if c is not None), default=None)

    def told(ids):
        return ",".join("null" if c is None else str(c)
                        for c in sorted(ids, key=lambda c: (c is not None, c or 0)))

    return [(least(p), len(p), least(p[:-1]) if p else None, len(m), kids[p], leaves[p], saved[p], sha(told(e)))
            for p, (m, e) in nodes.items()]
