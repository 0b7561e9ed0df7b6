"""Plain Python versions of the operators, for small tables."""

import hashlib
import re
from collections import Counter, defaultdict

import xxhash

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall((text or "").encode().lower())


def shingles(text, n=5):
    w = words(text)
    return {tuple(w[k:k + n]) for k in range(max(1, len(w) - n + 1))} if w else set()


def classes(rows, percent=80):
    """{index of row: smallest linked id} of rows (id, text)."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    at = defaultdict(list)
    for k, (i, _) in enumerate(rows):
        if i is not None:
            for g in sets[k]:
                at[g].append(k)
    common = Counter()
    for members in at.values():
        for a in range(len(members)):
            for b in range(a):
                common[members[b], members[a]] += 1
    for (a, b), c in common.items():
        if 100 * c >= percent * (len(sets[a]) + len(sets[b]) - c):
            parent[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return [(i, len(sets[k]), None if i is None else least[find(k)]) for k, (i, _) in enumerate(rows)]


def cut_windows(rows, depth=50):
    """[(id, kept bytes, spans)] of rows (id, text): windows that also start in a row with a smaller id go."""
    first = {}
    for i, t in rows:
        b = (t or "").encode()
        if i is not None:
            for k in range(len(b) - depth + 1):
                w = b[k:k + depth]
                first[w] = min(i, first.get(w, i))
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        last = 0
        for k in range(len(b) - depth + 1) if i is not None else ():
            if first[b[k:k + depth]] < i:
                for x in range(max(last, k), k + depth):
                    gone[x] = 1
                last = k + depth
        spans, k = [], 0
        while k < len(b):
            if gone[k]:
                e = k
                while e < len(b) and gone[e]:
                    e += 1
                spans.append((k, e))
                k = e
            else:
                k += 1
        out.append((i, bytes(c for c, g in zip(b, gone) if not g), spans))
    return out


def units(text, mode="sentence"):
    b = (text or "").encode()
    ws = [(m.start(), m.end()) for m in WORD.finditer(b)]
    out = []
    for k, (s, e) in enumerate(ws):
        end = ws[k - 1][1]
        if k == 0 or b"\n" in b[end:s] or (mode == "sentence" and b[end - 1:end] in (b".", b"!", b"?")):
            out.append([s, []])
        out[-1][1].append(b[s:e].lower())
    return [(s, out[k + 1][0] if k + 1 < len(out) else len(b), tuple(w)) for k, (s, w) in enumerate(out)]


def cut_units(rows, mode="sentence", min_words=10):
    """{(id, text): (kept bytes, spans)}: units that stand earlier (by id, place) go in long enough runs."""
    seen, out = set(), {}
    for i, t in sorted({(i, t or "") for i, t in rows if i is not None}):
        b, us = t.encode(), units(t, mode)
        late = []
        for _, _, w in us:
            late.append(w in seen)
            seen.add(w)
        spans, k = [], 0
        while k < len(us):
            if late[k]:
                j = k
                while j < len(us) and late[j]:
                    j += 1
                if sum(len(us[x][2]) for x in range(k, j)) >= min_words:
                    spans.append((us[k][0], us[j - 1][1]))
                k = j
            else:
                k += 1
        kept, last = b"", 0
        for s, e in spans:
            kept += b[last:s]
            last = e
        out[i, t] = (kept + b[last:], spans)
    return out


def cut_lines_and_passages(rows, min_words=10):
    """{(id, text): (kept bytes, spans, units)}: later lines go, and runs of later sentences that are long enough."""
    seen, seen_lines, out = set(), set(), {}
    for i, t in sorted({(i, t or "") for i, t in rows if i is not None}):
        b, us, later_lines = t.encode(), units(t), []
        for s, e, w in units(t, "line"):
            if w in seen_lines:
                later_lines.append((s, e))
            seen_lines.add(w)
        late = []
        for _, _, w in us:
            late.append(w in seen)
            seen.add(w)
        goes, k = [any(s <= u[0] and u[1] <= e for s, e in later_lines) for u in us], 0
        while k < len(us):
            j = k
            while j < len(us) and late[j]:
                j += 1
            if sum(len(us[x][2]) for x in range(k, j)) >= min_words:
                goes[k:j] = [True] * (j - k)
            k = max(j, k + 1)
        spans = []
        for (s, e, _), gone in zip(us, goes):
            if gone:
                spans = [*spans[:-1], (spans[-1][0], e)] if spans and spans[-1][1] == s else [*spans, (s, e)]
        kept, last = b"", 0
        for s, e in spans:
            kept, last = kept + b[last:s], e
        out[i, t] = (kept + b[last:], spans, sum(goes))
    return out


def sha(data):
    return hashlib.sha256(data).hexdigest()


def simhash(text, n=3):
    """The fingerprint of a text, bit by bit."""
    w = words(text)
    if not w:
        return 0
    grams = [b" ".join(w[k:k + n]) for k in range(max(1, len(w) - n + 1))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(grams))


def simhash_classes(rows, bits=2):
    """[(id, fingerprint, smallest id reachable)] of rows (id, text), from all pairs."""
    prints = {}
    for i, t in rows:
        if i is not None:
            prints.setdefault(simhash(t), []).append(i)
    own = sorted(prints)
    parent = {f: f for f in own}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a in own:
        for b in own:
            if a < b and bin(a ^ b).count("1") <= bits:
                parent[find(a)] = find(b)
    least = {}
    for f in own:
        least[find(f)] = min(least.get(find(f), min(prints[f])), *prints[f])
    return [(i, simhash(t), None if i is None else least[find(simhash(t))]) for i, t in rows]


def near_words(a, b):
    """Whether one inserted, deleted or replaced code point makes one word of the other."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:k] + long[k + 1:] == short for k in range(len(long)))


def variant_groups(counts, ratio=10):
    """[(word, form, root, n, n_near, form_n)] of {word: n}, from all pairs."""
    near = {w: [x for x in counts if near_words(w, x)] for w in counts}
    best = {w: min(x, key=lambda y: (-counts[y], y)) for w, x in near.items() if x}
    form = {w: f for w, f in best.items() if counts[f] >= ratio * counts[w]}

    def root(w):
        return root(form[w]) if w in form else w
    return [(w, form.get(w), root(w), n, len(near[w]), counts[form[w]] if w in form else None) for w, n in counts.items()]


def divergences(rows, min_docs=3, top=200):
    """[(lang, source, part, item, value, rank)] of rows (text, lang, source)."""
    term = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    use, docs = defaultdict(Counter), defaultdict(Counter)
    for t, lang, source in rows:
        found = [x.translate(lower) for x in term.findall(t or "")]
        use[lang or "", source or ""].update(found)
        docs[lang or ""].update(set(found))
    out = []
    for lang in docs:
        kept = {t for t, n in docs[lang].items() if n >= min_docs}
        groups = {s: {t: c[t] for t in kept} for (x, s), c in use.items() if x == lang}
        whole = {t: sum(c[t] for c in groups.values()) for t in kept}

        def price(c):
            total = sum(c.values())
            return {t: 1 + 10 ** 9 * (n + 1) // (total + len(kept)) for t, n in c.items()}
        prices, q = {s: price(c) for s, c in groups.items()}, price(whole)
        for s, p in prices.items():
            pairs = [(x, sum((p[t] - y[t]) ** 2 // y[t] for t in kept)) for x, y in prices.items() if x != s]
            terms = [(t, (p[t] - q[t]) ** 2 // q[t]) for t in kept if groups[s][t] and p[t] > q[t]]
            for part, items in (("pair", pairs), ("term", terms)):
                ranked = sorted(items, key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, x, v, k) for k, (x, v) in enumerate(ranked, 1) if part == "pair" or k <= top]
    return out
