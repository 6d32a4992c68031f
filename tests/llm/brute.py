"""Plain versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict

SPACES = re.compile(r"[\x20\x09-\x0D]+")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
ASCII_LOWER = {65 + k: 97 + k for k in range(26)}


def words(text):
    return WORD.findall(text or "")


def quality(rows, line_share=0.10, line_docs=20, left_share=0.5):
    """Rows of doc_id, text, source to doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept."""
    tidy = lambda line: SPACES.sub(" ", line).strip(" ").lower()
    texts, hosts = defaultdict(set), defaultdict(set)
    for _, text, source in rows:
        for line in (text or "").split("\n"):
            if words(line):
                texts[source or "", tidy(line)].add(text)
                hosts[source or ""].add(text)
    often = {k for k, t in texts.items() if len(t) >= line_docs and len(t) > line_share * len(hosts[k[0]])}
    out = []
    for doc_id, text, source in rows:
        w = words(text)
        lines = [line for line in (text or "").split("\n") if words(line)]
        windows = Counter(tuple(w[p : p + 3]) for p in range(len(w) - 2))
        covered = {q for p in range(len(w) - 2) if windows[tuple(w[p : p + 3])] > 1 for q in (p, p + 1, p + 2)}
        gone = sum(len(words(line)) for line in lines if (source or "", tidy(line)) in often)
        failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
        symbols = sum((text or "").count(c) for c in "#*$%&|<>")
        kept = not failed and not len(w) - gone < left_share * len(w)
        out.append((doc_id, len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(covered), failed, kept))
    return out


def removed(rows, length=50):
    """Rows of doc_id, text to doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    order = lambda i: (i is None, i or 0)
    first = {}
    for doc_id, text in sorted(rows, key=lambda r: order(r[0])):
        data = (text or "").encode()
        for p in range(len(data) - length + 1):
            first.setdefault(data[p : p + length], doc_id)
    out = []
    for doc_id, text in rows:
        data = (text or "").encode()
        cut = bytearray(len(data))
        for p in range(len(data) - length + 1):
            if order(first[data[p : p + length]]) < order(doc_id):
                cut[p : p + length] = b"\1" * length
        kept = bytes(x for x, gone in zip(data, cut) if not gone)
        spans = sum(1 for k in range(len(cut)) if cut[k] and (k == 0 or not cut[k - 1]))
        out.append((doc_id, len(data), sum(cut), spans, hashlib.sha256(kept).hexdigest()))
    return out


def shingles(text, size):
    w = words((text or "").translate(ASCII_LOWER))
    if len(w) >= size:
        return {tuple(w[p : p + size]) for p in range(len(w) - size + 1)}
    return {tuple(w)} if w else set()


def groups(rows, size, percent):
    """Rows of doc_id, text to doc_id, number of shingles and the index of the first row of the component."""
    sets = [shingles(text, size) for _, text in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x] = parent[parent[x]]
        return x

    for b, second in enumerate(sets):
        for a in range(b):
            if second and sets[a] and 100 * len(sets[a] & second) >= percent * len(sets[a] | second):
                parent[find(b)] = find(a)
    return [(doc_id, len(sets[k]), find(k)) for k, (doc_id, _) in enumerate(rows)]


def components(rows, size, percent):
    found = groups(rows, size, percent)
    least = {}
    for doc_id, _, root in found:
        if doc_id is not None:
            least[root] = min(least.get(root, doc_id), doc_id)
    return [(doc_id, n, least.get(root) if n else doc_id) for doc_id, n, root in found]


UNITS = "percent dollars hours kg km miles minutes".split()


def template(text):
    """Canonical tokens and their values, for texts of ASCII letters, digits and simple marks."""
    out, previous, opens = [], None, True
    for match in re.finditer(r"(?:[A-Za-z0-9\x80-\U0010ffff]|(?<=\d)[.,](?=\d))+|[.!?:\n]", text or ""):
        token = match[0]
        if token in ".!?:\n":
            opens = True
            continue
        if re.search(r"\d", token):
            kind = "<number>"
        elif previous == "<number>" and token.lower() in UNITS:
            kind = "<unit>"
        elif token[0].isupper() and not opens:
            kind = "<name>"
        else:
            kind = None
        out.append((kind or token.lower(), token.lower(), kind))
        previous, opens = kind, False
    return out


def contaminated(docs, items, span=10, literals=5, coverage=0.5):
    """Pairs of doc_id and item_id."""
    found = set()
    cut = lambda t, k, n: tuple(x[0] for x in t[k : k + n])
    enough = lambda t, k, n: sum(x[2] is None for x in t[k : k + n]) >= literals
    texts = [(doc_id, template(text)) for doc_id, text in docs]
    for item_id, text in items:
        item = template(text)
        plain = [x[1] for x in item]
        n = min(span, len(plain))
        parts = [plain[k : k + n] for k in range(len(plain) - n + 1)] if plain else []
        for doc_id, doc in texts:
            words_ = [x[1] for x in doc]
            held = [words_[k : k + n] for k in range(len(words_) - n + 1)] if n >= literals or len(words_) == n else []
            if parts and sum(part in held for part in parts) >= coverage * len(parts):
                found.add((doc_id, item_id))
        n = min(span, len(item))
        places = [k for k in range(len(item) - n + 1) if n >= literals and enough(item, k, n)]
        for doc_id, doc in texts:
            aligned = defaultdict(list)
            where = defaultdict(list)
            for k in range(len(doc) - n + 1):
                where[cut(doc, k, n)].append(k)
            for k in places:
                for j in where[cut(item, k, n)]:
                    aligned[j - k].append(k)
            covered = set()
            for shift, ks in aligned.items():
                pairs = {
                    (item[k + i][2], item[k + i][1], doc[k + shift + i][1]) for k in ks for i in range(n) if item[k + i][2]
                }
                names = [p for p in pairs if p[0] == "<name>"]
                if len({p[:2] for p in pairs}) == len(pairs) and len({p[2] for p in names}) == len(names):
                    covered |= set(ks)
            if places and len(covered) >= coverage * len(places):
                found.add((doc_id, item_id))
    return found


TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall((text or "").translate(ASCII_LOWER))


def search(docs, items, top=20):
    """Rows of item_id, rank, doc_id, score, for ``docs`` of doc_id, text and ``items`` of item_id, text."""
    counts = [(doc_id, Counter(terms(text))) for doc_id, text in docs if terms(text)]
    n_docs, n_terms = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    weights = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1))) for t, n in df.items()}
    out = []
    for item_id, text in items:
        found = []
        for doc_id, c in counts:
            m = 75 + 25 * sum(c.values()) * n_docs // n_terms
            score = sum(weights[t] * (10**9 * c[t] // (1000 * c[t] + 12 * m)) for t in terms(text) if t in c)
            if score > 0:
                found.append((-score, doc_id is None, doc_id or 0, doc_id))
        for rank, (score, _, _, doc_id) in enumerate(sorted(found, key=lambda f: f[:3])[:top], 1):
            out.append((item_id, rank, doc_id, -score))
    return out


def _finite(vector):
    return vector is not None and all(x is not None and math.isfinite(x) for x in vector)


def near_vectors(rows, cosine=0.98):
    """Rows of vec_id, vector, label to vec_id, n_links, component_id, kept."""
    able = [label is not None and _finite(v) and any(v) for _, v, label in rows]
    parent, links = list(range(len(rows))), [0] * len(rows)

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    def similar(v, w):
        v, w = ([x / max(map(abs, u)) for x in u] for u in (v, w))
        return sum(x * y for x, y in zip(v, w)) >= cosine * math.sqrt(sum(x * x for x in v) * sum(x * x for x in w))

    for b in range(len(rows)):
        for a in range(b):
            if able[a] and able[b] and rows[a][2] == rows[b][2] and similar(rows[a][1], rows[b][1]):
                links[a] += 1
                links[b] += 1
                parent[find(b)] = find(a)
    out = []
    for k, (vec_id, _, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(k) and rows[j][0] is not None]
        out.append((vec_id, links[k], min(ids, default=None), vec_id == min(ids, default=None)))
    return out


def negatives(rows, positives=5, keep=10, least=30, most=90):
    """Rows of vec_id, vector, label to anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    able = [(i, v, label) for i, v, label in rows if label is not None and _finite(v)]
    whole = [[max(-(1 << 28), min(1 << 28, math.floor(256 * x))) for x in v] for _, v, _ in able]
    out = []
    for a, (anchor, _, own) in enumerate(able):
        if anchor is None or anchor % 100:
            continue
        scored = []
        for b, (vec_id, _, label) in enumerate(able):
            if a != b:
                scored.append((-sum(x * y for x, y in zip(whole[a], whole[b])), vec_id is None, vec_id or 0, vec_id, label == own))
        scored.sort(key=lambda s: s[:3])
        for target, _, _, positive, _ in [s for s in scored if s[4]][:positives]:
            near = [s for s in scored if not s[4] and -least * target <= -100 * s[0] <= -most * target][:keep]
            out += [(anchor, positive, rank, s[3], -target, -s[0]) for rank, s in enumerate(near, 1)]
    return out
