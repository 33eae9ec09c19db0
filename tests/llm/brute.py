"""Plain versions of the operators, for small inputs."""

import collections
import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def repeats(docs, length=100):
    """doc_id -> (bytes, removed, spans, sha256 of the rest) for [(doc_id, text)]; ids are distinct."""
    seen, out = set(), {}
    for d, t in sorted(docs):
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if b[p:p + length] in seen:
                gone[p:p + length] = b"\1" * length
            else:
                seen.add(b[p:p + length])
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out[d] = (len(b), len(b) - len(kept), spans, hashlib.sha256(kept).hexdigest())
    return out


def shingles(text):
    w = (text or "").lower().split()
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def classes(docs, similarity=0.8):
    """doc_id -> (least id of its class, links) for [(doc_id, text)]."""
    sets = {d: shingles(t) for d, t in docs}
    where = collections.defaultdict(list)
    for d, s in sets.items():
        for g in s:
            where[g].append(d)
    both = collections.Counter()
    for ds in where.values():
        for i in range(len(ds)):
            for j in range(i):
                both[min(ds[i], ds[j]), max(ds[i], ds[j])] += 1
    parent, links = {d: d for d in sets}, collections.Counter()

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (a, b), n in both.items():
        if n >= similarity * (len(sets[a]) + len(sets[b]) - n):
            links[a] += 1
            links[b] += 1
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return {d: (find(d), links[d]) for d in sets}


def counts(text):
    """(words, word characters, symbols, repeated lines, repeated words, base test failed)."""
    t = text or ""
    w = WORD.findall(t)
    seen, dup = set(), 0
    for line in t.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    grams = collections.Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    again = {j for i in range(len(w) - 2) if grams[tuple(w[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
    n = len(w)
    return n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(again), n < 50 or 100 * len(again) > 50 * n


def fill_in_middle(doc_id, text, marks=("<P>", "<S>", "<M>"), seed="1"):
    """(n, form, prefix characters, middle characters, output) of one text."""
    t = text or ""
    p, s, m = marks
    u = re.findall(r"[A-Za-z]+|[^A-Za-z]", t)
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k:8 * k + 8], 16) for k in range(4))
    if not t or any(x in t for x in marks) or h3 % 100 >= 90:
        return len(u), "plain", None, None, t
    a, b = sorted((h1 % (len(u) + 1), h2 % (len(u) + 1)))
    x, y, z = "".join(u[:a]), "".join(u[a:b]), "".join(u[b:])
    if h4 % 100 < 20:
        return len(u), "spm", len(x), len(y), s + z + p + x + m + y
    return len(u), "psm", len(x), len(y), p + x + s + z + m + y


def passages(docs, window=13):
    """(doc_id, text) -> (words, removed, sha256 of the rest) for [(doc_id, text)]; an id may have several texts."""
    first = {}
    for d, t in docs:
        w = WORD.findall(t or "")
        for i in range(len(w) - window + 1):
            k = tuple(w[i:i + window])
            first[k] = min(d, first.get(k, d))
    out = {}
    for d, t in docs:
        w = WORD.findall(t or "")
        gone = {i + j for i in range(len(w) - window + 1) if first[tuple(w[i:i + window])] < d for j in range(window)}
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out[d, t] = len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()
    return out


def phrase_lists(docs, depth=3, least=10, top=2000, share=50):
    """{(stratum, rank): (phrase, a, l, r, n, score)} for [(stratum, text)]."""
    f = collections.defaultdict(collections.Counter)
    for s, t in docs:
        t = re.sub("[A-Z]", lambda m: m.group().lower(), t or "")
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", t):
            w = re.findall(r"[^\x20\x09]+", piece)
            for k in range(1, depth + 1):
                f["und" if s is None else s].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = {}
    for s, c in f.items():
        n = sum(v for k, v in c.items() if len(k) == 1)
        many = {k: v for k, v in c.items() if len(k) > 1 and v >= least}
        held = collections.defaultdict(int)
        for k, v in many.items():
            for size in range(2, len(k)):
                for i in range(len(k) - size + 1):
                    held[k[i:i + size]] = max(held[k[i:i + size]], v)
        rows = []
        for k, a in many.items():
            if 100 * held[k] >= share * a:
                continue
            score, _, l, r = min((10 ** 6 * a * a // (c[k[:j]] * c[k[j:]]), j, c[k[:j]], c[k[j:]]) for j in range(1, len(k)))
            rows.append((-score, -a, " ".join(k).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(rows)[:top], 1):
            out[s, rank] = phrase.decode(), -a, l, r, n, -score
    return out


def alike(length=1024):
    """Two unlike words of one length whose polynomial hash modulo 2^64 is the same for every base (Thue-Morse)."""
    one = "".join("ab"[bin(i).count("1") % 2] for i in range(length))
    return one, one.translate(str.maketrans("ab", "ba"))


def kept(docs, labels, rules, ladder, cost, limit=0.05, delta=0.05):
    """doc_id -> verdict for [(doc_id, text, stratum)] and {doc_id: good}: exact bounds by summing the binomial, rule by rule."""
    from fractions import Fraction
    from math import comb

    def ratios(t):
        n, chars, symbols, dup, again, failed = counts(t)
        lines = sum(1 for x in (t or "").split("\n") if WORD.search(x))
        up, low = len(re.findall("[A-Z]", t or "")), len(re.findall("[a-z]", t or ""))
        pairs = {"symbols": (symbols, chars), "dup_lines": (dup, lines), "repeats": (again, n), "upper": (up, up + low), "word_length": (chars, 20 * n)}
        return failed, {k: a / b if b else 0.0 for k, (a, b) in pairs.items()}

    seen = {d: ratios(t) for d, t, _ in docs}
    strata = {s for d, _, s in docs if d in labels and not seen[d][0]}
    cut = {}
    for s in strata:
        mine = [d for d, _, x in docs if x == s and d in labels and not seen[d][0]]
        n = sum(labels[d] for d in mine)
        for r in rules:
            best = 0
            for c in ladder:
                good = sum(labels[d] for d in mine if seen[d][1][r] > c)
                bad = sum(1 - labels[d] for d in mine if seen[d][1][r] > c)
                p = Fraction(limit).limit_denominator(10 ** 6) / len(rules)
                # the upper bound is within the limit where so few rejections are improbable at the limit
                if not n or sum(comb(n, i) * p ** i * (1 - p) ** (n - i) for i in range(good + 1)) > delta / (len(strata) * len(rules)):
                    break
                if bad - cost * good > best:
                    best, cut[s, r] = bad - cost * good, c
    return {d: not seen[d][0] and not any(seen[d][1][r] > cut[s, r] for r in rules if (s, r) in cut) for d, _, s in docs}
