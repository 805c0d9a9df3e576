"""Plain versions of the operators, for small tables."""

import hashlib


def substring(rows, length=50):
    docs = [(i, (t or "").encode().split()) for i, t in rows]
    least = {}
    for i, w in docs:
        for a in range(len(w) - length + 1 if i is not None else 0):
            key = tuple(w[a : a + length])
            least[key] = min(least.get(key, i), i)
    out = []
    for i, w in docs:
        gone = set()
        for a in range(len(w) - length + 1 if i is not None else 0):
            if least[tuple(w[a : a + length])] < i:
                gone.update(range(a, a + length))
        out.append((i, len(w), len(gone), hashlib.sha256(b" ".join(x for j, x in enumerate(w) if j not in gone)).hexdigest()))
    return out


def suffix(rows, length=400):
    docs = [(i, (t or "").encode()) for i, t in rows]
    seen = {}
    for _, b in docs:
        for a in range(len(b) - length + 1):
            seen[b[a : a + length]] = seen.get(b[a : a + length], 0) + 1
    out = []
    for i, b in docs:
        gone = bytearray(len(b))
        for a in range(len(b) - length + 1):
            if seen[b[a : a + length]] > 1:
                gone[a : a + length] = b"\1" * length
        spans = sum(1 for j in range(len(b)) if gone[j] and not (j and gone[j - 1]))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(bytes(x for j, x in enumerate(b) if not gone[j])).hexdigest()))
    return out


def jaccard(rows, n, percent):
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set())
    label = list(range(len(rows)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                x, y = find(i), find(j)
                label[max(x, y)] = min(x, y)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return [(d, len(sets[i]), least.get(find(i), None)) for i, (d, _) in enumerate(rows)]


def statistics(text):
    raw = (text or "").encode()
    words = raw.split()
    seen = {}
    for i in range(len(words) - 4):
        seen.setdefault(tuple(words[i : i + 5]), []).append(i)
    hit = {i + k for at in seen.values() if len(at) > 1 for i in at for k in range(5)}
    lines = [x for x in (text or "").split("\n") if x.encode().split()]
    joined = "".join(w.decode() for w in words)
    return len(words), len(joined), sum(c in "#*$%&|<>" for c in joined), len(lines) - len(set(lines)), len(hit)


def thue_morse(n):
    bits = [bin(i).count("1") % 2 for i in range(n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)
