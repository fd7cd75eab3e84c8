"""A small corpus with every case the text operators must stand, and brute-force versions of what they find."""

import hashlib
import random
import re
from collections import Counter, defaultdict

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, digest string, ids string"
SPACE = r"[^\x20\x09-\x0D]+"


def words(text):
    return re.findall(SPACE, text or "")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def sha(data):
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def corpus():
    """Rows with nulls, empty and long texts, ties, repeats, periodic texts, near copies and shared passages."""
    rng = random.Random(8)
    syllables = ["lo", "mi", "ra", "ké", "tun", "sch", "ba", "ing", "ño", "der"]
    word = lambda: "".join(rng.choices(syllables, k=rng.randint(1, 4)))
    passage = " ".join(word() for _ in range(90))
    texts = [None, "", "   \t\n", "One", "one", "ONE two", "!!! 123", "x" * 900, "da " * 300, "ab cd ef " * 200]
    for _ in range(12):
        texts.append(" ".join(word() for _ in range(rng.randint(3, 200))))
    base = " ".join(word() for _ in range(150)).split()
    for k in range(12):  # near copies that drift away from each other
        changed = list(base)
        for i in range(k):
            changed[i * 11] = word()
        texts.append(" ".join(changed))
    texts += [texts[12], texts[12].upper(), texts[12] + " ", texts[13].replace(" ", "\n")]
    for _ in range(6):  # a passage in other surroundings
        texts.append(" ".join([word() for _ in range(30)]) + " " + passage + " " + " ".join(word() for _ in range(20)))
    texts.append(passage + " " + passage)
    texts.append(" ".join(word() for _ in range(4000)) + " " + passage)
    texts.append(passage.lower() + " " + "é" * 401)
    rows = [(i * 3 + 1, t, rng.choice(["en", "fr", None]), rng.choice(["a", "b", "é", None]), 1, "x", "y") for i, t in enumerate(texts)]
    rows.append(rows[14])  # a row twice
    rows.append((None, texts[15], "en", "a", 1, "x", "y"))
    rows.append((None, "no id and a text of its own", "en", "a", 1, "x", "y"))
    return rows


def exact(rows):
    groups = defaultdict(list)
    for i, t, *_ in rows:
        groups[sha(lower(t or ""))].append(i)
    known = lambda v: max((x for x in v if x is not None), default=None)
    return sorted(((i, known(v), len(v), h) for h, v in groups.items() for i in v), key=repr)


def repeated_words(rows, window=50):
    """doc_id, n_words, n_removed, sha for rows with distinct ids."""
    seen, out = {}, []
    for i, t, *_ in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        w = words(t)
        gone, own = [False] * len(w), []
        for a in range(len(w) - window + 1):
            key = tuple(w[a : a + window])
            if key in seen and seen[key] < i:
                gone[a : a + window] = [True] * window
            own.append(key)
        for key in own:
            seen.setdefault(key, i)
        out.append((i, len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone) if not g))))
    return sorted(out)


def repeated_bytes(rows, window=400):
    texts = [(i, (t or "").encode()) for i, t, *_ in rows]
    met = Counter(b[a : a + window] for _, b in texts for a in range(len(b) - window + 1))
    out = []
    for i, b in texts:
        gone = bytearray(len(b))
        for a in range(len(b) - window + 1):
            if met[b[a : a + window]] > 1:
                gone[a : a + window] = b"\1" * window
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((i, len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), sha(kept)))
    return sorted(out, key=repr)


def groups(ids, linked):
    """Smallest id each reaches."""
    up = {i: i for i in ids}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in linked:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    return {i: top(i) for i in ids}


def gram_groups(rows, n=5):
    sets = {}
    for i, t, *_ in rows:
        if i is not None:
            w = words(lower(t or ""))
            sets[i] = frozenset(tuple(w[a : a + n]) for a in range(max(1, len(w) - n + 1))) if w else frozenset()
    ids = sorted(sets)
    links = [
        (a, b) for a in ids for b in ids
        if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    ]
    return [(i, len(sets[i]), c) for i, c in sorted(groups(ids, links).items())]
