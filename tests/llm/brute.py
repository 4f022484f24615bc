"""Small plain-Python versions of the operators' contracts, and documents that are awkward for them."""

import hashlib
import random
import re
import zlib

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
CASE = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def documents(seed=7, n=120):
    """(doc_id, text): nulls, empty and odd white space, one long text, copies, near copies, shared lines."""
    r = random.Random(seed)
    vocab = ["".join(r.choice("abcdeéñü") for _ in range(r.randint(1, 9))) for _ in range(300)] + ["The", "THE", "the", "ſ", "K", "1", "22", "x\u0085y", " "]
    line = lambda k: " ".join(r.choice(vocab) for _ in range(k))
    shared = [line(12) for _ in range(5)]
    base = "\n".join(line(20) for _ in range(4))
    out = [(1, None), (2, ""), (3, "\n\n"), (4, " \t\r\n\x0b\x0c"), (5, "one"), (6, "a b c"), (7, "a b c d"), (8, "A B C D"), (9, "x" * 3000)]
    for i in range(10, n):
        kind = r.randrange(6)
        words = base.split(" ")
        if kind == 0:
            for _ in range(r.randint(0, 6)):
                words[r.randrange(len(words))] = r.choice(vocab)
            text = " ".join(words)
        elif kind == 1:
            text = "\n".join([line(r.randint(1, 30)), r.choice(shared).upper(), "  " + r.choice(shared) + "\t", line(3)])
        elif kind == 2:
            text = (line(2) + " ") * r.randint(1, 60)
        elif kind == 3 and len(out) > 12:
            text = out[r.randrange(9, len(out))][1]
        else:
            text = "\n".join(line(r.randint(0, 40)) for _ in range(r.randint(1, 5)))
        out.append((i, text))
    out.append((n, " ".join(r.choice(vocab) for _ in range(20000)) + "\n" + shared[0]))
    return out


def counts(text):
    text = text or ""
    words = SPACED.findall(text)
    seen, dup = set(), 0
    for x in text.split("\n"):
        if SPACED.search(x):
            dup += x in seen
            seen.add(x)
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    often = {g for g in grams if grams.count(g) > 1} if len(grams) < 3000 else {g for g, k in __import__("collections").Counter(grams).items() if k > 1}
    covered = {i + j for i, g in enumerate(grams) if g in often for j in range(3)}
    return {"n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)), "n_dup_lines": dup, "n_repeat_words": len(covered)}


def line_dedup(docs, min_chars=20, min_docs=3):
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate(CASE)
    held = {}
    for i, text in docs:
        for x in (text or "").split("\n"):
            if len(key(x)) >= min_chars:
                held.setdefault(key(x), set()).add(i)
    out = []
    for i, text in docs:
        lines = (text or "").split("\n")
        kept = [x for x in lines if not (len(held.get(key(x), ())) >= min_docs and max(held[key(x)]) != i)]
        out.append((i, len(lines), len(lines) - len(kept), sha("\n".join(kept))))
    return out


def shingles(text, k):
    words = SPACED.findall((text or "").translate(CASE))
    return {tuple(words[i:i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def near_dup(docs, k=4, percent=80):
    """doc_id to (size, component); docs without null ids."""
    sets = [(i, shingles(t, k)) for i, t in docs]
    parent = {i: i for i, _ in docs}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, (i, s) in enumerate(sets):
        for j, t in sets[:a]:
            if s and t and 100 * len(s & t) >= percent * len(s | t):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return sorted((i, len(s), find(i)) for i, s in sets)


def decontaminate(docs, items, window=10):
    """Rows of (doc_id, n_words, n_hit, n_items, sha of items)."""
    wins = {}
    for item, text in items:
        w = ALNUM.findall((text or "").translate(CASE))
        k = min(window, len(w))
        for at in range(len(w) - k + 1 if w else 0):
            wins.setdefault(tuple(w[at:at + k]), set()).add("" if item is None else str(item))
    out = []
    for i, text in docs:
        w = ALNUM.findall((text or "").translate(CASE))
        hit, found = set(), set()
        for k in {len(x) for x in wins}:
            for at in range(len(w) - k + 1):
                if (x := tuple(w[at:at + k])) in wins:
                    hit |= set(range(at, at + k))
                    found |= wins[x]
        out.append((i, len(w), len(hit), len(found), sha(",".join(sorted(found)))))
    return out


def near_items(docs, items, window=10, slop=3):
    """(doc_id, items with a window whose words stand in order in a stretch of its size and at most ``slop`` words more)."""
    wins = {}
    for item, text in items:
        w = ALNUM.findall((text or "").translate(CASE))
        k = min(window, len(w))
        for at in range(len(w) - k + 1 if w else 0):
            wins.setdefault(tuple(w[at:at + k]), set()).add("" if item is None else str(item))
    out = []
    for i, text in docs:
        w = ALNUM.findall((text or "").translate(CASE))
        found = set()
        for x in wins:
            for at in range(len(w)):
                stretch = iter(w[at:at + len(x) + slop])
                if w[at] == x[0] and all(any(y == z for z in stretch) for y in x):
                    found |= wins[x]
        out.append((i, sorted(found)))
    return out


def crc(ids):
    return zlib.crc32(b"".join(int(x).to_bytes(4, "little") for x in ids))
