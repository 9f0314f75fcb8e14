"""Plain versions of the operators, for small tables."""

import hashlib
import re
import zlib
from collections import Counter
from itertools import combinations

import public_tokenizers
from tokenizers import Tokenizer


def shingles(text, size=5):
    words = re.findall(r"[^\W_]+", (text or "").lower())
    size = min(size, len(words))
    return [tuple(words[k : k + size]) for k in range(len(words) - size + 1)] if words else []


def probability_jaccard(x, y):
    both = x.keys() & y.keys()
    every = x.keys() | y.keys()
    return sum(1 / sum(max(x.get(j, 0) / x[i], y.get(j, 0) / y[i]) for j in every) for i in both)


def classes(docs):
    """Class of each id by comparing all pairs that share a shingle."""
    import math

    sets = {i: {s: 1 + math.log(n) for s, n in Counter(shingles(t)).items()} for i, t in docs}
    root = {i: i for i, _ in docs}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in combinations(sorted(root), 2):
        x, y = sets[a], sets[b]
        if not x or not y or min(len(x), len(y)) < 0.2 * max(len(x), len(y)) or not x.keys() & y.keys():
            continue
        # The index is no more than the share that the common shingles could have at best.
        if x == y or (2 * len(x.keys() & y.keys()) > 0.5 * min(len(x), len(y)) and probability_jaccard(x, y) >= 0.8 - 1e-12):
            p, q = find(a), find(b)
            root[max(p, q)] = min(p, q)
    return {i: find(i) for i in root}


def leaks(docs, items):
    """Pairs of document and item with a window of the item's size at weighted similarity 0.8 or more."""
    found = set()
    for item, text in items:
        want = Counter(shingles(text))
        for doc, body in docs:
            have = shingles(body)
            if not want or not set(have) & want.keys():
                continue
            total = sum(want.values())
            per = min(total, len(have))  # a shorter document is one window
            for k in range(len(have) - per + 1):
                window = Counter(have[k : k + per])
                common = sum((window & want).values())
                if common / (per + total - common) >= 0.8:
                    found.add((doc, item))
                    break
    return found


def token_rows(docs):
    """Rows of the token files, from the tokenizer alone."""
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    out, start = [], 0
    for doc, text in docs:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((doc, start, len(ids), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))))
        start += len(ids)
    return out


def secret_spans(text):
    """Base spans by the patterns as they are stated."""
    kinds = (
        ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 6),
        ("access", re.compile("AKIA[A-Z0-9]+"), 0, 20),
        ("hex", re.compile("[0-9a-f]+"), 0, 24),
    )
    found = []
    for k, (name, pattern, group, least) in enumerate(kinds):
        found += [(m.start(), k, f"{name}:{m.start()}:{m.end()}") for m in pattern.finditer(text or "") if len(m[group]) >= least]
    listed = ",".join(s for _, _, s in sorted(found))
    return listed, hashlib.sha256(listed.encode()).hexdigest()
