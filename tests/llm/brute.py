"""Plain-Python versions of the contracts, to hold the operators against on small tables."""

import hashlib
import re
import zlib
from functools import cache

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)


@cache
def tokenizer():
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return library


def ids_crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def base_spans(text):
    text = text or ""
    found = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return [(kind, start, end) for start, _, end, kind in sorted(found)]


def spelled(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def url_parts(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match("[^/?#]*", rest)[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), re.match("[^?#]*", rest[len(host):])[0]


def judge(url, rules):
    host, path = url_parts(url)
    fits = [(len(h + p), v == "block", h + p, v) for h, p, v in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[2], best[3] if best else "allow"


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def words(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower(text or ""))


def decontaminate(docs, items):
    """Per document: words, hit words, items."""
    windows = {}
    for item, text in items:
        own = words(text)
        size = min(13, len(own))
        for i in range(len(own) - size + 1 if own else 0):
            windows.setdefault(tuple(own[i : i + size]), set()).add(item)
    sizes = {len(w) for w in windows}
    out = []
    for text in docs:
        own, hit, found = words(text), set(), set()
        for size in sizes:
            for i in range(len(own) - size + 1):
                if (owners := windows.get(tuple(own[i : i + size]))) is not None:
                    hit |= set(range(i, i + size))
                    found |= owners
        out.append((len(own), len(hit), {x for x in found if x is not None}))
    return out


def shingles(text):
    own = re.findall("[^\x20\x09-\x0d]+", lower(text or ""))
    if not own:
        return frozenset()
    if len(own) < 5:
        return frozenset([tuple(own)])
    return frozenset(tuple(own[i : i + 5]) for i in range(len(own) - 4))


def components(nodes, links):
    """Smallest node reachable from each node."""
    parent = {x: x for x in nodes}

    def root(x):
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {x: root(x) for x in nodes}


def jaccard_links(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    lists = {}
    for n, (_, s) in enumerate(sets):
        for g in s:
            lists.setdefault(g, []).append(n)
    shared = {}
    for owners in lists.values():
        for x in range(len(owners)):
            for y in range(x):
                shared[owners[y], owners[x]] = shared.get((owners[y], owners[x]), 0) + 1
    return [(sets[a][0], sets[b][0]) for (a, b), n in shared.items()
            if 100 * n >= 80 * (len(sets[a][1]) + len(sets[b][1]) - n)]


def cosine_links(rows):
    good = [(i, np.array(v, float), label) for i, v, label in rows
            if v is not None and label is not None and all(x is not None and np.isfinite(x) for x in v) and np.any(np.array(v, float))]
    links = []
    for a in range(len(good)):
        for b in range(a):
            if good[a][2] == good[b][2] and len(good[a][1]) == len(good[b][1]):
                x, y = good[a][1], good[b][1]
                if x @ y / np.sqrt(x @ x) / np.sqrt(y @ y) >= 0.93:
                    links.append((good[b][0], good[a][0]))
    return links
