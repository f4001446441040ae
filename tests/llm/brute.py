"""Plain versions of the contracts, a document at a time."""

import hashlib
import math
import re
import zlib
from collections import Counter

import xxhash

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def mod(doc_id, n):
    return None if doc_id is None else zlib.crc32(str(doc_id).encode()) % n


def lm_base(docs):
    """{row: (n_tokens, n_known, train_tokens, base_score)} of (doc_id, text) rows."""
    split = [[*WORD.findall((t or "").translate(LOW)), None] for _, t in docs]
    count = Counter(w for (i, _), ws in zip(docs, split) if mod(i, 7) not in (2, None) for w in ws)
    n, v = sum(count.values()), len(count)
    return [(len(ws), sum(count[w] > 0 for w in ws), n, sum(math.log10((count[w] + 1) / (n + v + 1)) for w in ws)) for ws in split]


def lm_score(docs, mu):
    """{doc_id: log10 probability} of (doc_id, held_out, text) rows: hierarchical Dirichlet smoothing over whole-corpus counts."""
    split = {i: [*WORD.findall((t or "").translate(LOW)), "</s>"] for i, _, t in docs}
    learn = [split[i] for i, h, _ in docs if not h]
    one, two, three = Counter(w for ws in learn for w in ws), Counter(), Counter()
    before2, before3 = Counter(), Counter()
    for ws in learn:
        for a, b, c in zip(["<s>", "<s>", *ws], ["<s>", *ws], ws):
            two[b, c] += 1
            three[a, b, c] += 1
            before2[b] += 1
            before3[a, b] += 1
    n, v = sum(one.values()), len(one)
    out = {}
    for i, ws in split.items():
        total = 0.0
        for a, b, c in zip(["<s>", "<s>", *ws], ["<s>", *ws], ws):
            p = (one[c] + 1) / (n + v + 1)
            p = (two[b, c] + mu[2] * p) / (before2[b] + mu[2])
            total += math.log10((three[a, b, c] + mu[3] * p) / (before3[a, b] + mu[3]))
        out[i] = total
    return out


def quality_base(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    repeated = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    n = len(words)
    return n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(repeated), n < 50 or 100 * len(repeated) > 50 * n


def fingerprint(text):
    words = WORD.findall((text or "").translate(LOW))
    if not words:
        return 0
    grams = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints):
    """Least doc_id reachable of each (doc_id, fingerprint) row; null ids carry links too."""
    distinct = sorted({f for _, f in prints})
    root = {f: f for f in distinct}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(distinct):
        for b in distinct[i + 1 :]:
            if (a ^ b).bit_count() <= 4:
                root[find(a)] = find(b)
    least = {}
    for i, f in prints:
        if i is not None:
            least[find(f)] = min(i, least.get(find(f), i))
    return [least.get(find(f)) for _, f in prints]


def repeats(docs, length=50):
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of (doc_id, text) rows; a null id is larger than all."""
    texts = [(math.inf if i is None else i, (t or "").encode()) for i, t in docs]
    first = {}
    for i, b in texts:
        for k in range(len(b) - length + 1):
            w = b[k : k + length]
            first[w] = min(i, first.get(w, i))
    out = []
    for (i, b), (doc, _) in zip(texts, docs):
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if first[b[k : k + length]] < i:
                gone[k : k + length] = b"\1" * length
        runs = sum(1 for k in range(len(b)) if gone[k] and not (k and gone[k - 1]))
        left = bytes(c for c, g in zip(b, gone) if not g)
        out.append((doc, len(b), sum(gone), runs, hashlib.sha256(left).hexdigest()))
    return out


def contained(docs, items, width=5, least=0.8):
    """(doc_id, item_id, shared, size) of every document row and item row."""
    split = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    out = []
    for item, t in items:
        w = split(t)
        k = min(width, len(w))
        own = {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if k else set()
        for doc, text in docs if own else []:
            d = split(text)
            shared = len(own & {tuple(d[i : i + k]) for i in range(len(d) - k + 1)})
            if shared >= least * len(own) - 1e-9:
                out.append((doc, item, shared, len(own)))
    return out
