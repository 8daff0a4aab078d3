"""Plain versions of the operators for small inputs."""

import hashlib
import re


def bytes_left(docs, width):
    """{doc_id: (n_bytes, n_removed, n_spans, sha256)} for [(doc_id, text)]."""
    first = {}
    for doc, text in docs:
        data = (text or "").encode()
        for i in range(len(data) - width + 1):
            w = data[i : i + width]
            if doc is not None:
                first[w] = min(first.get(w, doc), doc)
    out = []
    for doc, text in docs:
        data = (text or "").encode()
        gone = [False] * len(data)
        for i in range(len(data) - width + 1):
            if doc is not None and first[data[i : i + width]] < doc:
                gone[i : i + width] = [True] * width
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        kept = bytes(b for b, g in zip(data, gone) if not g)
        out.append((doc, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def words_left(docs, width):
    """[(doc_id, n_words, n_removed, sha256)] for [(doc_id, text)]."""
    split = [(d, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t in docs]
    first = {}
    for doc, words in split:
        for i in range(len(words) - width + 1):
            w = tuple(words[i : i + width])
            if doc is not None:
                first[w] = min(first.get(w, doc), doc)
    out = []
    for doc, words in split:
        gone = [False] * len(words)
        for i in range(len(words) - width + 1):
            if doc is not None and first[tuple(words[i : i + width])] < doc:
                gone[i : i + width] = [True] * width
        kept = " ".join(w for w, g in zip(words, gone) if not g)
        out.append((doc, len(words), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def near_classes(docs, similarity=0.8, k=5):
    """{doc_id: lowest doc_id of its class} for [(doc_id, text)] with distinct ids, by all pairs."""
    elements, root = {}, {}
    for doc, text in docs:
        if doc is None:
            continue
        root[doc] = doc
        if text is None:
            elements[doc] = None
            continue
        words = re.findall("[0-9a-z\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
        seen, out = {}, []
        for i in range(max(1, len(words) - k + 1) if words else 0):
            s = tuple(words[i : i + k])
            out.append((s, seen.get(s, 0)))
            seen[s] = seen.get(s, 0) + 1
        elements[doc] = out or [text]

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    def aligned(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            before = 0
            for j, y in enumerate(b):
                above = row[j + 1]
                row[j + 1] = before + 1 if x == y else max(above, row[j])
                before = above
        return row[-1]

    ids = sorted(elements)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            x, y = elements[a], elements[b]
            if x is None or y is None or find(a) == find(b):
                continue
            n = len(x) + len(y)
            if len(set(x) & set(y)) < similarity / (1 + similarity) * n - 1e-9:
                continue
            m = len(x) if x == y else aligned(x, y)
            if m >= similarity * (n - m) - 1e-9:
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {d: find(d) for d in ids}
