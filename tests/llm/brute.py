"""Plain Python versions of the query contracts, for small inputs."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np


def sha(data) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m.group().lower(), text)


def licenses(docs):
    out = {}
    for i, text in docs:
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text or ""))
        places = []
        for phrase, label in (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")):
            p = phrase.split()
            places += [(k, label) for k in range(len(words)) if words[k : k + len(p)] == p]
        at = [k for k, _ in places]
        out[i] = (len(words), len(places), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places})))
    return out


def contained(text, templates, threshold, block):
    """Labels of the templates whose words and names stand, enough of them, within twice the template's length in some window of the text."""
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text or ""))
    half, labels = block // 2, {}
    for label, t, names in templates:
        every = re.findall(r"[0-9a-z]+", t.lower())
        t, span = set(every), min(block, 2 * len(every))
        for s in range(0, max(len(words) - half - 1, 0) + 1, half):
            window = words[s : s + block]
            for k in range(len(window)):
                own = t & set(window[k : k + span])
                if set(names.split()) <= own and len(own) >= threshold * len(t) - 1e-9:
                    labels[label] = max(labels.get(label, 0), len(own) / len(t))
    return labels


def luhn(d: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(d)):
        v = int(c) * (1 + k % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def personal(docs):
    out = {}
    for i, text in docs:
        text, found = text or "", []
        for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
            found.append((m.start(), 0, m.end()))
        for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
            if all(int(p) <= 255 for p in m.group().split(".")):
                found.append((m.start(), 1, m.end()))
        for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
            d = re.sub("[^0-9]", "", m.group())
            if 14 <= len(d) <= 19 and luhn(d):
                found.append((m.start(), 2, m.end()))
        for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
            if 10 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
                found.append((m.start(), 3, m.end()))
        kinds = ["email", "ip", "card", "phone"]
        spans = [f"{kinds[k]}:{s}:{e}" for s, k, e in sorted(found)]
        n = Counter(k for _, k, _ in found)
        out[i] = (*[n[k] for k in range(4)], sha(",".join(spans)), spans)
    return out


def shingles(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[k : k + width]) for k in range(max(1, len(words) - width + 1)))


def near(docs, width, share):
    """doc_id -> (set size, smallest id reachable); ids distinct."""
    sets = {i: shingles(t, width) for i, t in docs}
    holders = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    both = Counter()
    for ids in holders.values():
        both.update((a, b) for k, a in enumerate(ids) for b in ids[k + 1 :])
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x] = root[root[x]]
        return x

    for (a, b), n in both.items():
        if 100 * n >= share * (len(sets[a]) + len(sets[b]) - n):
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def pieces(docs, tokenizer, capacity=2048):
    out = {}
    for i, text in docs:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        for k in range(0, len(ids), capacity):
            part = ids[k : k + capacity]
            out[(i, k // capacity)] = (k, len(part), zlib.crc32(part.tobytes()))
    return out


def round_trip(docs, tokenizer):
    out = {}
    for i, text in docs:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        out[i] = (len(ids), sha(np.array(ids, "<u4").tobytes()), sha(tokenizer.decode(ids, skip_special_tokens=False)))
    return out


def auc(score, label):
    order = np.argsort(score, kind="stable")
    values, inverse, n = np.unique(np.asarray(score)[order], return_inverse=True, return_counts=True)
    ranks = (np.cumsum(n) - (n - 1) / 2)[inverse]
    y = np.asarray(label)[order]
    return (ranks[y == 1].sum() - (y == 1).sum() * ((y == 1).sum() + 1) / 2) / ((y == 1).sum() * (y == 0).sum())


def base_secrets(text):
    """Sorted (start, order of the kind, end) of the base patterns."""
    found = []
    for m in re.finditer(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m.group(2)) >= 6:
            found.append((m.start(), 0, m.end()))
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 24]
    return sorted(found)


def secret_spans(text, generators, kinds, roles, reach, least_kinds, blank_line):
    """All reported spans by comparing every part of a scope with every other one."""
    base, weak = base_secrets(text), []
    for name, kind, pattern, _, group in generators[3:]:
        for m in re.finditer(pattern, text):
            v = m.group(group)
            if name == "opaque" and not (re.search("[0-9]", v) and re.search("[A-Z]", v) and re.search("[a-z]", v) and len(set(v)) >= least_kinds and 6 * v.count("/") <= len(v)):
                continue
            if not any(s < m.end() and m.start() < e for s, _, e in base):
                weak.append((m.start(), kinds.index(kind), m.end()))
    inside = lambda s, o: o != s and o[0] <= s[0] and s[2] <= o[2] and ((o[0], o[2]) != (s[0], s[2]) or o[1] < s[1])
    spans = sorted(set(base + [s for s in set(weak) if not any(inside(s, o) for o in weak)]))
    scope = {s: len(re.findall(blank_line, text[: s[0]])) for s in spans}
    role = lambda s: roles[kinds[s[1]]]

    def meets(s, wanted):
        return any(o != s and scope[o] == scope[s] and max(o[0] - s[2], s[0] - o[2], 0) <= reach and wanted(o) for o in spans)

    out = []
    for s in spans:
        has = {r: meets(s, lambda o, r=r: role(o) == r) for r in ("identifier", "secret", "endpoint")}
        strong = meets(s, lambda o: o[1] < 3)
        good = {"secret": has["identifier"] or has["endpoint"], "identifier": has["secret"], "endpoint": has["secret"] and (has["identifier"] or strong)}[role(s)]
        if s[1] < 3 or good:
            out.append(s)
    return ",".join(f"{kinds[k]}:{a}:{b}" for a, k, b in out)


def trie(rows):
    """Nodes of rebuilt conversations (conv_id, turn, role, text) by walking an actual trie."""
    own = defaultdict(list)
    for c, t, r, x in sorted((x for x in rows if x[0] is not None), key=lambda x: (x[0], x[1] is not None, x[1] or 0)):
        own[c].append((r or "", x or ""))
    built = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        donor = c - int(np.fmod(c, 100))
        built[c] = tuple(own.get(donor, [])[:h] + own[c][h:])
    return trie_of(built)


def trie_of(built):
    members = defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    children = Counter(n[:-1] for n in members if n)
    below = {n: [0, 0] for n in members}
    for n, cs in members.items():
        for d in range(len(n) + 1):
            below[n[:d]][0] += n not in children
            below[n[:d]][1] += (len(cs) - 1) * (len(n[-1][1]) if n else 0)
    out = []
    for n, cs in members.items():
        ends = ",".join(str(c) for c in sorted(cs) if len(built[c]) == len(n))
        out.append((min(cs), len(n), min(members[n[:-1]]) if n else None, len(cs), children[n], *below[n], sha(ends)))
    return sorted(out, key=str)


def whitening(rows, k=8):
    """(ids, n, deviations, whitened up to sign, explained) of rows (id, vector or None) of one length."""
    fine = [(i, v) for i, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    x = np.array([[int(np.floor(1024 * float(c))) + 100000 for c in v] for _, v in fine], object)
    n, sums = len(x), x.sum(axis=0)
    d = (x * n - sums)
    c = np.array(d / n, float)
    e, v = np.linalg.eigh(c.T @ c / n)
    e, v = e[::-1], v[:, ::-1]
    return [i for i, _ in fine], n, [int(s) for s in (d * d).sum(axis=1)], (c @ v[:, :k]) / np.sqrt(e[:k]), e[:k] / e.sum()
