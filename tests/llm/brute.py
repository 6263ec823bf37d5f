"""Plain Python versions of what the operators compute, and rows that are hard to handle."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import xxhash

ASCII_WORDS = re.compile(r"[^\x20\x09-\x0D]+")
FOLDED_WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}

LONG = " ".join(f"word{i % 977}" for i in range(60_000))
ODD_TEXTS = [None, "", " ", "\n\n\n", "é", "a b", "Same text here", "Same text here", "x" * 50_000, LONG]


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def words(text):
    return ASCII_WORDS.findall(text or "")


def folded_words(text):
    return FOLDED_WORDS.findall((text or "").translate(LOWER))


def components(nodes, links):
    """node -> smallest node reachable."""
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    return {n: root(n) for n in nodes}


def simhash(text, shingle=3):
    w = [x.translate(LOWER) for x in words(text)]
    if not w:
        return 0
    runs = [w[i : i + shingle] for i in range(len(w) - shingle + 1)] or [w]
    hashes = [xxhash.xxh64_intdigest(" ".join(run).encode(), 42) for run in runs]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def simhash_groups(docs, most=2):
    """doc_id -> (fingerprint, component)."""
    marks = {d: simhash(t) for d, t in docs}
    ids = sorted(marks)
    links = [(a, b) for i, a in enumerate(ids) for b in ids[i + 1 :] if bin(marks[a] ^ marks[b]).count("1") <= most]
    groups = components(ids, links)
    return {d: (marks[d], groups[d]) for d in ids}


def contamination(text, items, window=13):
    """(n_words, hit word positions, items that occur)."""
    w, hit, found = folded_words(text), set(), set()
    for item, item_text in items:
        grams = folded_words(item_text)
        size = min(window, len(grams))
        if not size:
            continue
        wanted = {tuple(grams[i : i + size]) for i in range(len(grams) - size + 1)}
        for i in range(len(w) - size + 1):
            if tuple(w[i : i + size]) in wanted:
                hit |= set(range(i, i + size))
                found.add(str(item))
    return len(w), hit, found


def repeated(sequences, size):
    """doc -> positions covered by a run of `size` that also starts earlier; docs in order."""
    seen, gone = set(), {}
    for doc, sequence in sequences:
        gone[doc] = set()
        for i in range(len(sequence) - size + 1):
            run = tuple(sequence[i : i + size])
            if run in seen:
                gone[doc] |= set(range(i, i + size))
            seen.add(run)
    return gone


def repeated_lines(docs, run=3, words=20):
    """doc -> positions of lines in a run of `run` lines, or of fewer with so many words, that also starts earlier."""
    gone = repeated(docs, run)
    for size in range(1, run):
        seen = set()
        for doc, lines in docs:
            for i in range(len(lines) - size + 1):
                part = tuple(lines[i : i + size])
                if len(ASCII_WORDS.findall(" ".join(part))) >= words:
                    if part in seen:
                        gone[doc] |= set(range(i, i + size))
                    seen.add(part)
    return gone


def secrets(text):
    """Spans by the three patterns, sorted by start and kind."""
    assign = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    text = text or ""
    spans = [(m.start(), 0, m.end()) for m in re.finditer(assign, text, re.I | re.A) if len(m[2]) >= 8]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return [f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in sorted(spans)]


def merkle(rows, fan=8):
    """rows (doc_id, source, lang, n_chars, text), changed texts by place -> the manifest of each row."""

    def leaf(values):
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))

    def tree(digests):
        levels = [digests]
        while len(levels[-1]) > 1:
            level = levels[-1]
            levels.append([sha("".join(level[i : i + fan])) for i in range(0, len(level), fan)])
        return levels

    def siblings(levels, at):
        for level in levels[:-1]:
            run = level[at - at % fan :][:fan]
            yield "".join(run[: at % fan]), "".join(run[at % fan + 1 :])
            at //= fan

    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append(row)
    for own in groups.values():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: tree([leaf(r) for r in groups[g]]) for g in names}
    upper = tree([trees[g][-1][0] for g in names])
    out = []
    for place, g in enumerate(names):
        for at, row in enumerate(groups[g]):
            proof = [*siblings(trees[g], at), *siblings(upper, place)]
            tampered = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0 and row[4] is not None
            folded = leaf([*row[:4], row[4].translate(LOWER)]) if tampered else leaf(row)
            for before, after in proof:
                folded = sha(before + folded + after)
            root = upper[-1][0]
            proof_sha = sha("".join(b + a for b, a in proof))
            out.append((row[0], leaf(row), trees[g][-1][0], root, proof_sha, folded, folded == root))
    return out


def collocations(rows, longest=5, least=100, top=2000, absorb=100):
    """rows (lang, text) -> (lang, rank, phrase, a, l, r, n, score)."""
    counts, totals = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            w = re.findall("[^ \t]+", piece)
            totals[lang] += len(w)
            for i in range(len(w)):
                counts[lang].update(tuple(w[i:j]) for j in range(i + 1, min(len(w), i + longest) + 1))
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        gone = {
            p[i:j]
            for p, a in candidates.items()
            for i in range(len(p))
            for j in range(i + 2, len(p) + 1)
            if j - i < len(p) and 100 * a >= absorb * f[p[i:j]]
        }
        scored = []
        for p, a in candidates.items():
            if p not in gone:
                cuts = [(1000 * a * totals[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p))]
                score, k = min(cuts)
                scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return out
