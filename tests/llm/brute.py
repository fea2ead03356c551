"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import xxhash

BLANK = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return BLANK.findall(text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def base_counts(text):
    text = text or ""
    w = words(text)
    lines = [x for x in text.split("\n") if words(x)]
    windows = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    often = Counter(windows)
    covered = {i + k for i, x in enumerate(windows) if often[x] > 1 for k in range(5)}
    return {
        "n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered),
        "base_failed": len(w) < 10 or 100 * len(covered) > 20 * len(w),
    }


def passages(text, seen, least=10):
    """Places of the lines that go: runs of pairs of neighbouring lines with words that are ``seen(pair, number)``, of ``least`` words."""
    lines = text.split("\n")
    at = [k for k, x in enumerate(lines) if words(x)]
    pairs = [(lines[a], lines[b]) for a, b in zip(at, at[1:])]
    hits, gone = [k for k, p in enumerate(pairs) if seen(p, k)], set()
    runs = []
    for k in hits:
        if runs and k - runs[-1][-1] <= 2:
            runs[-1].append(k)
        else:
            runs.append([k])
    for run in runs:
        covered = at[run[0] : run[-1] + 2]
        if sum(len(words(lines[k])) for k in covered) >= least:
            gone |= set(range(covered[0], covered[-1] + 1))
    return gone


def line_dedup(rows, mean=1):
    """Texts of ``(id, text)`` rows; ids are distinct."""
    def chosen(pair):
        a, b = (int(hashlib.md5(x.encode()).hexdigest()[:7], 16) for x in pair)
        return (b * 1_000_003 + a) % 2_147_483_647 % mean == 0

    holder = {}
    for i, text in sorted(rows):
        own = [x for x in (text or "").split("\n") if words(x)]
        for p in zip(own, own[1:]):
            holder.setdefault(p, i)
    out = {}
    for i, text in rows:
        if text is None:
            out[i] = None
            continue
        place = {}

        def seen(pair, k):
            if not chosen(pair):
                return False
            first = place.setdefault(pair, k)  # noqa: B023
            return holder[pair] < i or k >= first + 2  # noqa: B023

        gone = passages(text, seen)
        out[i] = "\n".join(x for k, x in enumerate(text.split("\n")) if k not in gone)
    return out


def shared_runs(rows, least=50):
    """Lines of runs of two or more neighbouring lines with over ``least`` words that a document with a smaller id, no exact copy,
    holds too: (id, lines of the run)."""
    seen, texts, found = {}, set(), []
    for i, text in sorted(rows):
        if text is None or text in texts:
            continue
        texts.add(text)
        lines = text.split("\n")
        pairs = list(zip(lines, lines[1:]))
        hit = [seen.get(p, i) < i for p in pairs]
        k = 0
        while k < len(pairs):
            if not hit[k]:
                k += 1
                continue
            end = k
            while end + 1 < len(pairs) and hit[end + 1]:
                end += 1
            run = lines[k : end + 2]
            if sum(map(bool, map(words, run))) > 1 and sum(len(words(x)) for x in run) > least:
                found.append((i, run))
            k = end + 1
        for p in pairs:
            seen.setdefault(p, i)
    return found


def fingerprint(text):
    w = [x.encode() for x in words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))]
    shingles = [b" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) > 2 else [b" ".join(w)] if w else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints, bits=3):
    """Smallest reachable id per ``(id, print)``."""
    ids = defaultdict(list)
    for i, p in prints:
        ids[p].append(i)
    nodes = list(ids)
    root = {p: p for p in nodes}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for k, a in enumerate(nodes):
        for b in nodes[:k]:
            if (a ^ b).bit_count() <= bits:
                root[find(a)] = find(b)
    least = defaultdict(list)
    for p in nodes:
        least[find(p)] += ids[p]
    return {(i, p): min(least[find(p)]) for i, p in prints}


LICENSE_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def license_words(text):
    return LICENSE_WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def license_scan(text, templates, threshold=0.8, block_lines=3):
    phrases = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))
    w = license_words(text)
    places, base = [], set()
    for phrase, label in phrases:
        p = phrase.split()
        at = [i for i in range(len(w)) if w[i : i + len(p)] == p]
        places += at
        base |= {label} if at else set()
    found, best = set(), 0.0
    lines = (text or "").split("\n")
    for i in range(len(lines)):
        block = {x for line in lines[i : i + block_lines] for x in license_words(line)}
        for label, template in templates:
            t = set(license_words(template))
            if len(t & block) >= threshold * len(t) - 1e-9:
                found.add(label)
                best = max(best, len(t & block) / len(t))
    for label, template in templates:
        t = set(license_words(template))
        width = math.ceil(len(license_words(template)) / threshold - 1e-9)
        for i in range(len(w)):
            share = len(t & set(w[i : i + width])) / len(t)
            if share >= threshold - 1e-9:
                found.add(label)
                best = max(best, share)
    return {
        "n_words": len(w), "n_base": len(places), "first_word": min(places, default=None),
        "last_word": max(places, default=None), "base_labels": ",".join(sorted(base)),
        "labels": ",".join(sorted(base | found)), "score": 1.0 if places else best,
    }


def substring_dedup(rows, window=50):
    """Per id the kept words of ``(id, text)`` rows; ids are distinct."""
    first = {}
    split = {i: words(t) for i, t in rows}
    for i in sorted(split):
        w = split[i]
        for k in range(len(w) - window + 1):
            first.setdefault(tuple(w[k : k + window]), i)
    out = {}
    for i, w in split.items():
        gone = {
            k + d for k in range(len(w) - window + 1) if first[tuple(w[k : k + window])] < i for d in range(window)
        }
        out[i] = [x for k, x in enumerate(w) if k not in gone]
    return out


def tiling(item, text, least):
    """Lengths of greedy tiles: again and again the longest match of unmarked words, the first one in the item and then in the text."""
    item, text, out = list(item), list(text), []
    while True:
        best = (0, 0, 0)
        lengths = [0] * (len(text) + 1)
        for p in range(len(item) - 1, -1, -1):
            lengths = [
                lengths[t + 1] + 1 if item[p] == text[t] and item[p] > 0 and text[t] > 0 else 0 for t in range(len(text))
            ] + [0]
            longest = max(lengths)
            if longest >= best[0] and longest:
                best = (longest, p, lengths.index(longest))
        n, p, t = best
        if n < least:
            return out
        out.append(n)
        item[p : p + n], text[t : t + n] = [-1] * n, [-2] * n


def crc(text):
    return zlib.crc32((text or "").encode())
