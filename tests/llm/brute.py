"""Plain versions of what the operators compute."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import xxhash

_MASK = (1 << 64) - 1


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def base_counts(text: str | None) -> tuple[int, int, int, int, int]:
    own = words(text)
    lines = [x for x in (text or "").split("\n") if words(x)]
    threes = [tuple(own[i : i + 3]) for i in range(len(own) - 2)]
    counts = Counter(threes)
    repeated = {i + d for i, t in enumerate(threes) if counts[t] > 1 for d in range(3)}
    return (
        len(own),
        sum(map(len, own)),
        len(re.findall("[#*$%&|<>]", text or "")),
        len(lines) - len(set(lines)),
        len(repeated),
    )


def _spark_hash(*values: str) -> int:
    seed = 42
    for value in values:
        seed = xxhash.xxh64_intdigest(value.encode(), seed)
    return seed - (1 << 64) if seed >> 63 else seed


def grams(text: str | None, buckets: int) -> list[int]:
    own = words(text)
    pairs = zip(own, own[1:], strict=False)
    return [_spark_hash(w) % buckets for w in own] + [_spark_hash(*p) % buckets for p in pairs]


def mean_ratios(docs: dict[int, str | None], trusted: set[int], buckets: int) -> dict[int, float]:
    raw, target = Counter(), Counter()
    for k, text in docs.items():
        own = grams(text, buckets)
        raw.update(own)
        if k in trusted:
            target.update(own)
    raw_sum, target_sum = raw.total() + buckets, target.total() + buckets
    ratio = [
        round(1e6 * (math.log((target[b] + 1) / target_sum) - math.log((raw[b] + 1) / raw_sum)))
        for b in range(buckets)
    ]
    return {k: sum(ratio[b] for b in g) / len(g) / 1e6 for k, t in docs.items() if (g := grams(t, buckets))}


def left_out_ratio(docs: dict[int, str | None], trusted: set[int], k: int, buckets: int) -> float:
    """The mean ratio of document k under a target of all other trusted documents."""
    raw, target = Counter(), Counter()
    for i, text in docs.items():
        own = grams(text, buckets)
        raw.update(own)
        if i in trusted and i != k:
            target.update(own)
    raw_sum, target_sum = raw.total() + buckets, target.total() + buckets
    own = grams(docs[k], buckets)
    ratios = (math.log((target[b] + 1) / target_sum) - math.log((raw[b] + 1) / raw_sum) for b in own)
    return sum(ratios) / len(own)


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def shingles(text: str | None) -> list[tuple[str, ...]]:
    own = words(text)
    size = min(5, len(own))
    return [tuple(own[i : i + size]) for i in range(len(own) - size + 1)] if own else []


def longest_common(a: list, b: list) -> int:
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[-1]))
        row = new
    return row[-1]


def near_classes(docs: dict[int, str | None], least: float = 0.8) -> dict[int, int]:
    """Smallest id of each component; all pairs that share a shingle."""
    label = {k: k for k in docs}

    def find(x: int) -> int:
        while label[x] != x:
            x = label[x]
        return x

    own = {k: shingles(t) for k, t in docs.items()}
    sets = {k: Counter(s) for k, s in own.items()}
    ids = sorted(docs)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if (docs[a] or "") == (docs[b] or ""):
                linked = True
            else:
                total = len(own[a]) + len(own[b])
                most = (sets[a] & sets[b]).total()
                if not total or most < least * (total - most):
                    continue
                common = longest_common(own[a], own[b])
                linked = common >= least * (total - common) - 1e-9
            if linked:
                x, y = find(a), find(b)
                label[max(x, y)] = min(x, y)
    return {k: find(k) for k in ids}


def repeated_words(docs: dict[int, str | None], size: int) -> dict[int, set[int]]:
    """Words that stand in a passage of `size` words found in two places or more."""
    places: dict[tuple, list] = {}
    for k, text in docs.items():
        own = words(text)
        for i in range(len(own) - size + 1):
            places.setdefault(tuple(own[i : i + size]), []).append((k, i))
    found: dict[int, set[int]] = {}
    for at in places.values():
        if len(at) > 1:
            for k, i in at:
                found.setdefault(k, set()).update(range(i, i + size))
    return found
