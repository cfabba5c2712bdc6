"""Plain, single-process versions of what the operators compute."""

import collections
import re

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LOWERED = str.maketrans(UPPER, LOWER)

#: Texts that operators must get through: (doc_id, text).
ODD = [
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, "one"),
    (None, "a null id and ten words or so of text in it here"),
    (None, None),
    (5, "long " * 40_000 + "end"),
    (6, "x" * 200_000),
    (7, "repeated row with its own ten words that stand here twice"),
    (7, "repeated row with its own ten words that stand here twice"),
    (8, "same id, first text of some length, with a few more words"),
    (8, "same id, second text of some length, with other words in"),
    (9, "Ünïcödé, 日本語 text with odd blanks\x0b\x0c and \x1c controls é́"),
]


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWERED))
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def groups(sets, threshold=0.75):
    """For each set of a list the smallest index reachable by links."""
    parent = list(range(len(sets)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    holders = collections.defaultdict(list)
    for k, own in enumerate(sets):
        common = collections.Counter(j for s in own for j in holders[s])
        for j, n in common.items():
            if n >= threshold * (len(own) + len(sets[j]) - n):
                a, b = sorted((root(j), root(k)))
                parent[b] = a
        for s in own:
            holders[s].append(k)
    return [root(k) for k in range(len(sets))]


def alnum_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWERED))


def hit_words(text, items):
    """(words, covered words, items found) of a document against (item_id, text)."""
    words, covered, found = alnum_words(text), set(), set()
    for name, item in items:
        own = alnum_words(item)
        size = min(10, len(own))
        windows = {tuple(own[i : i + size]) for i in range(len(own) - size + 1)} if own else set()
        for i in range(len(words) - size + 1) if windows else ():
            if tuple(words[i : i + size]) in windows:
                covered.update(range(i, i + size))
                found.add(name)
    return len(words), len(covered), found
