"""Term counts of a text's shape: how characters of different classes follow each other, and how much repeats."""

from __future__ import annotations

from collections import Counter

import numpy as np

#: Character classes by byte; letters above 127 count as lower case, which their bytes cannot tell.
CLASSES = ("a", "A", "0", " ", "\n", ".", ",", "!?", "|/\\", "*#$%&@^~", "-_=+<>", "\"'`()[]{}:;")
REPEATS = 12
LENGTHS = 16
SHARES = 16


def _class_table() -> np.ndarray:
    table = np.full(256, len(CLASSES) - 1, dtype=np.int64)
    for number, letters in enumerate(CLASSES):
        for letter in letters:
            table[ord(letter)] = number
    table[[*range(ord("a"), ord("z") + 1), *range(128, 256)]] = 0
    table[ord("A") : ord("Z") + 1] = 1
    table[ord("0") : ord("9") + 1] = 2
    table[[9, 13, 11, 12]] = 3
    return table


TABLE = _class_table()
TRIGRAMS = len(CLASSES) ** 3
TERMS = TRIGRAMS + REPEATS + LENGTHS + 2 * SHARES + 2


def shape_terms(text: str) -> np.ndarray:
    """Weights of all terms, each group with the root of its share, so a text of any length gets a comparable vector.

    The groups: trigrams of character classes (runs of one class beyond two collapsed), how often the words of the text occur in it,
    word lengths, the share of different words and of different word pairs, and of words that follow themselves.  An empty
    text has no terms.
    """
    out = np.zeros(TERMS, dtype=np.float32)
    data = np.frombuffer(text.encode("utf-8", "replace"), dtype=np.uint8)
    if not len(data):
        return out
    classes = TABLE[data]
    # At most two of a run stay: enough to tell one letter from a word.
    again = classes[1:] == classes[:-1]
    keep = np.ones(len(classes), dtype=bool)
    keep[2:] = ~(again[1:] & again[:-1])
    classes = classes[keep]
    if len(classes) >= 3:
        codes = (classes[:-2] * len(CLASSES) + classes[1:-1]) * len(CLASSES) + classes[2:]
        counts = np.bincount(codes, minlength=TRIGRAMS)
        out[:TRIGRAMS] = np.sqrt(counts / len(codes))
    words = text.split()
    if not words:
        return out
    at = TRIGRAMS
    tally = Counter(words)
    counts = np.fromiter(tally.values(), np.int64, len(tally))
    # Relative to the text's length: a word of a long text occurs more often.
    excess = np.log2(counts) - 0.5 * np.log2(len(words)) + 5
    out[at : at + REPEATS] = np.sqrt(np.bincount(np.clip(excess, 0, REPEATS - 1).astype(int), weights=counts, minlength=REPEATS) / len(words))
    at += REPEATS
    lengths = np.minimum(np.fromiter(map(len, words), np.int64, len(words)), LENGTHS) - 1
    out[at : at + LENGTHS] = np.sqrt(np.bincount(lengths, minlength=LENGTHS) / len(words))
    at += LENGTHS
    pairs = max(1, len(words) - 1)
    out[at + min(SHARES - 1, int(SHARES * len(tally) / len(words)))] = 1
    at += SHARES
    out[at + min(SHARES - 1, int(SHARES * len(set(zip(words, words[1:], strict=False))) / pairs))] = 1
    at += SHARES
    out[at] = np.sqrt(sum(a == b for a, b in zip(words, words[1:], strict=False)) / pairs)
    out[at + 1] = np.sqrt(tally.most_common(1)[0][1] / len(words))
    return out
