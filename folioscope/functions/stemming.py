"""The Porter stemmer, after the published algorithm (M. F. Porter, 1980), as rule tables."""

from __future__ import annotations

import re
from functools import lru_cache

_VOWEL = "aeiou"
# Suffix rules of steps 2, 3 and 4 of the algorithm. Fixed values.
_STEP2 = [
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"), ("bli", "ble"),
    ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"), ("ization", "ize"), ("ation", "ate"),
    ("ator", "ate"), ("alism", "al"), ("iveness", "ive"), ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"),
    ("iviti", "ive"), ("biliti", "ble"), ("logi", "log"),
]
_STEP3 = [("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"), ("ful", ""), ("ness", "")]
_STEP4 = [
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou", "ism", "ate", "iti",
    "ous", "ive", "ize",
]


def _shape(word: str) -> str:
    """One letter per character: v for vowels (y after a consonant counts), c for consonants."""
    out = ""
    for i, ch in enumerate(word):
        out += "v" if ch in _VOWEL or ch == "y" and i > 0 and out[-1] == "c" else "c"
    return out


def _measure(word: str) -> int:
    return len(re.findall("v+c+", _shape(word)))


def _short(word: str) -> bool:
    """Ends consonant-vowel-consonant, the last not w, x or y."""
    return _shape(word).endswith("cvc") and word[-1] not in "wxy"


def _swap(word: str, rules: list[tuple[str, str]], least: int) -> str:
    for suffix, new in sorted(rules, key=lambda r: -len(r[0])):
        if word.endswith(suffix):
            head = word[: -len(suffix)]
            return head + new if _measure(head) >= least else word
    return word


@lru_cache(maxsize=100_000)
def porter(word: str) -> str:
    if len(word) <= 2:
        return word
    if word.endswith("s"):
        if word.endswith(("sses", "ies")):
            word = word[:-2]
        elif not word.endswith("ss"):
            word = word[:-1]
    if word.endswith("eed"):
        if _measure(word[:-3]) > 0:
            word = word[:-1]
    else:
        for suffix in ("ed", "ing"):
            head = word[: -len(suffix)]
            if word.endswith(suffix) and "v" in _shape(head):
                word = head
                if word.endswith(("at", "bl", "iz")):
                    word += "e"
                elif len(word) > 1 and word[-1] == word[-2] and _shape(word)[-1] == "c" and word[-1] not in "lsz":
                    word = word[:-1]
                elif _measure(word) == 1 and _short(word):
                    word += "e"
                break
    if word.endswith("y") and "v" in _shape(word[:-1]):
        word = word[:-1] + "i"
    word = _swap(word, _STEP2, 1)
    word = _swap(word, _STEP3, 1)
    for suffix in sorted(_STEP4, key=len, reverse=True):
        if word.endswith(suffix):
            head = word[: -len(suffix)]
            if _measure(head) > 1 and (suffix != "ion" or head.endswith(("s", "t"))):
                word = head
            break
    if word.endswith("e"):
        m = _measure(word[:-1])
        if m > 1 or m == 1 and not _short(word[:-1]):
            word = word[:-1]
    if word.endswith("ll") and _measure(word) > 1:
        word = word[:-1]
    return word
