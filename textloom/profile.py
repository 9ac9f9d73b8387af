"""Script profiles: which characters count, where sentences end, which tokens there are.

All text operators are column builders over a profile, so one implementation serves any
script.  ``DEVA`` keeps Devanagari; ``LATIN`` runs the same algorithms on Latin text.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import cached_property
from itertools import product

#: White space spelled out: Java's, RE2's and Python's classes differ.
WHITE = "\\t-\\r\\x{1c}-\\x{20}\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}"

# Skipped tokens, quality limits, sentence marks, default window.
SKIP_TOKENS = (" ", "।", "?", "!", "\t", "\n", "")
MIN_TOKENS, MAX_TOKENS, MIN_UNIQUE, MAX_UNKNOWN = 5, 80, 3, 0.3
DEFAULT_WINDOW = 4


@dataclass(frozen=True)
class Profile:
    name: str
    letters: str
    """Character class (without brackets) of what cleaning keeps."""
    end_marks: str
    """Sentence ends in cleaned text."""
    raw_end_marks: str
    """Sentence ends in raw text."""
    vocabulary: tuple[str, ...]
    window: int | None = DEFAULT_WINDOW
    skip: tuple[str, ...] = SKIP_TOKENS
    currency: str = ""
    extra: dict[str, str] = field(default_factory=dict, hash=False)

    def __post_init__(self) -> None:
        if self.window is not None and self.window < 1:
            raise ValueError("the token window must be at least 1")

    @cached_property
    def reach(self) -> int:
        longest = max(map(len, self.vocabulary), default=0)
        return longest if self.window is None else self.window

    @cached_property
    def selectable(self) -> tuple[str, ...]:
        return tuple(t for t in self.vocabulary if t not in self.skip)

    @cached_property
    def pattern(self) -> str:
        """Longest-first alternation of the usable tokens, folded into a trie.

        Matching it again and again from the left, skipping what doesn't match, is greedy
        longest-match tokenisation.
        """
        return trie_pattern(t for t in self.vocabulary if t and len(t) <= self.reach)

    def has_letter(self, token: str) -> bool:
        letters = re.sub(r"\\x\{([0-9a-fA-F]+)\}", lambda m: re.escape(chr(int(m[1], 16))), self.letters)
        return bool(re.search(f"[{letters}]", token))

    def tokens(self, text: str) -> list[str]:
        """Driver-side tokenisation of short strings (vocabularies, tests)."""
        return re.findall(self.pattern, text)

    def with_window(self, window: int | None) -> Profile:
        return Profile(self.name, self.letters, self.end_marks, self.raw_end_marks, self.vocabulary, window, self.skip, self.currency)


def trie_pattern(tokens) -> str:
    """A pattern without capturing groups that matches the longest of the tokens at a place.

    Branches of a node begin with different characters, so their order doesn't matter; those
    that go on alike are one character class, which keeps the pattern short and fast.
    """
    root: dict = {}
    for token in tokens:
        node = root
        for ch in token:
            node = node.setdefault(ch, {})
        node[""] = {}

    def build(node: dict) -> str:
        alike: dict[str, list[str]] = {}
        for ch in sorted(k for k in node if k):
            alike.setdefault(build(node[ch]), []).append(re.escape(ch))
        branches = [(chs[0] if len(chs) == 1 else f"[{''.join(chs)}]") + rest for rest, chs in alike.items()]
        if not branches:
            return ""
        body = branches[0] if len(branches) == 1 and "" not in node else f"(?:{'|'.join(branches)})"
        return f"{body}?" if "" in node else body

    return build(root)


def syllables(onsets: tuple[str, ...], signs: tuple[str, ...], alone: tuple[str, ...]) -> tuple[str, ...]:
    """Onset x sign in order, then what stands alone; the first of equal entries stays."""
    return tuple(dict.fromkeys([o + s for o, s in product(onsets, signs)] + list(alone)))


# Consonants and conjuncts, vowel signs, independent vowels, extras, digits, marks.
DEVA_ONSETS = (
    "क", "ख", "ग", "घ", "ङ", "च", "छ", "ज", "झ", "ञ", "ट", "ठ", "ड", "ढ", "ण", "त", "थ", "द", "ध", "न", "प", "फ", "ब", "व", "भ", "म",
    "य", "र", "ल", "व", "श", "ष", "स", "ह", "क्ष", "त्र", "ज्ञ", "त्त", "द्ध", "श्र", "द्य",
)
DEVA_VOWEL_SIGNS = ("ा", "ि", "ी", "ु", "ू", "े", "ै", "ो", "ौ", "ं")
DEVA_HALANT, DEVA_NASAL, DEVA_REPHA = "्", "ँ", "्र"
DEVA_VOWELS = ("अ", "आ", "ई", "इ", "उ", "ऊ", "ए", "ऐ", "ॐ", "ॠ", "ऋ", "ऌ")
DEVA_EXTRAS = (" ", "।", "?", "!")
DEVA_DIGITS = ("०", "१", "२", "३", "४", "५", "६", "७", "८", "९")

LATIN_ONSETS = ("", "b", "c", "d", "f", "g", "h", "j", "k", "l", "m", "n", "p", "q", "r", "s", "t", "v", "w", "x", "z", "ch", "sh", "th", "wh", "st", "tr", "pr", "gr", "br", "cl", "pl")
LATIN_NUCLEI = ("a", "e", "i", "o", "u", "y", "é", "è", "ê", "ä", "ö", "ü", "ó", "í", "á")
LATIN_CODAS = ("", "n", "r", "s", "t", "l")


def devanagari_vocabulary() -> tuple[str, ...]:
    """Every onset bare, halved, nasal or with repha, and with each vowel sign likewise.

    The order is part of the vocabulary, since ids follow it: bare, halved, nasal, repha, and
    with each sign bare and nasal before repha; the halved form stands in its first place only.
    """
    with_sign = [m + v + n for v in DEVA_VOWEL_SIGNS for m in ("", DEVA_REPHA) for n in ("", DEVA_NASAL)]
    bare = ("", DEVA_HALANT, DEVA_NASAL, DEVA_REPHA, DEVA_REPHA + DEVA_NASAL)
    return syllables(DEVA_ONSETS, (*bare, *with_sign), DEVA_VOWELS + DEVA_EXTRAS + DEVA_DIGITS)


def latin_vocabulary() -> tuple[str, ...]:
    rimes = tuple(n + c for n, c in product(LATIN_NUCLEI, LATIN_CODAS))
    letters = tuple("abcdefghijklmnopqrstuvwxyzàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿß")
    return syllables(LATIN_ONSETS, rimes, letters + (" ", ".", "?", "!") + tuple("0123456789"))


DEVA = Profile("deva", "\\x{0900}-\\x{097F}", "।", "।!?", devanagari_vocabulary(), currency="रु")
LATIN = Profile("latin", "a-z\\x{00DF}-\\x{00F6}\\x{00F8}-\\x{00FF}.", ".", ".!?", latin_vocabulary(), skip=(" ", ".", "?", "!", "\t", "\n", ""), currency="$")
