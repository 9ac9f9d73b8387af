"""Texts to ids by the tokenizers library, each distinct chunk encoded once a worker.

Both vocabularies in use cut a text at white space before they merge, so a text may be
encoded chunk by chunk: the ids of the whole are those of its chunks in a row.  Chunks are
kept in a bounded table as raw little-endian ids, which a join of bytes puts together.

``lower``: white space is dropped; chunks are split off at spaces and line feeds, and marks
that close a word are parted from it, as the tokenizer's own pattern does; the library sees
all other characters.  ``bytes``: white space leads the word after it; chunks are runs of
white space with the run of other characters that follows, where white space is Unicode's
White_Space, and closing marks and a lone line feed before a word are chunks themselves.

Which of the two holds is read from the file (``_kind``); with any other normaliser or
pre-tokenizer a text is a chunk as a whole.  Null texts are empty and have no ids.
"""

from __future__ import annotations

import json
import os
import re
from array import array

import numpy as np

WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff"
_MARKS = ".,;:!?"
#: A lone line feed before a letter; a word up to its closing marks; else white space and what follows.
#: Possessive, since a shorter run of the same characters never lets the rest match.
_CHUNK = re.compile(f"\\n(?=[{LETTERS}])|[{WHITE}]*+(?:[{LETTERS}]++(?=[{_MARKS}]++(?:[{WHITE}]|$))|[^{WHITE}]++)|[{WHITE}]++")
#: Marks that close a word of unaccented letters: parted from it, they stay the pieces they were.
_CLOSING = re.compile(f"(?<=[A-Za-z])([{_MARKS}]+)(?=[ \\n]|$)")
KEEP, LONGEST = 800_000, 64
#: Texts and new words that are handled at once: few, so that they stay in a core's cache.
BATCH, JOINED = 16, 250
_open: dict[str, "Encoder"] = {}
# The word pattern of the ``lower`` vocabulary.
_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def _kind(spec: dict) -> str:
    """``lower`` or ``bytes`` if texts may be cut at white space as described above, else ``whole``."""
    pre, norm = spec.get("pre_tokenizer") or {}, spec.get("normalizer")
    level = {"type": "ByteLevel", "add_prefix_space": False}
    plain = [t for t in spec.get("added_tokens", []) if not t.get("special")]
    if plain or spec.get("truncation") or spec["model"]["type"] != "BPE" or spec["model"].get("dropout"):
        return "whole"
    if norm is None and pre.items() >= (level | {"use_regex": True}).items():
        return "bytes"
    steps = pre.get("pretokenizers", [{}])
    cuts = {"type": "Split", "pattern": {"Regex": _WORDS}, "behavior": "Removed", "invert": True}
    lowers = [n["type"] for n in (norm or {}).get("normalizers", [])] == ["NFC", "Replace", "Lowercase"]
    spaces = lowers and norm["normalizers"][1].items() >= {"pattern": {"Regex": r"\s+"}, "content": " "}.items()
    if spaces and len(steps) == 2 and steps[0].items() >= cuts.items() and steps[1].items() >= (level | {"use_regex": False}).items():
        return "lower"
    return "whole"


class Encoder:
    """Holds two generations of at most about KEEP chunks each; the older one is dropped whole."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        kind = _kind(json.loads(self.tokenizer.to_str()))
        self.lower, self.whole = kind == "lower", kind == "whole"
        if kind == "bytes":
            vocabulary = self.tokenizer.get_vocab()
            self.feed = vocabulary.get("\u010a", -1)  # byte 0x0A in the vocabulary's alphabet
            self.leads = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
            self.leads[[i for t, i in vocabulary.items() if t[0:1] == "\u0120"]] = True  # byte 0x20
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _chunks(self, text: str) -> list[str]:
        if not self.lower:
            return _CHUNK.findall(text)
        if text.isascii():
            text = text.lower()
        return _CLOSING.sub(r" \1", text).replace("\n", " ").split(" ")

    def _one_by_one(self, chunks: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(chunks, add_special_tokens=False)]

    def _words(self, words: list[str]) -> list[bytes]:
        """Words of letters alone, each one piece of the ``lower`` pattern, encoded as one text and
        parted at the pieces.  Should the pattern see more pieces, each is encoded alone."""
        out: list[bytes] = []
        for at in range(0, len(words), JOINED):
            some = words[at : at + JOINED]
            e = self.tokenizer.encode(" ".join(some), add_special_tokens=False)
            piece = np.array(e.word_ids, np.int64)
            cut = np.concatenate(([0], np.flatnonzero(np.diff(piece)) + 1, [len(piece)])) * 4
            raw, cut = array("I", e.ids).tobytes(), cut.tolist()
            parts = [raw[i:j] for i, j in zip(cut, cut[1:], strict=False)]
            out += parts if len(parts) == len(some) else self._one_by_one(some)
        return out

    def _joined(self, chunks: list[str], between: str) -> list[bytes]:
        """Chunks of the ``bytes`` kind encoded as one text: those that begin with their only space are
        parted where an id begins with a space, words of letters alone at line feeds put between them."""
        out: list[bytes] = []
        groups = [chunks[at : at + JOINED] for at in range(0, len(chunks), JOINED)]
        found = self.tokenizer.encode_batch_fast([between.join(some) for some in groups], add_special_tokens=False)
        for some, e in zip(groups, found, strict=True):
            ids = array("I", e.ids)
            raw, values = ids.tobytes(), np.frombuffer(ids, np.uint32)
            at = np.flatnonzero(values == self.feed if between else self.leads[values])
            if len(at) != len(some) - len(between) or not between and at[0]:
                out += self._one_by_one(some)
                continue
            first = (4 * at).tolist()
            if between:
                out += [raw[i:j] for i, j in zip([0, *(i + 4 for i in first)], [*first, len(raw)], strict=True)]
            else:
                out += [raw[i:j] for i, j in zip(first, [*first[1:], len(raw)], strict=True)]
        return out

    def _learn(self, chunks: set[str]) -> dict[str, bytes]:
        """Ids of chunks that aren't known."""
        got = {c: self.older[c] for c in chunks if c in self.older}
        new = chunks - got.keys()
        bare = [c for c in new if c.isalpha()]
        spaced = [] if self.lower else [c for c in new if c[0] == " " and c[1:2].strip()]
        got.update(zip(bare, self._words(bare) if self.lower else self._joined(bare, "\n"), strict=True))
        got.update(zip(spaced, self._joined(spaced, ""), strict=True))
        others = [c for c in new if c not in got]
        got.update(zip(others, self._one_by_one(others), strict=True))
        return got

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        if self.whole:
            return self._one_by_one([t or "" for t in texts])
        out: list[bytes] = []
        for at in range(0, len(texts), BATCH):
            chunks: list[str] = []
            ends = [0]
            for t in texts[at : at + BATCH]:
                chunks += self._chunks(t or "")
                ends.append(len(chunks))
            ids = list(map(self.known.get, chunks))
            missing = [k for k, i in enumerate(ids) if i is None]
            if missing:
                got = self._learn({chunks[k] for k in missing})
                for k in missing:
                    ids[k] = got[chunks[k]]
                self.known.update((k, v) for k, v in got.items() if len(k) <= LONGEST)
            out += [b"".join(ids[i:j]) for i, j in zip(ends, ends[1:], strict=False)]
            if len(self.known) > KEEP:
                self.older, self.known = self.known, {}
        return out


def encoder(path: str) -> Encoder:
    """One encoder a worker process: that of the last vocabulary file, so tables don't add up."""
    if path not in _open:
        _open.clear()
        _open[path] = Encoder(path)
    return _open[path]


def public(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))
