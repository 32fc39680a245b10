"""Encoding with vocabularies whose words never depend on what stands around them."""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterable, Iterator
from functools import cache
from itertools import chain

import numpy as np
import regex
import tiktoken
from tokenizers import Tokenizer

# Distinct words and parts of words a worker remembers; a table starts anew beyond that.
# Words are put together from parts cheaply, so parts are kept longer.
MEMO_WORDS = 500_000
MEMO_PARTS = 800_000
# Of both together, what a worker may go on holding while it waits or works for others.
KEPT_BETWEEN = 200_000
# New words encoded as one text.
TOGETHER = 500
# Words whose characters all keep their place when the tokenizer normalizes them. Nothing
# is tried twice: both alternatives hold letters.
_PLAIN = re.compile(r"(?:[^\W_]|[!-;=-~])++")
# Letters that normalization keeps and lower-casing maps one to one, and ASCII marks.
_SIMPLE = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ0-9!-;=-~]+")


@cache
def load(path: str) -> Tokenizer:
    """The tokenizer of a file, without truncation and padding."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
    found = Tokenizer.from_file(path)
    found.no_truncation()
    found.no_padding()
    return found


def id_type(tokenizer: Tokenizer) -> np.dtype:
    """The narrowest little-endian unsigned type that holds every id."""
    return np.dtype("<u2" if tokenizer.get_vocab_size(True) <= 1 << 16 else "<u4")


def word_parts(tokenizer: Tokenizer) -> regex.Pattern | None:
    """The pattern whose matches in a lower-cased word are encoded each for itself.

    None for tokenizers that do more than lower-casing before they split.
    """
    told = json.loads(tokenizer.to_str())
    steps = [n["type"] for n in (told["normalizer"] or {}).get("normalizers", [])]
    split = (told["pre_tokenizer"] or {}).get("pretokenizers", [])
    if steps != ["NFC", "Replace", "Lowercase"] or [s["type"] for s in split] != ["Split", "ByteLevel"]:
        return None
    first, last = split
    whole = first["behavior"] == "Removed" and first["invert"] and "Regex" in first["pattern"]
    if not whole or last["use_regex"] or last["add_prefix_space"]:
        return None
    return regex.compile(first["pattern"]["Regex"])


def byte_alphabet() -> dict[str, int]:
    """Characters of byte-level vocabularies, and the bytes they stand for.

    Printable Latin-1 characters stand for their own byte, the other bytes in order for
    the characters from U+0100 on.
    """
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(other)}


def part_merger(tokenizer: Tokenizer) -> Callable[[str], list[int]] | None:
    """From parts of words, each with a blank behind it, to the ids of all.

    The blank stands for the vocabulary's end mark, so that whole parts merge by rank;
    parts hold no blank of their own. None where the ids do not follow the merges:
    single bytes first, then those with the end mark, then merged ones.
    """
    mark = json.loads(tokenizer.to_str())["model"].get("end_of_word_suffix")
    added, alphabet = tokenizer.get_added_tokens_decoder(), byte_alphabet()
    ranks: dict[bytes, int] = {}
    for token, i in tokenizer.get_vocab(True).items():
        if i in added:
            continue
        ended = bool(mark) and token.endswith(mark)
        whole = bytes(alphabet[c] for c in (token[: -len(mark)] if ended else token))
        ranks[whole + b" " * ended] = i
        if len(whole) == 1 and i >= 512 or len(whole) > 1 and i < 512:
            return None
    if not mark or len(ranks) + len(added) != tokenizer.get_vocab_size(True):
        return None
    return tiktoken.Encoding(
        "parts", pat_str="[^ ]* ", mergeable_ranks=ranks, special_tokens={}
    ).encode_ordinary


def last_ids(tokenizer: Tokenizer) -> np.ndarray:
    """Whether each id ends what it is a part of, by the mark of the vocabulary."""
    mark = json.loads(tokenizer.to_str())["model"].get("end_of_word_suffix") or "\0"
    vocabulary = tokenizer.get_vocab(True)
    found = np.zeros(max(vocabulary.values()) + 1, bool)
    found[[i for token, i in vocabulary.items() if token.endswith(mark)]] = True
    return found


def _lists(words: list[str]) -> Iterator[list[str]]:
    return (words[k : k + TOGETHER] for k in range(0, len(words), TOGETHER))


class WordMemo:
    """Ids of whole texts, each distinct part of a word encoded once.

    Fits vocabularies that drop white space and end each word with a mark: the ids of
    a text are then the ids of its words one after the other. Texts are cut at ASCII
    blanks only; rarer white space stays inside a word and is left to the tokenizer.
    """

    def __init__(self, path: str) -> None:
        self.tokenizer = load(path)
        self.kind = id_type(self.tokenizer)
        self.known: dict[str, bytes] = {}
        self.known_parts: dict[str, bytes] = {}
        self.merge = part_merger(self.tokenizer)
        self.parts = word_parts(self.tokenizer) if self.merge else None
        self.last = last_ids(self.tokenizer)

    def _learn(self, words: list[str], known: dict[str, bytes]) -> None:
        """Encode words as one text, which is faster, and part the ids by where they stand."""
        found = self.tokenizer.encode(" ".join(words), add_special_tokens=False)
        ends = np.cumsum([len(w) + 1 for w in words])
        parts = np.searchsorted([place[0] for place in found.offsets], ends).tolist()
        ids, width = np.array(found.ids, self.kind).tobytes(), self.kind.itemsize
        for word, a, b in zip(words, [0, *parts[:-1]], parts, strict=True):
            known[word] = ids[a * width : b * width]

    def _learn_parts(self, parts: list[str]) -> None:
        """The same for parts that are not split further, by rank: each ends with its only end mark."""
        ids = np.array(self.merge(" ".join(parts) + " "), self.kind)
        stops = np.flatnonzero(self.last[ids]) + 1
        if len(stops) != len(parts):
            self._learn(parts, self.known_parts)
            return
        whole, ends = ids.tobytes(), (stops * self.kind.itemsize).tolist()
        start = 0
        for part, end in zip(parts, ends, strict=True):
            self.known_parts[part] = whole[start:end]
            start = end

    def encode(self, texts: Iterable[str]) -> list[bytes]:
        """The ids of each text as bytes of `kind`."""
        split = [_blank(t).split(" ") for t in texts]
        if len(self.known) > MEMO_WORDS:
            self.known.clear()
        if len(self.known_parts) > MEMO_PARTS:
            self.known_parts.clear()
        new = set(chain.from_iterable(split)).difference(self.known)
        # a word is its parts, which many words share: `Mine!!` is `mine` and `!!`
        parted = {}
        if self.parts:
            simple = [w for w in new if _SIMPLE.fullmatch(w)]
            find = self.parts.findall
            parted = {w: [w] if w.isalpha() and w.islower() else find(w.lower()) for w in simple}
            parts = set(chain.from_iterable(parted.values())).difference(self.known_parts)
            new.difference_update(simple)
            for some in _lists(list(parts)):
                self._learn_parts(some)
        plain = [w for w in new if _PLAIN.fullmatch(w)]
        for some in _lists(plain):
            self._learn(some, self.known)
        for word in new.difference(plain):
            found = self.tokenizer.encode(word, add_special_tokens=False)
            self.known[word] = np.array(found.ids, self.kind).tobytes()
        for word, own in parted.items():
            if len(own) == 1:
                self.known[word] = self.known_parts[own[0]]
            else:
                self.known[word] = b"".join([self.known_parts[p] for p in own])
        get = self.known.__getitem__
        return [b"".join(map(get, words)) for words in split]

    def rest(self) -> None:
        """At the end of a task: tables that have grown large go, as workers outlive their stage."""
        if len(self.known) + len(self.known_parts) > KEPT_BETWEEN:
            self.known, self.known_parts = {}, {}


def _blank(text: str) -> str:
    for other in "\n\t\r\x0b\x0c":
        text = text.replace(other, " ")
    return text


@cache
def word_memo(path: str) -> WordMemo:
    """One memo per worker and vocabulary, kept between tasks."""
    return WordMemo(path)


def as_u4(ids: bytes, kind: np.dtype) -> bytes:
    """The same ids as little-endian unsigned 32-bit integers."""
    return ids if kind.itemsize == 4 else np.frombuffer(ids, kind).astype("<u4").tobytes()
