"""Byte-level BPE encoding and decoding with content-defined chunk reuse.

A rolling hash over the last characters cuts texts into chunks, so equal passages get
equal chunks wherever they stand. Each distinct chunk is encoded once per worker: its
inner part, from its first to its last blank at which the vocabulary's own splitting
must break, keeps its ids; what is left over at both ends is the seam. Chunks are
joined by re-encoding the seam from the last certain break of the left chunk to the
first certain one of the right chunk; a chunk without any certain break lengthens the
seam until one comes. The ids are then exactly those of the whole text.

Definite results: a null text is the empty text, with no ids; null ids of documents are
kept; repeated rows are encoded one by one; an empty table gives no rows. Texts are
encoded whole.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator
from functools import cache

import numpy as np
import tiktoken
from pyspark.sql import DataFrame

from counterfoil.llm.common import Columns, id_and_text, map_columns
from counterfoil.llm.tokens import byte_alphabet, load

# The rolling hash looks at so many characters; one place in MEAN ends a chunk.
WINDOW, MEAN = 8, 256
# Chunks a worker remembers; the table starts anew beyond that.
MEMO_CHUNKS = 100_000
# Fixed value: how byte-level vocabularies of this kind split texts.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_FACTOR = np.uint32(0x9E3779B1)
# A blank between two characters that are no white space: the splitting pattern takes
# at most one blank in front of a word, and nothing else across it.
_BREAK = re.compile(r"(?<=\S) (?=\S)")


def chunks(text: str) -> list[str]:
    """The text cut after each place where the hash of the last WINDOW characters says so."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    if len(points) <= WINDOW:
        return [text] if text else []
    rolled = np.zeros(len(points) - WINDOW + 1, np.uint32)
    for k in range(WINDOW):
        rolled = rolled * _FACTOR + points[k : k + len(rolled)]
    cuts = np.flatnonzero((rolled * _FACTOR) >> np.uint32(32 - MEAN.bit_length() + 1) == 0)
    ends = [*(cuts + WINDOW).tolist(), len(text)]
    starts = [0, *ends[:-1]]
    return [text[a:b] for a, b in zip(starts, ends, strict=True) if b > a]


def _last_break(text: str) -> int:
    """The start of the last certain break of a text that has one."""
    at = text.rfind(" ", 1, len(text) - 1)
    while text[at - 1].isspace() or text[at + 1].isspace():
        at = text.rfind(" ", 1, at)
    return at


class ChunkEncoder:
    """Whole texts to ids through remembered chunks and the seams between them.

    Chunks and seams are merged by rank, which takes a vocabulary whose ids follow the
    order of its merges; texts that hold a special token go through the tokenizer as
    they are.
    """

    def __init__(self, path: str) -> None:
        self.tokenizer = load(path)
        added = self.tokenizer.get_added_tokens_decoder()
        ranks = {b: i for i, b in enumerate(token_bytes(path)) if i not in added}
        self.merge = tiktoken.Encoding(
            "ranks", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={}
        ).encode_ordinary
        self.chunks: dict[str, tuple[str, array | None, str]] = {}
        self.asked = self.encoded = 0  # chunks met, and those of them that were new
        self.specials = tuple(t.content for t in added.values())

    def chunk(self, text: str) -> tuple[str, array | None, str]:
        """Left seam, inner ids, right seam; without a certain break (text, None, "")."""
        self.asked += 1
        found = self.chunks.get(text)
        if found is None:
            self.encoded += 1
            first = _BREAK.search(text)
            if first is None:
                found = (text, None, "")
            else:
                start, stop = first.start(), _last_break(text)
                ids = array("I", self.merge(text[start:stop]) if stop > start else [])
                found = (text[:start], ids, text[stop:])
            if len(self.chunks) >= MEMO_CHUNKS:
                self.chunks.clear()
            self.chunks[text] = found
        return found

    def encode(self, text: str) -> list[int]:
        if any(s in text for s in self.specials):  # they may lie across chunks
            return self.tokenizer.encode(text, add_special_tokens=False).ids
        ids: list[int] = []
        seam: list[str] = []
        for part in chunks(text):
            left, inner, right = self.chunk(part)
            seam.append(left)
            if inner is not None:
                ids += self.merge("".join(seam))
                ids += inner
                seam = [right]
        if seam:
            ids += self.merge("".join(seam))
        return ids


@cache
def encoder(path: str) -> ChunkEncoder:
    """One per worker and vocabulary, kept between tasks."""
    return ChunkEncoder(path)


@cache
def token_bytes(path: str) -> list[bytes]:
    """The bytes of every id: the inverse of the byte alphabet of the vocabulary."""
    tokenizer, alphabet = load(path), byte_alphabet()
    return [
        bytes(alphabet[c] for c in tokenizer.id_to_token(i))
        for i in range(tokenizer.get_vocab_size(True))
    ]


def decode(ids: list[int], path: str) -> str:
    """The text of ids; bytes that are no UTF-8 become U+FFFD."""
    return b"".join(map(token_bytes(path).__getitem__, ids)).decode("utf-8", "replace")


def encoded(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, ids."""

    def run(batches: Iterator[Columns]) -> Iterator[Columns]:
        for batch in batches:
            yield {
                "doc_id": batch["doc_id"],
                "ids": [encoder(tokenizer).encode(t) for t in batch["text"]],
            }

    return map_columns(id_and_text(docs, id_col, text_col), run, "doc_id long, ids array<int>")


def round_trip_digests(
    docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per document: doc_id, n_tokens, and digests of its ids and of the decoded text."""

    def run(batches: Iterator[Columns]) -> Iterator[Columns]:
        names = [str(i) for i in range(len(token_bytes(tokenizer)))]
        for batch in batches:
            out: Columns = {k: [] for k in ("n_tokens", "ids_sha256", "decoded_sha256")}
            for text in batch["text"]:
                ids = encoder(tokenizer).encode(text)
                out["n_tokens"].append(len(ids))
                out["ids_sha256"].append(_sha(",".join(map(names.__getitem__, ids))))
                out["decoded_sha256"].append(_sha(decode(ids, tokenizer)))
            yield out | {"doc_id": batch["doc_id"]}

    return map_columns(
        id_and_text(docs, id_col, text_col), run,
        "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string",
    )


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()
