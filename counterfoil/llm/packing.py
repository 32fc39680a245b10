"""Best-two-fit packing of documents into sequences of a fixed capacity.

Definite results: a null text is the empty text (its end id alone); a null id is kept;
repeated rows are packed one by one; an empty table gives no rows. Only documents
longer than the capacity are cut, into full pieces and a rest.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from counterfoil.llm.common import Columns, id_and_text, map_columns, written
from counterfoil.llm.tokens import as_u4, word_memo

CAPACITY = 4096
# Pieces packed together. Enough that the few bins a group leaves open do not count,
# and a bound for what one task holds (a few MB).
GROUP_PIECES = 20_000

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, row long"


def cut(
    docs: DataFrame,
    tokenizer: str,
    end_id: int,
    capacity: int = CAPACITY,
    with_ids: bool = False,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The pieces of every document, numbered by (part, row); with_ids adds their ids."""

    def make(batches: Iterator[Columns]) -> Iterator[Columns]:
        memo = word_memo(tokenizer)
        end, width = np.array([end_id], memo.kind).tobytes(), memo.kind.itemsize
        part, row = TaskContext.get().partitionId(), 0
        for batch in batches:
            out: Columns = {c.split()[0]: [] for c in PIECES.split(", ")} | {"ids": []}
            for doc_id, found in zip(batch["doc_id"], memo.encode(batch["text"]), strict=True):
                ids = found + end
                for piece, at in enumerate(range(0, len(ids), capacity * width)):
                    own = as_u4(ids[at : at + capacity * width], memo.kind)
                    out["doc_id"].append(doc_id)
                    out["piece"].append(piece)
                    out["start"].append(at // width)
                    out["length"].append(len(own) // 4)
                    out["ids_crc32"].append(zlib.crc32(own))
                    out["part"].append(part)
                    out["row"].append(row)
                    if with_ids:
                        out["ids"].append(np.frombuffer(own, "<u4").tolist())
                    row += 1
            yield out
        memo.rest()

    schema = PIECES + ", ids array<long>" * with_ids
    return map_columns(id_and_text(docs, id_col, text_col), make, schema)


def best_two_fit(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Bins as lists of lengths, each length of 1 to capacity.

    Each bin starts with the largest length left and takes the largest that still fits,
    again and again. Then its smallest may give way to two others that together fill
    the widened gap better.
    """
    counts = np.bincount(lengths, minlength=capacity + 1)
    at = np.arange(capacity + 1)
    below = np.maximum.accumulate(np.where(counts > 0, at, 0))  # largest length left up to each

    def take(size: int) -> None:
        counts[size] -= 1
        if not counts[size]:
            below[size : np.searchsorted(below, size, "right")] = below[size - 1]

    def give(size: int) -> None:
        counts[size] += 1
        stop = size + int(np.searchsorted(below[size:], size, "left"))
        below[size:stop] = size

    bins = []
    while first := int(below[capacity]):
        take(first)
        members, gap = [first], capacity - first
        while size := int(below[gap]):
            take(size)
            members.append(size)
            gap -= size
        if gap and len(members) > 1 and (room := gap + members[-1]) > 1:
            small = at[1 : room // 2 + 1][counts[1 : room // 2 + 1] > 0]
            if len(small):
                large = below[room - small]
                both = np.where((large > small) | (counts[small] > 1), small + large, 0)
                best = int(both.argmax())
                if both[best] > members[-1]:
                    give(members.pop())
                    for size in (int(large[best]), int(small[best])):
                        take(size)
                        members.append(size)
        bins.append(members)
    return bins


def _pack_group(capacity: int):
    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "part", "row"], ignore_index=True)
        lengths = rows["length"].to_numpy()
        bins = best_two_fit(lengths, capacity)
        sizes = np.array([s for b in bins for s in b])
        numbers = np.repeat(np.arange(len(bins)), [len(b) for b in bins])
        offsets = np.concatenate([np.cumsum([0, *b[:-1]]) for b in bins])
        slots = np.argsort(sizes, kind="stable")  # the k-th slot of a length gets its k-th piece
        rows["sequence_id"] = (rows["pack_group"].iloc[0].astype(np.int64) << 32) + numbers[slots]
        rows["offset"] = offsets[slots].astype(np.int64)
        return rows[[*_OUT]]

    return pack


_OUT = {
    "doc_id": "long", "piece": "int", "start": "long", "length": "long", "ids_crc32": "long",
    "sequence_id": "long", "offset": "long", "part": "int", "row": "long",
}


def pack(pieces: DataFrame, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Each piece with its sequence and its place there; (part, row) stays its number.

    Pieces are dealt into groups by a hash of their own number, so groups are even
    whatever the ids, and their count grows with the table.
    """
    groups = max(1, -(-pieces.count() // group_pieces))
    dealt = pieces.select(
        *PIECE_COLUMNS, F.pmod(F.xxhash64("part", "row"), F.lit(groups)).alias("pack_group")
    )
    schema = ", ".join(f"{k} {v}" for k, v in _OUT.items())
    return dealt.groupBy("pack_group").applyInPandas(_pack_group(capacity), schema)


PIECE_COLUMNS = [c.split()[0] for c in PIECES.split(", ")]


def packed(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY) -> DataFrame:
    """Cut, written (so that counting and packing see the same pieces), and packed."""
    return pack(written(cut(docs, tokenizer, end_id, capacity), "pieces"), capacity)


def sequences(pieces: DataFrame, placed: DataFrame) -> DataFrame:
    """The filled sequences: sequence_id, ids, whatever the documents' ids.

    pieces: from cut(with_ids=True), written; placed: what pack made of that same table.
    A sequence is bounded by its capacity.
    """
    both = placed.join(pieces.select("part", "row", "ids"), ["part", "row"])
    return both.groupBy("sequence_id").agg(
        F.flatten(
            F.transform(
                F.sort_array(F.collect_list(F.struct("offset", "ids"))), lambda x: x["ids"]
            )
        ).alias("ids")
    )
