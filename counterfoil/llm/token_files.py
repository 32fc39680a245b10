"""Token-ID output: flat unsigned integer files with 64-bit document offsets.

Part p of an output holds `p.ids` (the ids of its documents, nothing between) and
`p.idx` (little-endian int64: number of documents n, their n ids, n + 1 offsets into
`p.ids` counted in ids). Parts follow each other in ascending doc_id order; the place
of a part's first id in the whole output is the prefix sum of the earlier parts.

Definite results: a null text is the empty text (its end id alone); a null id comes
first, and is written as the smallest int64; rows that repeat an id follow each other,
ordered by a hash of the text and then the text; an empty table gives no parts. Texts are never cut.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from counterfoil.llm.common import Columns, id_and_text, map_columns, written
from counterfoil.llm.tokens import as_u4, word_memo
from counterfoil.session import work_folder

NO_ID = -(1 << 63)


def _place(folder: str, name: str) -> tuple[fs.FileSystem, str]:
    system, path = fs.FileSystem.from_uri(folder)
    return system, f"{path}/{name}"


def write_token_files(
    docs: DataFrame,
    tokenizer: str,
    end_id: int,
    folder: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Write the files below folder; returns a row per part: part, n_docs, n_ids, base.

    Rows are dealt by ranges of doc_id and a hash of the text, so the work of a part is
    bounded by the number of partitions, also where very many texts share an id. A task writes under a name of its own and renames at its end, so a
    repeated task replaces a part by the same bytes.
    """
    spark = docs.sparkSession
    folder = folder or work_folder(spark, "token-files")
    ordered = (
        id_and_text(docs, id_col, text_col)
        .withColumn("own", F.xxhash64("text"))
        .repartitionByRange("doc_id", "own")
        .sortWithinPartitions("doc_id", "own", "text")
        .drop("own")
    )

    def write(batches: Iterator[Columns]) -> Iterator[Columns]:
        part = TaskContext.get().partitionId()
        first = next(batches, None)
        if first is None:
            return
        memo = word_memo(tokenizer)
        end = np.array([end_id], memo.kind).tobytes()
        own = f"{part}-{uuid.uuid4().hex}"
        system, path = _place(folder, f"{own}.ids")
        system.create_dir(path.rpartition("/")[0], recursive=True)
        ids: list[int] = []
        sizes: list[int] = []
        batch: Columns | None = first
        with system.open_output_stream(path) as out:
            while batch is not None:
                for found in memo.encode(batch["text"]):
                    out.write(found + end)
                    sizes.append(len(found) // memo.kind.itemsize + 1)
                ids += [NO_ID if i is None else i for i in batch["doc_id"]]
                batch = next(batches, None)
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        index = np.concatenate([[len(ids)], ids, offsets]).astype("<i8")
        _, side = _place(folder, f"{own}.idx")
        with system.open_output_stream(side) as out:
            out.write(index.tobytes())
        system.move(path, _place(folder, f"{part}.ids")[1])
        system.move(side, _place(folder, f"{part}.idx")[1])
        yield {
            "part": [part], "n_docs": [len(ids)], "n_ids": [int(offsets[-1])],
            "width": [memo.kind.itemsize], "folder": [folder],
        }

    schema = "part int, n_docs long, n_ids long, width int, folder string"
    parts = written(map_columns(ordered, write, schema), "token-parts")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # one row per partition, so the prefix sum is small whatever the table
    return parts.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def _open(system: fs.FileSystem, path: str) -> pa.NativeFile:
    return pa.memory_map(path) if isinstance(system, fs.LocalFileSystem) else system.open_input_file(path)


def read_token_files(parts: DataFrame, with_ids: bool = False) -> DataFrame:
    """Every document of the files: doc_id, start, n_tokens, ids_crc32 (and its ids).

    Files are mapped into memory where the folder is a local one, so a task holds the
    offsets of a part and the ids of one document at a time.
    """

    def read(batches: Iterator[Columns]) -> Iterator[Columns]:
        for batch in batches:
            for part, width, folder, base in zip(
                batch["part"], batch["width"], batch["folder"], batch["base"], strict=True
            ):
                system, side = _place(folder, f"{part}.idx")
                with _open(system, side) as file:
                    index = np.frombuffer(file.read(), "<i8")
                n = int(index[0])
                ids, offsets = index[1 : n + 1], index[n + 1 :]
                kind = np.dtype(f"<u{width}")
                with _open(system, _place(folder, f"{part}.ids")[1]) as file:
                    for start in range(0, n, 1000):
                        stop = min(n, start + 1000)
                        found = [
                            as_u4(file.read(int(offsets[k + 1] - offsets[k]) * width), kind)
                            for k in range(start, stop)
                        ]
                        out = {
                            "doc_id": [None if i == NO_ID else i for i in ids[start:stop].tolist()],
                            "start": (offsets[start:stop] + base).tolist(),
                            "n_tokens": [len(x) // 4 for x in found],
                            "ids_crc32": [zlib.crc32(x) for x in found],
                        }
                        if with_ids:
                            out["ids"] = [np.frombuffer(x, "<u4").tolist() for x in found]
                        yield out

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    # a task per part: a number that is given is not merged by adaptive execution
    n = max(1, parts.count())
    spread = parts.select("part", "width", "folder", "base").repartition(n, "part")
    return map_columns(spread, read, schema + ", ids array<long>" * with_ids)


def token_files(spark: SparkSession, docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """Written and read back."""
    return read_token_files(write_token_files(docs, tokenizer, end_id))
