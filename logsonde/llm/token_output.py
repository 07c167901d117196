"""Token-ID output: documents in id order, as independently coded, checksummed blocks; and reading them back.

The file format is a Parquet table whose rows are blocks (see `range_coder`), in one file for each range of ids:
`part` (the task that wrote it; parts ascend with doc_id), `block` (from 0 in its part), `part_start` (ids of the
part before the block), `n_ids`, `doc_ids` and `doc_lengths` (the documents of the block, in order) and `payload`.
A block holds whole documents, so any task can decode any block alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from logsonde.llm.common import in_tasks, part_starts
from logsonde.llm.range_coder import decode_block, encode_block
from logsonde.llm.token_ids import token_ids

BLOCK_IDS = 1 << 20
BLOCKS = (
    "part int, block int, part_start long, n_ids long, doc_ids array<long>, doc_lengths array<long>, payload binary"
)
DOCUMENTS = "part int, doc_id long, in_part long, n_tokens long, ids binary"


def write_tokens(
    docs: DataFrame, path: str, tokenizer: str, end_id: int | None = 2, vocabulary: int = 49408, block_ids: int = BLOCK_IDS
) -> None:
    """Encodes the whole texts of `docs` (doc_id long, text) and writes them to `path` in ascending doc_id order.

    `end_id` is appended to each document. A null or empty text has the end id only; a null doc_id comes first;
    rows that repeat a doc_id all stay, in the order of a hash of their text; an empty table gives an empty file.
    Other columns are not read. A text longer than a block is one block by itself.
    """
    end = b"" if end_id is None else int(end_id).to_bytes(4, "little")

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder, part = token_ids(tokenizer), TaskContext.get().partitionId()
        ids: list[bytes] = []
        names: list[int | None] = []
        lengths: list[int] = []
        block = start = held = 0

        def close() -> pd.DataFrame:
            payload = encode_block(np.frombuffer(b"".join(ids), "<u4"), vocabulary)
            return pd.DataFrame(
                {
                    "part": [part], "block": [block], "part_start": [start], "n_ids": [held],
                    "doc_ids": [names], "doc_lengths": [lengths], "payload": [payload],
                }
            )

        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                coded = encoder.encode(text) + end
                ids.append(coded)
                names.append(None if pd.isna(doc_id) else int(doc_id))
                lengths.append(len(coded) // 4)
                held += lengths[-1]
                if held >= block_ids:
                    yield close()
                    block, start, held = block + 1, start + held, 0
                    ids, names, lengths = [], [], []
        if names:
            yield close()

    tie = F.xxhash64("text")
    rows = docs.select("doc_id", "text")
    ordered = rows.repartitionByRange("doc_id", tie).sortWithinPartitions("doc_id", tie, "text")
    in_tasks(ordered, encode, BLOCKS).write.mode("errorifexists").parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The documents of such a file: part, doc_id, start, n_tokens and ids (little-endian, 32 bits each).

    `start` counts the ids of all documents before. Damaged blocks raise an error.
    """
    blocks = spark.read.schema(BLOCKS).parquet(path)

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                coded = decode_block(row.payload).astype("<u4").tobytes()
                lengths = np.asarray(row.doc_lengths, dtype=np.int64)
                edges = np.concatenate([[0], np.cumsum(lengths)])
                yield pd.DataFrame(
                    {
                        "part": row.part,
                        "doc_id": pd.array([None if pd.isna(x) else int(x) for x in row.doc_ids], dtype="Int64"),
                        "in_part": row.part_start + edges[:-1],
                        "n_tokens": lengths,
                        "ids": [coded[4 * a : 4 * b] for a, b in zip(edges[:-1], edges[1:], strict=True)],
                    }
                )

    # A row for each task that wrote: bounded by the number of files, whatever the number of documents.
    starts = part_starts(blocks.groupBy("part").agg(F.sum("n_ids").alias("n")), "part", "n").select("part", "base")
    return (
        in_tasks(blocks, decode, DOCUMENTS)
        .join(F.broadcast(starts), "part")
        .select("part", "doc_id", (F.col("base") + F.col("in_part")).alias("start"), "n_tokens", "ids")
    )
