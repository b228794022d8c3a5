"""Cost-balanced packing of token ids into sequences.

A document becomes its token ids and one end id. Whole ``capacity``-sized pieces are sequences of
their own; the rests (shorter than ``capacity``) of a block of documents are packed together. A
block's sequences hold exactly its tokens: as many of ``capacity`` as they fill, and for what is
left one sequence for each binary digit, since a power of two needs no padding. Pieces go, by
descending cost ``linear * n + quadratic * n * n``, to the sequence of the lowest cost so far that
has room; a piece for which no room is left is cut, and the part that doesn't fit is placed next.

Blocks are runs of rows of one input partition, so nothing is shuffled, a task holds the rests of
one block at most, and a lost task is simply run again. Sequence ids carry the partition's number.

Ids are those of the tokenizers library for the same file (tests compare them). The library takes
1.5 microseconds of a CPU a character; so the file's vocabulary and merges are run by tiktoken, in
a tenth of that, or by the exact merges of ``bpe``, where a text holds a run of BLANK or more blanks,
on which tiktoken's pattern engine runs out of stack.

Defined results: a null text is an empty one and yields the end id alone; a null id is kept as
null; repeated rows are packed one by one; an empty table gives an empty table; other columns are
not read; a text of any length, and any run of blanks in it, is encoded whole.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, common

CAPACITY = 1024
END = 0
#: Rests of so many documents are packed together.
BLOCK = 4096
#: Cost of a piece of n tokens: LINEAR * n + QUADRATIC * n * n, as of a layer of width 1024.
LINEAR, QUADRATIC = 24.0 * 1024, 4.0
TOKENIZER = "byte_bpe_50k.json"
BLANK = 10_000
SCHEMA = "start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
_blanks = re.compile(rf"\s{{{BLANK}}}").search


@lru_cache(maxsize=2)
def encoders(path: str):
    """Two encoders of the file's vocabulary: a fast one, and one that takes any text."""
    import tiktoken

    model = bpe.model_at(path)
    ranks = {piece: i for i, piece in model.bytes_of.items() if i not in model.special.values()}
    fast = tiktoken.Encoding("bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=model.special)
    return fast, bpe.Codec(model, None)


def token_ids(text: str | None, path: str) -> np.ndarray:
    """The ids of a text; a special token's string in it is that token."""
    if not text:
        return np.empty(0, np.uint32)
    fast, exact = encoders(path)
    if _blanks(text):
        return np.frombuffer(exact.encode(text), "<u4")
    return fast.encode_to_numpy(text, allowed_special="all")


def capacities(total: int, capacity: int) -> list[int]:
    """Sizes that add up to ``total``: full sequences, then powers of two."""
    rest = total % capacity
    return [capacity] * (total // capacity) + [1 << b for b in range(capacity.bit_length(), -1, -1) if rest >> b & 1]


def assign(lengths: list[int], capacity: int, linear: float, quadratic: float) -> list[tuple[int, int, int, int, int]]:
    """(piece, from, length, sequence, offset): where each part of each piece goes."""
    room = np.array(capacities(sum(lengths), capacity), np.int64)
    cost, fill, out = np.zeros(len(room)), np.zeros(len(room), np.int64), []
    waiting = [(-n, i, 0) for i, n in enumerate(lengths) if n]
    heapq.heapify(waiting)
    while waiting:
        n, i, start = heapq.heappop(waiting)
        n = -n
        fits = room >= n
        if fits.any():
            s, part = int(np.where(fits, cost, np.inf).argmin()), n
        else:
            s = int(room.argmax())
            part = int(room[s])
            heapq.heappush(waiting, (part - n, i, start + part))
        out.append((i, start, part, s, int(fill[s])))
        cost[s] += linear * part + quadratic * part * part
        room[s] -= part
        fill[s] += part
    return out


def pack(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, end: int = END,
    capacity: int = CAPACITY, block: int = BLOCK, linear: float = LINEAR, quadratic: float = QUADRATIC,
) -> DataFrame:
    """A row for each piece: its document, place there, ids (little-endian uint32), sequence and offset."""
    path = path or public_tokenizers.path(TOKENIZER)
    kind = docs.schema[id_col].dataType.simpleString()
    ddl = f"`{id_col}` {kind}, {SCHEMA}"
    fields = common._arrow(docs.sparkSession, ddl)
    names = fields.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 40
        made, rests, out = 0, [], [[] for _ in names]
        size = 0

        def add(doc, start, ids, total, sequence, offset):
            nonlocal size
            size += 4 * len(ids)
            for column, v in zip(out, (doc, start, len(ids), ids.tobytes(), total, sequence, offset), strict=True):
                column.append(v)

        def flush_rests():
            nonlocal made
            for i, start, n, s, offset in assign([len(r[2]) for r in rests], capacity, linear, quadratic):
                doc, at, ids, total = rests[i]
                add(doc, at + start, ids[start : start + n], total, base + made + s, offset)
            made += len(capacities(sum(len(r[2]) for r in rests), capacity))
            rests.clear()

        def ready():
            nonlocal out, size
            batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, fields.types, strict=True)], schema=fields)
            out, size = [[] for _ in names], 0
            return batch

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.append(token_ids(text.as_py(), path).astype("<u4"), np.array([end], "<u4"))
                whole = len(ids) // capacity * capacity
                for start in range(0, whole, capacity):
                    add(doc, start, ids[start : start + capacity], len(ids), base + made, 0)
                    made += 1
                if whole < len(ids):
                    rests.append((doc, whole, ids[whole:], len(ids)))
                if len(rests) >= block:
                    flush_rests()
                if size > 8 << 20:
                    yield ready()
        flush_rests()
        yield ready()

    return docs.select(id_col, text_col).mapInArrow(run, ddl)


def digests(pieces: DataFrame) -> DataFrame:
    """The pieces with a checksum in place of their ids."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(pack(common.table(spark, sf_dir, "documents")))
