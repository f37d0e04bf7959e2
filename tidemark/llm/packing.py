"""Cost-balanced packing of token sequences."""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tokens import encoder, tokenizer_path
from tidemark.session import ship_package

CAPACITY = 1024
LINEAR, QUADRATIC = 1.0, 1.0 / 2048
WINDOW_TOKENS = 4_000_000
PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
          "sequence_length long")


def attention_cost(length, linear: float = LINEAR, quadratic: float = QUADRATIC):
    """Estimated cost of a piece: its tokens, and the attention among them."""
    return linear * length + quadratic * length * length


def powers_of_two(n: int) -> list[int]:
    """``n`` as descending powers of two."""
    return [1 << b for b in range(n.bit_length() - 1, -1, -1) if n >> b & 1]


def balanced(lengths: list[int], capacity: int = CAPACITY, linear: float = LINEAR, quadratic: float = QUADRATIC
             ) -> tuple[list[tuple[int, int, int, int, int]], list[int]]:
    """Places texts of the given token counts; returns ``(text, start, length, sequence, offset)`` and sequence sizes.

    Runs of ``capacity`` tokens fill sequences of their own. The rests are placed in descending order, each on
    the sequence of lowest cost among those with room. If none has room for a rest it is cut: what fits goes
    where most room is left, the remainder is placed next. The open sequences hold exactly the rests' tokens:
    the last ones have power-of-two sizes, so that nothing is padded.
    """
    placed, sizes, rests = [], [], []
    for i, n in enumerate(lengths):
        full = n // capacity
        for k in range(full):
            placed.append((i, k * capacity, capacity, len(sizes), 0))
            sizes.append(capacity)
        if n % capacity:
            rests.append((n % capacity, i, full * capacity))
    total = sum(r[0] for r in rests)
    rooms = [capacity] * (total // capacity) + powers_of_two(total % capacity)
    if not rooms:
        return placed, sizes
    base = len(sizes)
    sizes += rooms
    room = np.array(rooms)
    used = np.zeros(len(rooms), dtype=np.int64)
    cost = np.zeros(len(rooms))
    queue = [(-n, i, start) for n, i, start in rests]
    heapq.heapify(queue)
    while queue:
        n, i, start = heapq.heappop(queue)
        n = -n
        open_cost = np.where(room >= n, cost, np.inf)
        s = int(np.argmin(open_cost))
        if open_cost[s] == np.inf:
            s = int(np.argmax(room))
            fits = int(room[s])
            heapq.heappush(queue, (-(n - fits), i, start + fits))
            n = fits
        placed.append((i, start, n, base + s, int(used[s])))
        used[s] += n
        room[s] -= n
        cost[s] += attention_cost(n, linear, quadratic)
    return placed, sizes


def pack_documents(docs: DataFrame, tokenizer: str | None = None, separator: int = 0, capacity: int = CAPACITY,
                   window_tokens: int = WINDOW_TOKENS, linear: float = LINEAR, quadratic: float = QUADRATIC,
                   with_ids: bool = False) -> DataFrame:
    """``docs(doc_id, text)`` -> one row per piece of a packed sequence.

    A document is its token ids and then ``separator``; a null or empty text is the separator alone. Each task
    packs its own rows, in windows of about ``window_tokens`` tokens, so there is no shuffle and memory does not
    follow the input; a longer document fills windows of its own. Sequences are dense and have ``capacity``
    tokens, except the last of a window, whose sizes are powers of two: no token is padding. ``sequence_id``
    is the task's number times 2**33 plus a counter. A null ``doc_id`` stays null, repeated ones are separate
    documents, other columns are ignored; an empty table gives no rows. ``with_ids`` adds the ids of each piece.
    """
    if capacity < 1 or capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")
    ship_package(docs.sparkSession)
    path = tokenizer or tokenizer_path()
    schema = PIECES + (", ids array<int>" if with_ids else "")

    def pack(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        encode, task = encoder(path), TaskContext.get().partitionId()
        made, names, ids, held = 0, [], [], 0
        end = np.array([separator], dtype="<u4").tobytes()

        def flush():
            nonlocal made, names, ids, held
            placed, sizes = balanced([len(x) // 4 for x in ids], capacity, linear, quadratic)
            columns = [[] for _ in range(9 if with_ids else 8)]
            for i, start, n, sequence, offset in placed:
                raw = ids[i][4 * start:4 * (start + n)]
                row = (names[i], start, n, zlib.crc32(raw), len(ids[i]) // 4, (task << 33) + made + sequence, offset, sizes[sequence])
                for column, value in zip(columns, row):
                    column.append(value)
                if with_ids:
                    columns[8].append(np.frombuffer(raw, "<i4"))
            made += len(sizes)
            names, ids, held = [], [], 0
            kinds = [pa.int64()] * 8 + [pa.list_(pa.int32())] * with_ids
            labels = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "sequence_length", "ids"]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=labels[:len(columns)])

        for batch in batches:
            docs_of, texts = batch.column(0).to_pylist(), batch.column(1)
            for at in range(0, len(docs_of), 200):
                for name, raw in zip(docs_of[at:at + 200], encode(texts.slice(at, 200).to_pylist())):
                    raw += end
                    names.append(name)
                    ids.append(raw)
                    held += len(raw) // 4
                    if held >= window_tokens:
                        yield flush()
        if names:
            yield flush()

    columns = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return columns.mapInArrow(pack, schema)
