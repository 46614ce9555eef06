"""Cost-balanced packing of tokenised documents into sequences of a fixed length.

Attention over a sequence of pieces costs about ``linear * tokens + quadratic * sum of
squared piece lengths`` (attention stays within a document). Blocks of documents are
packed where they lie, without a shuffle: a block holds as many tokens as ``block``
sequences. Documents go in by descending length, each to the lowest-cost sequence that
still has room for it. Documents longer than a sequence first give off whole sequences. A
piece for which no sequence has room is cut: it fills the roomiest sequence and the rest
goes on. All sequences of a block are full at its end; what is left of a task's last block
is cut into sequences whose lengths are powers of two, which need no padding.

A task holds one block and one batch of texts at a time. Sequence ids are unique over
tasks: partition number in the high bits, a running number below. They depend on how the
input is partitioned, not on retries of a task.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adtally.llm.shared import python_ready

LENGTH = 2048
END_ID = 1
BLOCK = 512
LINEAR_COST = 1.0
QUADRATIC_COST = 1.0 / 1024
#: Texts encoded at a time.
TEXTS = 256
# Fixed value: how byte-level BPE cuts a text into words before merging.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"
_PROBE = "Don't  stop:\n\n42 é\t\u4e2d\u6587 <x> \U0001f600 "


class Encoder:
    """Ids of texts as little-endian 32-bit bytes, for a byte-level BPE tokenizer file.

    The file's vocabulary is handed to tiktoken, which merges the same pairs four times as
    fast as the library the file belongs to. That library checks a probe when the worker
    starts, and encodes texts that the faster one gives up on.
    """

    def __init__(self, tokenizer_file: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in set(printable)]
        byte = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}
        special = {t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        ranks = {bytes(byte[c] for c in t): i for t, i in self.tokenizer.get_vocab(with_added_tokens=False).items() if t not in special}
        self.fast = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)
        if self.fast.encode(_PROBE, allowed_special="all") != self.tokenizer.encode(_PROBE, add_special_tokens=False).ids:
            raise ValueError(f"{tokenizer_file} isn't a byte-level BPE tokenizer of the known form")

    def encode(self, texts: list[str | None]) -> list[bytes]:
        return [self._ids(t) if t else b"" for t in texts]

    def _ids(self, text: str) -> bytes:
        try:
            return self.fast.encode_to_numpy(text, allowed_special="all").astype("<u4").tobytes()
        except (ValueError, RuntimeError):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


@cache
def encoder(tokenizer_file: str) -> Encoder:
    """One for each worker process, which runs many tasks."""
    return Encoder(tokenizer_file)


def pack_block(lengths: list[int], length: int, sequences: int, linear: float, quadratic: float) -> list[tuple]:
    """(document, start, length, sequence, offset) of pieces filling ``sequences`` sequences.

    ``lengths`` sum up to at least ``sequences * length``; what doesn't fit stays out: the
    ends of the shortest documents.
    """
    out = []
    whole = 0
    rest = []
    for d, n in enumerate(lengths):
        start = 0
        while n - start >= length and whole < sequences:
            out.append((d, start, length, whole, 0))
            whole += 1
            start += length
        if n > start:
            rest.append((n - start, d, start))
    rest.sort(key=lambda x: (-x[0], x[1]))
    count = sequences - whole
    cost, room = np.zeros(count), np.full(count, length, np.int64)
    left = count * length
    for n, d, start in rest:
        while n and left:
            fits = np.flatnonzero(room >= n)
            if fits.size:
                s, take = int(fits[np.argmin(cost[fits])]), n
            else:
                s = int(np.argmax(room))
                take = int(room[s])
            out.append((d, start, take, whole + s, int(length - room[s])))
            cost[s] += linear * take + quadratic * take * take
            room[s] -= take
            left -= take
            start += take
            n -= take
    return out


def _tail(lengths: list[int], length: int) -> list[tuple]:
    """Pieces of all ids, in order, into sequences of descending powers of two."""
    total = sum(lengths)
    sizes = [length] * (total // length)
    sizes += [1 << i for i in range((total % length).bit_length() - 1, -1, -1) if total % length >> i & 1]
    out, d, start = [], 0, 0
    for s, size in enumerate(sizes):
        offset = 0
        while offset < size:
            if start == lengths[d]:
                d, start = d + 1, 0
                continue
            take = min(size - offset, lengths[d] - start)
            out.append((d, start, take, s, offset))
            offset += take
            start += take
    return out


def pack(
    docs: DataFrame, tokenizer_file: str, id_col: str = "doc_id", text_col: str = "text",
    length: int = LENGTH, end_id: int = END_ID, block: int = BLOCK,
    linear: float = LINEAR_COST, quadratic: float = QUADRATIC_COST,
) -> DataFrame:
    """Pieces: ``doc_id, start, length, doc_tokens, sequence_id, offset, ids`` (LE 32-bit bytes).

    Null and empty texts are documents of the end id alone. Rows with equal or null ids
    are documents of their own. An empty table gives no piece. Other columns are ignored.
    """
    python_ready(docs)
    if length < 1 or length & (length - 1):
        raise ValueError("length must be a power of two")
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode = encoder(tokenizer_file).encode
        first = TaskContext.get().partitionId() << 33
        held: list[tuple] = []  # (doc_id, ids not yet packed, ids before them, ids of the document)
        tokens = 0

        def emit(pieces: list[tuple]) -> pa.RecordBatch:
            cols = [
                pa.array([held[d][0] for d, *_ in pieces], pa.int64()),
                pa.array([held[d][2] + start for d, start, *_ in pieces], pa.int64()),
                pa.array([n for _, _, n, _, _ in pieces], pa.int64()),
                pa.array([held[d][3] for d, *_ in pieces], pa.int64()),
                pa.array([first + s for *_, s, _ in pieces], pa.int64()),
                pa.array([o for *_, o in pieces], pa.int64()),
                pa.array([held[d][1][4 * start : 4 * (start + n)] for d, start, n, _, _ in pieces], pa.binary()),
            ]
            return pa.RecordBatch.from_arrays(cols, NAMES)

        for batch in batches:
            for part in range(0, batch.num_rows, TEXTS):
                cut = batch.slice(part, TEXTS)
                for doc_id, ids in zip(cut.column(0).to_pylist(), encode(cut.column(1).to_pylist())):
                    ids += end
                    held.append((doc_id, ids, 0, len(ids) // 4))
                    tokens += len(ids) // 4
                while tokens >= block * length:
                    pieces = pack_block([len(h[1]) // 4 for h in held], length, block, linear, quadratic)
                    yield emit(pieces)
                    first += block
                    tokens -= block * length
                    done = [0] * len(held)
                    for d, start, n, *_ in pieces:
                        done[d] = max(done[d], start + n)
                    held = [(i, ids[4 * k :], at + k, n) for (i, ids, at, n), k in zip(held, done) if 4 * k < len(ids)]
        if held:
            lengths = [len(h[1]) // 4 for h in held]
            full = sum(lengths) // length
            pieces = pack_block(lengths, length, full, linear, quadratic) if full else []
            yield from ([emit(pieces)] if pieces else [])
            done = [0] * len(held)
            for d, start, n, *_ in pieces:
                done[d] = max(done[d], start + n)
            held = [(i, ids[4 * k :], at + k, n) for (i, ids, at, n), k in zip(held, done) if 4 * k < len(ids)]
            first += full
            if held:
                yield emit(_tail([len(h[1]) // 4 for h in held], length))

    return rows.mapInArrow(run, SCHEMA)


NAMES = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]
SCHEMA = "doc_id bigint, start bigint, length bigint, doc_tokens bigint, sequence_id bigint, offset bigint, ids binary"
