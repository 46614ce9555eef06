"""Exact removal of long repeats by a distributed merge sort of front-coded suffix runs.

A byte goes if a ``SPAN``-byte string that covers it also starts anywhere else.

Which suffixes. Every SPAN-byte window picks an anchor: the place of the least hashed
16-byte string among its first REACH places. Equal windows pick the same place, so two
copies of a window share the suffix at their anchors for at least KEY bytes. Only the
suffixes at anchors are sorted, about one in 60. Windows with one anchor are neighbours;
together they span the anchor's context, of which a 64-bit hash follows the KEY bytes in
the sort string, so equal contexts come to lie together too.

Sort. Each task sorts its anchors' strings into runs and cuts a run at splitters (from a
sample; they decide balance, never results). What is exchanged are front-coded slices: for
each string the length shared with the one before and the rest. Slices of one range are
combined by a loser tree that keeps, for each loser, its common prefix with the string it
lost to: of two strings, the one that shares more with the last output is smaller, and only
equal shares are compared, from there on. The prefix between neighbours falls out of it.

Verdicts. Equal context: all its windows repeat. Alone in its KEY: none does. Others
(contexts that agree around the anchor and differ further out) are settled by comparing
hashes of their windows within the KEY, where one context stands for its equals. Equal
strings within a run are settled before the exchange. Groups of very many different
contexts are settled window by window, again as sorted runs that are cut into ranges and
hold each window once, so no task holds a whole group.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adtally.llm.shared import python_ready, written

SPAN = 200
GRAM = 16
REACH = 145
KEY = SPAN - REACH + 1
#: Bytes of a sort string: the key and the hash of the context.
WIDTH = KEY + 8
#: Bytes worked on at once, and anchors in a run.
PIECE = 1 << 18
RUN = 1 << 17
#: Documents (their first bytes) that the splitters are taken from, about.
SAMPLE_DOCS, SAMPLE_BYTES = 1000, 4096
#: Bytes of text for each range and for each task that merges ranges, on average.
RANGE_BYTES, TASK_BYTES = 16 << 20, 64 << 20
#: Different contexts of one key beyond which the key is settled by aggregation.
LARGE = 512
#: Buckets of document hashes; a bounded broadcast that spares untouched texts the shuffle.
BUCKETS = 1 << 18

_C1, _C2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_SETTLED, _OPEN, _WITNESS = 0, 1, 2


# --- hashes and anchors ------------------------------------------------------------------


@cache
def _powers() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A random number for each byte; powers of an odd base, and of its inverse, mod 2**64."""
    n = 2 * PIECE + 4 * SPAN
    base = 0x9E3779B97F4A7C15
    up, down = np.full(n, base, np.uint64), np.full(n, pow(base, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    byte = np.random.default_rng(1).integers(1, 1 << 63, 256, dtype=np.uint64)
    return byte, np.cumprod(up), np.cumprod(down)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(31)) * _C1
    return x ^ x >> np.uint64(29)


def _sums(data: np.ndarray) -> np.ndarray:
    byte, up, _ = _powers()
    return np.concatenate((np.zeros(1, np.uint64), np.cumsum(byte[data] * up[: len(data)])))


def _hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the strings from start to end; equal strings have equal hashes anywhere."""
    return _mix((sums[end] - sums[start]) * _powers()[2][start])


def anchors(parts: list[bytes]) -> tuple[np.ndarray, ...]:
    """(part, first window, last window, sort strings) of the anchors of all windows of ``parts``.

    Window places count from the part's beginning.
    """
    sizes = np.array([len(p) for p in parts], np.int64)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    n = int(ends[-1]) if len(parts) else 0
    edges = np.zeros(n + 1, np.int32)
    some = sizes >= SPAN
    np.add.at(edges, starts[some], 1)
    np.add.at(edges, ends[some] - SPAN + 1, -1)
    windows = np.flatnonzero(np.cumsum(edges)[:n] > 0)
    if not windows.size:
        empty = np.empty(0, np.int64)
        return empty, empty, empty, np.empty((0, WIDTH), np.uint8)
    raw = b"".join(parts) + bytes(16)
    data = np.frombuffer(raw, np.uint8)
    eights = np.ndarray((n + 9,), "<u8", raw, strides=(1,))
    grams = eights[: n - GRAM + 1] * _C1 ^ (eights[8 : n - GRAM + 9] * _C2 >> np.uint64(1))
    grams = (grams ^ grams >> np.uint64(29)) * _C2
    # the place in the low bits: the leftmost of equal hashes is the least
    keys = grams >> np.uint64(20) << np.uint64(20) | np.arange(len(grams), dtype=np.uint64)
    padded = np.full(-(-len(keys) // REACH) * REACH, (1 << 64) - 1, np.uint64)
    padded[: len(keys)] = keys
    padded = padded.reshape(-1, REACH)
    before = np.minimum.accumulate(padded, axis=1).ravel()
    after = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(after[windows], before[windows + REACH - 1])
    at = (least & np.uint64((1 << 20) - 1)).astype(np.int64)
    cut = np.flatnonzero(np.concatenate(([True], (at[1:] != at[:-1]) | (windows[1:] != windows[:-1] + 1))))
    first, last = windows[cut], windows[np.append(cut[1:], len(windows)) - 1]
    at = at[cut]
    context = _hash(_sums(data[:n]), first, last + SPAN)
    strings = np.empty((len(at), WIDTH), np.uint8)
    strings[:, :KEY] = np.lib.stride_tricks.sliding_window_view(data, KEY)[at]
    strings[:, KEY:] = context.astype(">u8").view(np.uint8).reshape(-1, 8)
    part = np.searchsorted(ends, first, "right")
    return part, first - starts[part], last - starts[part], strings


def _cut(texts: Iterator[tuple[int, bytes]]) -> Iterator[list[tuple[int, int, bytes]]]:
    """Lists of (row, offset, bytes) of bounded size; each window lies in one piece."""
    held, size = [], 0
    for row, data in texts:
        for start in range(0, max(len(data) - SPAN + 1, 0), PIECE):
            held.append((row, start, data[start : start + PIECE + SPAN - 1]))
            size += len(held[-1][2])
            if size >= PIECE:
                yield held
                held, size = [], 0
    if held:
        yield held


# --- runs --------------------------------------------------------------------------------

_FIELDS = (("k1", "<i8"), ("k2", "<i8"), ("first", "<i8"), ("extra", "u1"), ("weight", "u1"))


def _shared(strings: np.ndarray) -> np.ndarray:
    """Bytes that each row shares with the row before (0 for the first)."""
    same = strings[1:] == strings[:-1]
    out = np.where(same.all(axis=1), strings.shape[1], same.argmin(axis=1))
    return np.concatenate(([0], out)).astype(np.uint8)


def _compressed(kind: int, n: int, *parts: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(struct.pack("<BI", kind, n) + b"".join(parts))


def front_coded(strings: np.ndarray, fields: dict[str, np.ndarray]) -> bytes:
    """A sorted slice: shared lengths, the rests, and what goes along with each string."""
    shared = _shared(strings)
    rests = strings[np.arange(strings.shape[1]) >= shared[:, None]]
    return _compressed(1, len(strings), shared.tobytes(), rests.tobytes(), *(fields[f].astype(t).tobytes() for f, t in _FIELDS))


def decoded(data: bytes) -> tuple[list[bytes], list[int], dict[str, np.ndarray]]:
    """What front_coded() was given, and the shared lengths; ``data`` is uncompressed."""
    n = struct.unpack_from("<I", data, 1)[0]
    at = 5
    shared = data[at : at + n]
    at += n
    strings, last = [], b""
    for s in shared:
        rest = WIDTH - s
        last = last[:s] + data[at : at + rest]
        at += rest
        strings.append(last)
    fields = {}
    for f, t in _FIELDS:
        fields[f] = np.frombuffer(data, t, n, at)
        at += fields[f].nbytes
    return strings, list(shared), fields


def _joined_spans(k1, k2, first, end) -> tuple[np.ndarray, ...]:
    """Spans (k1, k2, first, end), those of a document that touch or overlap made one."""
    order = np.lexsort((first, k2, k1))
    k1, k2, first, end = k1[order], k2[order], first[order], end[order]
    if not len(first):
        return k1, k2, first, end
    new_doc = np.concatenate(([True], (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])))
    # reach of all spans before, counted anew in each document by lifting documents apart
    lift = np.cumsum(new_doc) * (int(end.max()) + 1)
    reach = np.maximum.accumulate(end + lift)
    cut = np.flatnonzero(np.concatenate(([True], new_doc[1:] | (first[1:] + lift[1:] > reach[:-1]))))
    return k1[cut], k2[cut], first[cut], (reach - lift)[np.append(cut[1:], len(first)) - 1]


def _run_slices(strings, fields, splitters: np.ndarray, number: int) -> Iterator[tuple[int, bytes]]:
    """(range, slice) of one run; strings that repeat in the run are settled here."""
    columns = strings.view(">u8").astype(np.uint64)
    order = np.lexsort(columns.T[::-1])
    strings = strings[order]
    fields = {f: v[order] for f, v in fields.items()}
    cut = np.flatnonzero(np.concatenate(([True], (strings[1:] != strings[:-1]).any(axis=1))))
    count = np.diff(np.append(cut, len(strings)))
    again = np.repeat(count > 1, count)
    if again.any():
        spans = _joined_spans(*(fields[f][again] for f in ("k1", "k2", "first")), (fields["first"] + fields["extra"] + SPAN)[again])
        yield number % (len(splitters) + 1), _compressed(0, len(spans[0]), *(s.astype("<i8").tobytes() for s in spans))
    fields = {f: v[cut] for f, v in fields.items()} | {"weight": np.minimum(count, 2)}
    strings = np.ascontiguousarray(strings[cut])
    places = np.searchsorted(strings.view(f"S{WIDTH}").ravel(), splitters)
    bounds = [0, *places.tolist(), len(strings)]
    for p, (a, b) in enumerate(zip(bounds, bounds[1:])):
        if a < b:
            yield p, front_coded(strings[a:b], {f: v[a:b] for f, v in fields.items()})


def _sort(splitters: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId()
        held, size = [], 0

        def slices() -> pa.RecordBatch:
            strings = np.concatenate([s for s, _ in held])
            fields = {f: np.concatenate([x[f] for _, x in held]) for f in ("k1", "k2", "first", "extra")}
            found = list(_run_slices(strings, fields, splitters, number))
            return pa.RecordBatch.from_arrays(
                [pa.array([p for p, _ in found], pa.int32()), pa.array([s for _, s in found], pa.binary())], ["range", "slice"]
            )

        for batch in batches:
            k1, k2 = (batch.column(c).to_numpy(zero_copy_only=False) for c in (0, 1))
            texts = ((i, x.as_buffer().to_pybytes()) for i, x in enumerate(batch.column(2).cast(pa.binary())))
            for pieces in _cut(texts):
                part, first, last, strings = anchors([p[2] for p in pieces])
                row = np.array([p[0] for p in pieces], np.int64)[part]
                offset = np.array([p[1] for p in pieces], np.int64)[part]
                held.append((strings, {"k1": k1[row], "k2": k2[row], "first": first + offset, "extra": last - first}))
                size += len(part)
                if size >= RUN:
                    yield slices()
                    held, size, number = [], 0, number + 1
        if size:
            yield slices()

    return run


# --- merge -------------------------------------------------------------------------------


def merged(runs: list[tuple[list[int], list[int]]], width: int = WIDTH) -> Iterator[tuple[int, int, int]]:
    """(bytes shared with the output before, run, place in it) of all strings in order.

    A run is its sorted strings as big-endian numbers and their shared lengths. ``share``
    holds for each run's next string its common prefix with the last output: exactly, as
    front coding gives it to the winner's successor, and as each lost match left it.
    """
    k = 1
    while k < len(runs):
        k *= 2
    bits = 8 * width
    value = [r[0][0] if r[0] else 0 for r in runs] + [0] * (k - len(runs))
    share = [0 if r[0] else -1 for r in runs] + [-1] * (k - len(runs))
    place = [0] * k
    losers, winners = [0] * k, list(range(k)) if k > 1 else [0]
    level = [0] * k + winners
    for node in range(k - 1, 0, -1):
        a, b = level[2 * node], level[2 * node + 1]
        if share[a] == share[b] >= 0:
            if value[a] > value[b]:
                a, b = b, a
            share[b] = (bits - (value[a] ^ value[b]).bit_length()) >> 3
        elif share[a] < share[b]:
            a, b = b, a
        level[node], losers[node] = a, b
    w = level[1]
    while share[w] >= 0:
        yield share[w], w, place[w]
        strings, shared = runs[w]
        place[w] += 1
        if place[w] < len(strings):
            value[w], share[w] = strings[place[w]], shared[place[w]]
        else:
            share[w] = -1
        node = (w + k) >> 1
        while node:
            other = losers[node]
            mine, its = share[w], share[other]
            if mine == its:
                if mine >= 0:
                    x, y = value[w], value[other]
                    if y < x:
                        share[w] = (bits - (x ^ y).bit_length()) >> 3
                        losers[node], w = w, other
                    else:
                        share[other] = (bits - (x ^ y).bit_length()) >> 3
            elif mine < its:
                losers[node], w = w, other
            node >>= 1


_MERGED = "kind int, large boolean, key bigint, k1 bigint, k2 bigint, first bigint, extra int"


def _merged_batch(kind, large, key, k1, k2, first, extra) -> pa.RecordBatch:
    types = (pa.int32(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32())
    arrays = [pa.array(np.ascontiguousarray(v), t) for v, t in zip((kind, large, key, k1, k2, first, extra), types)]
    return pa.RecordBatch.from_arrays(arrays, [c.split()[0] for c in _MERGED.split(", ")])


def merge_range(slices: list[bytes], split_keys: set[bytes]) -> pa.RecordBatch | None:
    """Verdicts on the strings of one range; keys in ``split_keys`` go on in other ranges."""
    parts = [decoded(s) for s in slices]
    if not parts:
        return None
    runs = [([int.from_bytes(s, "big") for s in strings], shared) for strings, shared, _ in parts]
    order = np.array(list(merged(runs)), np.int64)
    base = np.cumsum([0] + [len(p[0]) for p in parts])
    at = base[order[:, 1]] + order[:, 2]
    fields = {f: np.concatenate([p[2][f] for p in parts])[at] for f, _ in _FIELDS}
    n = len(at)
    new_pair, new_key = order[:, 0] < WIDTH, order[:, 0] < KEY
    new_pair[0] = new_key[0] = True
    pair, group = np.cumsum(new_pair) - 1, np.cumsum(new_key) - 1
    many = np.bincount(pair, fields["weight"])[pair] >= 2
    contexts = np.bincount(group[new_pair])
    strings = [s for p in parts for s in p[0]]
    split = np.zeros(len(contexts), bool)
    if split_keys:
        split = np.array([strings[i][:KEY] in split_keys for i in at[new_key]])
    unsettled = (contexts >= 2) | split
    unsettled &= (np.bincount(group[new_pair], ~many[new_pair]) > 0) | split
    large = ((contexts > LARGE) | split)[group]
    settled = many & (fields["weight"] == 1)
    opened = ~many & unsettled[group]
    witness = many & new_pair & unsettled[group]
    kind = np.concatenate([np.full(int(m.sum()), k) for k, m in ((_SETTLED, settled), (_OPEN, opened), (_WITNESS, witness))])
    rows = np.concatenate([np.flatnonzero(m) for m in (settled, opened, witness)])
    if not n or not len(rows):
        return None
    heads = np.frombuffer(b"".join(strings[i][:KEY] for i in at[new_key]), np.uint8).reshape(-1, KEY)
    byte, up, _ = _powers()
    key = _mix((byte[heads] * up[:KEY]).sum(axis=1, dtype=np.uint64)).view(np.int64)[group]
    return _merged_batch(kind, large[rows], key[rows], *(fields[f][rows] for f in ("k1", "k2", "first", "extra")))


def _merge(split_keys: set[bytes]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        unpack = zstandard.ZstdDecompressor().decompress
        now, held = None, []
        for batch in batches:
            for number, packed in zip(batch.column(0).to_pylist(), batch.column(1)):
                data = unpack(packed.as_buffer())
                if number != now:
                    if (out := merge_range(held, split_keys)) is not None:
                        yield out
                    now, held = number, []
                if data[0] == 1:
                    held.append(data)
                    continue
                n = struct.unpack_from("<I", data, 1)[0]
                k1, k2, first, end = np.frombuffer(data, "<i8", 4 * n, 5).reshape(4, n)
                zero = np.zeros(n, np.int64)
                yield _merged_batch(zero, zero.astype(bool), zero, k1, k2, first, end - first - SPAN)
        if (out := merge_range(held, split_keys)) is not None:
            yield out

    return run


# --- open contexts -----------------------------------------------------------------------

_CONTEXT = "large boolean, key bigint, kind int, k1 bigint, k2 bigint, first bigint, data binary"


def window_hashes(contexts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(context, place in it, hash) of every window of each context."""
    sizes = np.array([len(c) for c in contexts], np.int64)
    ends = np.cumsum(sizes)
    count = sizes - SPAN + 1
    which = np.repeat(np.arange(len(contexts)), count)
    place = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
    out = np.empty(len(place), np.uint64)
    start = 0
    while start < len(contexts):  # as many contexts at a time as the powers reach
        stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + PIECE, "right")))
        low = ends[start] - sizes[start]
        sums = _sums(np.frombuffer(b"".join(contexts[start:stop]), np.uint8))
        mine = (which >= start) & (which < stop) if start or stop < len(contexts) else slice(None)
        begin = (ends - sizes - low)[which[mine]] + place[mine]
        out[mine] = _hash(sums, begin, begin + SPAN)
        start = stop
    return which, place, out


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of each open or witness context, from (k1, k2, text, list of contexts)."""
    for batch in batches:
        k1s, k2s = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        rows = []
        for k1, k2, text, wanted in zip(k1s, k2s, batch.column(2).cast(pa.binary()), batch.column(3)):
            data = text.as_buffer().to_pybytes()
            for w in wanted.as_py():
                context = data[w["first"] : w["first"] + w["extra"] + SPAN]
                rows.append((w["large"], w["key"], w["kind"], k1, k2, w["first"], context))
        names = [c.split()[0] for c in _CONTEXT.split(", ")]
        types = (pa.bool_(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
        for start in range(0, len(rows), 1 << 15):
            columns = zip(*rows[start : start + (1 << 15)])
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], names)


def _spans_batch(k1, k2, first, end) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(v), pa.int64()) for v in (k1, k2, first, end)], ["k1", "k2", "first", "end"])


_SPANS = "k1 bigint, k2 bigint, first bigint, end bigint"


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans of repeated windows of open contexts, from contexts sorted by key."""

    def done(t: pa.Table) -> pa.RecordBatch:
        column = lambda c: t.column(c).to_numpy()
        which, place, hashes = window_hashes(t.column("data").to_pylist())
        hashes = _mix(hashes ^ column("key").view(np.uint64)[which] * _C2)
        weight = np.where(column("kind") == _WITNESS, 2, 1)[which]
        _, at = np.unique(hashes, return_inverse=True)
        hit = (np.bincount(at, weight)[at] >= 2) & (weight == 1)
        which, first = which[hit], column("first")[which[hit]] + place[hit]
        return _spans_batch(*_joined_spans(column("k1")[which], column("k2")[which], first, first + SPAN))

    held: list[pa.RecordBatch] = []
    for batch in batches:
        for start in range(0, batch.num_rows, 1 << 13):
            held.append(batch.slice(start, 1 << 13))
            t = pa.Table.from_batches(held)
            keys = t.column("key").to_numpy()
            # the last key may go on
            whole = int(np.searchsorted(keys, keys[-1]))
            if whole >= 1 << 12:
                yield done(t.slice(0, whole))
                held = t.slice(whole).to_batches()
    if held:
        yield done(pa.Table.from_batches(held))


_OPEN_WINDOW = np.dtype([("hash", "<u8"), ("weight", "<i8"), ("k1", "<i8"), ("k2", "<i8"), ("first", "<i8")])


def _windows(ranges: int):
    """Runs of the windows of contexts of large keys, cut into equal ranges of their hashes.

    A window that a run holds twice is settled there: its spans come out joined, and one
    entry of weight 2 stands for all of them elsewhere. Others go on with their place.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId()
        for batch in batches:
            for start in range(0, batch.num_rows, 1 << 14):
                part = batch.slice(start, 1 << 14)
                which, place, hashes = window_hashes(part.column(6).to_pylist())
                column = lambda c, part=part: part.column(c).to_numpy(zero_copy_only=False)
                hashes = _mix(hashes ^ column(1).view(np.uint64)[which] * _C2)
                weight = np.where(column(2) == _WITNESS, 2, 1)[which]
                k1, k2, first = column(3)[which], column(4)[which], column(5)[which] + place
                unique, one, at = np.unique(hashes, return_index=True, return_inverse=True)
                total = np.bincount(at, weight)
                hit = (total[at] >= 2) & (weight == 1)
                spans = _joined_spans(k1[hit], k2[hit], first[hit], first[hit] + SPAN)
                entries = np.empty(len(unique), _OPEN_WINDOW)
                for f, v in (("hash", unique), ("weight", np.minimum(total, 2)), ("k1", k1[one]), ("k2", k2[one]), ("first", first[one])):
                    entries[f] = v
                numbers = [number % ranges]
                slices = [_compressed(0, len(spans[0]), *(s.astype("<i8").tobytes() for s in spans))]
                of = ((unique >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)
                cuts = np.searchsorted(of, np.arange(ranges + 1))
                for r in np.flatnonzero(cuts[1:] > cuts[:-1]).tolist():
                    numbers.append(r)
                    slices.append(_compressed(1, int(cuts[r + 1] - cuts[r]), entries[cuts[r] : cuts[r + 1]].tobytes()))
                yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int32()), pa.array(slices, pa.binary())], ["range", "slice"])
                number += 1

    return run


def _settle_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans that come settled, and those of windows that two runs hold, range by range."""
    import zstandard

    unpack = zstandard.ZstdDecompressor().decompress
    now, held = None, []

    def done() -> pa.RecordBatch:
        rows = np.concatenate(held)
        _, at = np.unique(rows["hash"], return_inverse=True)
        rows = rows[(rows["weight"] == 1) & (np.bincount(at, rows["weight"])[at] >= 2)]
        return _spans_batch(*_joined_spans(rows["k1"], rows["k2"], rows["first"], rows["first"] + SPAN))

    for batch in batches:
        for number, packed in zip(batch.column(0).to_pylist(), batch.column(1)):
            data = unpack(packed.as_buffer())
            if number != now:
                if held:
                    yield done()
                now, held = number, []
            n = struct.unpack_from("<I", data, 1)[0]
            if data[0] == 1:
                held.append(np.frombuffer(data, _OPEN_WINDOW, n, 5))
            else:
                yield _spans_batch(*np.frombuffer(data, "<i8", 4 * n, 5).reshape(4, n))
    if held:
        yield done()


# --- operator ----------------------------------------------------------------------------


def _cover(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, n_bytes, spans (joined), kept bytes, from (doc_id, text, spans)."""
    for batch in batches:
        for begin in range(0, batch.num_rows, 512):
            part = batch.slice(begin, 512)
            out = {"n_bytes": [], "n_removed": [], "n_spans": [], "kept": []}
            for text, spans in zip(part.column(1).cast(pa.binary()), part.column(2)):
                data = text.as_buffer().to_pybytes()
                first = spans.values.field("first").to_numpy(zero_copy_only=False)
                end = spans.values.field("end").to_numpy(zero_copy_only=False)
                same = np.zeros(len(first), np.int64)
                _, _, first, end = _joined_spans(same, same, first, end)
                bounds = [0, *np.stack([first, end], axis=1).ravel().tolist(), len(data)]
                kept = b"".join(data[a:b] for a, b in zip(bounds[::2], bounds[1::2]))
                for f, v in zip(out, (len(data), len(data) - len(kept), len(first), kept)):
                    out[f].append(v)
            types = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [part.column(0), *(pa.array(v, t) for v, t in zip(out.values(), types))], ["doc_id", *out]
            )


def _splitters(rows: DataFrame, n: int, ranges: int) -> np.ndarray:
    """Sorted strings that cut the anchors of sampled texts into ``ranges`` equal parts.

    ``rows`` are the ``n`` whose texts have anchors.
    """
    # where a stretch begins follows from the text, so all parts of texts are sampled
    begins = F.pmod(F.xxhash64("text"), F.greatest(F.octet_length("text") - SAMPLE_BYTES, F.lit(0)) + 1) + 1
    part = F.substring(F.encode("text", "UTF-8"), begins.cast("int"), F.lit(SAMPLE_BYTES))
    texts = rows.select(part.alias("t")).sample(min(1.0, SAMPLE_DOCS / max(n, 1)), seed=7).limit(2 * SAMPLE_DOCS)
    parts = [s for chunk in _cut(enumerate(bytes(r.t) for r in texts.collect())) for s in [anchors([p[2] for p in chunk])[3]]]
    strings = np.sort(np.concatenate(parts).view(f"S{WIDTH}").ravel()) if parts else np.empty(0, f"S{WIDTH}")
    return strings[np.unique(np.linspace(0, len(strings) - 1, ranges + 1).astype(int)[1:-1])] if len(strings) else strings


def repeated_spans(rows: DataFrame) -> DataFrame:
    """``k1, k2, first, end``: byte spans to remove, from ``rows (k1, k2, text)`` without nulls.

    Spans of a document may overlap. A task holds a range's slices, LARGE contexts of one
    key, or one document. Ranges and tasks grow with the bytes counted; how even the ranges
    are depends on the sampled splitters.
    """
    spark = python_ready(rows)
    some = rows.filter(F.octet_length("text") >= SPAN)
    n, size = some.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0))).first()
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = max(4 * tasks, size // RANGE_BYTES)
    tasks = max(tasks, size // TASK_BYTES)
    splitters = _splitters(some, n, ranges)
    split_keys = {bytes(s).ljust(WIDTH, b"\0")[:KEY] for s in splitters}
    slices = rows.select("k1", "k2", "text").mapInArrow(_sort(splitters), "range int, slice binary")
    ordered = slices.repartition(tasks, "range").sortWithinPartitions("range")
    verdicts = written(ordered.mapInArrow(_merge(split_keys), _MERGED), "verdicts")

    settled = verdicts.filter(F.col("kind") == _SETTLED).select("k1", "k2", "first", (F.col("first") + F.col("extra") + SPAN).alias("end"))
    wanted = verdicts.filter(F.col("kind") != _SETTLED)
    wanted = wanted.groupBy("k1", "k2").agg(F.collect_list(F.struct("large", "key", "kind", "first", "extra")).alias("wanted"))
    touched = _in_buckets(rows.select("k1", "k2", "text"), verdicts.filter(F.col("kind") != _SETTLED))
    contexts = written(touched.join(wanted.hint("shuffle_hash"), ["k1", "k2"]).mapInArrow(_contexts, _CONTEXT), "contexts")

    by_key = contexts.filter("not large").repartition("key").sortWithinPartitions("key").mapInArrow(_settle, _SPANS)
    windows = contexts.filter("large").mapInArrow(_windows(ranges), "range int, slice binary")
    by_hash = windows.repartition(tasks, "range").sortWithinPartitions("range").mapInArrow(_settle_windows, _SPANS)
    return settled.unionByName(by_key).unionByName(by_hash)


def _bucket(k2: str = "k2") -> Column:
    return F.pmod(F.col(k2), F.lit(BUCKETS)).cast("int")


def _in_buckets(rows: DataFrame, marked: DataFrame, how: str = "left_semi") -> DataFrame:
    """Rows whose hash falls into a bucket of ``marked``; at most BUCKETS numbers are broadcast."""
    buckets = marked.select(_bucket().alias("bucket")).distinct()
    return rows.join(F.broadcast(buckets), _bucket() == F.col("bucket"), how)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row: ``doc_id, n_bytes, n_removed, n_spans, kept`` (the remaining bytes).

    Null texts count as empty. Matches never cross documents; rows that repeat are copies of
    each other, and lose all that a 200-byte string covers. Texts under 200 bytes lose
    nothing. Null ids stay. Cuts may fall within a character, so ``kept`` is binary. Other
    columns are ignored; an empty table gives an empty result.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    # rows of equal id and text have equal spans, so the two numbers may stand for a row
    rows = rows.select("doc_id", F.coalesce("doc_id", F.lit(0)).alias("k1"), F.xxhash64("text").alias("k2"), "text")
    spans = written(repeated_spans(rows), "spans")
    each = spans.groupBy("k1", "k2").agg(F.collect_list(F.struct("first", "end")).alias("spans"))
    cut = (
        _in_buckets(rows, spans).join(each.hint("shuffle_hash"), ["k1", "k2"], "left")
        .select("doc_id", "text", F.coalesce("spans", F.array().cast("array<struct<first:bigint,end:bigint>>")).alias("spans"))
        .mapInArrow(_cover, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary")
    )
    whole = _in_buckets(rows, spans, "left_anti").select(
        "doc_id", F.octet_length("text").cast("bigint").alias("n_bytes"), F.lit(0).cast("bigint").alias("n_removed"),
        F.lit(0).cast("bigint").alias("n_spans"), F.encode("text", "UTF-8").alias("kept"),
    )
    return cut.unionByName(whole)
