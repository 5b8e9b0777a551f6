"""Token windows filled by Karmarkar-Karp multiway differencing.

Each task packs the documents of its partition in groups of some hundred windows, so no
text is shuffled and work space is one group. A document longer than a window first fills
whole windows of its own; what is left over, and shorter documents, are the parts of a
group. Part sizes are differenced: the two partial partitions with the greatest imbalance
are merged, the largest sums of one onto the smallest of the other, until one k-way
partition is left. If a window exceeds the capacity, more is kept back (below) or k rises, and
the group is done again.

Differencing levels windows only as finely as its smallest parts, so the longest leftovers, a
twelfth of the tokens, are kept back: once the rest is differenced, each window is filled up by
one cut of them (two where one text ends), of some 170 tokens. What would leave a window nearly
empty is cut off as sequences of a power of two, which need no padding.

Groups follow the input's partitions and row order, so another reading of the same files may
cut other pieces; each is whole and correct.

Empty and NULL texts are the end id alone. NULL and repeated document ids are rows like any
other; a partition without rows makes no windows. Each id lies in exactly one piece.
"""

import heapq
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from hazline.llm.common import SLICE, bigint, lean, slices, texts
from hazline.llm.tokens import shared_encoder

PIECES = T.StructType(
    [
        *map(bigint, "doc_id start length ids_crc32 doc_tokens sequence_id offset".split()),
        T.StructField("ids", T.BinaryType()),
    ]
)


def difference(sizes: list[int], k: int) -> tuple[np.ndarray, np.ndarray]:
    """Window number of each part and the sum of each of k windows, by multiway differencing.

    A partial partition is its non-empty sums in descending order with the tree node of each;
    a node above the parts joins two nodes. Ties go to the partition made first.
    """
    n = len(sizes)
    if k <= 1 or n == 0:
        return np.zeros(n, np.int64), np.array([sum(sizes)] * max(k, 0), np.int64)
    left, right = np.zeros(max(1, n), np.int64), np.zeros(max(1, n), np.int64)
    nodes = n
    heap = [
        (-size, at, np.array([size], np.int64), np.array([at], np.int64))
        for at, size in enumerate(sizes)
    ]
    heapq.heapify(heap)
    turn = n
    while len(heap) > 1:
        _, _, a, a_node = heapq.heappop(heap)
        _, _, b, b_node = heapq.heappop(heap)
        shared = len(a) + len(b) - k
        if shared > 0:
            split_a, split_b = len(a) - shared, len(b) - shared
            fresh = np.arange(nodes, nodes + shared)
            left[fresh - n] = a_node[split_a:]
            right[fresh - n] = b_node[split_b:][::-1]
            sums = np.concatenate([a[:split_a], b[:split_b], a[split_a:] + b[split_b:][::-1]])
            node = np.concatenate([a_node[:split_a], b_node[:split_b], fresh])
            nodes += shared
        else:
            sums, node = np.concatenate([a, b]), np.concatenate([a_node, b_node])
        order = np.argsort(-sums, kind="stable")
        sums, node = sums[order], node[order]
        gap = int(sums[0]) - (int(sums[-1]) if len(sums) == k else 0)
        heapq.heappush(heap, (-gap, turn, sums, node))
        turn += 1
    _, _, sums, node = heap[0]
    window = np.full(nodes, -1, np.int64)
    window[node] = np.arange(len(node))
    for joined in range(nodes - 1, n - 1, -1):
        window[left[joined - n]] = window[right[joined - n]] = window[joined]
    totals = np.zeros(k, np.int64)
    totals[: len(sums)] = sums
    return window[:n], totals


def _cut(texts: list[tuple], need: int) -> list[tuple]:
    """The next need tokens off the end of a list of (document, start, length) parts."""
    taken = []
    while need and texts:
        doc, start, length = texts.pop()
        take = min(need, length)
        taken.append((doc, start, take))
        if take < length:
            texts.append((doc, start + take, length - take))
        need -= take
    return taken


def pack_group(parts: list[tuple], capacity: int, reserve: int = 12) -> list[list[tuple]]:
    """Windows of (document, start, length) parts; every window within capacity."""
    windows: list[list[tuple]] = []
    total = sum(length for _, _, length in parts)
    parts = sorted(parts, key=lambda p: (p[2], p[0], p[1]))
    k, spare = divmod(total, capacity)
    # sequences of a power of two, down to one token where there is no window
    spare = -(-spare // 64) * 64 if k else spare
    if spare == capacity:
        k, spare = k + 1, 0
    for bit in (1 << n for n in reversed(range(capacity.bit_length() - 1)) if spare >> n & 1):
        windows.append(_cut(parts, bit))
    if not parts:
        return windows
    parts.sort(key=lambda p: (p[2], p[0], p[1]))
    least = -(-sum(length for _, _, length in parts) // capacity)
    k = max(k, least)
    share = reserve
    while True:
        # the longest texts are kept back to fill the windows up
        target, held, kept = k * capacity // share, 0, len(parts)
        while kept and held < target:
            kept -= 1
            held += parts[kept][2]
        at, sums = difference([length for _, _, length in parts[:kept]], k)
        if sums.max(initial=0) <= capacity:
            break
        if share > 3:
            share //= 2
        else:
            k += 1
    filled: list[list[tuple]] = [[] for _ in range(k)]
    for part, window in zip(parts[:kept], at.tolist(), strict=True):
        filled[window].append(part)
    rest = parts[kept:]
    for window, size in sorted(zip(filled, sums.tolist(), strict=True), key=lambda each: -each[1]):
        window += _cut(rest, capacity - size)
    return windows + [sorted(w) for w in filled if w]


def pack(
    docs: DataFrame,
    tokenizer: str,
    split: str,
    end_id: int,
    capacity: int = 2048,
    group_windows: int = 256,
    ids: bool = True,
) -> DataFrame:
    """Pieces (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids)."""
    if capacity < 128 or capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two of 128 or more")
    names = [field.name for field in PIECES]
    kinds = pa.schema([(n, pa.binary() if n == "ids" else pa.int64()) for n in names])

    def run(batches):
        sequence = TaskContext.get().partitionId() << 40
        encoder = shared_encoder(tokenizer, split)
        parts, held, waiting = [], {}, 0
        rows: list[tuple] = []
        turn = 0

        def place(window):
            nonlocal sequence
            offset = 0
            for key, start, length in window:
                doc, data = held[key]
                body = data[4 * start : 4 * (start + length)]
                rows.append(
                    (doc, start, length, zlib.crc32(body), len(data) // 4, sequence, offset)
                    + (body if ids else None,)
                )
                offset += length
            sequence += 1

        def flush():
            columns = zip(*rows, strict=True) if rows else ([] for _ in names)
            made = pa.RecordBatch.from_arrays(
                [pa.array(list(c), kinds.field(i).type) for i, c in enumerate(columns)],
                schema=kinds,
            )
            rows.clear()
            return made

        for batch in batches:
            for first, last in slices(batch, limit=SLICE):
                piece = batch.slice(first, last - first)
                coded, bounds = encoder.encode_column(piece.column("text"), end_id)
                bounds = bounds.tolist()
                for row, doc in enumerate(piece.column("doc_id").to_pylist()):
                    n = bounds[row + 1] - bounds[row]
                    held[turn] = doc, coded[bounds[row] : bounds[row + 1]].tobytes()
                    whole = n - n % capacity
                    for start in range(0, whole, capacity):
                        place([(turn, start, capacity)])
                    if n > whole:
                        parts.append((turn, whole, n - whole))
                        waiting += n - whole
                    else:
                        del held[turn]
                    turn += 1
                    if waiting >= group_windows * capacity:
                        for window in pack_group(parts, capacity):
                            place(window)
                        parts, held, waiting = [], {}, 0
                        yield flush()
                if len(rows) > 4096 or ids:
                    yield flush()
        for window in pack_group(parts, capacity) if parts else []:
            place(window)
        yield flush()

    return texts(docs).mapInArrow(lean(run), PIECES)
