"""Hierarchical packing of documents into sequences of several lengths.

Documents are routed to the shortest tier (context size) that holds them; whole windows of the
longest tier are cut off long documents first. Each tier's windows open with a document of that
tier; their gaps take the longest documents of shorter tiers that fit, and the last gap takes the
head of one. So every window is full, and only the last tokens of a task are padded. Windows are
then dealt to steps of equal token counts.
"""

import heapq
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sunsieve.llm.common import Batches, runs, text_of
from sunsieve.llm.tokenizer import word_bpe

#: Lengths of sequences, all powers of two.
TIERS = (512, 1024, 2048, 4096)
#: Tokens that a task holds before it packs them.
POOL_TOKENS = 1 << 20
#: Text that is tokenized at once.
RUN_BYTES = 1 << 19
#: Tokens of a step group: so many long windows, or as many tokens in shorter ones.
STEP_TOKENS = 16 * 4096
#: What a last rest is cut into, down to this length; the remainder is one padded sequence.
LEAST = 64

SCHEMA = (
    "doc_id long, start long, length long, ids binary, doc_tokens long, "
    "sequence_id long, offset long, tier int, step_group long"
)


@dataclass
class Piece:
    """Part of a document: the row it comes from and the ids it takes there."""

    row: int
    start: int
    length: int


@dataclass
class Window:
    tier: int
    pieces: list[Piece] = field(default_factory=list)
    used: int = 0

    def add(self, piece: Piece) -> None:
        self.pieces.append(piece)
        self.used += piece.length


class Shelf:
    """Pieces that wait, by length; ties by row and start."""

    def __init__(self) -> None:
        self.items: list[tuple[int, int, int]] = []

    def __len__(self) -> int:
        return len(self.items)

    def put(self, p: Piece) -> None:
        insort(self.items, (p.length, -p.row, -p.start))

    def take(self, at: int) -> Piece:
        length, row, start = self.items.pop(at)
        return Piece(-row, -start, length)

    def longest(self, most: int) -> Piece | None:
        """The longest piece of at most so many tokens."""
        at = bisect_right(self.items, (most + 1,)) - 1
        return self.take(at) if at >= 0 else None

    def shortest_over(self, least: int) -> Piece | None:
        """The shortest piece of more than so many tokens."""
        at = bisect_left(self.items, (least + 1,))
        return self.take(at) if at < len(self.items) else None


def fill(window: Window, shelf: Shelf) -> None:
    """Fill the window from the shelf: what fits, longest first, then the head of one that is cut."""
    while gap := window.tier - window.used:
        if (whole := shelf.longest(gap)) is None:
            break
        window.add(whole)
    if (gap := window.tier - window.used) and (cut := shelf.shortest_over(gap)):
        window.add(Piece(cut.row, cut.start, gap))
        shelf.put(Piece(cut.row, cut.start + gap, cut.length - gap))


def pack(lengths: list[int], tiers: tuple[int, ...] = TIERS, last: bool = True) -> tuple[list[Window], list[Piece]]:
    """Windows of documents of these lengths, and what is left for the next call (nothing at the last).

    Documents without tokens make no piece.
    """
    tiers = tuple(sorted(tiers))
    top, windows, shelves = tiers[-1], [], {t: Shelf() for t in tiers}
    for row, n in enumerate(lengths):
        start = 0
        while n - start >= top:
            windows.append(Window(top, [Piece(row, start, top)], top))
            start += top
        if n > start:
            shelves[next(t for t in tiers if t >= n - start)].put(Piece(row, start, n - start))
    # What is shorter than the tier in hand fills its gaps; what that cuts goes back among the short.
    shorter = Shelf()
    shorter.items = sorted(x for t in tiers[:-1] for x in shelves[t].items)
    left: list[Piece] = []
    for tier in reversed(tiers):
        below = max((t for t in tiers if t < tier), default=0)
        own = Shelf()
        if tier == top:
            own.items = shelves[top].items
        else:
            at = bisect_left(shorter.items, (below + 1,))
            own.items, shorter.items = shorter.items[at:], shorter.items[:at]
        while own:
            window = Window(tier)
            window.add(own.longest(tier))
            fill(window, shorter)
            if window.used < tier:  # nothing shorter is left: its own tier closes it
                fill(window, own)
                while own and len(own) and own.items[0][0] <= below:
                    shorter.put(own.take(0))
            if window.used == tier:
                windows.append(window)
            else:
                left += window.pieces
    left += [shorter.take(0) for _ in range(len(shorter))]
    if not last:
        return windows, left
    return windows + rest(left, top), []


def rest(left: list[Piece], top: int) -> list[Window]:
    """Full sequences of powers of two from the last pieces, and one padded sequence at most."""
    out, total = [], sum(p.length for p in left)
    left = sorted(left, key=lambda p: (p.row, p.start))[::-1]
    while total:
        size = min(top, 1 << (total.bit_length() - 1))
        size = size if size >= LEAST else total
        window = Window(size)
        while window.used < size:
            p = left.pop()
            room = size - window.used
            window.add(Piece(p.row, p.start, min(room, p.length)))
            if p.length > room:
                left.append(Piece(p.row, p.start + room, p.length - room))
        out.append(window)
        total -= size
    return out


def step_groups(windows: list[Window], step_tokens: int = STEP_TOKENS) -> list[int]:
    """A step for each window, so that steps hold nearly equal token counts: longest first, to the least."""
    n = max(1, -(-sum(w.used for w in windows) // step_tokens))
    loads, out = [(0, g) for g in range(n)], [0] * len(windows)
    for k in sorted(range(len(windows)), key=lambda k: (-windows[k].used, k)):
        load, g = heapq.heappop(loads)
        out[k] = g
        heapq.heappush(loads, (load + windows[k].used, g))
    return out


def pack_documents(
    docs: DataFrame,
    vocabulary: str,
    end_id: int = 2,
    tiers: tuple[int, ...] = TIERS,
    step_tokens: int = STEP_TOKENS,
    pool_tokens: int = POOL_TOKENS,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids, doc_tokens, sequence_id, offset, tier, step_group.

    A document is the tokenizer's ids of its whole text and then `end_id`; a null or empty text is
    that id alone, a null doc_id is kept, repeated rows are packed each for themselves, and other
    columns are not read. `ids` are little-endian unsigned 32-bit. `tier` is the sequence's length;
    the one sequence a task may leave short of a power of two is padded to the longest tier.

    Nothing is shuffled: a task packs the documents of its split in pools of about `pool_tokens`,
    and carries on with what a pool leaves, so memory and padding do not depend on the input's
    size, and no source or text can fill one task. Sequence ids hold the partition's number, so
    they are the same when a lost task runs again. Very small splits pad more: coalesce them first.
    """

    def step(batches: Batches) -> Batches:
        own = word_bpe(vocabulary)
        base = TaskContext.get().partitionId() << 36
        made, steps = 0, 0
        pool: list[tuple[int | None, int, int, bytes]] = []  # doc_id, first id's place, doc_tokens, ids
        held = 0

        def emit(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal pool, held, made, steps
            windows, left = pack([len(p[3]) // 4 for p in pool], tiers, last)
            group = step_groups(windows, step_tokens)
            rows: list[tuple] = []
            for k, w in enumerate(windows):
                at, tier = 0, w.tier if w.tier & (w.tier - 1) == 0 else max(tiers)
                for p in w.pieces:
                    doc, first, total, ids = pool[p.row]
                    part = ids[4 * p.start : 4 * (p.start + p.length)]
                    rows.append(
                        (doc, first + p.start, p.length, part, total, base + made + k, at, tier, base + steps + group[k])
                    )
                    at += p.length
            made += len(windows)
            steps += max(group, default=-1) + 1
            pool = [
                (pool[p.row][0], pool[p.row][1] + p.start, pool[p.row][2], pool[p.row][3][4 * p.start : 4 * (p.start + p.length)])
                for p in left
            ]
            held = sum(len(p[3]) // 4 for p in pool)
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), *[pa.int64()] * 3, pa.int32(), pa.int64()]
            names = [x.split()[0] for x in SCHEMA.split(", ")]
            for start in range(0, len(rows), 4096):
                columns = [pa.array(c, kind) for c, kind in zip(zip(*rows[start : start + 4096]), kinds)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

        end = np.array([end_id], dtype="<u4").tobytes()
        for batch in batches:
            for run in runs(batch, "text", RUN_BYTES):
                for doc, ids in zip(run.column("doc_id").to_pylist(), own.encode(run.column("text").to_pylist())):
                    ids += end
                    pool.append((doc, 0, len(ids) // 4, ids))
                    held += len(ids) // 4
                if held >= pool_tokens:
                    yield from emit(last=False)
        yield from emit(last=True)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return rows.mapInArrow(step, SCHEMA)
