"""Removal of repeated byte strings by merging Burrows-Wheeler transforms.

A string of `length` bytes repeats if it starts earlier too: in a document of smaller id, or
earlier in its own. Each such string is assigned to its anchor, the gram in it of least hash;
equal strings have equal anchors, so strings that may be equal meet where their anchor does. A run
of strings of one anchor is a context. Hashes choose only what meets:

1. Documents are dealt into blocks of text. A block asks, in shards by hash, which of its anchors
   stand elsewhere too; a shard answers with a mark for each.
2. A block sends the bytes of the contexts whose anchor has a mark, one of each in the block that
   are equal byte by byte, to groups by anchor.
3. A group indexes its contexts, with the number of their copies: shards of them get a
   Burrows-Wheeler transform each, and shards are merged by iterative interleave refinement, which
   moves only the marks that say from which shard each suffix comes. Blocks of the interleave that
   are left after `length` bytes are the intervals of suffixes with that long a common prefix. All
   members of an interval but the first repeat, and all copies of a context but the first.

So neither a block nor a shard nor a group grows with the corpus: there are more of each.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from facetlake.llm.shared import bounded, dropped, expanded, partitions, row_blocks, squeezed, string_buffer, text_columns, written
from facetlake.llm.textkit import CASED, mix, powers, prefix

#: Bytes of text in a vectorised step, in a round of combination inside a block, and in a block; each row counts as ROW more.
STEP, ROUND, BLOCK, ROW = 1 << 18, 4 << 20, 4 << 20, 64
#: Blocks to a shard of questions.
BLOCKS = 2
#: Bytes of contexts that one group gets on average, of those that are indexed at a time, and of a shard of them.
GROUP, BUNDLE, SHARD = 6 << 20, 1 << 18, 1 << 16
#: Contexts that differ, of one anchor and summed over blocks, beyond which its strings are dealt one by one.
HOT = 8_000
#: Blocks whose strings of such anchors meet at a time; what is left of them goes on, until one meeting is left.
FAN = 512
#: In an item: the anchor is the whole string.
_WHOLE = np.uint16(0xFFFF)
_CONTEXT = np.dtype([("fp", "<u8"), ("ctx", "<u8"), ("row", "<u4"), ("lo", "<u4"), ("more", "<u2"), ("at", "<u2")])
_ITEM = np.dtype([("doc", "<i8"), ("home", "<i8"), ("row", "<u4"), ("lo", "<u4"), ("more", "<u2"), ("at", "<u2")])
_SPAN = np.dtype([("row", "<u4"), ("lo", "<u4"), ("hi", "<u4")])


def contexts(raw: np.ndarray, offsets: np.ndarray, length: int) -> np.ndarray:
    """A record for each run of strings with one anchor: its hash and the context's, row, first start, further starts, the anchor's place behind that."""
    gram = length // 2
    spread = length - gram  # grams in a string, less one
    n = len(raw)
    starts = np.diff(offsets) - length + 1
    if n < length or not (starts > 0).any():
        return np.zeros(0, _CONTEXT)
    sums = prefix(raw, CASED)
    _, down = powers(n + 1)
    h = mix((sums[gram:] - sums[:-gram]) * down[: n - gram + 1])
    least = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64)
    span = 1
    while 2 * span <= spread + 1:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    rest = spread + 1 - span
    if rest:
        least = np.minimum(least[:-rest], least[rest:])
    rows = np.flatnonzero(starts > 0)
    count = starts[rows]
    at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(offsets[rows], count)
    anchor = (least[at] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    new = np.ones(len(at), bool)
    # A string's place moves by more than one from row to row, and an anchor never serves two rows.
    new[1:] = anchor[1:] != anchor[:-1]
    first = np.flatnonzero(new)
    lo = at[first]
    more = np.append(first[1:], len(at)) - first - 1
    row = np.searchsorted(offsets, lo, "right") - 1
    out = np.empty(len(lo), _CONTEXT)
    out["fp"] = h[anchor[first]]
    out["ctx"] = mix((sums[lo + more + length] - sums[lo]) * down[lo])
    out["row"] = row
    out["lo"] = lo - offsets[row]
    out["more"] = more
    out["at"] = anchor[first] - lo
    return out


def rounds(raw: np.ndarray, offsets: np.ndarray, length: int) -> Iterator[np.ndarray]:
    """contexts() of a block, in rounds; a row of over STEP bytes is read in pieces, whose strings follow each other."""
    held, seen = [], 0
    for a, b in row_blocks(offsets, STEP):
        lo, hi = int(offsets[a]), int(offsets[b])
        pieces = [(lo, hi)] if b - a > 1 or hi - lo <= STEP else [(x, min(hi, x + STEP + length - 1)) for x in range(lo, hi - length + 1, STEP)]
        for x, y in pieces:
            found = contexts(raw[x:y], offsets[a : b + 1] - x if len(pieces) == 1 else np.array([0, y - x]), length)
            found["row"] += np.uint32(a)
            found["lo"] += np.uint32(x - lo)
            held.append(found)
            seen += y - x
            if seen >= ROUND:
                yield np.concatenate(held)
                held, seen = [], 0
    if held:
        yield np.concatenate(held)


def spans(doc: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unions of the intervals [lo, hi) of each document."""
    order = np.lexsort((lo, doc))
    doc, lo, hi = doc[order], lo[order].astype(np.int64), hi[order].astype(np.int64)
    if not len(doc):
        return doc, lo, hi
    new = np.ones(len(doc), bool)
    new[1:] = doc[1:] != doc[:-1]
    # Within a document, the greatest end so far; documents are set apart by a large step.
    step = int(hi.max()) + 2
    group = np.cumsum(new) - 1
    reach = np.maximum.accumulate(hi + group * step)
    new[1:] |= lo[1:] + group[1:] * step > reach[:-1]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(doc)) - 1
    return doc[first], lo[first], reach[last] - group[last] * step


def spread_over(start: np.ndarray, size: np.ndarray, step: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Ranges i to j of strings (start, size) with the place of each of their bytes, about `step` at a time, and where each string begins there."""
    ends = np.cumsum(size)
    i = 0
    while i < len(size):
        done = int(ends[i - 1]) if i else 0
        j = max(i + 1, int(np.searchsorted(ends, done + step, "right")))
        begin = ends[i:j] - size[i:j] - done
        yield i, j, np.arange(int(ends[j - 1]) - done) + np.repeat(start[i:j] - begin, size[i:j]), begin
        i = j


def gathered(raw: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The bytes of strings, one behind the other."""
    return np.concatenate([np.zeros(0, np.uint8), *(raw[at] for _, _, at, _ in spread_over(start, size))])


def same_bytes(raw: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether the strings at a and at b, of the same size above 0, are equal."""
    out = np.ones(len(a), bool)
    for i, j, at, begin in spread_over(a, size):
        differ = raw[at] != raw[at + np.repeat((b - a)[i:j], size[i:j])]
        out[i:j] = np.add.reduceat(differ, begin, dtype=np.int64) == 0
    return out


def leaders(raw: np.ndarray, start: np.ndarray, size: np.ndarray, key: np.ndarray, doc: np.ndarray, lo: np.ndarray) -> np.ndarray:
    """Whether each string is the first, by (doc, lo), of those of its key and size with the same bytes.

    Strings that a key brings together but whose bytes differ from the first one's are firsts of their own.
    """
    out = np.ones(len(key), bool)
    if not len(key):
        return out
    key = mix(key + size.astype(np.uint64))
    order = np.argsort(key, kind="stable")
    same = np.append(False, key[order][1:] == key[order][:-1])
    some = order[same | np.append(same[1:], False)]
    some = some[np.lexsort((lo[some], doc[some], key[some]))]
    if not len(some):
        return out
    new = np.append(True, (key[some][1:] != key[some][:-1]) | (size[some][1:] != size[some][:-1]))
    first = some[np.flatnonzero(new)[np.cumsum(new) - 1]]
    some, first = some[~new], first[~new]
    out[some] = ~same_bytes(raw, start[some], start[first], size[some])
    return out


def packed_items(items: np.ndarray, texts: np.ndarray) -> bytes:
    """Records of contexts and their bytes, one behind the other."""
    return squeezed(np.concatenate([np.frombuffer(len(items).to_bytes(4, "little") + items.tobytes(), np.uint8), texts]))


def opened_items(blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The records and the bytes of many packed_items()."""
    items, texts = [np.zeros(0, _ITEM)], [np.zeros(0, np.uint8)]
    for blob in blobs:
        data = expanded(blob, np.uint8)
        n = int.from_bytes(data[:4].tobytes(), "little")
        items.append(data[4 : 4 + n * _ITEM.itemsize].view(_ITEM))
        texts.append(data[4 + n * _ITEM.itemsize :])
    return np.concatenate(items), np.concatenate(texts)


ROWS = "kind int, key long, home long, data binary"
GONE, ITEMS, HOT_ITEMS = 0, 1, 2


def table(rows: list[tuple]) -> pa.Table:
    """Rows of ROWS."""
    kinds = (pa.int32(), pa.int64(), pa.int64(), pa.binary())
    return pa.table([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names=["kind", "key", "home", "data"])


def gone_rows(home: np.ndarray, row: np.ndarray, lo: np.ndarray, hi: np.ndarray, groups: int) -> list[tuple]:
    """A row for each block: its intervals to go, united and packed."""
    order = np.argsort(home, kind="stable")
    cut = np.flatnonzero(np.append(True, np.diff(home[order]) != 0)) if len(order) else []
    out = []
    for x in np.split(order, cut[1:]) if len(order) else ():
        found = np.stack(spans(row[x], lo[x], hi[x])).T
        block = int(home[x[0]])
        out.append((GONE, block % groups, block, np.rec.fromarrays(found.T.astype(np.uint32), dtype=_SPAN).tobytes()))
    return out


class Shard:
    """Texts with their suffixes in order of their first symbols, and the transform of that order."""

    __slots__ = ("suffix", "before", "follows")

    def __init__(self, suffix: np.ndarray, before: np.ndarray, follows: np.ndarray):
        self.suffix, self.before, self.follows = suffix, before, follows


def transform(symbols: np.ndarray, after: np.ndarray, previous: np.ndarray, first: int, last: int, rounds: int) -> Shard:
    """The Burrows-Wheeler transform of one shard, the suffixes from `first` up to but without `last`.

    symbols: of each suffix its first symbol; after: the suffix behind that, or -1; previous: the suffix of
    which this one is the rest, or -1. The shard's own suffixes are sorted by doubling.
    """
    step = np.where(after[first:last] >= 0, after[first:last] - first, -1)
    rank = symbols[first:last].astype(np.int64) + 1
    depth = 1
    while True:
        second = np.where(step >= 0, rank[step], 0)
        key = rank * (int(rank.max()) + 1) + second
        order = np.argsort(key, kind="stable")
        ranked = key[order]
        new = np.append(True, ranked[1:] != ranked[:-1])
        rank[order] = np.cumsum(new)
        depth *= 2
        if depth >= rounds or new.all():
            break
        step = np.where(step >= 0, step[step], -1)
    suffix = (order + first).astype(np.int32)
    return Shard(suffix, previous[suffix], np.flatnonzero(after[suffix] < 0).astype(np.int32))


def merged(shards: list[Shard], symbols: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes of all shards in order of their first `rounds` symbols, and where blocks of equal ones begin.

    The interleave is a list of marks, one for each suffix, that names its shard; a shard's suffixes keep
    their order in it. Round by round the marks move to where the suffix before them stands: read in order,
    they are dealt by the symbols of the transforms. After k rounds the order is right for k symbols, and a
    block, once cut off from its neighbour, stays so; the round in which that happens is one more than their
    common prefix.
    """
    total = sum(len(s.suffix) for s in shards)
    number = np.arange(len(shards), dtype=np.uint16)
    # Suffixes without a rest stand first of their symbol, in shard order, in every round.
    ends = np.concatenate([s.suffix[s.follows] for s in shards])
    end_marks = np.repeat(number, [len(s.follows) for s in shards])
    marks = np.repeat(number, [len(s.suffix) for s in shards])
    block = np.zeros(total, np.int32)  # of each place, the first place of its block
    for k in range(rounds):
        rest = -1 if k else 0  # the block of no rest at all: no symbol of a rest is looked at in the first round
        before = np.empty(total, np.int32)
        for i, x in enumerate(shards):
            before[marks == i] = x.before
        has = np.flatnonzero(before >= 0)
        dealt = np.concatenate([symbols[ends], symbols[before[has]]])
        del before
        order = stable_order(dealt)
        moved = np.concatenate([end_marks, marks[has]])[order]
        came = np.concatenate([np.full(len(ends), rest, np.int32), block[has]])[order]
        dealt = dealt[order]
        del order, has
        first = np.flatnonzero(np.append(True, (dealt[1:] != dealt[:-1]) | (came[1:] != came[:-1])))
        old, marks, block = marks, moved, np.repeat(first.astype(np.int32), np.diff(np.append(first, total)))
        if len(first) == total and (old == marks).all():
            break
    out = np.empty(total, np.int32)
    for k, s in enumerate(shards):
        out[marks == k] = s.suffix
    return out, np.flatnonzero(np.append(True, block[1:] != block[:-1]))


def ranks(values: np.ndarray) -> np.ndarray:
    """Rank of each value among the distinct ones."""
    order = np.argsort(values)
    ordered = values[order]
    out = np.empty(len(values), np.uint32)
    out[order] = np.cumsum(np.append(False, ordered[1:] != ordered[:-1])) if len(values) else 0
    return out


def stable_order(values: np.ndarray) -> np.ndarray:
    """Stable order of unsigned 32-bit values, by 16 bits at a time."""
    order = np.argsort((values & np.uint32(0xFFFF)).astype(np.uint16), kind="stable")
    if len(values) and int(values.max()) >> 16:
        order = order[np.argsort((values >> np.uint32(16)).astype(np.uint16)[order], kind="stable")]
    return order


def intervals(raw: np.ndarray, offsets: np.ndarray, length: int, shard: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, start and interval of every string of `length` bytes in the texts, by merged transforms; at most 2**31 bytes."""
    width = max(w for w in (10, 8, 5, 4, 3, 2, 1) if length % w == 0)
    n = len(raw)
    sizes = np.diff(offsets)
    index = np.arange(n, dtype=np.int32)
    left = np.repeat(offsets[1:].astype(np.int32), sizes) - index
    # A symbol is `width` bytes; one cut short by the end of its text is lower than all that continue it.
    half = width // 2 if width > 5 else width
    value = np.zeros(n, np.uint64)
    for k in range(half):
        value *= np.uint64(257)
        value[: n - k] += np.where(left[: n - k] > k, raw[k:].astype(np.uint64) + np.uint64(1), np.uint64(0))
    symbols = ranks(value)
    del value
    if half < width:
        both = symbols.astype(np.uint64) * np.uint64(n + 2)
        both[: n - half] += np.where(left[: n - half] > half, symbols[half:].astype(np.uint64) + np.uint64(1), np.uint64(0))
        symbols = ranks(both)
        del both
    after = np.where(left > width, index + np.int32(width), np.int32(-1))
    previous = index - np.int32(width)
    previous[previous < np.repeat(offsets[:-1].astype(np.int32), sizes)] = -1
    rounds = length // width
    cuts = np.searchsorted(offsets, np.arange(shard, int(offsets[-1]) + shard, shard))
    edges = np.unique(np.concatenate([[0], cuts, [len(sizes)]]).clip(0, len(sizes)))
    shards = [transform(symbols, after, previous, int(offsets[a]), int(offsets[b]), rounds) for a, b in zip(edges, edges[1:], strict=False) if offsets[b] > offsets[a]]
    del after, previous, index
    order, first = merged(shards, symbols, rounds)
    group = np.repeat(np.arange(len(first), dtype=np.int32), np.diff(np.append(first, len(order))))
    full = left[order] >= length
    order, group = order[full], group[full]
    text = np.searchsorted(offsets, order, "right") - 1
    return text, order - offsets[text], group


def repeated(texts: list[bytes], length: int, shard: int = SHARD) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """intervals() of a list of texts."""
    raw = np.frombuffer(b"".join(texts), np.uint8)
    return intervals(raw, np.cumsum([0, *map(len, texts)]), length, shard)


def blocked(docs: DataFrame) -> DataFrame:
    """docs, whose last column is the id and which have a text, written in rows of about BLOCK bytes of text: block, data."""
    at = docs.columns.index("text")

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, seen, block = [], 0, TaskContext.get().partitionId() << 32

        def row() -> pa.RecordBatch:
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, held[0].schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                for x in held:
                    out.write_batch(x)
            return pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["block", "data"])

        for batch in batches:
            _, offsets = string_buffer(batch.column(at))
            for a, b in row_blocks(offsets + np.arange(batch.num_rows + 1) * ROW, BLOCK):
                held.append(batch.slice(a, b - a))
                seen += int(offsets[b] - offsets[a]) + (b - a) * ROW
                if seen >= BLOCK // 2:
                    yield row()
                    held, seen, block = [], 0, block + 1
        if held:
            yield row()

    return written(docs.mapInArrow(deal, "block long, data binary"), "blocks", **{"parquet.block.row.count.limit": "4"})


def opened(data: bytes) -> pa.Table:
    """The rows of a block; the last column is the id."""
    return pa.ipc.open_stream(pa.py_buffer(data)).read_all()


def searched(rows: pa.Table, at: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, offsets and ids of a block's texts; a text without id counts as empty."""
    ids = rows.column(rows.num_columns - 1)
    raw, offsets = string_buffer(pc.if_else(ids.is_valid(), rows.column(at), pa.scalar(None, pa.string())))
    return raw, offsets, ids.fill_null(0).to_numpy()


def shard_bits(blocks: int) -> int:
    """Bits of an anchor's hash that name its shard."""
    return max(1, (blocks // BLOCKS).bit_length())


def questions(blocks: DataFrame, at: int, bits: int, length: int) -> DataFrame:
    """For each round of each block, and each shard: 32 more bits of the anchors there, ascending, and of each how many contexts differ, twice, and whether it stands more than once."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                raw, offsets, _ = searched(opened(data.as_buffer()), at)
                for part, found in enumerate(rounds(raw, offsets, length)):
                    q = found["fp"] >> np.uint64(32 - bits)
                    order = np.lexsort((found["ctx"], q))
                    q, ctx = q[order], found["ctx"][order]
                    first = np.flatnonzero(np.append(True, q[1:] != q[:-1]))[: len(q)]
                    apart = np.append(True, (q[1:] != q[:-1]) | (ctx[1:] != ctx[:-1]))[: len(q)]
                    if not len(q):
                        continue
                    n = np.minimum(np.add.reduceat(apart, first, dtype=np.int64), 0x7FFF)
                    n = (2 * n + (np.diff(np.append(first, len(q))) > 1)).astype(np.uint16)
                    q = q[first]
                    shard = (q >> np.uint64(32)).astype(np.int64)
                    cut = np.flatnonzero(np.append(True, shard[1:] != shard[:-1]))
                    ends = np.append(cut[1:], len(q))
                    keys = [q[a:b].astype(np.uint32).tobytes() for a, b in zip(cut, ends, strict=True)]
                    counts = [squeezed(n[a:b]) for a, b in zip(cut, ends, strict=True)]
                    same = [pa.array(np.full(len(cut), x, np.int64)) for x in (block, part)]
                    yield pa.RecordBatch.from_arrays([*same, pa.array(shard[cut]), pa.array(keys, pa.binary()), pa.array(counts, pa.binary())], ["block", "part", "shard", "keys", "n"])

    return blocks.mapInArrow(ask, "block long, part long, shard long, keys binary, n binary")


#: An answer: the anchor stands once; more than once; and so that its strings are dealt one by one.
ALONE, MEETS, DEALT = 0, 1, 2


def answers(asked: DataFrame) -> DataFrame:
    """Each question, written, with a mark for each of its anchors, and the number of contexts that will meet."""

    def add(shard: pa.Table) -> pa.Table:
        keys = [np.frombuffer(x.as_buffer(), np.uint32) for x in shard["keys"]]
        cut = np.cumsum([0, *map(len, keys)])
        known, at = np.unique(np.concatenate(keys), return_inverse=True)
        n = np.concatenate([expanded(x, np.uint16) for x in shard["n"].to_pylist()])
        total = np.bincount(at, n >> 1)
        meets = (np.bincount(at) > 1) | (np.bincount(at, n & 1) > 0)
        marks = np.where(meets, np.where(total > HOT, DEALT, MEETS), ALONE).astype(np.uint8)[at]
        out = [pa.array([squeezed(marks[a:b]) for a, b in zip(cut[:-1], cut[1:], strict=True)], pa.binary())]
        out.append(pa.array([int((n[a:b] >> 1)[marks[a:b] != ALONE].sum()) for a, b in zip(cut[:-1], cut[1:], strict=True)], pa.int64()))
        return pa.table([*[shard[c] for c in ("block", "part", "shard")], *out], names=["block", "part", "shard", "marks", "n"])

    return written(asked.groupBy("shard").applyInArrow(add, "block long, part long, shard long, marks binary, n long"), "answers")


def string_hashes(raw: np.ndarray, start: np.ndarray, length: int) -> np.ndarray:
    """Hashes of strings of one length."""
    up, _ = powers(length)
    out = np.empty(len(start), np.uint64)
    for a in range(0, len(start), 4096):
        out[a : a + 4096] = mix((CASED[raw[start[a : a + 4096, None] + np.arange(length)]] * up[:length]).sum(axis=1, dtype=np.uint64))
    return out


def meeting(blocks: DataFrame, answered: DataFrame, at: int, bits: int, groups: int, salts: int, length: int) -> DataFrame:
    """ROWS of each block: contexts whose anchor stands elsewhere too, by group, and what repeats in the block itself."""

    def emit(block: pa.Table, known: pa.Table) -> pa.Table:
        if not block.num_rows or not known.num_rows:
            return table([])
        home = block["block"][0].as_py()
        raw, offsets, ids = searched(opened(block["data"][0].as_buffer()), at)
        known = known.sort_by([("part", "ascending"), ("shard", "ascending")])
        parts, marks = known["part"].to_numpy(), known["marks"].to_pylist()
        out = []
        for part, found in enumerate(rounds(raw, offsets, length)):
            _, of = np.unique(found["fp"] >> np.uint64(32 - bits), return_inverse=True)
            mark = np.concatenate([np.zeros(0, np.uint8), *(expanded(marks[i], np.uint8) for i in np.flatnonzero(parts == part))])[of]
            hot = found[mark == DEALT]
            found = found[mark == MEETS]
            key, ctx = found["fp"], found["ctx"]
            if len(hot):
                n = hot["more"].astype(np.int64) + 1
                hot = np.repeat(hot, n)
                hot["lo"] += (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)).astype(np.uint32)
                hot["more"], hot["at"] = 0, _WHOLE
                h = string_hashes(raw, offsets[hot["row"]] + hot["lo"], length)
                found, key, ctx = np.concatenate([found, hot]), np.concatenate([key, h]), np.concatenate([ctx, h])
            row, lo, size = found["row"].astype(np.int64), found["lo"].astype(np.int64), found["more"].astype(np.int64) + length
            doc, start = ids[row], offsets[row] + lo
            first = leaders(raw, start, size, ctx ^ mix(key), doc, lo)
            later = ~first
            out += gone_rows(np.full(int(later.sum()), home), row[later], lo[later], (lo + size)[later], groups)
            to = (mix(key) % np.uint64(groups)).astype(np.int64)
            whole = found["at"] == _WHOLE
            if salts > 1:
                to += np.where(whole, groups * (home % salts), 0)
            kind = np.where(whole, HOT_ITEMS, ITEMS)
            order = np.flatnonzero(first)
            order = order[np.lexsort((to[order], kind[order]))]
            cut = np.flatnonzero(np.append(True, (np.diff(to[order]) != 0) | (np.diff(kind[order]) != 0))) if len(order) else []
            for x in np.split(order, cut[1:]) if len(order) else ():
                items = np.empty(len(x), _ITEM)
                items["doc"], items["home"] = doc[x], home
                for c in ("row", "lo", "more", "at"):
                    items[c] = found[c][x]
                out.append((int(kind[x[0]]), int(to[x[0]]), home, packed_items(items, gathered(raw, start[x], size[x]))))
        return table(out)

    return blocks.groupBy("block").cogroup(answered.select("block", "part", "shard", "marks").groupBy("block")).applyInArrow(emit, ROWS)


class Group:
    """Contexts of some anchors with their bytes, and which of them are the first of their copies."""

    def __init__(self, blobs: list[bytes], length: int):
        self.items, self.raw = opened_items(blobs)
        gram = length // 2
        self.size = self.items["more"].astype(np.int64) + length
        offsets = np.concatenate([[0], np.cumsum(self.size)])
        self.start = offsets[:-1]
        self.anchor, whole = np.empty(len(self.items), np.uint64), np.empty(len(self.items), np.uint64)
        for a, b in row_blocks(offsets, STEP):
            sums = prefix(self.raw[offsets[a] : offsets[b]], CASED)
            _, down = powers(len(sums))
            lo, hi = offsets[a:b] - offsets[a], offsets[a + 1 : b + 1] - offsets[a]
            whole[a:b] = mix((sums[hi] - sums[lo]) * down[lo])
            lo = lo + np.where(self.items["at"][a:b] == _WHOLE, 0, self.items["at"][a:b])
            hi = np.where(self.items["at"][a:b] == _WHOLE, hi, lo + gram)
            self.anchor[a:b] = mix((sums[hi] - sums[lo]) * down[lo])
        self.doc, self.lo = self.items["doc"], self.items["lo"].astype(np.int64)
        self.first = leaders(self.raw, self.start, self.size, whole ^ mix(self.anchor), self.doc, self.lo)

    def copies(self, groups: int) -> list[tuple]:
        """ROWS of all copies but the first."""
        x = np.flatnonzero(~self.first)
        return gone_rows(self.items["home"][x], self.items["row"][x], self.lo[x], self.lo[x] + self.size[x], groups)

    def bundles(self) -> Iterator[np.ndarray]:
        """The first contexts of anchors that have more than one, about BUNDLE bytes of whole anchors at a time."""
        own = np.flatnonzero(self.first)
        own = own[np.argsort(self.anchor[own], kind="stable")]
        new = np.append(True, self.anchor[own][1:] != self.anchor[own][:-1])[: len(own)]
        own = own[~(new & np.append(new[1:], True))] if len(own) else own
        if len(own):
            new = np.append(True, self.anchor[own][1:] != self.anchor[own][:-1])
            edge = np.append(np.flatnonzero(new), len(own))
            at = np.concatenate([[0], np.cumsum(self.size[own])])[edge]
            for a, b in row_blocks(at, BUNDLE):
                yield own[edge[a] : edge[b]]


def thinned(hot: DataFrame, groups: int, salts: int, length: int) -> DataFrame:
    """ROWS of strings that are dealt one by one: of equal ones in a meeting the first goes on to the next, the others go."""

    def thin(rows: pa.Table) -> pa.Table:
        g = Group(rows["data"].to_pylist(), length)
        out = g.copies(groups)
        salt = rows["key"][0].as_py() // groups // FAN % salts
        own = np.flatnonzero(g.first)
        out.append((HOT_ITEMS, rows["key"][0].as_py() % groups + groups * salt, 0, packed_items(g.items[own], gathered(g.raw, g.start[own], g.size[own]))))
        return table(out)

    return written(hot.groupBy("key").applyInArrow(thin, ROWS), "thinned")


def repeats(blocks: DataFrame, at: int, length: int) -> DataFrame:
    """(block, data): of each block, packed pieces of the intervals of bytes to go, by row."""
    bits = shard_bits(blocks.count())
    answered = answers(questions(blocks, at, bits, length))
    n = answered.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    groups = max(partitions(blocks), -(-n * (length + length // 4) // GROUP))
    salts = -(-blocks.count() // FAN)
    met = meeting(blocks, answered, at, bits, groups, salts, length)
    if salts > 1:
        met = written(met, "met")
        hot, met = met.filter(F.col("kind") == HOT_ITEMS), met.filter(F.col("kind") != HOT_ITEMS)
        while salts > 1:
            salts = -(-salts // FAN)
            hot = thinned(hot, groups, salts, length)
            met, hot = met.unionByName(hot.filter(F.col("kind") == GONE)), hot.filter(F.col("kind") != GONE)
        met = met.unionByName(hot)

    def search(rows: pa.Table) -> pa.Table:
        gone = rows.filter(pc.equal(rows["kind"], GONE))
        g = Group(rows.filter(pc.not_equal(rows["kind"], GONE))["data"].to_pylist(), length)
        out = g.copies(groups)
        for x in g.bundles():
            size = g.size[x]
            text, start, group = intervals(gathered(g.raw, g.start[x], size), np.concatenate([[0], np.cumsum(size)]), length, SHARD)
            member = x[text]
            doc, lo = g.doc[member], g.lo[member] + start
            # The first of an interval's members stays.
            order = np.lexsort((lo, doc, group))
            member, doc, lo, group = member[order], doc[order], lo[order], group[order]
            head = np.append(True, group[1:] != group[:-1])
            lead = np.flatnonzero(head)[np.cumsum(head) - 1]
            later = (doc != doc[lead]) | (lo != lo[lead])
            out += gone_rows(g.items["home"][member[later]], g.items["row"][member[later]], lo[later], lo[later] + length, groups)
        return pa.concat_tables([gone, table(out)]).select(["home", "data"]).rename_columns(["block", "data"])

    return written(met.groupBy("key").applyInArrow(search, "block long, data binary"), "repeats")


def applied(docs: DataFrame, length: int, finish: Callable[[pa.Table, list[np.ndarray]], pa.Table], schema) -> DataFrame:
    """finish(rows, spans) of all rows of docs, in parts: spans has, for each row, the (k, 2) intervals of its text to go."""
    if not 2 <= length <= 65_000:
        raise ValueError("length must be from 2 to 65,000 bytes")
    bounded(docs.sparkSession)
    names, at = docs.columns, docs.columns.index("text")
    ids = docs.select("*", docs["doc_id"].cast("long").alias("_suffix_id"))
    if ids.filter("_suffix_id is not null").groupBy("_suffix_id").count().filter("count > 1").limit(1).count():
        return _applied_by_id(ids, length, finish, schema)
    blocks = blocked(ids)
    found = repeats(blocks, at, length)

    def end(block: pa.Table, pieces: pa.Table) -> pa.Table:
        if not block.num_rows:
            return finish(pa.schema([]).empty_table(), [])
        rows = opened(block["data"][0].as_buffer()).select(range(len(names)))
        x = np.concatenate([np.zeros(0, _SPAN), *(np.frombuffer(p.as_buffer(), _SPAN) for p in pieces["data"])])
        row, lo, hi = spans(x["row"], x["lo"], x["hi"])
        return finish(rows, np.split(np.stack([lo, hi], axis=1), np.searchsorted(row, np.arange(1, rows.num_rows))))

    return blocks.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(end, schema)


def _applied_by_id(ids: DataFrame, length: int, finish, schema) -> DataFrame:
    """applied() where rows repeat an id: the least text of each id is searched, and rows that have it are cut alike."""
    names, at = ids.columns[:-1], ids.columns.index("text")
    single = ids.filter("_suffix_id is not null").groupBy("_suffix_id").agg(F.min("text").alias("text"))
    found = removals(single.select(F.col("_suffix_id").alias("doc_id"), "text"), length).filter("size(spans) > 0")
    found = found.select(F.col("doc_id").alias("_suffix_key"), F.col("text").alias("_suffix_text"), F.col("spans").alias("_suffix_spans"))
    rows = ids.join(found, (F.col("_suffix_id") == F.col("_suffix_key")) & (ids["text"] == F.col("_suffix_text")), "left").drop("_suffix_id", "_suffix_key", "_suffix_text")

    def end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.array([(s["first"], s["last"]) for s in x or ()], np.int64).reshape(-1, 2) for x in batch.column(len(names)).to_pylist()]
            yield from finish(pa.Table.from_batches([batch]).select(range(len(names))), found).to_batches()

    return rows.mapInArrow(end, schema)


def removals(docs: DataFrame, length: int = 100) -> DataFrame:
    """A row for each row of docs (doc_id, text): doc_id, text, spans.

    spans: maximal runs of UTF-8 bytes, from first up to but without last, that strings of `length` bytes
    (2 to 65,000) cover which also start earlier; judged on the texts as given. Matches stay within a document.
    Nulls: a null text has no bytes; a null doc_id stays null, its text is neither searched nor cut. Rows
    that repeat a doc_id are one document, cut alike; if their texts differ, the least of them by code point
    is the document's, and the others are neither searched nor cut. A long text is read in pieces. Ties cannot
    be: of equal strings the least (doc_id, start) stays. Other columns are ignored; an empty table gives an empty one.
    """
    own = text_columns(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    kind = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))

    def listed(rows: pa.Table, found: list[np.ndarray]) -> pa.Table:
        x = np.concatenate([np.zeros((0, 2), np.int64), *found])
        lists = pa.ListArray.from_arrays(np.cumsum([0, *map(len, found)]).astype(np.int32), pa.StructArray.from_arrays([pa.array(x[:, k]) for k in (0, 1)], ["first", "last"]))
        return pa.table([*(rows.columns or [pa.array([], pa.int64()), pa.array([], pa.string())]), lists.cast(kind)], names=["doc_id", "text", "spans"])

    return applied(own, length, listed, "doc_id long, text string, spans array<struct<first:long,last:long>>")


def digest(docs: DataFrame, length: int = 100) -> DataFrame:
    """removals() as figures: doc_id, n_bytes, n_removed, n_spans, kept_sha256 of the bytes that stay.

    A null text has 0 bytes; nulls, repeats, ties, long texts and empty tables are as in removals().
    """
    own = text_columns(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def figures(rows: pa.Table, found: list[np.ndarray]) -> pa.Table:
        out = []
        for text, gone in zip(rows["text"] if found else (), found, strict=True):
            data = memoryview(text.as_buffer()) if text.is_valid else b""
            kept, at = hashlib.sha256(), 0
            for first, last in gone.tolist():
                kept.update(data[at:first])
                at = last
            kept.update(data[at:])
            out.append((len(data), int((gone[:, 1] - gone[:, 0]).sum()), len(gone), kept.hexdigest()))
        cols = list(zip(*out, strict=True)) or [(), (), (), ()]
        ids = rows["doc_id"] if found else pa.array([], pa.int64())
        return pa.table([ids, *(pa.array(c, pa.int64()) for c in cols[:3]), pa.array(cols[3], pa.string())], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return applied(own, length, figures, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def without_spans(data: bytes, gone: np.ndarray) -> bytes:
    """data without the intervals; one that begins or ends inside a character leaves that character whole."""
    parts, at = [], 0
    for first, last in gone.tolist():
        while first < last and data[first] & 0xC0 == 0x80:
            first += 1
        while last > first and last < len(data) and data[last] & 0xC0 == 0x80:
            last -= 1
        parts.append(data[at:first])
        at = last
    return b"".join([*parts, data[at:]])


def cut_texts(docs: DataFrame, length: int = 100) -> DataFrame:
    """The rows of docs with the runs of removals() cut out of their texts, and n_chars, a long, after that; other columns stay.

    A run that begins or ends inside a character leaves that character whole. Nulls, repeats, ties, long texts and
    empty tables are as in removals(); a null text has 0 characters.
    """
    names, at = docs.columns, docs.columns.index("text")
    schema = StructType([StructField("n_chars", LongType()) if f.name == "n_chars" else f for f in docs.schema.fields])

    def cut(rows: pa.Table, found: list[np.ndarray]) -> pa.Table:
        if not found:
            return rows
        texts = rows.column(at).to_pylist()
        for k in (k for k, gone in enumerate(found) if len(gone)):
            texts[k] = without_spans(texts[k].encode(), found[k]).decode()
        text = pa.array(texts, pa.string())
        n = pc.fill_null(pc.utf8_length(text), 0).cast(pa.int64())
        new = {"text": text, "n_chars": n}
        return pa.table([new.get(c, rows.column(k)) for k, c in enumerate(names)], names=names)

    return applied(docs, length, cut, schema)
