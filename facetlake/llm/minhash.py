"""MinHash near-duplicates by a multi-index Hamming join.

A signature is a row of b-bit symbols, the low bits of one minimum hash each. Two
signatures of m chunks that differ in at most 2m - 1 symbols have, by pigeonhole, a
chunk that differs in at most one. Each chunk therefore is an index with one key for
each place where that error may stand: the chunk without the symbol there. Texts that
meet under a key are candidates; candidates within the distance are confirmed on
their full shingle sets.

Members of a key are not paired with each other. Each is tried against the least of
them. Where those links leave a key's members apart, those outside its largest
component meet all its members in blocks of bounded size; near ones are gathered to
families by forests, whose full sets meet in the same way, and only links between
components come out. Texts of equal sets are one class from the start.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from facetlake.llm.components import Forest, components
from facetlake.llm.shared import dropped, partitions, row_blocks, salted, string_buffer, text_columns, without, written
from facetlake.llm.textkit import SPACES, Words, mix, randoms, row_windows

#: Symbols in a chunk, with at most one error; bits of a symbol.
CHUNK, BITS = 5, 16
#: Chance that a pair at the threshold lies beyond the signature distance.
MISS = 1e-5
#: Bytes of text in a step, and members of a key that one task compares with each other.
SIGN_STEP, BLOCK = 1 << 18, 1024
#: Members of keys that one task takes, on average, and pairs that it compares at a time.
ROWS, PAIRS = 200_000, 1 << 18
#: Members of a family in a block whose full sets one task holds.
FAMILY = 512
_LOW = np.uint64((1 << BITS) - 1)


def chunks(threshold: float) -> int:
    """Fewest chunks m for which a pair at the threshold differs in at most 2m - 1 of their symbols but for MISS."""
    apart = 1 - threshold
    m = 2
    while True:
        k = m * CHUNK
        if sum(comb(k, i) * apart**i * threshold ** (k - i) for i in range(2 * m, k + 1)) <= MISS:
            return m
        m += 1


def shingle_sets(raw: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes, ascending within a row, and their number in each row."""
    words = Words(raw, offsets, SPACES)
    values, rows = row_windows(words, words.hashes(), size)
    order = np.lexsort((values, rows))
    values, rows = values[order], rows[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (rows[1:] != rows[:-1])
    values, rows = values[new], rows[new]
    return values, np.bincount(rows, minlength=len(offsets) - 1)


def signatures(values: np.ndarray, counts: np.ndarray, symbols: int) -> np.ndarray:
    """A row of symbols for each non-empty set."""
    first = (np.cumsum(counts) - counts)[counts > 0]
    out = np.empty((len(first), symbols), np.uint16)
    if len(first):
        odd, shift = randoms(31, symbols) | np.uint64(1), randoms(37, symbols)
        for k in range(symbols):
            x = (values ^ shift[k]) * odd[k]
            out[:, k] = mix(np.minimum.reduceat(x ^ (x >> np.uint64(32)), first)) & _LOW
    return out


def digests(docs: DataFrame, size: int, symbols: int) -> DataFrame:
    """doc_id, n_shingles, two hashes of the set and its signature (null if empty)."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = string_buffer(batch.column(1))
            for a, b in row_blocks(offsets, SIGN_STEP):
                values, counts = shingle_sets(raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], size)
                full = counts > 0
                first = (np.cumsum(counts) - counts)[full]
                h = np.zeros((2, b - a), np.int64)
                if len(first):
                    h[0, full] = np.add.reduceat(mix(values), first).view(np.int64)
                    h[1, full] = np.add.reduceat(mix(values + np.uint64(99)), first).view(np.int64)
                signed = iter(signatures(values, counts, symbols))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(counts, pa.int64()), pa.array(h[0]), pa.array(h[1]), pa.array([next(signed).tobytes() if x else None for x in full], pa.binary())], ["doc_id", "n_shingles", "h1", "h2", "sig"])

    return docs.mapInArrow(digest, "doc_id long, n_shingles long, h1 long, h2 long, sig binary")


def index_keys(signed: DataFrame, m: int) -> DataFrame:
    """(key, id): for each chunk, the chunk without each of its symbols in turn."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = randoms(41, m * CHUNK)
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            sig = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint16).reshape(len(ids), -1).astype(np.uint64)
            for c in range(m):
                part = mix(sig[:, c * CHUNK : (c + 1) * CHUNK] + step[c * CHUNK : (c + 1) * CHUNK])
                whole = part.sum(axis=1, dtype=np.uint64)
                for k in range(CHUNK):
                    key = mix(whole - part[:, k] + step[c * CHUNK + k])
                    yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), batch.column(0)], ["key", "id"])

    return signed.select("id", "sig").mapInArrow(emit, "key long, id long")


def near(pairs: DataFrame, signed: DataFrame, most: int) -> DataFrame:
    """(u, v) of those pairs (u, v, a), a the signature of u, from which v's differs in at most `most` symbols."""

    def within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, y = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint16).reshape(batch.num_rows, -1) for k in (2, 3))
                yield batch.select([0, 1]).filter(pa.array((x != y).sum(axis=1) <= most))

    b = signed.select(F.col("id").alias("v"), F.col("sig").alias("b"))
    return pairs.dropDuplicates(["u", "v"]).join(b, "v").select("u", "v", "a", "b").mapInArrow(within, "u long, v long")


def full_sets(docs: DataFrame, ids: DataFrame, size: int) -> DataFrame:
    """(id, shingles): the packed shingle hashes, ascending, of the documents named in ids (id)."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = string_buffer(batch.column(1))
            for a, b in row_blocks(offsets, SIGN_STEP):
                values, counts = shingle_sets(raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], size)
                ends = np.cumsum(counts)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array([values[e - n : e].tobytes() for e, n in zip(ends, counts, strict=True)], pa.binary())], ["id", "shingles"])

    return written(docs.join(ids, docs["doc_id"] == ids["id"], "left_semi").mapInArrow(sets, "id long, shingles binary"), "sets")


def confirmed(pairs: DataFrame, sets: DataFrame, threshold: tuple[int, int]) -> DataFrame:
    """The pairs (u, v) whose full shingle sets are as similar as threshold, a fraction."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        up, down = threshold
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(down * both >= up * (len(x) + len(y) - both))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    # One document may be the least of very many.
    sizes = pairs.groupBy("u").agg(F.count("*").alias("n"))
    pairs, sizes = salted(pairs, written(sizes, "sizes"), ("u",), ("u",), "v", pairs.count())
    a = sizes.join(sets.select(F.col("id").alias("u"), F.col("shingles").alias("su")), "u").drop("n")
    b = sets.select(F.col("id").alias("v"), F.col("shingles").alias("sv"))
    return pairs.join(a, ["u", "_salt"]).join(b, "v").select("u", "v", "su", "sv").mapInArrow(check, "u long, v long")


def meetings(rows: DataFrame, by: str, size: int, name: str) -> tuple[DataFrame, int]:
    """What is left to compare of groups (by, id, comp), and its number of rows.

    Members that belong to the largest component of their group need not meet each other. The others, the few, are
    dealt to blocks x of about `size` by hash, all members to blocks y, and each of the few meets each member in one
    pair of blocks: rows (by, x, y, role, few, id, comp), role 0 for a few's own part and 1 for a member's.
    """
    counts = rows.groupBy(by, "comp").agg(F.count("*").alias("n"))
    counts = counts.groupBy(by).agg(F.sum("n").alias("n"), F.max("n").alias("top"), F.max_by("comp", F.struct("n", "comp")).alias("main")).filter("top < n")
    open_ = written(counts.select(by, F.ceil((F.col("n") - F.col("top")) / size).cast("int").alias("xs"), F.ceil(F.col("n") / size).cast("int").alias("ys"), "main", "n", "top"), name)
    total = open_.agg(F.coalesce(F.sum((F.col("n") - F.col("top")) * F.col("ys") + F.col("n") * F.col("xs")), F.lit(0))).first()[0]
    at = rows.join(open_, by).withColumn("few", F.col("comp") != F.col("main"))

    def dealt(role: int, own: str, own_n: str, other: str, other_n: str) -> DataFrame:
        out = at.filter("few") if role == 0 else at
        out = out.withColumn(own, F.pmod(F.xxhash64("id"), F.col(own_n)).cast("int")).withColumn(other, F.explode(F.sequence(F.lit(0), F.col(other_n) - 1)))
        return out.select(by, "x", "y", F.lit(role).alias("role"), "few", "id", "comp")

    return dealt(0, "x", "xs", "y", "ys").unionByName(dealt(1, "y", "ys", "x", "xs")), total


def close_pairs(group, x, y, role, few, ids, comp, sig, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places i, j of the few and of members, of rows ordered by (group, x, y, role), that meet in a block, differ in comp, and are near; in steps."""
    if not len(ids):
        return
    new = np.append(True, (group[1:] != group[:-1]) | (x[1:] != x[:-1]) | (y[1:] != y[:-1]))
    start = np.flatnonzero(new)
    stop = np.append(start[1:], len(ids))
    split = start + np.add.reduceat(role == 0, start, dtype=np.int64)  # where a block's members begin
    own = np.flatnonzero(role == 0)
    block = np.cumsum(new)[own] - 1
    n = (stop - split)[block]
    until, a = np.cumsum(n), 0
    while a < len(own):
        done = until[a - 1] if a else 0
        b = max(a + 1, int(np.searchsorted(until, done + PAIRS, "right")))
        i = np.repeat(own[a:b], n[a:b])
        j = np.arange(len(i)) + np.repeat(split[block[a:b]] - (until[a:b] - n[a:b] - done), n[a:b])
        # Two of the few meet twice, once in either's part.
        meet = (comp[i] != comp[j]) & (~few[j] | (ids[i] < ids[j]))
        i, j = i[meet], j[meet]
        near_ = (sig[i] != sig[j]).sum(axis=1) <= most
        yield i[near_], j[near_]
        a = b


def ordered(rows: pd.DataFrame, by: str) -> tuple:
    """The columns that close_pairs() takes, in its order, and that order."""
    order = np.lexsort(tuple(rows[c].to_numpy() for c in ("id", "role", "y", "x", by)))
    sig = np.frombuffer(b"".join(rows["sig"]), np.uint16).reshape(len(rows), -1)[order]
    return *(rows[c].to_numpy()[order] for c in (by, "x", "y", "role", "few", "id", "comp")), sig, order


def families(members: DataFrame, links: DataFrame, signed: DataFrame, most: int) -> DataFrame:
    """Forest edges (u, v) over documents that share a key and are near, but in different components so far.

    Each pair of blocks of a key gives at most as many edges as it has members, whatever the number of near pairs.
    """
    comp = components(links)
    at = members.join(comp, "id", "left").select("key", "id", F.coalesce("component_id", "id").alias("comp"))
    at, rows = meetings(at, "key", BLOCK, "open")
    at = at.join(signed.select("id", "sig"), "id")

    def connect(rows: pd.DataFrame) -> pd.DataFrame:
        *columns, _ = ordered(rows, "key")
        ids, forest, out = columns[5], Forest(), []
        for i, j in close_pairs(*columns, most):
            pairs = np.unique(np.stack([ids[i], ids[j]], axis=1), axis=0)
            out += [p for p in pairs.tolist() if forest.join(*p)]
        return pd.DataFrame(out, columns=["u", "v"], dtype=np.int64)

    # A task takes many keys at once; one pair of blocks never has more than about 2 * BLOCK rows.
    tasks = max(partitions(members), -(-rows // ROWS))
    return at.groupBy(F.pmod(F.xxhash64("key", "x", "y"), F.lit(tasks)).alias("task")).applyInPandas(connect, "u long, v long")


def family_links(family: DataFrame, links: DataFrame, signed: DataFrame, sets: DataFrame, most: int, threshold: tuple[int, int]) -> DataFrame:
    """Links (u, v) that connect what is apart in a family (id, family): near members are compared on their full sets.

    The full sets of a pair of blocks meet in one task, are compared there as bits, and only links that join two
    components come out.
    """
    comp = components(links)
    at = family.join(comp, "id", "left").select("family", "id", F.coalesce("component_id", "id").alias("comp"))
    at, rows = meetings(at, "family", FAMILY, "family")
    tasks = max(partitions(family), -(-rows // FAMILY))
    at = at.join(signed.select("id", "sig"), "id").join(sets, "id")
    up, down = threshold

    def link(rows: pd.DataFrame) -> pd.DataFrame:
        *columns, order = ordered(rows, "family")
        ids, comp = columns[5:7]
        full = [np.frombuffer(s, np.uint64) for s in rows["shingles"].to_numpy()[order]]
        n = np.array([len(s) for s in full])
        forest, out = Forest(), []
        for i, j in close_pairs(*columns, most):
            fits = (down * np.minimum(n[i], n[j]) >= up * np.maximum(n[i], n[j]))
            i, j = i[fits], j[fits]
            cuts = np.flatnonzero(np.append(True, i[1:] != i[:-1])) if len(i) else np.zeros(0, np.int64)
            for a, partners in zip(i[cuts].tolist(), np.split(j, cuts[1:]), strict=False):
                # Links found in this very task spare the pairs that they decide.
                b = [k for k in partners.tolist() if forest.root(int(comp[a])) != forest.root(int(comp[k]))]
                if not b:
                    continue
                rest = np.concatenate([full[k] for k in b])
                at_ = np.minimum(np.searchsorted(full[a], rest), n[a] - 1)
                both = np.add.reduceat((full[a][at_] == rest).astype(np.int64), np.cumsum([0, *n[b][:-1]]))
                for k, c in zip(b, both.tolist(), strict=True):
                    if down * c >= up * (n[a] + n[k] - c) and forest.join(int(comp[a]), int(comp[k])):
                        out.append((int(ids[a]), int(ids[k])))
        return pd.DataFrame(out, columns=["u", "v"], dtype=np.int64)

    return at.groupBy(F.pmod(F.xxhash64("family", "x", "y"), F.lit(tasks)).alias("task")).applyInPandas(link, "u long, v long")


def near_duplicates(docs: DataFrame, size: int = 5, threshold: tuple[int, int] = (4, 5)) -> DataFrame:
    """A row for each row of docs (doc_id, text): doc_id, n_shingles, component_id, kept.

    Documents link whose sets of distinct `size`-word shingles have a Jaccard similarity of at least
    `threshold`, a fraction; a text of fewer words is one shingle. component_id is the least doc_id that
    links reach, kept marks its document. Pairs whose signatures differ in more than 2m - 1 symbols, one
    in 1 / MISS at the threshold and fewer above, may stay apart; none below the threshold links.
    Nulls: a null or empty text has no shingles and links with nothing; a null doc_id stays null and
    unlinked, kept. Long texts are signed and compared whole. Ties cannot be: ids name components. Rows that repeat a doc_id share one result; if their texts differ, the least of
    them by code point stands for the document in links. Other columns are ignored; an empty table gives an empty one.
    """
    m = chunks(threshold[0] / threshold[1])
    own = text_columns(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    digest = written(digests(own, size, m * CHUNK), "digests")
    full = digest.filter("n_shingles > 0 and doc_id is not null")
    if full.groupBy("doc_id").agg(F.min("h1").alias("a"), F.max("h1").alias("b")).filter("a <> b").limit(1).count():
        single = near_duplicates(own.filter("doc_id is not null").groupBy("doc_id").agg(F.min("text").alias("text")), size, threshold)
        return digest.select("doc_id", "n_shingles").join(single.drop("n_shingles"), "doc_id", "left").withColumn("kept", F.coalesce("kept", F.lit(True)))
    classes = written(full.groupBy("h1", "h2", "n_shingles").agg(F.min("doc_id").alias("id"), F.first("sig").alias("sig"), F.count("*").alias("n")), "classes")
    signed = classes.select("id", "sig")
    keys = written(index_keys(signed, m), "keys")
    met = keys.groupBy("key").agg(F.min("id").alias("least"), F.count("*").alias("n")).filter("n > 1").select("key", "least")
    members = written(keys.join(met, "key"), "members")
    dropped(keys)
    # The least of a key brings its signature along, so that no join gathers all its partners.
    heads = members.filter("id = least").select("key", "least").join(signed.select(F.col("id").alias("least"), F.col("sig").alias("a")), "least")
    tried = members.filter("id <> least").join(heads.select("key", "a"), "key").select(F.col("least").alias("u"), F.col("id").alias("v"), "a")
    tried = written(near(tried, signed, 2 * m - 1), "tried")
    texts = own.dropDuplicates(["doc_id"]) if full.groupBy("doc_id").count().filter("count > 1").limit(1).count() else own
    sets = full_sets(texts, tried.select(F.col("u").alias("id")).union(tried.select("v")).distinct(), size)
    links = written(confirmed(tried, sets, threshold), "links")
    forest = written(families(members.select("key", "id"), links, signed, 2 * m - 1), "families")
    held = [members, tried, sets]
    if forest.limit(1).count():
        family = components(forest)
        heads = family.select(F.col("component_id").alias("id"), F.col("component_id").alias("family")).distinct()
        family = written(family.select("id", F.col("component_id").alias("family")).unionByName(heads), "members")
        late = family.join(sets.select("id"), "id", "left_anti").select("id")
        held += [full_sets(texts, late, size), family]
        more = family_links(family, links, signed, sets.unionByName(held[3]), 2 * m - 1, threshold)
        links = links.unionByName(written(more, "more"))
    # Copies have the component of their class, and find it by the hashes of their sets.
    comp = components(links).withColumnRenamed("id", "_id")
    for table in held:
        dropped(table)
    found = classes.join(comp, F.col("id") == F.col("_id"), "left").select(F.col("h1").alias("_h"), F.col("h2").alias("_i"), F.col("n_shingles").alias("_k"), "n", F.coalesce("component_id", "id").alias("component_id"))
    rows, found = salted(digest.drop("sig"), written(found, "found"), ("h1", "h2", "n_shingles"), ("_h", "_i", "_k"), "doc_id", digest.count())
    out = rows.join(found, (F.col("h1") == F.col("_h")) & (F.col("h2") == F.col("_i")) & (F.col("n_shingles") == F.col("_k")) & (rows["_salt"] == found["_salt"]) & F.col("doc_id").isNotNull(), "left")
    out = out.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def deduplicated(docs: DataFrame, size: int = 5, threshold: tuple[int, int] = (4, 5)) -> DataFrame:
    """The rows of docs, with all their columns, that near_duplicates() keeps.

    Where rows repeat an id, or have none, each row is a document of its own: of a group the row of least id stays,
    those without id behind all others, and of several rows of one id any one. A text without words stays.
    """
    ids = docs.select(docs["doc_id"].cast("long").alias("id"))
    if not ids.groupBy("id").count().filter("count > 1 or id is null").limit(1).count():
        return without(docs, near_duplicates(docs, size, threshold).filter("not kept").select(F.col("doc_id").alias("_gone")))
    rows = written(docs.withColumn("_deduplicated_row", F.monotonically_increasing_id()), "rows")
    own = rows.select(F.col("_deduplicated_row").alias("row"), rows["doc_id"].cast("long").alias("id"))
    found = near_duplicates(rows.select(F.col("_deduplicated_row").alias("doc_id"), "text"), size, threshold).select("doc_id", "component_id")
    found = found.join(own, F.col("doc_id") == F.col("row"))
    stays = found.groupBy("component_id").agg(F.min(F.struct(F.col("id").isNull(), "id", "row")).alias("least")).select(F.col("least.row").alias("_stays"))
    return rows.join(stays, F.col("_deduplicated_row") == F.col("_stays"), "left_semi").drop("_deduplicated_row")
