"""SimHash near-duplicates: fingerprints, a Gray-order hierarchical index, components.

1. Every whole text becomes a 64-bit fingerprint: XXH64 of each word shingle,
   then the majority of each bit. Python in tasks, as the bits of every
   shingle are counted at once in numpy.
2. Distinct fingerprints are routed to cells. Two fingerprints that differ in
   at most 2 of 64 bits agree on at least two of four 16-bit blocks, so each
   fingerprint goes to the six cells named by the pairs of its blocks. A cell
   with more than ``cell_limit`` fingerprints is divided by the same argument
   over its free bits (three sub-blocks, of which one agrees), twice at most:
   then a cell has at most 15 free bits, so its size has a proven bound. No
   link is lost at any step and no cell is capped.
3. A cell is sorted by Gray rank and indexed: each upper node holds the bits
   that all codes below it share, each lower node only what is shared beyond
   its parent's. A search adds up the differing bits from the top and leaves a
   node, with all codes below, once the sum exceeds the radius. Nodes whose
   codes are already in the query's class are left as well: only classes are
   wanted. So a cell returns a star per class, never all pairs.
4. Stars of all cells are joined by large-star/small-star rounds, each written
   to the shared folder.

Defined results: a null text counts as empty; texts without a word get
fingerprint zero and link as any other; a class whose ids are all null has a
null ``component_id``; repeated rows and ids stay separate rows of one class;
an empty table gives an empty result. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablegate.llm.base import mapped, plain_names, quoted, save, workspace

SHINGLE_WORDS = 3
MAX_BITS = 2
SEED = 42
FP, ROW = "__tg_fp", "__tg_row"  # columns added on the way
CELL_LIMIT = 4096
FANOUT = 8
_ALL = (1 << 64) - 1
_CHUNK = 1 << 17  # shingles whose bits are counted at once


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprint(raw: bytes, words: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """The unsigned fingerprint of one text, given as UTF-8."""
    from xxhash import xxh64_intdigest as digest

    parts = raw.lower().split()
    if not parts:
        return 0
    size = min(words, len(parts))
    ends = np.cumsum(np.fromiter(map(len, parts), dtype=np.int64, count=len(parts)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    joined = b" ".join(parts)
    n = len(parts) - size + 1
    counts = np.zeros(64, dtype=np.int64)
    for low in range(0, n, _CHUNK):
        high = min(n, low + _CHUNK)
        spans = zip(starts[low:high].tolist(), ends[low + size - 1 : high + size - 1].tolist(), strict=True)
        hashes = np.array([digest(joined[a:b], seed) for a, b in spans], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(sum(1 << int(i) for i in np.flatnonzero(2 * counts > n)))


def with_fingerprints(docs: DataFrame, text: str = "text", words: int = SHINGLE_WORDS, seed: int = SEED) -> DataFrame:
    """``docs`` with its columns and a last column ``__tg_fp`` (the fingerprint as a signed long)."""
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).cast(pa.large_binary())
            codes = [_signed(fingerprint(x.as_py() or b"", words, seed)) for x in texts]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(codes, pa.int64())], [*batch.schema.names, FP])

    return mapped(docs, run, [T.StructField(FP, T.LongType())])


def _divided(bits: list[int], parts: int) -> list[int]:
    """Masks of ``parts`` nearly equal runs of the given bit numbers."""
    return [sum(1 << int(b) for b in run) for run in np.array_split(np.array(bits), parts)]


def _masks() -> tuple[list[int], dict[int, list[int]], dict[int, list[int]]]:
    """The first masks and, for each mask, the finer ones that a hot cell is divided by."""
    blocks = _divided(list(range(64)), 4)
    first = [a | b for a, b in combinations(blocks, 2)]

    def finer(masks: list[int]) -> dict[int, list[int]]:
        return {m: [m | s for s in _divided([b for b in range(64) if not m >> b & 1], 3)] for m in masks}

    second = finer(first)
    return first, second, finer(sorted({m for v in second.values() for m in v}))


def _mask_column(masks: list[int]):
    return F.array(*[F.lit(_signed(m)).cast("long") for m in masks])


def _routed(codes: DataFrame, path: str, limit: int) -> DataFrame:
    """Rows (mask, cell, fp): every distinct code in every cell in which it may have a partner."""
    first, *steps = _masks()
    cell = F.col("fp").bitwiseAND(F.col("mask")).alias("cell")
    now = codes.select("fp", F.explode(_mask_column(first)).alias("mask")).select("mask", cell, "fp")
    done = []
    for depth, finer in enumerate(steps):
        hot = now.groupBy("mask", "cell").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > limit)
        # Written, so that Spark knows its size before it plans the two joins.
        hot = save(hot.select("mask", "cell"), f"{path}/hot-{depth}")
        if hot.isEmpty():
            break
        table = F.create_map(*[x for m, v in finer.items() for x in (F.lit(_signed(m)).cast("long"), _mask_column(v))])
        done.append(now.join(hot, ["mask", "cell"], "left_anti").select("mask", "cell", "fp"))
        inside = now.join(hot, ["mask", "cell"], "left_semi")
        now = inside.select("fp", F.explode(F.element_at(table, F.col("mask"))).alias("mask")).select("mask", cell, "fp")
    for other in done:
        now = now.unionByName(other)
    return now


class GrayIndex:
    """A hierarchy over codes in Gray order; upper nodes hold the bits that all codes below share."""

    def __init__(self, codes: np.ndarray, fanout: int = FANOUT):
        self.fanout = fanout
        ands, ors = [codes], [codes]
        while len(ands[-1]) > fanout:
            at = np.arange(0, len(ands[-1]), fanout)
            ands.append(np.bitwise_and.reduceat(ands[-1], at))
            ors.append(np.bitwise_or.reduceat(ors[-1], at))
        shared = [~(a ^ o) for a, o in zip(ands, ors, strict=True)]
        self.pattern = [a & s for a, s in zip(ands, shared, strict=True)]
        self.own = shared[:]  # of each node, the shared bits that its parent does not hold
        for k in range(len(shared) - 1):
            parent = np.arange(len(shared[k])) // fanout
            self.own[k] = shared[k] & ~shared[k + 1][parent]

    def search(self, queries: np.ndarray, radius: int, label: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, code) within the radius, but for codes under nodes wholly of the query's class.

        label: the class of each code; of: the class of each query.
        """
        low, high = [label], [label]
        for k in range(1, len(self.own)):
            at = np.arange(0, len(low[-1]), self.fanout)
            low.append(np.minimum.reduceat(low[-1], at))
            high.append(np.maximum.reduceat(high[-1], at))
        top = len(self.own) - 1
        width = len(self.own[top])
        q = np.repeat(np.arange(len(queries)), width)
        node = np.tile(np.arange(width), len(queries))
        bits = np.zeros(len(q), dtype=np.uint8)
        for k in range(top, -1, -1):
            bits = bits + np.bitwise_count((queries[q] ^ self.pattern[k][node]) & self.own[k][node])
            keep = (bits <= radius) & ~((low[k][node] == of[q]) & (high[k][node] == of[q]))
            q, node, bits = q[keep], node[keep], bits[keep]
            if k:
                n = len(self.own[k - 1])
                child = (node[:, None] * self.fanout + np.arange(self.fanout)).ravel()
                real = child < n
                q, node, bits = (np.repeat(x, self.fanout)[real] for x in (q, node, bits))
                node = child[real]
        return q, node


def _merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after joining the classes of each pair of positions; a class is named by its least position."""
    pairs = np.unique(np.sort(np.stack([label[a], label[b]], axis=1), axis=1), axis=0)
    up: dict[int, int] = {}

    def root(x: int) -> int:
        while x in up:
            x = up[x]
        return x

    for x, y in pairs.tolist():
        x, y = root(x), root(y)
        if x != y:
            up[max(x, y)] = min(x, y)
    if not up:
        return label
    to = np.arange(len(label))
    for x in up:
        to[x] = root(x)
    return to[label]


def cell_classes(codes: np.ndarray, radius: int) -> np.ndarray:
    """The class of each code (codes in Gray order), named by a position."""
    label = np.arange(len(codes))
    index = GrayIndex(codes)
    step = max(1, min(256, (1 << 19) // len(codes)))
    for low in range(0, len(codes), step):
        high = min(len(codes), low + step)
        q, found = index.search(codes[low:high], radius, label, label[low:high])
        if len(q):
            label = _merge(label, q + low, found)
    return label


def _gray_rank(code):
    """Where a 64-bit code stands in Gray order, as a long that sorts so."""
    for by in (1, 2, 4, 8, 16, 32):
        code = code.bitwiseXOR(F.shiftrightunsigned(code, by))
    return code.bitwiseXOR(F.lit(_signed(1 << 63)).cast("long"))


def _cell_links(radius: int):
    def solve(mask: np.ndarray, cell: np.ndarray, fp: np.ndarray) -> tuple[list, list]:
        """Links of the complete cells in these sorted rows."""
        first = np.flatnonzero(np.concatenate(([True], (mask[1:] != mask[:-1]) | (cell[1:] != cell[:-1]))))
        last = np.append(first[1:], len(fp))
        us, vs = [], []
        for a, b in zip(first[last - first > 1].tolist(), last[last - first > 1].tolist(), strict=True):
            codes = fp[a:b]
            label = cell_classes(codes.view(np.uint64), radius)
            least = np.full(len(codes), np.iinfo(np.int64).max)
            np.minimum.at(least, label, codes)
            to = least[label]
            linked = to != codes
            us.append(codes[linked])
            vs.append(to[linked])
        return us, vs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.int64)] * 3
        for batch in batches:
            rows = [np.concatenate((h, c.to_numpy(zero_copy_only=False))) for h, c in zip(held, batch.columns, strict=True)]
            if not len(rows[0]):
                continue
            # The last cell may go on in the next batch.
            same = (rows[0] == rows[0][-1]) & (rows[1] == rows[1][-1])
            cut = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
            held = [r[cut:] for r in rows]
            yield from out(*(r[:cut] for r in rows))
        yield from out(*held)

    def out(mask: np.ndarray, cell: np.ndarray, fp: np.ndarray) -> Iterator[pa.RecordBatch]:
        us, vs = solve(mask, cell, fp) if len(fp) else ([], [])
        if us:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x), pa.int64()) for x in (us, vs)], ["u", "v"])

    return run


def links(codes: DataFrame, path: str, radius: int = MAX_BITS, limit: int = CELL_LIMIT) -> DataFrame:
    """Links (u, v), v < u, that connect every class of the distinct codes ``fp``."""
    if radius > MAX_BITS:
        raise ValueError("the cells hold every pair of codes only up to 2 differing bits")
    cells = _routed(codes, path, limit).repartition("mask", "cell")
    cells = cells.sortWithinPartitions("mask", "cell", _gray_rank(F.col("fp")))
    return cells.mapInArrow(_cell_links(radius), "u long, v long").distinct()


def components(edges: DataFrame, path: str) -> DataFrame:
    """(u, v) for every node u but the least of its component, v being that least node.

    Large-star and small-star rounds, each written to ``path``, until the
    edges no longer change.
    """
    now, seen = save(edges, f"{path}/round-0"), None
    k = 0
    while True:
        mark = now.agg(F.count(F.lit(1)), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 31)))).first()
        if mark == seen or not mark[0]:
            return now
        seen, k = mark, k + 1
        both = now.select("u", "v").union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        below = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(below, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = save(small.union(below.select("u", F.col("m").alias("v"))).distinct(), f"{path}/round-{k}")


def _classes(prints: DataFrame, path: str, radius: int, limit: int) -> DataFrame:
    """(fp, root) for all distinct fingerprints of ``prints(__tg_fp)``; root names the class."""
    codes = save(prints.select(F.col(FP).alias("fp")).distinct(), f"{path}/codes")
    stars = components(links(codes, path, radius, limit), f"{path}/stars")
    joined = codes.join(stars, F.col("fp") == F.col("u"), "left")
    return joined.select("fp", F.coalesce("v", "fp").alias("root"))


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    words: int = SHINGLE_WORDS,
    radius: int = MAX_BITS,
    limit: int = CELL_LIMIT,
) -> DataFrame:
    """One row per document: id, fingerprint (16 hex digits), component_id (least id of its class)."""
    path = workspace(docs.sparkSession, "simhash")
    rows = docs.select(F.col(quoted(id_col)).alias("_id"), F.col(quoted(text)).alias("_text"))
    prints = save(with_fingerprints(rows, "_text", words).select("_id", FP), f"{path}/prints")
    least = prints.groupBy(FP).agg(F.min("_id").alias("least"))
    classes = least.join(_classes(prints, path, radius, limit), F.col(FP) == F.col("fp"))
    best = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    named = save(classes.join(best, "root").select("fp", "component_id"), f"{path}/named")
    return prints.join(named, F.col(FP) == F.col("fp")).select(
        F.col("_id").alias(id_col), F.lower(F.lpad(F.hex(FP), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(
    docs: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    words: int = SHINGLE_WORDS,
    radius: int = MAX_BITS,
    limit: int = CELL_LIMIT,
) -> DataFrame:
    """``docs`` with one row of every class: that of the least id, ids that are null last, one of repeated rows."""
    path = workspace(docs.sparkSession, "simhash-keep")
    # The row number is written with the row, so it does not change when a task is run again.
    rows, at_id, at_text = plain_names(docs, id_col, text)
    prints = save(with_fingerprints(rows.withColumn(ROW, F.monotonically_increasing_id()), at_text, words), f"{path}/prints")
    order = F.struct(F.col(at_id).isNull(), F.col(at_id).alias("id"), F.col(ROW).alias("row"))
    least = prints.groupBy(FP).agg(F.min(order).alias("least"))
    classes = least.join(_classes(prints.select(FP), path, radius, limit), F.col(FP) == F.col("fp"))
    best = classes.groupBy("root").agg(F.min("least").alias("best")).select(F.col("best.row").alias(ROW))
    return prints.join(save(best, f"{path}/kept"), ROW, "left_semi").select(*rows.columns).toDF(*docs.columns)
