"""Near-duplicate documents by HyperMinHash registers.

One pass makes, for each document, its set of word shingles (64-bit hashes),
a 64-bit name of that set and ``REGISTERS`` compressed registers: the set's
hashes are dealt to buckets by their first bits, and of the least hash of a
bucket the register keeps the count of leading zeros (4 bits) and the next 4.
Documents with equal sets become one node. Registers, folded to half their
number, form ``BANDS`` bands; nodes sharing a band meet in a bucket.

Few shingles leave most registers of a band empty, and bands with one or two
filled ones agree by chance, more often the more nodes there are. Such bands
are left out; sets of up to ``SMALL`` shingles (and those that one of them may
link with) meet by shingles instead: in any common order of all shingles, two
sets of n and m shingles with similarity j share one of the first
n - ceil(j n) + 1 of the one and m - ceil(j m) + 1 of the other. The order puts
the most frequent shingles last; it decides who meets, not who links.

Candidates never are all pairs of a bucket:

1. In each bucket every node meets the bucket's most central node (the one
   with the largest buckets altogether): a number of pairs linear in the rows.
   The collision-corrected estimate from the registers drops hopeless pairs;
   the rest is confirmed on full sets.
2. Buckets whose nodes then still lie in several components are searched
   again: pairs across components only, registers compared in blocks of
   ``BLOCK`` nodes inside tasks, and only pairs whose estimate comes within
   ``SLACK`` standard deviations of the threshold leave the task to be
   confirmed on full sets. No cap on partners, candidates or buckets.

A pair at the threshold that meets by bands alone shares none with probability
(1 - 0.8**6)**42 < 3e-6 where all registers are filled, and less than 1e-6 at
``SMALL`` shingles, bands of less than ``FILLED`` registers left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from ._graph import components
from ._text import U64, blocks, mix, seeded, shingles, utf8, word_hashes, words

REGISTERS = 512
BANDS, BAND_ROWS = 42, 6
ZEROS = 14        # leading zeros are counted up to this
SLACK = 4.0       # standard deviations of the estimate below the threshold
BLOCK = 2048      # nodes of a bucket compared at once
SMALL = 160       # shingles up to which sets meet by shingles
FILLED = 3        # registers that a band has at least, at thresholds of 80 percent and more
FREQUENT, FREQUENT_FROM = 50_000, 16   # shingles put last: the most frequent of those in so many small sets
BROADCAST_IDS = 1_000_000   # ids that may be broadcast (8 MB); more of them are joined by shuffle

_LAST = np.iinfo(np.int64).max   # no common shingle: two hashes of other kinds are equal
_BUCKET = np.arange(REGISTERS, dtype=U64) << U64(55)
_LEAD = np.array([min(ZEROS, 15 - int(x).bit_length()) for x in range(1 << 15)], U64)


def registers(hashes: np.ndarray) -> np.ndarray:
    """Compressed registers of a sorted set of hashes: 0 where a bucket is empty; a lesser hash gives a larger code."""
    out = np.zeros(REGISTERS, np.uint8)
    at = np.searchsorted(hashes, _BUCKET)
    at[at == len(hashes)] = len(hashes) - 1
    least = hashes[at]
    full = (least >> U64(55)) == np.arange(REGISTERS, dtype=U64)
    rest = least << U64(9)
    lead = _LEAD[rest >> U64(49)]
    mantissa = (rest << (lead + U64(1))) >> U64(60)
    code = (lead << U64(4) | (U64(15) - mantissa)) + U64(1)
    out[full] = code[full]
    return out


def small_limit(percent: int) -> int:
    """The shingles up to which a set may link with one of ``SMALL`` shingles."""
    return SMALL * 100 // max(1, percent)


def band_keys(regs: np.ndarray, filled: int = 1) -> np.ndarray:
    """One key per row of registers and band; 0 where the band has less than ``filled`` registers with a hash."""
    folded = np.maximum(regs[:, 0::2], regs[:, 1::2])[:, :BANDS * BAND_ROWS].astype(U64)
    parts = folded.reshape(len(regs), BANDS, BAND_ROWS)
    keys = mix((parts * seeded(BAND_ROWS, 9)).sum(2) + seeded(BANDS, 11)) | U64(1)
    keys[(parts != 0).sum(2) < filled] = 0
    return keys


def _collision_table() -> np.ndarray:
    """For 2**(i/4 - 10) hashes a bucket, how often two unrelated filled registers agree."""
    lead = np.repeat(np.arange(ZEROS + 1), 16)
    mantissa = np.tile(np.arange(16), ZEROS + 1)
    low = 2.0 ** -(lead + 1) * (1 + mantissa / 16)
    high = low + 2.0 ** -(lead + 1) / 16
    low[lead == ZEROS] = mantissa[lead == ZEROS] * 2.0 ** -(ZEROS + 4)
    high[lead == ZEROS] = low[lead == ZEROS] + 2.0 ** -(ZEROS + 4)
    load = 2.0 ** (np.arange(120) / 4 - 10)[:, None]
    p = np.exp(-load * low) - np.exp(-load * high)
    return ((p / p.sum(1, keepdims=True)) ** 2).sum(1)


_COLLIDE = _collision_table()


def estimate(a: np.ndarray, b: np.ndarray, n_a, n_b) -> tuple[np.ndarray, np.ndarray]:
    """Collision-corrected Jaccard estimates of rows of registers, and the registers filled on either side."""
    filled = ((a != 0) | (b != 0)).sum(1)
    equal = ((a == b) & (a != 0)).sum(1)
    load = (np.asarray(n_a, float) + np.asarray(n_b, float)) / 2 / REGISTERS
    chance = _COLLIDE[np.clip(np.rint((np.log2(load) + 10) * 4), 0, len(_COLLIDE) - 1).astype(int)]
    return (equal / filled - chance) / (1 - chance), filled


def hopeful(a, b, n_a, n_b, percent: int) -> np.ndarray:
    """Pairs that sizes and the estimate do not rule out."""
    j = percent / 100
    est, filled = estimate(a, b, n_a, n_b)
    sizes = 100 * np.minimum(n_a, n_b) >= percent * np.maximum(n_a, n_b)
    return sizes & (est >= j - SLACK * deviation(j, filled, n_a, n_b))


def deviation(j: float, filled, n_a, n_b) -> np.ndarray:
    """Standard deviation of the estimate for a pair of similarity ``j``.

    The filled registers are a sample without replacement of the union, which
    they nearly exhaust where sets are small; chance agreement adds a little.
    """
    union = np.maximum((np.asarray(n_a) + np.asarray(n_b)) / (1 + j), filled)
    return np.sqrt(j * (1 - j) / filled * (1 - filled / union) + (1 - j) * 0.011 / filled + 0.5 / union ** 2)


def _sets(batch: pa.RecordBatch, k: int) -> Iterator[tuple[int, int, list[np.ndarray]]]:
    """The sorted shingle sets of the rows lo..hi of a batch, block by block."""
    data, offsets = utf8(batch.column("text"))
    for lo, hi in blocks(offsets):
        starts, ends, rows = words(data, offsets[lo:hi + 1])
        found, bounds = shingles(word_hashes(data, starts, ends), rows, hi - lo, k)
        yield lo, hi, [np.unique(found[bounds[i]:bounds[i + 1]]) for i in range(hi - lo)]


def _names(sets: list[np.ndarray]) -> pa.Array:
    return pa.array([xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63) if len(s) else None for s in sets], pa.int64())


def _signer(k: int, percent: int):
    limit, filled = small_limit(percent), FILLED if percent >= 80 else 1
    schema = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("node", pa.int64()),
                        ("regs", pa.binary()), ("bands", pa.list_(pa.int64())), ("small", pa.list_(pa.int64()))])

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, sets in _sets(batch, k):
                regs = np.zeros((hi - lo, REGISTERS), np.uint8)
                for i, s in enumerate(sets):
                    if len(s):
                        regs[i] = registers(s)
                keys = band_keys(regs, filled)
                keys[[len(s) <= SMALL for s in sets]] = 0
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").slice(lo, hi - lo),
                    pa.array([len(s) for s in sets], pa.int64()),
                    _names(sets),
                    pa.array([r.tobytes() for r in regs], pa.binary()),
                    pa.array([x[x != 0].view(np.int64) for x in keys], pa.list_(pa.int64())),
                    pa.array([s.view(np.int64) if 0 < len(s) <= limit else None for s in sets], pa.list_(pa.int64())),
                ], schema=schema)
    return sign


def _rows(df: DataFrame) -> DataFrame:
    return df.selectExpr("cast(doc_id as bigint) as doc_id", "cast(text as string) as text")


def signatures(docs: DataFrame, k: int = 4, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, node (the set's 64-bit name; null: no words), regs, bands (of sets beyond ``SMALL``
    shingles), small (the shingles of sets up to ``small_limit``)."""
    return _rows(docs).mapInArrow(
        _signer(k, percent), "doc_id long, n_shingles long, node long, regs binary, bands array<long>, small array<long>")


def frequent_shingles(nodes: DataFrame) -> np.ndarray:
    """The most frequent shingles of small sets, the most frequent last: ``FREQUENT`` of them at most."""
    counted = (nodes.select(F.explode("small").alias("key")).groupBy("key").agg(F.count("*").alias("n"))
               .where(F.col("n") >= FREQUENT_FROM).orderBy(F.desc("n"), "key").limit(FREQUENT))
    return np.array([r.key for r in counted.collect()][::-1], np.int64)


def _prefixer(percent: int, last: np.ndarray):
    """The keys by which small sets meet: the first shingles, ``last`` being put last."""
    by_value = np.argsort(last)
    values = last[by_value]

    def first(found: np.ndarray) -> np.ndarray:
        keep = len(found) - -(-percent * len(found) // 100) + 1
        at = np.minimum(np.searchsorted(values, found), max(0, len(values) - 1))
        rank = np.where(values[at] == found, by_value[at] + 1, 0) if len(values) else np.zeros(len(found), np.int64)
        return found[np.lexsort((found, rank))[:keep]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            flat, ends = b.column("small").flatten().to_numpy(zero_copy_only=False), np.cumsum(b.column("small").value_lengths().to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays([b.column("node"), pa.array([first(x) for x in np.split(flat, ends)[:-1]], pa.list_(pa.int64()))],
                                             ["node", "first"])
    return run


def first_shingles(nodes: DataFrame, percent: int) -> DataFrame:
    """node, first: the shingles by which small sets meet."""
    small = nodes.where("small is not null").select("node", "small")
    return small.mapInArrow(_prefixer(percent, frequent_shingles(small)), "node long, first array<long>")


def meeting_keys(nodes: DataFrame, first: DataFrame) -> DataFrame:
    """key, node: the buckets of each node; pairs at the threshold meet in one."""
    return (nodes.select(F.explode("bands").alias("key"), "node")
            .unionByName(first.select(F.explode("first").alias("key"), "node")))


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), REGISTERS)


def _estimator(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            good = hopeful(_matrix(b.column("regs_a")), _matrix(b.column("regs_b")),
                           b.column("n_a").to_numpy(), b.column("n_b").to_numpy(), percent)
            yield b.select(["node_a", "node_b"]).filter(pa.array(good))
    return run


def _crosser(percent: int):
    """Compares the nodes of a bucket's block pair; rows come sorted by key, left, right, side."""
    filled = FILLED if percent >= 80 else 1

    def compare(key: int, regs: np.ndarray, sizes: np.ndarray, nodes: np.ndarray, labels: np.ndarray,
                side: np.ndarray, first: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        one_block = not side.any()
        out_a, out_b = [], []
        for i in np.flatnonzero(side == 0):
            others = np.arange(i + 1, len(nodes)) if one_block else np.flatnonzero(side == 1)
            others = others[labels[others] != labels[i]]
            if len(others):
                near = others[hopeful(regs[i][None, :], regs[others], sizes[i], sizes[others], percent)]
                if len(near):
                    # a pair that meets in several bands is told by the first of them; one that meets by shingles
                    # alone, by the least
                    mine, theirs = band_keys(regs[i][None, :], filled).view(np.int64), band_keys(regs[near], filled).view(np.int64)
                    same = (mine == theirs) & (mine != 0) & (np.minimum(sizes[i], sizes[near]) > SMALL)[:, None]
                    by_band = same.any(1)
                    told = np.where(by_band, mine[0][same.argmax(1)], key)
                    for x in np.flatnonzero(~by_band):
                        told[x] = np.intersect1d(first[i], first[near[x]]).min(initial=_LAST)
                    near = near[(told == key) | (told == _LAST)]
                    out_a.append(np.full(len(near), nodes[i]))
                    out_b.append(nodes[near])
        none = np.zeros(0, np.int64)
        return np.concatenate(out_a or [none]), np.concatenate(out_b or [none])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def flush(table: pa.Table) -> pa.RecordBatch:
            key = table.column("key").to_numpy()
            left, right = table.column("left").to_numpy(), table.column("right").to_numpy()
            cut = np.flatnonzero((key[1:] != key[:-1]) | (left[1:] != left[:-1]) | (right[1:] != right[:-1])) + 1
            regs = np.frombuffer(b"".join(table.column("regs").to_pylist()), np.uint8).reshape(-1, REGISTERS)
            sizes, nodes = table.column("n").to_numpy(), table.column("node").to_numpy()
            labels, side = table.column("label").to_numpy(), table.column("side").to_numpy()
            first = [np.asarray(x.as_py() or (), np.int64) for x in table.column("first")]
            found = [compare(int(key[a]), regs[a:b], sizes[a:b], nodes[a:b], labels[a:b], side[a:b], first[a:b])
                     for a, b in zip(np.concatenate([[0], cut]), np.concatenate([cut, [len(key)]])) if b - a > 1]
            a = np.concatenate([x[0] for x in found] or [np.zeros(0, np.int64)])
            b = np.concatenate([x[1] for x in found] or [np.zeros(0, np.int64)])
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["node_a", "node_b"])

        for batch in batches:
            held.append(batch)
            table = pa.Table.from_batches(held)
            if table.num_rows < 2:
                continue
            key, left, right = (table.column(c).to_numpy() for c in ("key", "left", "right"))
            # all but the last group is whole
            last = np.flatnonzero((key != key[-1]) | (left != left[-1]) | (right != right[-1]))
            whole = int(last[-1]) + 1 if len(last) else 0
            if whole:
                yield flush(table.slice(0, whole))
                held = table.slice(whole).combine_chunks().to_batches()
        if held and (table := pa.Table.from_batches(held)).num_rows:
            yield flush(table)
    return run


def _setter(k: int):
    schema = pa.schema([("node", pa.int64()), ("hashes", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, sets in _sets(batch, k):
                yield pa.RecordBatch.from_arrays([_names(sets), pa.array([s.tobytes() for s in sets], pa.binary())],
                                                 schema=schema)
    return run


def _confirmer(percent: int):
    def linked(a: bytes, b: bytes) -> bool:
        x, y = np.frombuffer(a, U64), np.frombuffer(b, U64)
        both = len(np.intersect1d(x, y, assume_unique=True))
        return 100 * both >= percent * (len(x) + len(y) - both)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            good = [linked(x.as_py(), y.as_py()) for x, y in zip(b.column("set_a"), b.column("set_b"))]
            yield b.select(["node_a", "node_b"]).filter(pa.array(good, pa.bool_()))
    return run


_PAIR = "node_a long, node_b long"


def _sided(df: DataFrame, side: str, **renamed: str) -> DataFrame:
    return df.select(F.col("node").alias(f"node_{side}"), *(F.col(c).alias(f"{to}_{side}") for c, to in renamed.items()))


def confirm(pairs: DataFrame, docs: DataFrame, reps: DataFrame, k: int, percent: int) -> DataFrame:
    """Those of ``pairs`` (node_a, node_b) that full shingle sets link; written to the shared folder.

    The sets are made again from the texts of the nodes in question alone
    (``reps``: node, doc_id), so that no sets of other documents are moved.
    """
    asked = materialize(pairs.select(F.col("node_a").alias("node")).union(pairs.select(F.col("node_b").alias("node")))
                        .distinct().join(reps, "node"))
    ids = asked.select("doc_id").distinct()
    if asked.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    texts = _rows(docs).join(ids, "doc_id", "left_semi")
    sets = materialize(texts.mapInArrow(_setter(k), "node long, hashes binary").join(asked, "node", "left_semi"))
    return materialize(pairs.join(_sided(sets, "a", hashes="set"), "node_a").join(_sided(sets, "b", hashes="set"), "node_b")
                       .select("node_a", "node_b", "set_a", "set_b").mapInArrow(_confirmer(percent), _PAIR))


def near_duplicates(docs: DataFrame, k: int = 4, percent: int = 80) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Documents link where 100 * intersection >= percent * union of their sets
    of ``k``-word shingles (A-Z lower-cased, words between blanks; fewer words:
    the whole sequence is the one shingle). component_id is the smallest
    doc_id reachable, kept says that it is the document's own. Null, empty and
    blank texts have no shingles and link with nothing. Exact copies and
    repeated rows share a component; rows that repeat a doc_id each get a row,
    by their own text. Other columns are ignored; an empty table gives no rows.
    """
    signed = materialize(signatures(docs, k, percent))
    reps = signed.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("doc_id"))
    nodes = materialize(signed.where("node is not null").select("node", F.col("n_shingles").alias("n"), "regs", "bands", "small")
                        .dropDuplicates(["node"]))
    sketches = nodes.select("node", "n", "regs")

    first = materialize(first_shingles(nodes, percent))
    exploded = meeting_keys(nodes, first)
    crowded = exploded.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    buckets = materialize(exploded.join(crowded, "key"))
    central = buckets.groupBy("node").agg(F.sum("size").alias("central"))
    pivots = (buckets.join(central, "node").groupBy("key")
              .agg(F.max(F.struct("central", "node")).alias("top")).select("key", F.col("top.node").alias("node_a")))
    pairs = (buckets.select("key", F.col("node").alias("node_b")).join(pivots, "key")
             .where("node_a <> node_b").select("node_a", "node_b").distinct())
    hopes = (pairs.join(_sided(sketches, "a", n="n", regs="regs"), "node_a")
             .join(_sided(sketches, "b", n="n", regs="regs"), "node_b")
             .select("node_a", "node_b", "n_a", "n_b", "regs_a", "regs_b").mapInArrow(_estimator(percent), _PAIR))
    links = confirm(materialize(hopes), docs, reps, k, percent)

    labels = components(links)
    members = (buckets.join(labels, "node", "left")
               .select("key", "node", "size", F.coalesce("label", "node").alias("label")))
    mixed = (members.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"))
             .where("low <> high").select("key"))
    n_blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    block = F.when(n_blocks == 1, 0).otherwise(F.pmod(F.hash("node"), n_blocks))
    dealt = (members.join(mixed, "key").withColumn("block", block)
             .withColumn("other", F.explode(F.sequence(F.lit(0), n_blocks - 1)))
             .select("key", F.least("block", "other").alias("left"), F.greatest("block", "other").alias("right"),
                     (F.col("block") > F.col("other")).cast("int").alias("side"), "node", "label")
             .join(sketches, "node").join(first, "node", "left"))
    crossing = (dealt.repartition("key", "left", "right").sortWithinPartitions("key", "left", "right", "side")
                .select("key", "left", "right", "side", "node", "label", "n", "regs", "first")
                .mapInArrow(_crosser(percent), _PAIR))
    more = confirm(materialize(crossing), docs, reps, k, percent)
    final = components(links.union(more))

    named = (reps.join(final, "node", "left")
             .select("node", F.coalesce("label", "node").alias("label"), "doc_id"))
    least = named.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    classes = named.join(least, "label").select("node", "component_id")
    return (signed.select("doc_id", "n_shingles", "node").join(classes, "node", "left")
            .select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
            .withColumn("kept", F.col("doc_id") == F.col("component_id")))
