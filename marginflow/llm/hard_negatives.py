"""Hard negatives by slots: top rows per disjoint score slot answer overlapping windows.

Each of an anchor's positives (its best rows of the same label) asks for the best
rows of other labels with a score in a window below its own. The windows' upper
limits split the scores into disjoint slots. Combiners inside tasks keep the
first k rows of each anchor and slot, a second combine does so over all tasks, and
every window is answered by the slots from its upper limit down, merged in order:
the first k of that suffix, as far as the window's lower limit admits them.

Anchors go out in blocks of ``ANCHOR_BYTES``. For a block the vectors are read
twice, where they lie: once for the positives, once for the slots. Only the
combiners' rows are shuffled, and only a block's anchors and its positives'
scores meet the driver. The work is the product of anchors and rows, as the
question asks.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, materialize

ANCHOR_BYTES = 32 << 20      # components (8 bytes each) of the anchors in one block
TILE_ROWS, TILE_ANCHORS = 2048, 1024
FIRST_TILE = 128             # tiles of rows grow up to TILE_ROWS while the combiner's thresholds settle
SCALE = 256
MOST_COMPONENT, MOST_SCORE = 1 << 40, 1 << 56
_NEVER = -(1 << 62)
_ABOVE = 1 << 62


def quantised(values: np.ndarray) -> np.ndarray:
    """floor(256 x) of doubles, kept within MOST_COMPONENT."""
    with np.errstate(over="ignore"):
        return np.clip(np.floor(values * SCALE), -MOST_COMPONENT, MOST_COMPONENT)


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products of the rows of ``a`` and ``b`` (whole numbers as float64)."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    most = float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1]
    if most < 1 << 24:
        return (a.astype(np.float32) @ b.astype(np.float32).T).astype(np.int64)
    if most < 1 << 53:
        return (a @ b.T).astype(np.int64)
    whole = np.vectorize(int, otypes=[object])
    exact = whole(a) @ whole(b).T
    return np.clip(exact, -MOST_SCORE, MOST_SCORE).astype(np.int64)


def _vectors(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The rows of one vector length, and their quantised vectors."""
    column = batch.column("embedding")
    offsets = column.offsets.to_numpy()
    flat = column.values.to_numpy(zero_copy_only=False)
    sizes = np.diff(offsets)
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        at = offsets[rows][:, None] + np.arange(size)
        yield rows, quantised(flat[at].astype(np.float64))


@dataclass
class Block:
    """Anchors of one block, and the slots of each: (lower, upper] in descending order, empty where lower >= upper."""

    ids: np.ndarray
    labels: np.ndarray
    vectors: dict[int, tuple[np.ndarray, np.ndarray]]  # length -> (anchors, quantised vectors)
    same: bool               # rows of the anchor's label (other rows than itself), or of other labels
    keep: int
    lower: np.ndarray        # anchors x slots
    upper: np.ndarray


class Combiner:
    """The first ``keep`` rows of each anchor and slot: higher scores first, ties by smaller id, null ids last."""

    def __init__(self, block: Block):
        self.b = block
        n, self.slots = block.lower.shape
        self.rows = [np.zeros(0, np.int64)] * 3 + [np.zeros(0, bool)]  # group (anchor, slot), score, id, null id
        self.new: list[tuple] = []
        self.waiting = 0
        self.tile = FIRST_TILE
        self.least = np.full(n * self.slots, _NEVER)      # a group's last kept score and id, once it is full
        self.least_id = np.full(n * self.slots, np.iinfo(np.int64).max)
        self._floor()

    def _floor(self) -> None:
        lower, upper = self.b.lower, self.b.upper
        floor = np.maximum(lower + 1, self.least.reshape(lower.shape))
        self.floor = np.where(lower < upper, floor, _ABOVE).min(1, initial=_ABOVE)
        self.ceiling = upper.max(1, initial=_NEVER)

    def settle(self) -> None:
        """Cut every group to its first rows."""
        if not self.waiting:
            return
        group, score, ids, null = (np.concatenate(x) for x in zip(self.rows, *self.new))
        self.new, self.waiting = [], 0
        order = np.lexsort((ids, null, -score, group))
        group = group[order]
        start = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        rank = np.arange(len(group)) - np.repeat(start, np.diff(np.append(start, len(group))))
        order = order[rank < self.b.keep]
        group, rank = group[rank < self.b.keep], rank[rank < self.b.keep]
        self.rows = [group, score[order], ids[order], null[order]]
        full = rank == self.b.keep - 1
        self.least[group[full]] = self.rows[1][full]
        self.least_id[group[full]] = np.where(self.rows[3][full], np.iinfo(np.int64).max, self.rows[2][full])
        self._floor()

    def _tile(self, of: np.ndarray, anchors: np.ndarray, rows: np.ndarray, labels, ids, null) -> None:
        b = self.b
        s = scores(anchors, rows)
        hit = (s >= self.floor[of][:, None]) & (s <= self.ceiling[of][:, None])
        hit &= (b.labels[of][:, None] == labels) == b.same
        if b.same:
            hit &= (b.ids[of][:, None] != ids) | null
        i, j = np.nonzero(hit)
        if not len(i):
            return
        a, score = of[i], s[i, j]
        slot = (score[:, None] <= b.upper[a]).sum(1) - 1
        group = a * self.slots + slot
        good = (score > b.lower[a, slot]) & ((score > self.least[group]) | (score == self.least[group]) & (ids[j] <= self.least_id[group]))
        if good.any():
            j = j[good]
            self.new.append((group[good], score[good], ids[j], null[j]))
            self.waiting += len(j)
            if self.tile < TILE_ROWS or self.waiting > max(1 << 16, len(self.rows[0]) // 2):
                self.settle()

    def add(self, batch: pa.RecordBatch) -> None:
        ids = batch.column("vec_id")
        null = ids.is_null().to_numpy(zero_copy_only=False)
        ids = ids.fill_null(np.iinfo(np.int64).max).to_numpy(zero_copy_only=False)
        labels = batch.column("label").to_numpy(zero_copy_only=False)
        for rows, vectors in _vectors(batch):
            of, anchors = self.b.vectors.get(vectors.shape[1], (np.zeros(0, np.int64), None))
            order = np.argsort(ids[rows], kind="stable")
            rows, vectors = rows[order], vectors[order]
            at = 0
            while at < len(rows) and len(of):
                part = slice(at, at + self.tile)
                r = rows[part]
                for lo in range(0, len(of), TILE_ANCHORS):
                    hi = lo + TILE_ANCHORS
                    self._tile(of[lo:hi], anchors[lo:hi], vectors[part], labels[r], ids[r], null[r])
                at += self.tile
                self.tile = min(TILE_ROWS, 2 * self.tile)


_TOP = "anchor int, slot int, vec_id long, score long"


def _combined(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        combiner = Combiner(shared.value)
        for batch in batches:
            combiner.add(batch)
        combiner.settle()
        group, score, ids, null = combiner.rows
        for lo in range(0, len(group), 1 << 16):
            part = slice(lo, lo + (1 << 16))
            yield pa.RecordBatch.from_arrays([
                pa.array((group[part] // combiner.slots).astype(np.int32)), pa.array((group[part] % combiner.slots).astype(np.int32)),
                pa.array(ids[part], mask=null[part]), pa.array(score[part])], ["anchor", "slot", "vec_id", "score"])
    return run


def _top(rows: DataFrame, block: Block) -> DataFrame:
    """anchor, slot, vec_id, score, rank: the first ``block.keep`` rows of all."""
    shared = rows.sparkSession.sparkContext.broadcast(block)
    best = W.partitionBy("anchor", "slot").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return (rows.mapInArrow(_combined(shared), _TOP).withColumn("rank", F.row_number().over(best))
            .where(F.col("rank") <= block.keep))


def _arrays(anchors: pa.Table) -> tuple[np.ndarray, np.ndarray, dict]:
    vectors: dict[int, list] = {}
    start = 0
    for batch in anchors.to_batches():
        for rows, v in _vectors(batch):
            vectors.setdefault(v.shape[1], []).append((rows + start, v))
        start += batch.num_rows
    return (anchors.column("vec_id").to_numpy(), anchors.column("label").to_numpy(),
            {k: tuple(np.concatenate(x) for x in zip(*parts)) for k, parts in vectors.items()})


def slots_of(n: int, anchor: np.ndarray, score: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """(lower, upper) of each anchor's slots, given its positives' scores: windows are low % to high % of a score.

    Lower limits are exclusive. A negative score's window is empty. Slots end below the lowest window.
    """
    upper = np.full((n, 1), _NEVER)
    lowest = np.full(n, _ABOVE)
    use = score >= 0
    anchor, score = anchor[use], score[use]
    order = np.lexsort((-score, anchor))
    anchor, score = anchor[order], score[order]
    start = np.searchsorted(anchor, np.arange(n))
    if len(anchor):
        place = np.arange(len(anchor)) - start[anchor]
        upper = np.full((n, int(place.max()) + 1), _NEVER)
        upper[anchor, place] = high * score // 100
        np.minimum.at(lowest, anchor, -(-low * score // 100))
    lower = np.concatenate([upper[:, 1:], np.full((n, 1), _NEVER)], 1)
    return np.maximum(lower, lowest[:, None] - 1), upper


def _mine_block(rows: DataFrame, anchors: pa.Table, positives: int, negatives: int, low: int, high: int) -> DataFrame:
    ids, labels, vectors = _arrays(anchors)
    n = len(ids)
    every = Block(ids, labels, vectors, True, positives, np.full((n, 1), _NEVER), np.full((n, 1), _ABOVE))
    found = materialize(_top(rows, every).select("anchor", F.col("vec_id").alias("positive_id"),
                                                 F.col("score").alias("positive_score")))
    known = found.select("anchor", "positive_score").toArrow()  # at most ``positives`` of each anchor of the block
    lower, upper = slots_of(n, known.column(0).to_numpy().astype(np.int64), known.column(1).to_numpy(), low, high)
    windows = Block(ids, labels, vectors, False, negatives, lower, upper)
    # at most slots x negatives entries of an anchor
    entry = F.struct((-F.col("score")).alias("down"), F.col("vec_id").isNull().alias("null"), F.col("vec_id").alias("id"))
    ordered = _top(rows, windows).groupBy("anchor").agg(F.sort_array(F.collect_list(entry)).alias("entries"))
    p = F.col("positive_score")
    fits = F.slice(F.filter("entries", lambda e: (low * p <= -100 * e["down"]) & (-100 * e["down"] <= high * p)), 1, negatives)
    names = rows.sparkSession.createDataFrame(pa.table({"anchor": pa.array(np.arange(n), pa.int32()), "anchor_id": ids}))
    return (found.join(ordered, "anchor").join(F.broadcast(names), "anchor")
            .select("anchor_id", "positive_id", p, F.posexplode(fits).alias("place", "entry"))
            .select("anchor_id", "positive_id", (F.col("place") + 1).cast("int").alias("rank"),
                    F.col("entry.id").alias("negative_id"), "positive_score", (-F.col("entry.down")).alias("negative_score")))


RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def mine(vectors: DataFrame, is_anchor: str, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
         anchor_bytes: int = ANCHOR_BYTES) -> DataFrame:
    """Hard negatives of the anchors among ``vectors`` (vec_id, label, embedding).

    ``is_anchor`` is a condition on vec_id. An anchor's positives are its first ``positives`` rows of the same
    label, each answered by the first ``negatives`` rows of other labels whose score is ``low`` to ``high``
    percent of the positive's. Columns: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Rows with a null label or vector, or a null or non-finite component, take no part. Scores are exact inner products of floor(256 x);
    components beyond 2**40 count as 2**40, scores beyond 2**56 as 2**56. Vectors of other lengths than the
    anchor's are not compared with it, empty ones score 0. Ties go by the smaller vec_id, null ids last. Each row
    counts, repeated ones too, but an anchor row that is repeated whole is one anchor, and rows with the anchor's vec_id
    are never its positives. Anchors have a vec_id. Other columns are ignored; no anchors give no rows.
    """
    odd = F.exists(F.col("embedding"), lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = (vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
                           F.col("embedding").cast("array<double>").alias("embedding"))
            .where("label is not null and embedding is not null").where(~odd))
    anchors = materialize(rows.where("vec_id is not null").where(is_anchor).distinct())
    total = anchors.agg(F.sum(F.size("embedding") * 8 + 64)).first()[0] or 0
    if not total:
        return rows.sparkSession.createDataFrame([], RESULT)
    blocks = -(-total // anchor_bytes)
    spark = rows.sparkSession
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/marginflow-tables/{uuid.uuid4().hex}"
    for k in range(blocks):
        block = anchors.where(F.pmod(F.xxhash64("vec_id", "label", "embedding"), F.lit(blocks)) == k).toArrow()
        if block.num_rows:
            _mine_block(rows, block, positives, negatives, low, high).write.parquet(f"{base}/block={k}")
    return spark.read.schema(RESULT).parquet(f"{base}/*")
