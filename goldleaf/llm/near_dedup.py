"""Near duplicates by circulant MinHash, banding and exact Jaccard checks.

Two permutations make all signature coordinates: ``sigma`` scatters the
shingles over a circle of 2**32 places, and coordinate ``k`` is the least value
of ``pi`` over the places shifted by ``k``.  Both are fixed bijections of 32-bit
numbers.

Steps, each on the whole input:

1. Documents with equal shingle sets become one node.
2. Bands of the signature put nodes into buckets.  In each bucket every node is
   compared with the bucket's least node, on full sets.  The links found give
   first components, so copies of one text need no further comparison.
3. A bucket that still holds several components is dealt out in pairs of
   blocks.  Signatures tell which nodes can have a partner in another
   component; those are compared on full sets, and a task returns links that
   join two components, at most one less than its nodes.  No pairs leave a task.

Two sets of similarity 0.75 share a band with probability 1 - 3e-7; nodes of
which fewer than 55 % of the coordinates agree are taken for unlike, five
standard deviations below 0.75.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldleaf.llm.bitmaps import possible
from goldleaf.llm.blocks import blocks, mix, runs, shingle_sets
from goldleaf.llm.components import components
from goldleaf.llm.tasks import map_arrow
from goldleaf.sources.tables import materialize

BANDS, BAND_ROWS = 40, 4
COORDINATES = BANDS * BAND_ROWS
AGREEING = 0.55
PERCENT = 75
BLOCK_NODES = 1024

U32, U64 = np.uint32, np.uint64


def sigma(shingles: np.ndarray) -> np.ndarray:
    """The places of the shingles on the circle."""
    return (mix(shingles ^ U64(0x5851F42D4C957F2D)) >> U64(32)).astype(U32)


def pi(places: np.ndarray) -> np.ndarray:
    x = places ^ (places >> U32(16))
    x *= U32(0x7FEB352D)
    x ^= x >> U32(15)
    x *= U32(0x846CA68B)
    x ^= x >> U32(16)
    return x


def signatures(shingles: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """One row of coordinates per set; no set is empty."""
    out = np.empty((len(firsts), COORDINATES), U32)
    places = sigma(shingles)
    for k in range(COORDINATES):
        out[:, k] = np.minimum.reduceat(pi(places + U32(k)), firsts)
    return out


def band_keys(signature: np.ndarray) -> np.ndarray:
    parts = signature.reshape(len(signature), BANDS, BAND_ROWS).astype(U64)
    key = np.broadcast_to(mix(np.arange(BANDS, dtype=U64)), parts.shape[:2])
    for j in range(BAND_ROWS):
        key = mix(key + parts[:, :, j] * U64(0x9E3779B97F4A7C15))
    return key.view(np.int64)


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block in blocks(batches):
        shingles, firsts = shingle_sets(block.data, block.offsets)
        sizes = np.diff(firsts)
        some = np.flatnonzero(sizes)
        set_a, set_b = np.zeros(len(sizes), U64), np.zeros(len(sizes), U64)
        keys = np.zeros((0, BANDS), np.int64)
        if len(some):
            at = firsts[:-1][some]
            set_a[some] = np.add.reduceat(mix(shingles ^ U64(0x2545F4914F6CDD1D)), at)
            set_b[some] = np.add.reduceat(mix(shingles ^ U64(0xDA942042E4DD58B5)), at)
            keys = band_keys(signatures(shingles, at))
        places = np.concatenate([[0], np.cumsum(np.where(sizes > 0, BANDS, 0))]).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [
                block.rows.column("doc_id"),
                pa.array(sizes),
                pa.array(set_a.view(np.int64)),
                pa.array(set_b.view(np.int64)),
                pa.ListArray.from_arrays(places, keys.ravel()),
            ],
            ["doc_id", "n_shingles", "set_a", "set_b", "bands"],
        )


def _binary(rows: list[np.ndarray]) -> pa.Array:
    return pa.array([r.tobytes() for r in rows], pa.binary())


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block in blocks(batches):
        shingles, firsts = shingle_sets(block.data, block.offsets)
        if not (np.diff(firsts) > 0).all():
            raise ValueError("a node without words")
        yield pa.RecordBatch.from_arrays(
            [
                block.rows.column("node"),
                _binary(list(signatures(shingles, firsts[:-1]))),
                _binary([shingles[a:b] for a, b in zip(firsts[:-1], firsts[1:])]),
            ],
            ["node", "signature", "shingles"],
        )


def _alike(common: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    return (common > 0) & (100 * common >= PERCENT * (sizes - common))


def _check_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept = []
        for a, b in zip(batch.column("set_u"), batch.column("set_v")):
            a, b = np.frombuffer(a.as_buffer(), U64), np.frombuffer(b.as_buffer(), U64)
            common = len(np.intersect1d(a, b, assume_unique=True))
            kept.append(bool(_alike(np.int64(common), np.int64(len(a) + len(b)))))
        yield batch.select(["u", "v"]).filter(pa.array(kept, pa.bool_()))


def _pairs_apart(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Which rows are on the left and the right of a block pair; one block pairs with itself."""
    block = table.column("block").to_numpy()
    left, right = table.column("i")[0].as_py(), table.column("j")[0].as_py()
    return np.flatnonzero(block == left), np.flatnonzero(block == right)


def _promising(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with a partner in another component whose signature agrees enough.

    A pair counts only in the first band that it shares.
    """
    for table in runs(batches, ["key", "i", "j"]):
        left, right = _pairs_apart(table)
        rows = np.frombuffer(b"".join(table.column("signature").to_pylist()), U32).reshape(-1, COORDINATES)
        component = table.column("component").to_numpy()
        band = table.column("band")[0].as_py()
        wanted = np.zeros(len(rows), bool)
        for x in left:
            others = right[component[right] != component[x]]
            same = rows[others] == rows[x]
            close = others[same.mean(axis=1) >= AGREEING]
            if len(close):
                shared = (rows[close] == rows[x]).reshape(len(close), BANDS, BAND_ROWS).all(axis=2)
                close = close[shared.argmax(axis=1) == band]
                wanted[close] = True
                wanted[x] |= len(close) > 0
        if wanted.any():
            found = table.select(["key", "i", "j", "block", "node", "component"]).filter(pa.array(wanted))
            yield from found.combine_chunks().to_batches()


def exact_links(left: list[np.ndarray], right: list[np.ndarray], left_of: np.ndarray, right_of: np.ndarray) -> list[tuple[int, int]]:
    """Pairs (left, right) that join different components and are alike on full sets.

    ``left_of`` and ``right_of`` are the components.  Intersections of all pairs
    are products of 0/1 matrices over the shingles that occur on both sides,
    some thousand shingles at a time.
    """
    sizes_l, sizes_r = np.array([len(s) for s in left]), np.array([len(s) for s in right])
    all_l, all_r = np.concatenate(left), np.concatenate(right)
    both = np.intersect1d(all_l, all_r)
    row_l, row_r = np.repeat(np.arange(len(left)), sizes_l), np.repeat(np.arange(len(right)), sizes_r)
    keep_l, keep_r = np.isin(all_l, both), np.isin(all_r, both)
    row_l, row_r = row_l[keep_l], row_r[keep_r]
    col_l, col_r = np.searchsorted(both, all_l[keep_l]), np.searchsorted(both, all_r[keep_r])
    common = np.zeros((len(left), len(right)), np.float32)
    width = 8192
    for start in range(0, len(both), width):
        a, b = np.zeros((len(left), width), np.float32), np.zeros((len(right), width), np.float32)
        for m, row, col in ((a, row_l, col_l), (b, row_r, col_r)):
            here = (col >= start) & (col < start + width)
            m[row[here], col[here] - start] = 1
        common += a @ b.T
    alike = _alike(common.astype(np.int64), sizes_l[:, None] + sizes_r[None, :])
    alike &= left_of[:, None] != right_of[None, :]
    root: dict[int, int] = {}

    def top(x: int) -> int:
        while root.get(x, x) != x:
            x = root[x]
        return x

    found = []
    for x, y in zip(*np.nonzero(alike)):
        a, b = top(int(left_of[x])), top(int(right_of[y]))
        if a != b:
            root[max(a, b)] = min(a, b)
            found.append((int(x), int(y)))
    return found


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table in runs(batches, ["key", "i", "j"]):
        left, right = _pairs_apart(table)
        if not (len(left) and len(right)):
            continue
        sets = [np.frombuffer(s.as_buffer(), U64) for s in table.column("shingles")]
        node, component = table.column("node").to_numpy(), table.column("component").to_numpy()
        found = exact_links([sets[x] for x in left], [sets[x] for x in right], component[left], component[right])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(node[left[[x for x, _ in found]]] if found else [], pa.int64()),
                pa.array(node[right[[y for _, y in found]]] if found else [], pa.int64()),
            ],
            ["u", "v"],
        )


def _with_components(rows: DataFrame, named: DataFrame) -> DataFrame:
    return rows.join(named, "node", "left").withColumn("component", F.coalesce("component", "node"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row of (doc_id, text).

    A null text, or one without words, has no shingles and is linked with
    nothing.  Rows of one doc_id count as one document.  A row without doc_id
    links with nothing and keeps a null component; it is kept.  Repeated rows
    get the same result each.  Other columns are ignored.
    """
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    features = materialize(
        map_arrow(
            docs, _features, "doc_id bigint, n_shingles bigint, set_a bigint, set_b bigint, bands array<bigint>"
        ),
        "minhash",
    )
    # Copies of a set have equal bands, whichever row they are taken from.
    nodes = materialize(
        features.where("doc_id IS NOT NULL AND n_shingles > 0")
        .groupBy("set_a", "set_b")
        .agg(F.min("doc_id").alias("node"), F.any_value("bands").alias("bands")),
        "nodes",
    )
    rows = nodes.select("node", F.posexplode("bands").alias("band", "key"))
    hubs = rows.groupBy("key").agg(F.min("node").alias("hub"), F.count(F.lit(1)).alias("n")).where("n > 1")
    buckets = materialize(rows.join(hubs, "key"), "buckets")
    stars = materialize(
        buckets.where("node <> hub").select(F.col("node").alias("u"), F.col("hub").alias("v")).distinct(), "stars"
    )
    wanted = stars.select(F.col("u").alias("node")).unionByName(stars.select(F.col("v").alias("node"))).distinct()
    texts = docs.withColumnRenamed("doc_id", "node").where(F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    sets = materialize(
        map_arrow(
            possible(texts, wanted, "node").join(wanted.hint("merge"), "node", "left_semi"), _sets, "node bigint, signature binary, shingles binary"
        ),
        "sets",
    )
    one_set = sets.select("node", "shingles")
    # One plan at every size: sets are dealt out by node and never follow a broadcast of the pairs.
    pairs = one_set.toDF("u", "set_u").join(stars.hint("merge"), "u").join(one_set.toDF("v", "set_v").hint("merge"), "v")
    links = materialize(
        map_arrow(pairs.select("u", "v", "set_u", "set_v"), _check_pairs, "u bigint, v bigint"), "checked"
    )
    first = components(links)

    rows = materialize(_with_components(buckets, first), "rows")
    open_keys = (
        rows.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high")
    )
    n_blocks = F.ceil(F.col("n") / BLOCK_NODES).cast("int")
    dealt = (
        rows.join(open_keys.select("key"), "key")
        .withColumn("block", F.pmod(F.xxhash64("node"), n_blocks).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), n_blocks - 1)))
        .withColumn("i", F.least("block", "other"))
        .withColumn("j", F.greatest("block", "other"))
        .select("key", "band", "i", "j", "block", "node", "component")
    )

    def together(df: DataFrame) -> DataFrame:
        return df.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "node")

    promising = materialize(
        map_arrow(
            together(dealt.join(sets.select("node", "signature").hint("merge"), "node")),
            _promising,
            "key bigint, i int, j int, block int, node bigint, component bigint",
        ),
        "promising",
    )
    more = map_arrow(together(promising.join(one_set.hint("merge"), "node")), _compare, "u bigint, v bigint")
    final = components(links.unionByName(more))

    of_set = _with_components(nodes.drop("bands"), final)
    return (
        features.drop("bands")
        .join(of_set, ["set_a", "set_b"], "left")
        .select(
            "doc_id",
            "n_shingles",
            F.when(F.col("n_shingles") > 0, F.when(F.col("doc_id").isNotNull(), F.col("component")))
            .otherwise(F.col("doc_id"))
            .alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )
