"""MinHash near-duplicate detection with banded candidates and odd sketches.

Texts with one shingle set form a class, so exact copies never meet in pairs. Classes that share a band of ROWS of
their BANDS * ROWS MinHash values are candidates: two sets of Jaccard similarity 0.8 share none with probability
(1 - 0.8**5)**32 < 4e-6. The samples are also folded into an odd sketch (parity bits); the population count of two
sketches' XOR tells high similarities precisely, so it sorts out candidates before full sets are fetched. Every link is
confirmed on full sets.

A bucket of m classes makes m - 1 candidates, not m**2 / 2: each class with the bucket's hub, the class that shares
most bands with others. In a bucket whose classes are not all connected after that, those outside its largest component
are compared with all others, in blocks bounded by rows and by bytes: nearest sketches first, and only until two
components are linked. So no pair that shares a band stays untested unless it is connected already.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from collatio.llm.components import components
from collatio.llm.shared import durable, releasing, unused
from collatio.llm.shingles import WordHashes, mix, shared, shingle_set

BANDS, ROWS = 32, 5
SAMPLES = BANDS * ROWS
SKETCH_WORDS = 8
SKETCH_BITS = 64 * SKETCH_WORDS
#: Candidates whose sketches put them this far below the threshold are dropped: over 5 standard deviations of the estimate.
SLACK = 0.2
#: Classes of a bucket that a task compares: strays and members, and the bytes of sets of either.
STRAYS, MEMBERS = 256, 2048
BLOCK_BYTES = 8_000_000
#: Classes whose sets are wanted up to which their keys (24 bytes each) are broadcast, so that no other text moves.
BROADCAST_ROWS = 200_000

_random = np.random.default_rng(20240607)
_XOR = _random.integers(0, 2**32, SAMPLES, dtype=np.uint32)
_TIMES = _random.integers(0, 2**32, SAMPLES, dtype=np.uint32) | np.uint32(1)
_SALT = _random.integers(0, 2**63, SAMPLES, dtype=np.uint64)


def min_hashes(items: np.ndarray) -> np.ndarray:
    """SAMPLES minima of a non-empty set of 64-bit hashes."""
    low = (items ^ (items >> np.uint64(32))).astype(np.uint32)
    best = np.full(SAMPLES, 2**32 - 1, dtype=np.uint32)
    for i in range(0, len(low), 128):
        np.minimum(best, ((low[i : i + 128, None] ^ _XOR) * _TIMES).min(axis=0), out=best)
    return best


def band_keys(samples: np.ndarray) -> np.ndarray:
    """(n, SAMPLES) minima -> (n, BANDS) keys."""
    parts = samples.reshape(len(samples), BANDS, ROWS).astype(np.uint64)
    keys = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), parts.shape[:2])
    for i in range(ROWS):
        keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, i])
    return keys.view(np.int64)


def odd_sketches(samples: np.ndarray) -> np.ndarray:
    """(n, SAMPLES) minima -> (n, SKETCH_WORDS) longs: bit j is the parity of the samples that hash to j."""
    at = (mix(samples.astype(np.uint64) ^ _SALT) % np.uint64(SKETCH_BITS)).astype(np.int64)
    bits = np.zeros((len(samples), SKETCH_BITS), dtype=np.uint8)
    np.bitwise_xor.at(bits, (np.arange(len(samples))[:, None], at), 1)
    return np.packbits(bits, axis=1).view(np.int64)


def most_bits(similarity: float) -> int:
    """The population count of the XOR of two sketches that stands for this similarity of their sets."""
    return math.ceil(SKETCH_BITS / 2 * (1 - math.exp(-4 * SAMPLES * (1 - similarity) / SKETCH_BITS)))


SIGNATURE = "row long, doc_id long, text_hash long, n_shingles long, set_id binary, keys array<long>, sketch array<long>"


def signatures(docs: DataFrame, ngram: int) -> DataFrame:
    """docs (row, doc_id, text_hash, text) -> SIGNATURE; a text without words has null set_id, keys and sketch."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            texts = batch.column(3).cast(pa.binary())
            sets, minima, sizes = [], [], []
            for text in texts:
                items = shingle_set(text.as_py(), ngram, known)
                sizes.append(len(items))
                sets.append(hashlib.blake2b(items.tobytes(), digest_size=16).digest() if len(items) else None)
                minima.append(min_hashes(items) if len(items) else np.zeros(SAMPLES, dtype=np.uint32))
            if not sizes:
                continue
            samples, empty = np.array(minima), pa.array(np.array(sizes) == 0)
            lists = []
            for found in (band_keys(samples), odd_sketches(samples)):
                offsets = pa.array(np.arange(len(found) + 1, dtype=np.int32) * found.shape[1])
                lists.append(pa.ListArray.from_arrays(offsets, pa.array(found.ravel()), mask=empty))
            columns = [batch.column(0), batch.column(1), batch.column(2), pa.array(sizes, pa.int64()), pa.array(sets, pa.binary()), *lists]
            yield pa.RecordBatch.from_arrays(columns, names=["row", "doc_id", "text_hash", "n_shingles", "set_id", "keys", "sketch"])

    return docs.mapInArrow(releasing(sign), SIGNATURE)


def _full_sets(docs: DataFrame, nodes: DataFrame, wanted: DataFrame, ngram: int) -> DataFrame:
    """(node, items): the shingle sets of the wanted nodes: only their texts are read again into Python."""
    keys = durable(nodes.join(wanted.select("node").distinct(), "node").select("node", "id_key", "text_hash"))
    texts = docs.join(F.broadcast(keys) if keys.count() <= BROADCAST_ROWS else keys, ["id_key", "text_hash"]).select("node", "text")

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            for lo in range(0, len(batch), 256):
                part = batch.slice(lo, 256)
                sets = [shingle_set(t.as_py(), ngram, known).tobytes() for t in part.column(1).cast(pa.binary())]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sets, pa.binary())], names=["node", "items"])

    # Rows that repeat id and text give one class several times.
    return durable(texts.mapInArrow(releasing(expand), "node long, items binary").groupBy("node").agg(F.max("items").alias("items")))


def _sketch_bits(a: str, b: str) -> Column:
    total = F.lit(0)
    for i in range(SKETCH_WORDS):
        total = total + F.bit_count(F.col(a)[i].bitwiseXOR(F.col(b)[i]))
    return total


def _confirmed(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, ngram: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets have at least `percent` of their union in common."""
    sets = _full_sets(docs, nodes, pairs.select(F.explode(F.array("a", "b")).alias("node")), ngram)

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = np.frombuffer(x.as_py(), dtype=np.uint64), np.frombuffer(y.as_py(), dtype=np.uint64)
                both = shared(x, y)
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left, right = sets.select(F.col("node").alias("a"), F.col("items").alias("x")), sets.select(F.col("node").alias("b"), F.col("items").alias("y"))
    return durable(pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(confirm, "a long, b long"))


def _block_links(table: pa.Table, percent: int) -> pa.Table:
    """Links between the strays and the members of one block of a bucket that join different components.

    A pair that shares several bands is tested in the bucket of the first one only.
    """
    columns = {n: table[n].combine_chunks() for n in ("key", "node", "comp", "n_shingles", "stray", "keys", "sketch", "items")}
    key, node, comp, sizes = (columns[n].to_numpy() for n in ("key", "node", "comp", "n_shingles"))
    stray, items = columns["stray"].to_numpy(zero_copy_only=False), columns["items"]
    keys = columns["keys"].flatten().to_numpy().reshape(-1, BANDS)
    sketch = columns["sketch"].flatten().to_numpy().view(np.uint64).reshape(len(node), -1)
    members = np.flatnonzero(~stray)
    limit = most_bits(percent / 100 - SLACK)
    root: dict[int, int] = {}

    def find(c: int) -> int:
        while root.get(c, c) != c:
            c = root[c]
        return c

    out: list[tuple[int, int]] = []
    for s in np.flatnonzero(stray):
        near = members[(comp[members] != comp[s]) & (100 * np.minimum(sizes[members], sizes[s]) >= percent * np.maximum(sizes[members], sizes[s]))]
        same = keys[near] == keys[s]
        near = near[same[np.arange(len(near)), same.argmax(axis=1)] & (keys[s][same.argmax(axis=1)] == key[s])]
        bits = np.bitwise_count(sketch[near] ^ sketch[s]).sum(axis=1, dtype=np.int64)
        near = near[bits <= limit][np.argsort(bits[bits <= limit], kind="stable")]
        own = np.frombuffer(items[int(s)].as_py(), dtype=np.uint64)
        for m in near:
            if find(int(comp[s])) == find(int(comp[m])):
                continue
            other = np.frombuffer(items[int(m)].as_py(), dtype=np.uint64)
            both = shared(own, other)
            if 100 * both >= percent * (len(own) + len(other) - both):
                out.append((int(node[s]), int(node[m])))
                root[find(int(comp[s]))] = find(int(comp[m]))
    return pa.table({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([y for _, y in out], pa.int64())})


def _leftover_links(members: DataFrame, links: DataFrame, docs: DataFrame, nodes: DataFrame, ngram: int, percent: int) -> DataFrame | None:
    """Links between classes that share a bucket but no component of the links so far; None if there are no such classes."""
    placed = members.join(components(links), "node", "left").select("key", "node", F.coalesce("comp", "node").alias("comp"))
    placed = placed.join(nodes.select("node", "n_shingles"), "node")
    rows, size = F.count("*").alias("rows"), F.sum(8 * F.col("n_shingles")).alias("bytes")
    sizes = durable(placed.groupBy("key", "comp").agg(rows, size))
    top = F.max(F.struct("rows", "comp", "bytes")).alias("top")
    # A bucket of two has been tested whole.
    mixed = sizes.groupBy("key").agg(F.count("*").alias("comps"), F.sum("rows").alias("rows"), F.sum("bytes").alias("bytes"), top).where("comps > 1 and rows > 2")

    def blocks(n: Column, most: int, size: Column) -> Column:
        return F.greatest(F.ceil(n / most), F.ceil(size / BLOCK_BYTES))

    mixed = durable(mixed.select("key", F.col("top.comp").alias("main"), blocks(F.col("rows") - F.col("top.rows"), STRAYS, F.col("bytes") - F.col("top.bytes")).alias("n_i"), blocks(F.col("rows"), MEMBERS, F.col("bytes")).alias("n_j")))
    if mixed.isEmpty():
        return None
    inside = durable(placed.join(mixed, "key"))
    sets = _full_sets(docs, nodes, inside, ngram)
    # The sets of a class go to each block that it is in; what a block holds is bounded, but for sets that alone are larger.
    rows = inside.drop("n_shingles").join(nodes.select("node", "n_shingles", "keys", "sketch").join(sets, "node"), "node")
    slot, columns = F.xxhash64("node"), ["node", "comp", "n_shingles", "keys", "sketch", "items"]
    left = rows.where("comp <> main").select("key", F.pmod(slot, "n_i").alias("i"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_j") - 1)).alias("j"), F.lit(True).alias("stray"), *columns)
    right = rows.select("key", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_i") - 1)).alias("i"), F.pmod(slot, "n_j").alias("j"), F.lit(False).alias("stray"), *columns)
    return durable(left.unionByName(right).groupBy("key", "i", "j").applyInArrow(lambda t: _block_links(t, percent), "a long, b long"))


def _grouped(docs: DataFrame, id_col: str, text_col: str, ngram: int, percent: int) -> DataFrame:
    """(row, doc_id, text_hash, n_shingles, first) for every row of docs; first is the struct of the row that stays."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    id_key = F.coalesce(F.col("doc_id"), F.lit(-(2**62))).alias("id_key")
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    signed = durable(signatures(source.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text_hash", "text"), ngram))
    texts = source.select(id_key, "text_hash", "text")
    worded = signed.where("n_shingles > 0")
    classes = worded.groupBy("set_id").agg(F.min("row").alias("node"))
    nodes = durable(worded.join(classes.select(F.col("node").alias("row")), "row").select(F.col("row").alias("node"), id_key, "text_hash", "n_shingles", "keys", "sketch"))
    entries = nodes.select("node", F.explode("keys").alias("key"))
    # Aggregates are written on their own before they are joined back: Spark can split a hot key only where both sides come straight from exchanges.
    buckets = durable(entries.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"))
    members = durable(entries.join(buckets, "key"))
    weights = members.groupBy("node").agg(F.sum("n").alias("weight"))
    hubs = durable(members.join(weights, "node").groupBy("key").agg(F.max(F.struct("weight", (-F.col("node")).alias("minus"))).alias("top")).select("key", (-F.col("top.minus")).alias("hub")))
    pairs = members.join(hubs, "key").where("node <> hub").select(F.greatest("node", "hub").alias("a"), F.least("node", "hub").alias("b")).distinct()
    light = nodes.select("node", "n_shingles", "sketch")
    a, b = (light.select(*[F.col(c).alias(f"{side}_{c}") for c in light.columns]) for side in ("a", "b"))
    near = pairs.join(a, F.col("a") == F.col("a_node")).join(b, F.col("b") == F.col("b_node"))
    near = near.where((_sketch_bits("a_sketch", "b_sketch") <= most_bits(percent / 100 - SLACK)) & (100 * F.least("a_n_shingles", "b_n_shingles") >= percent * F.greatest("a_n_shingles", "b_n_shingles"))).select("a", "b")
    links = _confirmed(durable(near), texts, nodes, ngram, percent)
    rest = _leftover_links(members.where("n > 2"), links, texts, nodes, ngram, percent)
    found = components(links if rest is None else links.unionByName(rest))
    joined = classes.join(found, "node", "left").select("set_id", F.coalesce("comp", "node").alias("comp"))
    rows = ["row", "doc_id", "text_hash", "n_shingles"]
    own = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row").alias("first")
    placed = durable(worded.select(*rows, "set_id").join(joined, "set_id"))
    first = durable(placed.groupBy("comp").agg(F.min(own).alias("first")))
    alone = signed.where("n_shingles = 0").select(*rows, own)
    return placed.join(first, "comp").select(*rows, "first").unionByName(alone)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ngram: int = 5, percent: int = 80) -> DataFrame:
    """One row per row of docs: doc_id, n_shingles, component_id, kept.

    Texts are linked when their sets of distinct `ngram`-word shingles (the whole sequence if shorter) have at least
    `percent` of their union in common. component_id is the smallest id that links lead to, kept marks the row that
    has it. Null and wordless texts have no shingles and are linked with nothing. Null ids come after all others;
    of rows that repeat an id as well, one is kept. An empty table gives an empty result. Other columns of docs are
    ignored, whatever their names.
    """
    found = _grouped(docs, id_col, text_col, ngram, percent)
    return found.select("doc_id", "n_shingles", F.col("first.doc_id").alias("component_id"), (F.col("first.row") == F.col("row")).alias("kept"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ngram: int = 5, percent: int = 80) -> DataFrame:
    """The rows of docs that near_duplicates marks as kept, with all their columns, whatever their names; of rows that repeat id and text one."""
    k0, k1, kept = unused(docs, "id_key", "text_hash", "kept")
    found = _grouped(docs, id_col, text_col, ngram, percent).where("n_shingles > 0")
    keys = found.groupBy(F.coalesce("doc_id", F.lit(-(2**62))).alias(k0), F.col("text_hash").alias(k1)).agg(F.max(F.col("first.row") == F.col("row")).alias(kept), F.count("*").alias("n"))
    # Keys whose rows don't all stay: few where few texts are copies, and then no text has to move.
    marked = durable(keys.where(~F.col(kept) | (F.col("n") > 1)).select(k0, k1, kept))
    rows = docs.withColumns({k0: F.coalesce(F.col(id_col).cast("long"), F.lit(-(2**62))), k1: F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))})
    joined = rows.join(F.broadcast(marked) if marked.count() <= BROADCAST_ROWS else marked, [k0, k1], "left")
    whole = joined.where(F.col(kept).isNull()).select(*docs.columns)
    if marked.where(kept).isEmpty():
        return whole
    return whole.unionByName(joined.where(kept).dropDuplicates([k0, k1]).select(*docs.columns))
