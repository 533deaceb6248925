"""Near-duplicate detection: MinHash bands, odd sketches, links confirmed on full sets.

A document is the set of its distinct word shingles.  Documents with the same set form one
class, and only classes are compared, so copies never make pairs.  MinHash bands propose
pairs of classes.  The samples are also folded into an odd sketch, a bitmap of parities:
the population count of two sketches' XOR estimates their similarity, and pairs far below
the threshold go no further.  The rest are confirmed on the full sets.

Every bucket first links its members to one leader.  Then buckets whose members are still
in different components are searched by tasks that hold a bounded part of a bucket with its
sets: closest sketches first, only pairs that are still apart and share no earlier band,
and only links that join two components come out.  So components are complete, and no step
puts out more rows than a bucket has members.

Recall: at the threshold of 80 % a pair misses all bands with probability
(1 - 0.8^4)^32 = 5e-8, and the sketch bound drops it with under 1e-6.

Defined cases: words are runs of other than space and 0x09-0x0D, A-Z lower-cased; a text
with fewer words than a shingle is one shingle; without words (or null) its set is empty
and it is linked with nothing, so it is kept; rows that repeat an id are kept together; a
null id is never a component's name unless it is alone.  Only id and text are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textkit as tk
from .components import components
from .scratch import staged, unused, workspace
from .skew import join_groups

BANDS, BAND_ROWS = 32, 4
SAMPLES = 256
SKETCH_WORDS = 16  # of 64 bits
#: Largest XOR count of two sketches at similarity 0.8, beyond which under 1e-6 lie.
SKETCH_DISTANCE = 155
#: Shingles of a bucket's members that one task compares with as many others.
CHUNK_SHINGLES = 2 << 20

_RNG = np.random.Generator(np.random.PCG64(97))
_SPREAD = _RNG.integers(0, 2**64 - 1, 4, dtype=tk.U64) | tk.U64(1)
_FACTOR = (_RNG.integers(0, 2**31, SAMPLES, dtype=np.uint32) << np.uint32(1)) | np.uint32(1)
_OFFSET = _RNG.integers(0, 2**32, SAMPLES, dtype=np.uint32)
_SAMPLE_SALT = _RNG.integers(0, 2**64 - 1, SAMPLES, dtype=tk.U64)


def shingle_sets(buf: np.ndarray, off: np.ndarray, width: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each row of a block."""
    starts, ends = tk.words(buf, off)
    rows = tk.rows_of(starts, off)
    word = tk.hash_spans(tk.lower_ascii(buf), starts, ends)
    full = tk.hash_runs(word, width)
    cuts = tk.group_bounds(rows, len(off) - 1)
    for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        if hi - lo >= width:
            yield np.unique(full[lo:hi - width + 1])
        else:
            yield tk.hash_runs(word[lo:hi], hi - lo) if hi > lo else word[:0]


def min_hashes(shingles: np.ndarray) -> np.ndarray:
    """SAMPLES minima (``uint32``) of a non-empty set."""
    out = np.full(SAMPLES, np.iinfo(np.uint32).max, np.uint32)
    per = SAMPLES // len(_SPREAD)
    for lo in range(0, len(shingles), 2048):
        for j, spread in enumerate(_SPREAD):
            x = (tk.mix(shingles[lo:lo + 2048] * spread) >> tk.U64(32)).astype(np.uint32)
            s = slice(j * per, (j + 1) * per)
            h = x[:, None] * _FACTOR[s]
            h += _OFFSET[s]
            np.minimum(out[s], h.min(axis=0), out=out[s])
    return out


def odd_sketch(samples: np.ndarray) -> np.ndarray:
    """Parity bitmap of the (sample number, minimum) pairs, as 64-bit words."""
    bit = tk.mix(samples.astype(tk.U64) ^ _SAMPLE_SALT) >> tk.U64(64 - 10)
    odd = np.bincount(bit.astype(np.int64), minlength=64 * SKETCH_WORDS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def similarity_estimate(distance: np.ndarray) -> np.ndarray:
    """Similarity at which two odd sketches are expected to differ in ``distance`` bits."""
    bits = 64 * SKETCH_WORDS
    return 1 + bits / (4 * SAMPLES) * np.log(np.maximum(1 - 2 * distance / bits, 1e-9))


def _band_keys(samples: np.ndarray) -> np.ndarray:
    used = samples[:BANDS * BAND_ROWS].astype(tk.U64).reshape(BANDS, BAND_ROWS)
    key = np.arange(BANDS, dtype=tk.U64)
    for j in range(BAND_ROWS):
        key = tk.mix(key * tk.U64(0x9E3779B97F4A7C15) + used[:, j])
    return key.view(np.int64)


def _node(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def signatures(docs: DataFrame, width: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, node, bands, sketch); ``node`` names the set, null if empty."""
    tk.small_batches(docs.sparkSession)
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = pa.schema([("doc_id", tk.arrow_type(rows, "doc_id")),
                        ("n_shingles", pa.int64()), ("node", pa.binary()),
                        ("bands", pa.list_(pa.int64())), ("sketch", pa.list_(pa.int64()))])

    def sign(batch, buf, off):
        sizes, nodes, bands, sketches = [], [], [], []
        for s in shingle_sets(buf, off, width):
            sizes.append(len(s))
            if not len(s):
                nodes.append(None), bands.append(None), sketches.append(None)
                continue
            samples = min_hashes(s)
            nodes.append(_node(s)), bands.append(_band_keys(samples))
            sketches.append(odd_sketch(samples))
        return [batch.column("doc_id"), sizes, nodes, bands, sketches]

    return rows.mapInArrow(tk.map_blocks(sign, schema), f"doc_id {kind}, n_shingles long, "
                           "node binary, bands array<long>, sketch array<long>")


def _set(value: pa.BinaryScalar) -> np.ndarray:
    return np.frombuffer(value.as_buffer(), tk.U64)


def _similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether two sets share at least ``percent`` % of their union."""
    merged = np.sort(np.concatenate([x, y]))
    common = int((merged[1:] == merged[:-1]).sum())
    return 100 * common >= percent * (len(merged) - common)


def _distance():
    return sum((F.bit_count(F.col("sketch_a")[i].bitwiseXOR(F.col("sketch_b")[i]))
                for i in range(SKETCH_WORDS)), F.lit(0))


def _sets(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """(node, shingles) of the classes in ``wanted`` (node, doc_id)."""
    ids = wanted.select(F.col("doc_id").alias("wanted_id")).distinct()
    rows = docs.join(ids, F.col("doc_id").eqNullSafe(F.col("wanted_id")), "left_semi")
    schema = pa.schema([("node", pa.binary()), ("shingles", pa.binary())])

    def make(_, buf, off):
        sets = list(shingle_sets(buf, off, width))
        return [[_node(s) for s in sets], [s.tobytes() for s in sets]]

    made = rows.mapInArrow(tk.map_blocks(make, schema), "node binary, shingles binary")
    return made.join(wanted.select("node"), "node", "left_semi")


def _confirm(stage: Callable, pairs: DataFrame, docs: DataFrame, classes: DataFrame, width: int,
             percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    ends = pairs.select(F.col("a").alias("node")).unionByName(
        pairs.select(F.col("b").alias("node"))).distinct()
    sets = stage(_sets(docs, classes.select("node", "doc_id").join(ends, "node"), width), "sets")
    both = (pairs.join(sets.toDF("a", "set_a"), "a").join(sets.toDF("b", "set_b"), "b"))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = [_similar(_set(x), _set(y), percent) for x, y in
                      zip(batch.column("set_a"), batch.column("set_b"), strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))

    return both.select("a", "b", "set_a", "set_b").mapInArrow(check, "a binary, b binary").distinct()


def _joining_links(percent: int):
    """Function of two parts of a bucket (or one with itself): links between members of
    different components, no more than it takes to join them."""
    def run(key: tuple, group: pa.Table) -> pa.Table:
        side = np.asarray(group.column("side"))
        low, high = key[1].as_py(), key[2].as_py()
        n = len(side)
        sketch = np.asarray(group.column("sketch").combine_chunks().flatten()).reshape(
            n, SKETCH_WORDS).view(tk.U64)
        bands = np.asarray(group.column("bands").combine_chunks().flatten()).reshape(n, BANDS)
        at = group.column("band_no")[0].as_py()
        leads = np.asarray(group.column("leads"))
        nodes = group.column("node")
        sets = [_set(x) for x in group.column("shingles")]
        size = np.fromiter(map(len, sets), np.int64, n)
        number: dict[bytes, int] = {}
        comp = np.array([number.setdefault(c, len(number)) for c in
                         group.column("component").to_pylist()])
        left = np.flatnonzero((side == low) & ~leads)  # leaders have met all members
        right = left if low == high else np.flatnonzero((side == high) & ~leads)
        a, b = [], []
        for i in left:
            js = right[right > i] if low == high else right
            js = js[comp[js] != comp[i]]
            js = js[100 * np.minimum(size[js], size[i]) >= percent * np.maximum(size[js], size[i])]
            far = np.bitwise_count(sketch[js] ^ sketch[i]).sum(axis=1)
            js, far = js[far <= SKETCH_DISTANCE], far[far <= SKETCH_DISTANCE]
            js = js[np.argsort(far, kind="stable")]
            js = js[~(bands[js, :at] == bands[i, :at]).any(axis=1)]  # that bucket sees to them
            for j in js:
                if comp[i] != comp[j] and _similar(sets[i], sets[j], percent):
                    x, y = sorted((nodes[int(i)].as_py(), nodes[int(j)].as_py()))
                    a.append(x), b.append(y)
                    comp[comp == comp[j]] = comp[i]
        return pa.table({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary())})

    return run


def link(docs: DataFrame, signed: DataFrame, width: int, percent: int) -> DataFrame:
    """(node, component) of the classes that are linked with another class."""
    with workspace(docs.sparkSession, "near") as stage:
        classes = stage(signed.filter("node IS NOT NULL").groupBy("node").agg(
            F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n_shingles"),
            F.first("bands").alias("bands"), F.first("sketch").alias("sketch")), "classes")
        sketches = classes.select("node", "sketch")
        members = classes.select("node", "n_shingles", F.posexplode("bands").alias("band_no", "band"))
        # the leader is the member that comes first in a hash order of all classes, so that
        # the buckets of one group mostly share a leader
        place = F.struct(F.xxhash64("node").alias("order"), F.col("node").alias("node"))
        buckets = members.groupBy("band").agg(
            F.count("*").alias("members"), F.sum("n_shingles").alias("shingles"),
            F.min(place)["node"].alias("leader")).filter("members > 1")
        placed = stage(members.drop("n_shingles").join(buckets, "band"), "buckets")
        led = placed.filter(F.col("node") != F.col("leader")).select(
            F.least("node", "leader").alias("a"), F.greatest("node", "leader").alias("b")).distinct()
        close = (led.join(sketches.toDF("a", "sketch_a"), "a")
                 .join(sketches.toDF("b", "sketch_b"), "b")
                 .filter(_distance() <= SKETCH_DISTANCE).select("a", "b"))
        links = stage(_confirm(stage, stage(close, "pairs"), docs, classes, width, percent),
                       "links")
        found = components(links)

        # members of buckets of three or more that are not all in one component
        named = placed.filter("members > 2").join(found, "node", "left").select(
            "band", "band_no", "node", "shingles", (F.col("node") == F.col("leader")).alias("leads"),
            F.coalesce("component", "node").alias("component"))
        split = named.groupBy("band").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
        apart = stage(named.join(split.filter("lo != hi").select("band"), "band"), "apart")
        sets = stage(_sets(docs, classes.select("node", "doc_id").join(
            apart.select("node").distinct(), "node"), width).dropDuplicates(["node"]), "sets")
        parts = F.ceil(F.col("of") / CHUNK_SHINGLES).cast("int")
        more = stage(
            apart.withColumnRenamed("shingles", "of")
            .withColumn("side", F.pmod(F.xxhash64("node", F.lit(3)), parts).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
            .join(classes.select("node", "bands", "sketch"), "node").join(sets, "node")
            .select("band", F.least("side", "other").alias("low"), F.greatest("side", "other").alias("high"),
                    "side", "band_no", "node", "component", "leads", "bands", "sketch", "shingles")
            .groupBy("band", "low", "high")
            .applyInArrow(_joining_links(percent), "a binary, b binary").distinct(), "links")
        return components(links.unionByName(more))


def find(docs: DataFrame, width: int = 5, percent: int = 80, key: str = "doc_id",
         text: str = "text") -> DataFrame:
    """Per row: ``doc_id``, ``n_shingles``, ``component_id`` (smallest id reachable over
    links of at least ``percent`` % similarity) and ``kept`` (it is that id)."""
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    signed = staged(signatures(rows, width), "near-signatures")
    found = link(rows, signed, width, percent)
    # rows of the same set or of linked sets share a group
    grouped = staged(signed.select("doc_id", "n_shingles", "node").filter("node IS NOT NULL")
                     .join(found, "node", "left")
                     .select("doc_id", "n_shingles", F.coalesce("component", "node").alias("group")),
                     "near-groups")
    names = staged(grouped.groupBy("group").agg(F.min("doc_id").alias("component_id"),
                                                F.count("*").alias("_rows")), "near-names")
    n_rows = grouped.count()
    single = signed.filter("node IS NULL").select("doc_id", "n_shingles",
                                                  F.col("doc_id").alias("component_id"))
    out = join_groups(grouped, names, "group", "_rows", n_rows).select(
        "doc_id", "n_shingles", "component_id").unionByName(single)
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def keep_one(docs: DataFrame, width: int = 5, percent: int = 80, key: str = "doc_id",
             text: str = "text") -> DataFrame:
    """One row of each group, with all its columns: the one with the smallest id, and of
    rows that repeat that id the one whose columns come first.  Rows with an empty set are
    in no group and stay."""
    names, row = docs.columns, unused(docs, "_row")
    rows = docs.select("*", F.xxhash64(F.col(key), F.col(text)).alias(row))
    found = staged(find(rows, width, percent, row, text), "near-found").withColumnRenamed(
        "doc_id", row)
    owner = rows.select(row, F.col(key).alias("id")).distinct()
    best = (found.filter("n_shingles > 0").select(row, "component_id").distinct()
            .join(owner.withColumnRenamed(row, "of"), F.col(row) == F.col("of"))
            .groupBy("component_id").agg(F.min(F.struct(
                F.col("id").isNull().alias("no_id"), "id", F.col("of").alias("row")))["row"].alias(row))
            .select(row))
    alone = found.filter("n_shingles = 0").select(row).distinct()
    empty = rows.join(alone, row, "left_semi").select(*names)
    first = rows.join(best, row, "left_semi").dropDuplicates([row]).select(*names)
    return first.unionByName(empty)
