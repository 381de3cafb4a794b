"""Near-duplicate detection with BagMinHash signatures.

A document is the multiset of its five-word shingles; similarity is the
weighted Jaccard of the multisets. BagMinHash draws, for every shingle, the
points of a Poisson process on each level of its (integer, hence exactly
discretised) count. Levels are grouped in dyadic blocks, (0,1], (1,2], (2,4],
(4,8] and so on: a block has one process of the block's width, and a point of a
block that the count covers only in part is kept if the level it falls on is
below the count. Points come in ascending order, so a process ends as soon as
it passes the largest value of the signature so far.

Signatures are cut into bands; documents with an equal band are candidates,
and candidates are verified on the multisets themselves. Groups never expand
into all pairs: in each round every band bucket offers its members one centre,
each document is verified against the most promising centre offered, links
merge classes, and only buckets with members of different classes are looked at
again; when a round links little the pairs left between classes are all
verified. Large buckets are dealt in blocks, so no task has all pairs of one. A candidate is not verified
if the sizes forbid the similarity, or if the whole signatures, four bits of
each value, are five standard deviations below it. What is shuffled by bucket
is narrow (document, size, class, bucket); signatures are joined to the pairs
that the centres make, and at the end to the members of mixed buckets.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_map, quoted, ship, spread, stash, table, texts_of
from .textvec import mix, owners, sequence_keys, shingles, words

#: Words in a shingle.
SHINGLE = 5
#: Weighted Jaccard from which documents are linked.
SIMILAR = 0.8
#: Bands and rows of a band: a pair at 0.8 is missed with probability (1 - 0.8**5)**36 = 6e-7.
BANDS, ROWS = 36, 5
#: Rounds with centres at most, before the pairs left are verified; they end when a round links less than this share of its pairs.
STAR_ROUNDS, WORTH = 5, 0.1
#: Values of the finer signature of documents that share a band; it rules out candidates from a similarity of 0.74 down.
FINE = 1024
#: Standard deviations by which a sketch may fall short of the similarity.
SLACK = 5.0
#: Members of a block: larger buckets are dealt in blocks, and every two blocks are paired by themselves.
DEAL = 4096
#: Pairs whose sketches are compared at a time.
_PAIRS = 1 << 15
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def bags(hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text: owner, shingle, count."""
    owner = owners(bounds)
    if not len(hashes):
        return owner, hashes, np.zeros(0, dtype=np.int64)
    order = np.lexsort((hashes, owner))
    owner, hashes = owner[order], hashes[order]
    first = np.flatnonzero(np.concatenate(([True], (owner[1:] != owner[:-1]) | (hashes[1:] != hashes[:-1]))))
    return owner[first], hashes[first], np.diff(np.concatenate((first, [len(hashes)])))


def bag_minhash(owner: np.ndarray, element: np.ndarray, count: np.ndarray, texts: int, size: int) -> np.ndarray:
    """BagMinHash signatures (texts x size) of the bags; infinite for texts without elements."""
    # one process for each dyadic block of levels that the count reaches
    seeds, low, width, weight, own = [], [], [], [], []
    block, begin, left = 0, 0, np.arange(len(element))
    while len(left):
        span = 1 if block < 2 else 1 << (block - 1)
        seeds.append(mix(element[left] + np.uint64((block + 1) * 0xD6E8FEB86659FD93 & (1 << 64) - 1)))
        low.append(np.full(len(left), begin, dtype=np.int64))
        width.append(np.full(len(left), span, dtype=np.int64))
        weight.append(count[left])
        own.append(owner[left])
        begin += span
        block += 1
        left = left[count[left] > begin]
    seeds, low, width, weight, own = map(np.concatenate, (seeds, low, width, weight, own)) if seeds else (np.zeros(0, dtype=np.uint64), *(np.zeros(0, dtype=np.int64) for _ in range(4)))
    out = np.full(texts * size, np.inf)
    at, most, step = np.zeros(len(seeds)), np.full(texts, np.inf), 0
    while len(seeds):
        many = min(32, max(1, 8192 // len(seeds)))  # few processes: several points of each at once
        draw = mix(seeds[:, None] + (np.arange(step + 1, step + 1 + many, dtype=np.uint64) * _GOLD)[None, :])
        step += many
        gap = -np.log(((draw >> np.uint64(12)).astype(np.float64) + 0.5) * 2.0**-52) / (size * width)[:, None]
        gap[:, 0] += at
        points = np.cumsum(gap, axis=1)
        at = points[:, -1]
        other = mix(draw ^ np.uint64(0xA0761D6478BD642F))
        part = ((other >> np.uint64(32)) * np.uint64(size) >> np.uint64(32)).astype(np.int64)
        level = low[:, None] + ((other & np.uint64(0xFFFFFFFF)) * width[:, None].astype(np.uint64) >> np.uint64(32)).astype(np.int64)
        good = (level < weight[:, None]) & (points < most[own][:, None])
        np.minimum.at(out, (own[:, None] * size + part)[good], points[good])
        most = out.reshape(texts, size).max(axis=1)
        live = at < most[own]
        seeds, low, width, weight, own, at = seeds[live], low[live], width[live], weight[live], own[live], at[live]
    return out.reshape(texts, size)


def band_hashes(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One hash for each band; the values are rounded to single precision, so that the last bit of a logarithm can't matter."""
    bits = signatures.astype(np.float32).view(np.uint32).astype(np.uint64).reshape(len(signatures), bands, rows)
    acc = np.zeros((len(signatures), bands), dtype=np.uint64)
    for k in range(rows):
        acc = mix(acc + bits[:, :, k] + np.uint64(k + 1))
    return acc.view(np.int64)


def sketches(signatures: np.ndarray) -> np.ndarray:
    """Four bits of each signature value, sixteen to a long."""
    bits = mix(signatures.astype(np.float32).view(np.uint32).astype(np.uint64)) >> np.uint64(60)
    bits = np.pad(bits, ((0, 0), (0, -bits.shape[1] % 16))).reshape(len(bits), -1, 16)
    return (bits << (np.arange(16, dtype=np.uint64) * np.uint64(4))).sum(axis=2, dtype=np.uint64).view(np.int64)


def differing(a: Column, b: Column, longs: int) -> Column:
    """How many four-bit values differ between two sketches of so many longs."""

    def nibbles(x: Column) -> Column:
        x = x.bitwiseOR(F.shiftrightunsigned(x, 1))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 2))
        return F.bit_count(x.bitwiseAND(F.lit(0x1111111111111111)))

    if longs > 16:  # too many terms for compiled code
        return F.aggregate(F.zip_with(a, b, lambda x, y: nibbles(x.bitwiseXOR(y))), F.lit(0), lambda acc, x: acc + x)
    total = F.lit(0)
    for k in range(longs):
        total = total + nibbles(F.get(a, k).bitwiseXOR(F.get(b, k)))
    return total


def most_differing(size: int, similar: float) -> int:
    """Differing values of a pair of exactly the similarity, and SLACK standard deviations."""
    same = similar + (1 - similar) / 16
    return int(size * (1 - same) + SLACK * sqrt(size * same * (1 - same)))


def sign(docs: DataFrame, key: str, text: str, width: int, bands: int, rows: int) -> DataFrame:
    """(doc_id, k1, k2, n, bands, sketch): the keys of the word sequence, the number of shingles, the bands' keys.

    A text without words has n = 0, no bands, and the hash of the raw text for its keys.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        hashes, bounds = words(texts_of(batch))
        k1, k2 = sequence_keys(hashes, bounds)
        shingle, ends = shingles(hashes, bounds, width)
        owner, element, count = bags(shingle, ends)
        signatures = bag_minhash(owner, element, count, batch.num_rows, bands * rows)
        drawn = sketches(signatures)
        # the number of the band is part of its key
        values = mix(band_hashes(signatures, bands, rows).view(np.uint64) + np.arange(bands, dtype=np.uint64) * _GOLD).view(np.int64)
        n = np.diff(ends)
        lists = []
        for found in (values, drawn):
            offsets = np.concatenate(([0], np.cumsum(np.where(n > 0, found.shape[1], 0)))).astype(np.int32)
            lists.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(found[n > 0].reshape(-1))))
        raw = batch.column("raw").to_numpy(zero_copy_only=False)
        k1, k2 = np.where(n > 0, k1.view(np.int64), raw), np.where(n > 0, k2.view(np.int64), 0)
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(k1), pa.array(k2), pa.array(n), *lists], ["doc_id", "k1", "k2", "n", "bands", "sketch"])

    source = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"), F.xxhash64(text).alias("raw"))
    return arrow_map(source, run, "doc_id long, k1 long, k2 long, n long, bands array<long>, sketch array<long>")


def multisets(docs: DataFrame, key: str, text: str, width: int) -> DataFrame:
    """(node, bag, fine): the sorted shingle multiset as a set, the k-th copy of a shingle with a hash of its own; the fine sketch."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        shingle, ends = shingles(*words(texts_of(batch)), width)
        owner, element, count = bags(shingle, ends)
        copy = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
        values = mix(np.repeat(element, count) + copy.astype(np.uint64) * _GOLD).view(np.int64)
        order = np.lexsort((values, np.repeat(owner, count)))
        fine = np.concatenate([_fine(owner, element, count, at, min(at + 256, batch.num_rows)) for at in range(0, batch.num_rows, 256)])
        step = pa.array((np.arange(len(fine) + 1) * fine.shape[1]).astype(np.int32))
        lists = [pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(values[order])), pa.ListArray.from_arrays(step, pa.array(fine.reshape(-1)))]
        return pa.RecordBatch.from_arrays([batch.column("node"), *lists], ["node", "bag", "fine"])

    return arrow_map(docs.select(F.col(key).cast("long").alias("node"), F.col(text).alias("text")), run, "node long, bag array<long>, fine array<long>")


def _fine(owner: np.ndarray, element: np.ndarray, count: np.ndarray, begin: int, end: int) -> np.ndarray:
    own = slice(*np.searchsorted(owner, [begin, end]))
    return sketches(bag_minhash(owner[own] - begin, element[own], count[own], end - begin, FINE))


def verify(pairs: DataFrame, held: DataFrame, similar: float) -> DataFrame:
    """Those of the pairs (a, b) whose multisets have a weighted Jaccard of ``similar`` or more."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        left, right = batch.column("bag_a"), batch.column("bag_b")
        lv, rv = left.values.to_numpy(), right.values.to_numpy()
        lo, ro = left.offsets.to_numpy(), right.offsets.to_numpy()
        good = np.zeros(batch.num_rows, dtype=bool)
        for i in range(batch.num_rows):
            x, y = lv[lo[i] : lo[i + 1]], rv[ro[i] : ro[i + 1]]
            if len(x) > len(y):
                x, y = y, x
            if not len(x) or len(x) < similar * len(y):
                continue
            at = np.minimum(np.searchsorted(y, x), len(y) - 1)
            both = int((y[at] == x).sum())
            good[i] = both >= similar * (len(x) + len(y) - both)
        if not good.any():
            return None
        return pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(good))

    sides = pairs
    for x in "ba":  # only sets that a pair asks for are shuffled
        asked = held.withColumnsRenamed({"node": x, "bag": f"bag_{x}"}).join(pairs.select(x).distinct(), x, "left_semi")
        sides = sides.join(asked, x)
    return arrow_map(sides.select("a", "b", "bag_a", "bag_b"), run, "a long, b long")


def between(left: DataFrame, similar: float, size: int) -> DataFrame:
    """(a, b), a < b: the pairs of one bucket, of different classes, that sizes and sketches don't rule out; each from the first band that it shares.

    left has bucket, size (its members), node, n, comp, bands, sketch, fine.
    Rows are shuffled once, to the pairs of blocks that they are in, and paired
    as they come in order.
    """
    names = ["bucket", "cell", "block", "node", "n", "comp"]

    def some(a: np.ndarray, b: np.ndarray, g: dict[str, np.ndarray]) -> pa.RecordBatch:
        for name, most in (("sketch", most_differing(size, similar)), ("fine", most_differing(FINE, similar))):
            x = (g[name][a] ^ g[name][b]).view(np.uint64)
            x |= x >> np.uint64(1)
            x |= x >> np.uint64(2)
            good = np.bitwise_count(x & np.uint64(0x1111111111111111)).sum(axis=1, dtype=np.int64) <= most
            a, b = a[good], b[good]
        first = (g["bands"][a] == g["bands"][b]).argmax(axis=1)
        good = g["bands"][a, first] == g["bucket"][a]
        x, y = g["node"][a[good]], g["node"][b[good]]
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], ["a", "b"])

    def paired(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        g = {x: batch.column(x).to_numpy() for x in names} | {x: batch.column(x).flatten().to_numpy().reshape(batch.num_rows, -1) for x in ("bands", "sketch", "fine")}
        at = np.arange(batch.num_rows)
        new = np.flatnonzero(np.concatenate(([True], (np.diff(g["bucket"]) != 0) | (np.diff(g["cell"]) != 0), [True])))
        after = np.repeat(new[1:], np.diff(new)) - at - 1  # rows of its group that follow each
        upto, low = np.concatenate(([0], np.cumsum(after))), 0
        while low < len(at):
            high = max(low + 1, int(np.searchsorted(upto, upto[low] + _PAIRS, "right")) - 1)
            a = np.repeat(at[low:high], after[low:high])
            b = a + 1 + np.arange(len(a)) - np.repeat(upto[low:high] - upto[low], after[low:high])
            n, m = g["n"][a], g["n"][b]
            good = (g["comp"][a] != g["comp"][b]) & (np.minimum(n, m) >= similar * np.maximum(n, m))
            good &= (g["cell"][a] < 0) | (g["block"][a] != g["block"][b])
            if good.any():
                yield some(a[good], b[good], g)
            low = high

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            # the last group may go on in the next batch
            key = [batch.column(x).to_numpy() for x in names[:2]]
            same = (key[0] == key[0][-1]) & (key[1] == key[1][-1]) if batch.num_rows else np.zeros(0, dtype=bool)
            if not len(same):
                continue
            begin = len(same) - int(same.sum())
            if held and begin == 0 and (held[-1].column("bucket")[-1].as_py(), held[-1].column("cell")[-1].as_py()) == (key[0][-1], key[1][-1]):
                held.append(batch)
                continue
            held.append(batch.slice(0, begin))
            yield from paired(pa.concat_batches(held))
            held = [batch.slice(begin)]
        if held:
            yield from paired(pa.concat_batches(held))

    # a block with itself is a cell below 0: all its pairs; a cell of two blocks has the pairs between them
    blocks = F.ceil(F.col("size") / DEAL).cast("int")
    dealt = left.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cell = F.when(F.col("block") == F.col("other"), -1 - F.col("block").cast("long")).otherwise(F.least("block", "other").cast("long") * F.col("blocks") + F.greatest("block", "other"))
    rows = dealt.select("bucket", cell.alias("cell"), "block", "node", F.col("n").cast("int").alias("n"), "comp", "bands", "sketch", "fine")
    ship(left.sparkSession)
    return rows.repartition("bucket", "cell").sortWithinPartitions("bucket", "cell").mapInArrow(run, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(node, comp): the smallest node of each connected component, for the nodes of the edges (a, b).

    Labels spread to neighbours and jump to their label's label until nothing
    changes, so the rounds grow with the logarithm of the longest path; each
    round is written to the shared folder.
    """
    both = stash(edges.select(F.col("a").alias("x"), F.col("b").alias("y")).unionByName(edges.select(F.col("b").alias("x"), F.col("a").alias("y"))).distinct(), "edges")
    labels = stash(both.groupBy(F.col("x").alias("node")).agg(F.min("y").alias("y")).select("node", F.least("node", "y").alias("comp")), "labels")
    while True:
        near = both.join(labels, F.col("y") == F.col("node")).groupBy("x").agg(F.min("comp").alias("near"))
        spread = labels.join(near, F.col("node") == F.col("x")).select("node", F.col("comp").alias("old"), F.least("comp", "near").alias("comp"))
        parent = spread.select(F.col("node").alias("p"), F.col("comp").alias("up"))
        jumped = stash(spread.join(parent, F.col("comp") == F.col("p")).select("node", "old", F.col("up").alias("comp")), "labels")
        changed = jumped.where("old <> comp").limit(1).count()
        labels = jumped.select("node", "comp")
        if not changed:
            return labels


def _relabel(classes: DataFrame, edges: DataFrame) -> DataFrame:
    """classes (node, comp) after merging the classes that edges join."""
    a, b = classes.withColumnsRenamed({"node": "a", "comp": "ca"}), classes.withColumnsRenamed({"node": "b", "comp": "cb"})
    between = edges.join(a, "a").join(b, "b").where("ca <> cb").select(F.least("ca", "cb").alias("a"), F.greatest("ca", "cb").alias("b")).distinct()
    merged = components(between).select(F.col("node").alias("comp"), F.col("comp").alias("to"))
    return stash(classes.join(merged, "comp", "left").select("node", F.coalesce("to", "comp").alias("comp")), "classes")


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = SHINGLE, similar: float = SIMILAR, bands: int = BANDS, rows: int = ROWS
) -> DataFrame:
    """One row per document: doc_id (long) and class_id, the smallest doc_id of its class.

    Classes are the connected components of the links of similarity ``similar``
    or more; texts of the same words in the same order are always linked.

    Defined results: texts of fewer than ``width`` words have one shingle, of
    all their words; wordless texts (also the empty one) are linked with equal
    texts only; a null text is alone in its class; rows that share a doc_id are
    one document, which links the classes of its texts; a null doc_id has a null class; an empty table gives no rows;
    texts are read whole, and further columns are ignored.
    """
    docs = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))  # other columns could clash
    whole = docs.where("text is not null")
    signed = stash(sign(whole, "doc_id", "text", width, bands, rows), "signed")
    # one node for each word sequence; equal sequences have equal bands, so any will do
    nodes = stash(
        signed.where("doc_id is not null").groupBy("k1", "k2").agg(F.min("doc_id").alias("node"), F.max("n").alias("n"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch")),
        "nodes",
    )
    members = nodes.where("n > 0").select("node", F.col("n").cast("int").alias("n"), F.explode("bands").alias("bucket"))
    buckets = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1").select("bucket")
    # only members of buckets of two or more, each in a class of its own
    shared = stash(members.join(buckets, "bucket").withColumn("comp", F.col("node")), "shared")
    wanted = stash(shared.select("node").distinct(), "wanted")
    sets = stash(multisets(whole.join(wanted.withColumnRenamed("node", "doc_id"), "doc_id", "left_semi"), "doc_id", "text", width), "bags")
    held, fine = sets.select("node", "bag"), sets.select("node", "fine").distinct()
    sketch = stash(nodes.where("n > 0").select("node", "sketch").join(wanted, "node", "left_semi"), "sketches")
    classes = wanted.select("node", F.col("node").alias("comp"))

    sized = f"least(n, m) >= {similar}D * greatest(n, m)"

    def coarse(pairs: DataFrame) -> DataFrame:
        """pairs (a, b) with d, how many values of their signatures differ, if these may be similar."""
        a, b = (sketch.select(F.col("node").alias(x), F.col("sketch").alias(f"of_{x}")) for x in "ab")
        d = differing(F.col("of_a"), F.col("of_b"), -(-bands * rows // 16))
        return pairs.join(b, "b").join(a, "a").select("a", "b", d.alias("d")).where(F.col("d") <= most_differing(bands * rows, similar))

    def mixed(shared: DataFrame) -> DataFrame:
        """Buckets with members of several classes: their number of members."""
        return shared.groupBy("bucket").agg(F.min("comp").alias("least"), F.max("comp").alias("most"), F.count(F.lit(1)).alias("size")).where("least <> most").select("bucket", "size")

    for turn in range(STAR_ROUNDS):
        # the member that comes first by a hash that differs from round to round; the smallest in the first
        rank = F.struct(F.lit(0).cast("long") if not turn else F.xxhash64("node", F.lit(turn)), "node", "n", "comp")
        centres = shared.groupBy("bucket").agg(F.min(rank).alias("c"))
        offered = shared.join(centres, "bucket").select("node", "n", "comp", F.col("c.node").alias("centre"), F.col("c.n").alias("m"), F.col("c.comp").alias("centre_comp"))
        offered = offered.where(f"comp <> centre_comp and {sized}").select(F.col("node").alias("a"), F.col("centre").alias("b")).distinct()
        taken = coarse(offered).groupBy("a").agg(F.min(F.struct("d", "b")).alias("best"))
        pairs = stash(taken.select("a", F.col("best.b").alias("b")), "pairs")
        links = stash(verify(pairs, held, similar), "links")
        if (many := links.count()) == 0:
            break
        classes = _relabel(classes, links)
        shared = stash(shared.drop("comp").join(classes, "node"), "shared")
        if many < WORTH * pairs.count():
            break
        shared = stash(shared.join(mixed(shared).select("bucket"), "bucket", "left_semi"), "shared")
    # what is left between classes: every pair of one bucket; only here, and only for mixed buckets, rows carry their signatures
    drawn = nodes.where("n > 0").select("node", "bands", "sketch").join(wanted, "node", "left_semi").join(fine, "node")
    left = shared.join(mixed(shared), "bucket").join(drawn, "node").where(F.array_contains("bands", F.col("bucket")))
    links = stash(verify(stash(between(left, similar, bands * rows).distinct(), "rest"), held, similar), "links")
    if links.limit(1).count():
        classes = _relabel(classes, links)

    found = nodes.select("k1", "k2", "node").join(classes, "node", "left").select("k1", "k2", F.coalesce("comp", "node").alias("comp"))
    classed = signed.where("doc_id is not null").select("doc_id", "k1", "k2").join(found, ["k1", "k2"]).select("doc_id", "comp")
    bare = docs.where("text is null or doc_id is null").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("doc_id").cast("long").alias("comp"))
    out = stash(classed.unionByName(bare), "classed")
    # a document with texts in several classes links them
    several = out.groupBy("doc_id").agg(F.min("comp").alias("least"), F.max("comp").alias("most")).where("least <> most").select("doc_id", "least")
    links = stash(out.join(several, "doc_id").where("comp <> least").select(F.col("least").alias("a"), F.col("comp").alias("b")).distinct(), "links")
    if links.limit(1).count():
        merged = components(links).select(F.col("node").alias("comp"), F.col("comp").alias("to"))
        out = out.join(merged, "comp", "left").select("doc_id", F.coalesce("to", "comp").alias("comp"))
    return out.select("doc_id", F.col("comp").alias("class_id"))


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of docs for each class of near duplicate texts, that of the smallest doc_id, columns unchanged.

    Rows are judged by their own texts, also where they share a doc_id: a text
    goes only if one like it stays. Of equal rows one stays; rows without a
    doc_id are compared with each other only, and a row without a text goes only if it
    repeats one of its doc_id.
    """
    hidden = "_"  # inner names start with it and columns of docs don't
    while any(x.startswith(hidden) for x in docs.columns):
        hidden += "_"
    id_, hash_, gone_, gone_hash, own_, row_, text_, kept_ = (hidden + x for x in ("id", "hash", "gone", "gone_hash", "own", "row", "text", "kept"))
    source = docs
    docs = docs.select("*", F.col(key).alias(id_), F.xxhash64(F.col(text)).alias(hash_))
    keyed = docs.where(F.col(id_).isNotNull())
    texts = stash(keyed.groupBy(id_, hash_).count(), "texts")
    several = stash(texts.groupBy(id_).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(id_), "several")
    repeats = stash(texts.where("count > 1").select(id_, hash_), "repeats")
    if several.limit(1).count():
        # a number of its own for each text of such an id
        rows = keyed.where(F.col(text).isNotNull()).select(id_, hash_, F.col(text).alias(text_))
        rows = rows.join(several.withColumn(own_, F.lit(True)), id_, "left").withColumn(row_, F.when(F.col(own_), F.xxhash64(id_, hash_)).otherwise(F.col(id_).cast("long")))
        classes = stash(near_duplicates(rows, row_, text_).distinct(), "rows")
        rows = stash(rows.select(id_, hash_, F.col(row_).alias("doc_id")).distinct().join(classes, "doc_id"), "rows")
        first = rows.groupBy("class_id").agg(F.min(F.struct(id_, hash_)).alias(kept_))
        gone = rows.join(first, "class_id").where(F.struct(id_, hash_) != F.col(kept_)).select(F.col(id_).alias(gone_), F.col(hash_).alias(gone_hash))
        kept = keyed.join(gone, (F.col(id_) == F.col(gone_)) & (F.col(hash_) == F.col(gone_hash)), "left_anti")
    else:
        gone = near_duplicates(keyed.select(F.col(id_).alias("doc_id"), F.col(text).alias("text"))).where("doc_id <> class_id").select(F.col("doc_id").alias(gone_)).distinct()
        kept = keyed.join(gone, F.col(id_) == F.col(gone_), "left_anti")
    if repeats.limit(1).count():
        same = repeats.select(F.col(id_).alias(gone_), F.col(hash_).alias(gone_hash))
        is_same = F.col(id_).eqNullSafe(F.col(gone_)) & (F.col(hash_) == F.col(gone_hash))
        kept = kept.join(same, is_same, "left_anti").unionByName(kept.join(same, is_same, "left_semi").dropDuplicates([id_, text]))
    kept = kept.select(*map(quoted, source.columns))
    bare = source.where(F.col(key).isNull())
    if bare.where(F.col(text).isNotNull()).limit(1).count():
        rest = keep_one(bare.where(F.col(text).isNotNull()).withColumn(row_, F.xxhash64(F.col(text))), row_, text).drop(row_)
        bare = rest.unionByName(bare.where(F.col(text).isNull()))
    return kept.unionByName(bare)


def op4_bagminhash_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate class of every document."""
    return near_duplicates(spread(table(spark, sf_dir, "documents")))


#: Every pair that shares a shingle, by the Jaccard of the multisets; wordless texts by equality.
ORACLE_SQL = {
    "op4_bagminhash_near_dups": r"""
WITH RECURSIVE word_lists AS (
  SELECT doc_id, text, regexp_extract_all(lower(text), '[\p{L}\p{N}_]+') AS w FROM documents WHERE text IS NOT NULL AND doc_id IS NOT NULL
), runs AS (
  SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [concat('!', text)] WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, CAST(len(w) - 3 AS BIGINT)), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS run FROM word_lists
), bags AS (
  SELECT doc_id, run, count(*) AS c, sum(count(*)) OVER (PARTITION BY doc_id) AS n FROM runs GROUP BY doc_id, run
), links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM bags a JOIN bags b ON a.run = b.run AND a.doc_id < b.doc_id GROUP BY 1, 2
  HAVING sum(least(a.c, b.c)) >= 0.8::DOUBLE * (any_value(a.n) + any_value(b.n) - sum(least(a.c, b.c)))
), sides AS (
  SELECT a, b FROM links UNION SELECT b, a FROM links
), reach AS (
  SELECT a AS node, a AS other FROM sides UNION SELECT reach.node, sides.b FROM reach JOIN sides ON sides.a = reach.other
), classes AS (
  SELECT node, min(other) AS class_id FROM reach GROUP BY node
)
SELECT doc_id, coalesce(class_id, doc_id) AS class_id FROM documents LEFT JOIN classes ON node = doc_id"""
}
