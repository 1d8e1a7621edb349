"""Near duplicates by ProbMinHash, banding and verification.

A document is a weighted set: its shingles of five words (lower case, cut at white space; all words of a shorter
text), weighted by how often they occur. Every shingle sends points at exponential intervals, at a rate equal to its weight; a
point falls into one of ``m`` slots, and a slot keeps the shingle whose point came first. Two documents agree in a
slot with a chance equal to their probability Jaccard similarity

    J(x, y) = sum over i of 1 / (sum over j of max(x_j / x_i, y_j / y_i)),

which is the usual Jaccard similarity where all weights are equal. The times of a shingle depend on the shingle
alone, and a document stops as soon as no later point can win a slot.

Slots are cut into bands; texts that agree in a whole band meet in a bucket. Links are verified with the exact J.
Equal texts are one node throughout. No bucket is turned into all its pairs:

1. in the first ``FIRST_BANDS`` bands every bucket offers its least node against all others, linear in its size;
   this joins groups of near copies to components;
2. over all bands, buckets whose members are still in several components are compared across components, and only
   there. Members are dealt to chunks of about ``CHUNK`` by a hash, and two chunks meet in one block, whose task counts
   shared shingles for all of the block together and gives out no pair but the links that connect something new.

So every pair that shares a bucket is either compared or already connected, without a cap: a bucket of n texts that
stay unlike takes (n / CHUNK)^2 / 2 blocks, each of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wardlake.llm.exact_dedup import rows_of
from wardlake.llm.common import components, row_key, salted_lookup, stage, text_of

WORDS = 5
SIMILAR = 0.8
BANDS, ROWS = 36, 7
FIRST_BANDS = 6
CHUNK = 256
COLUMNS = 20_000
#: Texts of a leader are copied once for so many partners.
PARTNERS = 500
HASH_ENTRIES = 400_000
BATCH_CHARS = 2_000_000

_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]


def _mixed(x: np.ndarray) -> np.ndarray:
    """A well spread 64-bit hash of 64-bit numbers."""
    x = x + _MIX[0]
    x = (x ^ (x >> np.uint64(30))) * _MIX[1]
    x = (x ^ (x >> np.uint64(27))) * _MIX[2]
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """64-bit hashes of words, kept while there is room."""

    def __missing__(self, word: str) -> int:
        import xxhash
        h = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        if len(self) < HASH_ENTRIES:
            self[word] = h
        return h


_HASHES = WordHashes()


def shingles(text: str, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of a text and their counts; none for a text without words."""
    ws = text.lower().split()
    if not ws:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    h = np.fromiter(map(_HASHES.__getitem__, ws), np.uint64, len(ws))
    n = min(words, len(h))
    out = np.full(len(h) - n + 1, n, np.uint64)
    for k in range(n):
        out = _mixed(out ^ h[k:len(h) - n + 1 + k])
    return np.unique(out, return_counts=True)


def probability_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """The exact J of two weighted sets in time n log n; 0 if either is empty."""
    (ha, wa), (hb, wb) = a, b
    if not len(ha) or not len(hb):
        return 0.0
    every = np.union1d(ha, hb)
    x, y = np.zeros(len(every)), np.zeros(len(every))
    x[np.searchsorted(every, ha)] = wa
    y[np.searchsorted(every, hb)] = wb
    ratio = np.divide(x, y, out=np.full(len(x), np.inf), where=y > 0)
    order = np.argsort(ratio, kind="stable")
    x, y, ratio = x[order], y[order], ratio[order]
    sum_y = np.cumsum(y)  # of ratios up to this one
    sum_x = x.sum() - np.cumsum(x)  # of ratios above it
    both = (x > 0) & (y > 0)
    # max(x_j / x_i, y_j / y_i) is the first where ratio_j > ratio_i, else the second
    return float((1.0 / (sum_x[both] / x[both] + sum_y[both] / y[both])).sum())


def signatures(sets: list[tuple[np.ndarray, np.ndarray]], m: int) -> np.ndarray:
    """ProbMinHash of each non-empty weighted set: an array of sets x ``m`` shingle hashes.

    Arrivals are drawn in rounds for all sets of about one size together: each shingle still running draws its next
    points, and runs on while its last point lies before the latest slot of its set.
    """
    out = np.zeros((len(sets), m), np.uint64)
    size = np.array([len(h) for h, _ in sets])
    per_round = 1 << np.ceil(np.log2(np.maximum(1.0, m / np.maximum(size, 1)))).astype(int)
    for k in np.unique(per_round):
        rows = np.flatnonzero((per_round == k) & (size > 0))
        if not len(rows):
            continue
        doc = np.repeat(np.arange(len(rows)), size[rows])
        item = np.concatenate([sets[r][0] for r in rows])
        rate = np.concatenate([sets[r][1] for r in rows]).astype(float)
        time = np.zeros(len(item))
        first = np.full(len(rows) * m, np.inf)
        winner = np.zeros(len(rows) * m, np.uint64)
        step = 0
        while len(item):
            with np.errstate(over="ignore"):
                seeds = (np.arange(step, step + k, dtype=np.uint64) + np.uint64(1)) * _MIX[1]
                r = _mixed(item[:, None] ^ seeds[None, :])
            step += k
            gap = -np.log(((r >> np.uint64(11)).astype(float) + 0.5) / (1 << 53)) / rate[:, None]
            at = time[:, None] + np.cumsum(gap, axis=1)
            slot = ((_mixed(r) >> np.uint64(32)) * np.uint64(m) >> np.uint64(32)).astype(np.int64)
            key = (doc[:, None] * m + slot).ravel()
            when = at.ravel()
            near = when < first[key]
            key, when, who = key[near], when[near], np.repeat(item, k)[near]
            np.minimum.at(first, key, when)
            won = when == first[key]
            winner[key[won]] = who[won]
            time = at[:, -1]
            on = time < first.reshape(len(rows), m).max(axis=1)[doc]
            doc, item, rate, time = doc[on], item[on], rate[on], time[on]
        out[rows] = winner.reshape(len(rows), m)
    return out


def bands_of(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One hash per band, the band's number mixed in: sets x bands."""
    parts = signature.reshape(len(signature), bands, rows)
    out = np.broadcast_to(np.arange(bands, dtype=np.uint64), parts.shape[:2])
    for k in range(rows):
        out = _mixed(out ^ parts[:, :, k])
    return out.view(np.int64) if out.flags.c_contiguous else np.ascontiguousarray(out).view(np.int64)


def _signed(bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column("text").to_pylist()
            start = 0
            while start < len(texts):
                stop, chars = start, 0
                while stop < len(texts) and (stop == start or chars + len(texts[stop]) <= BATCH_CHARS):
                    chars += len(texts[stop])
                    stop += 1
                sets = [shingles(t) for t in texts[start:stop]]
                got = bands_of(signatures(sets, bands * rows), bands, rows)
                part = b.slice(start, stop - start)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("digest"), pa.array(
                        [g if len(s[0]) else [] for g, s in zip(got, sets)], pa.list_(pa.int64()))],
                    names=["doc_id", "digest", "bands"])
                start = stop
    return run


def _verified(similar: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, mine = None, None
        for b in batches:
            good, sims = [], []
            for k, (a, ta, tb) in enumerate(zip(b.column("a").to_pylist(), b.column("text_a").to_pylist(),
                                                b.column("text_b").to_pylist())):
                if a != last:
                    last, mine = a, shingles(ta)
                s = probability_jaccard(mine, shingles(tb))
                if s >= similar - 1e-12:
                    good.append(k)
                    sims.append(s)
            at = pa.array(good, pa.int64())
            yield pa.RecordBatch.from_arrays([b.column("a").take(at), b.column("b").take(at), pa.array(sims, pa.float64())],
                                             names=["a", "b", "similarity"])
    return run


def _links(pairs: DataFrame, texts: DataFrame, similar: float) -> DataFrame:
    """Verified links among candidate ``pairs`` (a, b), distinct; ``texts`` has (node, text) for every node in them.

    A leader's text is copied once for every PARTNERS of its pairs, which are dealt to the copies by a hash.
    """
    copies = F.ceil(F.col("n") / F.lit(float(PARTNERS))).cast("long")
    fan = stage(pairs.groupBy("a").agg(F.count("*").alias("n")).select("a", copies.alias("copies")), "near-fan")
    dealt = salted_lookup(pairs, fan, ["a"], "inner").withColumn("copy", F.pmod(F.xxhash64("b"), "copies"))
    right = dealt.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
    left = texts.withColumnRenamed("node", "a").join(fan, "a").select(
        "a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)).alias("copy"), F.col("text").alias("text_a"))
    return right.join(left, ["a", "copy"]).select("a", "b", "text_a", "text_b").mapInArrow(
        _verified(similar), "a long, b long, similarity double")


def _in_buckets(signed: DataFrame, labels: DataFrame | None, first: int | None = None) -> DataFrame:
    """(bucket, node, label) for all bands, or the first ones; a node without a label is its own component."""
    if labels is None:
        named = signed.withColumn("label", F.col("node"))
    else:
        named = signed.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    bands = F.col("bands") if first is None else F.slice("bands", 1, first)
    return named.select("node", "label", F.explode(bands).alias("bucket"))


def _leader_pairs(rows: DataFrame) -> DataFrame:
    """Per bucket of several nodes, the least against the others: distinct (a, b)."""
    heads = stage(rows.groupBy("bucket").agg(F.min("node").alias("a"), F.max("node").alias("most")).filter(
        "a < most").select("bucket", "a"), "near-heads")
    return salted_lookup(rows.select("bucket", F.col("node").alias("b")), heads, ["bucket"], "inner").filter(
        "a <> b").select("a", "b").distinct()


def _similar_pairs(sets: list[tuple[np.ndarray, np.ndarray]], similar: float) -> np.ndarray:
    """Which of all pairs of a block can be similar: exact for texts without repeated shingles, a bound for others."""
    m = len(sets)
    size = np.array([w.sum() for _, w in sets], float)
    plain = np.array([len(h) == w.sum() for h, w in sets])
    every = np.concatenate([h for h, _ in sets])
    owner = np.repeat(np.arange(m), [len(h) for h, _ in sets])
    weight = np.concatenate([w for _, w in sets]).astype(np.float32)
    _, column, count = np.unique(every, return_inverse=True, return_counts=True)
    shared = count[column] > 1
    column, owner, weight = column[shared], owner[shared], weight[shared]
    order = np.argsort(column, kind="stable")
    column, owner, weight = column[order], owner[order], weight[order]
    common = np.zeros((m, m))  # common[x, y]: weight in x of what x and y share
    start = 0
    while start < len(column):
        stop = int(np.searchsorted(column, column[start] + COLUMNS))
        at = np.unique(column[start:stop], return_inverse=True)[1]
        has = np.zeros((m, at.max() + 1), np.float32)
        has[owner[start:stop], at] = weight[start:stop]
        common += has @ (has > 0).astype(np.float32).T
        start = stop
    share = common / np.maximum(size, 1)[:, None]
    good = np.minimum(share, share.T) >= similar - 1e-6
    both = plain[:, None] & plain[None, :]
    jaccard = common / np.maximum(1, size[:, None] + size[None, :] - common)
    return np.where(both, jaccard >= similar - 1e-6, good)


def _block_links(nodes: list[int], labels: list[int], chunks: list[int], texts: list[str], two: bool,
                 similar: float) -> list[tuple[int, int, float]]:
    """The links of a block that connect components not yet connected in it."""
    sets = [shingles(t) for t in texts]
    up: dict[int, int] = {}

    def top(x):
        while up.get(x, x) != x:
            x = up[x]
        return x

    may = _similar_pairs(sets, similar) if len(sets) > 2 else np.ones((len(sets), len(sets)), bool)
    out = []
    for i, j in zip(*np.nonzero(np.triu(may, 1))):
        if two and chunks[i] == chunks[j]:
            continue  # met in a block of their own
        x, y = top(labels[i]), top(labels[j])
        if x != y:
            s = probability_jaccard(sets[i], sets[j])
            if s >= similar - 1e-12:
                up[max(x, y)] = min(x, y)
                out.append((min(nodes[i], nodes[j]), max(nodes[i], nodes[j]), s))
    return out


def _blocks(similar: float):
    """Rows of a partition, sorted by block: one block in memory at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows = None, []

        def links():
            if len({r[1] for r in rows}) < 2:
                return []
            nodes, labels, chunks, texts = map(list, zip(*rows))
            return _block_links(nodes, labels, chunks, texts, key[1] != key[2], similar)

        def given(found):
            return pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], t) for k, t in enumerate(
                (pa.int64(), pa.int64(), pa.float64()))], names=["a", "b", "similarity"])

        for b in batches:
            names = ("bucket", "low", "high", "node", "label", "chunk", "text")
            found = []
            for bucket, low, high, *row in zip(*(b.column(n).to_pylist() for n in names)):
                if (bucket, low, high) != key:
                    found += links() if rows else []
                    key, rows = (bucket, low, high), []
                rows.append(row)
            yield given(found)
        yield given(links() if rows else [])

    return run


def _links_across(rows: DataFrame, texts_of, similar: float) -> DataFrame | None:
    """Links between components among the members (bucket, node, label) of all buckets; None if no bucket is mixed."""
    parts = rows.groupBy("bucket").agg(F.min("label").alias("least"), F.max("label").alias("most"), F.count("*").alias("n"))
    mixed = stage(parts.filter("least < most").select(
        "bucket", F.ceil(F.col("n") / F.lit(float(CHUNK))).cast("long").alias("of")), "near-mixed")
    waiting = stage(rows.join(mixed, "bucket"), "near-waiting")
    if waiting.limit(1).count() == 0:
        return None
    dealt = waiting.withColumn("chunk", F.pmod(F.xxhash64("node"), "of")).withColumn(
        "other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("of") - 1))).withColumn(
        "low", F.least("chunk", "other")).withColumn("high", F.greatest("chunk", "other"))
    texts = stage(texts_of(waiting.select("node").distinct()), "near-texts")
    blocks = dealt.join(texts, "node").select("bucket", "low", "high", "node", "label", "chunk", "text")
    return stage(blocks.repartition("bucket", "low", "high").sortWithinPartitions("bucket", "low", "high").mapInArrow(
        _blocks(similar), "a long, b long, similarity double"), "near-links")


def near_links(signed: DataFrame, texts_of, similar: float = SIMILAR) -> tuple[DataFrame | None, DataFrame | None]:
    """Links (a, b, similarity) that connect all similar nodes, and their components (node, label).

    ``signed`` has (node, bands), one row per distinct text; ``texts_of(nodes)`` gives (node, text) for a table of
    nodes. (None, None) if no two texts are similar.
    """
    links, labels = None, None
    first = stage(_leader_pairs(_in_buckets(signed, None, FIRST_BANDS)), "near-pairs")
    if first.limit(1).count():
        texts = stage(texts_of(first.select(F.explode(F.array("a", "b")).alias("node")).distinct()), "near-texts")
        links = stage(_links(first, texts, similar), "near-links")
        labels = components(links, "near")
    more = _links_across(_in_buckets(signed, labels), texts_of, similar)
    if more is not None:
        links = more if links is None else links.unionByName(more)
        labels = components(links, "near")
    return links, labels


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similar: float = SIMILAR,
            bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """One row per row of ``docs``: doc_id, class_id, class_size, kept, text_sha256.

    A class is a set of documents connected by links; class_id is its smallest id, class_size its rows, and one row
    of it, of that id, is kept. Texts without words (null, empty, white space) are linked to equal texts
    alone. Rows that repeat id and text are of one class and one of them is kept; null ids lose to others and
    the class_id of a class of null ids is null. An empty table gives no rows; other columns are not read.
    """
    plain = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    keyed = plain.withColumn("digest", F.sha2("text", 256))
    kind = plain.schema["doc_id"].dataType.simpleString()
    signed = stage(keyed.mapInArrow(_signed(bands, rows), f"doc_id {kind}, digest string, bands array<long>"), "near-signed")
    seed = 0
    while True:  # a node is a 64-bit hash of the digest under a seed that has no two digests collide
        node = F.xxhash64(F.lit(seed), "digest")
        nodes = stage(signed.groupBy(node.alias("node"), "digest", "bands").agg(
            F.min(row_key("doc_id")).alias("one"), F.count("*").alias("n")), "near-nodes")
        if nodes.groupBy("node").agg(F.count("*").alias("k")).filter("k > 1").limit(1).count() == 0:
            break
        seed += 1

    def texts_of(wanted: DataFrame) -> DataFrame:
        want = wanted.join(nodes.select("node", "one"), "node")
        full = keyed.select(node.alias("node"), row_key("doc_id").alias("one"), "text")
        return full.join(want, ["node", "one"]).select("node", "text")

    _, labels = near_links(nodes.select("node", "bands"), texts_of, similar)
    listed = signed.select("doc_id", F.col("digest").alias("text_sha256"), node.alias("node"))
    shared = nodes.filter("n > 1").select("node", F.col("node").alias("label"))
    if labels is not None:
        shared = shared.join(labels.select("node"), "node", "left_anti").unionByName(labels)
    marked = stage(salted_lookup(listed, shared, ["node"]), "near-marked")
    sums = marked.filter("label IS NOT NULL").groupBy("label").agg(F.min("doc_id").alias("class_id"),
                                                                   F.count("*").alias("class_size"))
    full = salted_lookup(marked, sums, ["label"])
    class_id = F.when(F.col("label").isNull(), F.col("doc_id")).otherwise(F.col("class_id"))
    placed = full.withColumn("class_id", class_id).withColumn("class_size", F.coalesce("class_size", F.lit(1).cast("long")))
    # of rows that share the class's smallest id, the first by text stays
    mine = placed.withColumn("_head", F.col("doc_id").eqNullSafe(F.col("class_id")))
    nth = F.row_number().over(W.partitionBy("_head", "doc_id", "class_id", F.coalesce("label", "node")).orderBy("text_sha256"))
    return mine.select("doc_id", "class_id", "class_size", (F.col("_head") & (nth == 1)).alias("kept"), "text_sha256")


def one_of_each_class(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each class of ``classes``, all columns as they were, whatever their names.

    Nulls, ties and repeated rows are decided as there; an empty table gives no rows.
    """
    kept = classes(docs, id_col, text_col).filter("kept").select(row_key("doc_id").alias("key"), F.col("text_sha256").alias("digest"))
    return rows_of(docs, kept, id_col, text_col)
