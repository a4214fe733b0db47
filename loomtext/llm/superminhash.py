"""SuperMinHash near-duplicate detection: signatures, banding, confirmation on full sets, union-find grouping.

A document's set is its distinct five-word shingles (ASCII lower case, ASCII white space between words). Every element
deals its ranks to the signature's places by a random permutation of its own, so an element counts once in each place
and the places are correlated; a document needs only so many ranks of its elements as still lower a place. Documents
of equal sets are one class. Classes that agree in a band meet in its bucket: with the bucket's leader, and in small
buckets with each other. Pairs are confirmed on their full sets. In larger buckets that then still hold several
components, the members of different components are compared block by block: no bucket is capped, and what a component
has already joined isn't compared.

Defined cases: a null text, or one without words, has an empty set and is linked with nothing; a text of fewer than
five words has its whole sequence as its one shingle; rows that share an id but not a set are each judged by their own
text (only what is alike is linked), and several of them can be kept; rows without an id keep a null component; an
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents, forget, materialize, uniform
from .graph import components

SHINGLE, BANDS, ROWS = 5, 20, 6
PLACES = BANDS * ROWS
#: Classes in a bucket up to which all are compared with each other (half as many pairs as classes, for each).
SMALL_BUCKET = 16
#: Members of a bucket in a block that is compared at once.
BLOCK_MEMBERS = 512
#: Pairs of one node that are confirmed beside one copy of its text; a node of more of them has more copies.
DEAL_PAIRS = 1024
CHUNK_ELEMENTS = 100_000
KNOWN_WORDS = 150_000
_MUL, _GOLD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1B54A32D192ED03)


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) > KNOWN_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: list[str | None], known: WordHashes) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    out = []
    for t in texts:
        words = (t or "").encode("utf-8", "surrogatepass").lower().split()
        n = len(words)
        if not n:
            out.append(np.zeros(0, np.uint64))
            continue
        h = np.fromiter(map(known.__getitem__, words), np.uint64, n)
        span = min(n, SHINGLE)
        s = h[: n - span + 1].copy()
        for k in range(1, span):
            s *= _MUL
            s += h[k : n - span + 1 + k]
        out.append(np.unique(mixed(s + np.uint64(span))))
    return out


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """SuperMinHash of non-empty sets, a row for each: rank and 32 random bits, ordered as their sum."""
    counts = np.array([len(s) for s in sets])
    element, doc = np.concatenate(sets), np.repeat(np.arange(len(sets)), counts)
    low = np.full(len(sets) * PLACES, np.iinfo(np.int64).max)
    perm = None
    for rank in range(PLACES):
        r = mixed(element + np.uint64((rank + 1) * int(_GOLD) & (1 << 64) - 1))
        swap = rank + ((r >> np.uint64(32)) * np.uint64(PLACES - rank) >> np.uint64(32)).astype(np.int64)
        if rank == 0:
            place, first_swap = swap, swap
        else:
            at = np.arange(len(element))
            if perm is None:
                perm = np.tile(np.arange(PLACES, dtype=np.uint8), (len(element), 1))
                perm[at, first_swap] = 0
            place = perm[at, swap].astype(np.int64)
            perm[at, swap] = perm[:, rank]
        value = np.int64(rank) << np.int64(32) | (r & np.uint64(0xFFFFFFFF)).astype(np.int64)
        np.minimum.at(low, doc * PLACES + place, value)
        # Later ranks are larger, so a document whose places are all below the next rank is done.
        open_docs = (low.reshape(-1, PLACES).max(axis=1) >> 32) > rank
        if not open_docs.any():
            break
        keep = open_docs[doc]
        element, doc, first_swap = element[keep], doc[keep], first_swap[keep]
        perm = perm[keep] if perm is not None else None
    return low.reshape(-1, PLACES)


def band_hashes(signature: np.ndarray) -> np.ndarray:
    s = signature.astype(np.uint64).reshape(-1, BANDS, ROWS)
    h = np.arange(1, BANDS + 1, dtype=np.uint64)[None, :] * _GOLD
    for k in range(ROWS):
        h = mixed(h * _MUL + s[:, :, k])
    return h.astype(np.int64)


SKETCH = "doc_id long, n_shingles long, set_key binary, bands array<long>, text_hash long"


def sketch(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """A row for each document: size and hash of its set, its band hashes, and the hash of its text."""

    def run(batches):
        known = WordHashes()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                b = batch.slice(at, 256)
                sets = shingle_sets(b.column(1).to_pylist(), known)
                bands: list[np.ndarray | None] = [None] * len(sets)
                some: list[int] = []
                size = 0
                for i in [*(i for i, s in enumerate(sets) if len(s)), None]:
                    if some and (i is None or size + len(sets[i]) > CHUNK_ELEMENTS):
                        for k, row in zip(some, band_hashes(signatures([sets[k] for k in some])), strict=True):
                            bands[k] = row
                        some, size = [], 0
                    if i is not None:
                        some.append(i)
                        size += len(sets[i])
                keys = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(map(len, sets), pa.int64()), pa.array(keys, pa.binary()), pa.array(bands, pa.list_(pa.int64())), b.column(2)], [c.split()[0] for c in SKETCH.split(", ")])

    return df.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"), F.xxhash64(text).alias("text_hash")).mapInArrow(run, SKETCH)


def confirm(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs (a, b) whose full sets are alike; ``texts``: (node, body), one row for each node.

    The leader of a large bucket is ``a`` of many pairs: they are dealt out, so that no task has all of them.
    """

    def run(batches):
        known = WordHashes()
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                b = batch.slice(at, 128)
                # Pairs come in the order of ``a``, so its set is often the last one's.
                keep, last, last_set = [], None, None
                for i, (x, tx, ty) in enumerate(zip(b.column(0).to_pylist(), b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True)):
                    if x != last or last_set is None:
                        last, last_set = x, shingle_sets([tx], known)[0]
                    other = shingle_sets([ty], known)[0]
                    common = len(np.intersect1d(last_set, other, assume_unique=True))
                    if 100 * common >= percent * (len(last_set) + len(other) - common):
                        keep.append(i)
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(keep, pa.int64())), b.column(1).take(pa.array(keep, pa.int64()))], ["a", "b"])

    deals = F.ceil(F.count(F.lit(1)) / DEAL_PAIRS).cast("int")
    often = pairs.groupBy("a").agg(deals.alias("deals")).filter("deals > 1")
    times = F.coalesce("deals", F.lit(1))
    dealt = pairs.join(often, "a", "left").select("a", "b", F.floor(uniform(5, F.col("b")) * times).cast("int").alias("deal"))
    left = texts.withColumnRenamed("node", "a").join(often, "a", "left").select("a", F.col("body").alias("body_a"), F.explode(F.sequence(F.lit(0), times - 1)).alias("deal"))
    right = texts.select(F.col("node").alias("b"), F.col("body").alias("body_b"))
    both = dealt.join(right, "b").join(left, ["a", "deal"]).select("a", "b", "body_a", "body_b")
    return both.mapInArrow(run, "a long, b long")


def links_in_blocks(members: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Links between members (bucket, node, m, root) of a bucket that are not of one root yet.

    A bucket's members are dealt into blocks, and every two blocks of it meet in one group. There, one pass over the
    group's shingles gives a member's common elements with all others. Members of the group's commonest root are not
    compared with each other.
    """

    def run(table: pa.Table) -> pa.Table:
        node, root = table.column("node").to_numpy(), table.column("root").to_numpy()
        sets = shingle_sets(table.column("body").to_pylist(), WordHashes())
        sizes = np.array([len(x) for x in sets])
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        element = np.unique(np.concatenate(sets), return_inverse=True)[1].ravel()
        names, times = np.unique(root, return_counts=True)
        main = names[times.argmax()]
        a, b = [], []
        for i in np.flatnonzero(root != main):
            mine = np.zeros(int(element.max()) + 1, np.int64)
            mine[element[starts[i] : starts[i] + sizes[i]]] = 1
            common = np.add.reduceat(mine[element], starts)
            alike = np.flatnonzero((100 * common >= percent * (sizes[i] + sizes - common)) & (root != root[i]))
            for k in alike[np.unique(root[alike], return_index=True)[1]]:
                a.append(min(node[i], node[k]))
                b.append(max(node[i], node[k]))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    blocks = F.ceil(F.col("m") / BLOCK_MEMBERS).cast("int")
    rows = members.withColumn("own", F.floor(uniform(3, F.col("node"), F.col("bucket")) * blocks).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    rows = rows.join(texts, "node").select("bucket", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "node", "root", "body")
    return rows.groupBy("bucket", "i", "j").applyInArrow(run, "a long, b long")


def alike_in_size(percent: int):
    """The share of common elements can't be over that of the sizes."""
    return (100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")) & (F.col("a") != F.col("b"))


def numbered(sketches: DataFrame) -> DataFrame:
    """(set_key, least, text_hash, node): each class with the id and text of one of its rows, and a number of its own.

    It is the class' least id. Of classes that share their least id only one has it; the others have 64 bits of their
    set's hash instead.
    """
    least = F.min(F.struct("doc_id", "text_hash"))
    classes = sketches.filter("n_shingles > 0 and doc_id is not null").groupBy("set_key").agg(least.alias("l")).select("set_key", F.col("l.doc_id").alias("least"), F.col("l.text_hash").alias("text_hash"))
    classes = materialize(classes, "nd-sets")
    shared = classes.groupBy(F.col("least").alias("shared")).agg(F.min("set_key").alias("first_key"), F.count(F.lit(1)).alias("k")).filter("k > 1")
    own = F.when(F.col("set_key") != F.col("first_key"), F.xxhash64("set_key"))
    return classes.join(shared, F.col("least") == F.col("shared"), "left").select("set_key", "least", "text_hash", F.coalesce(own, F.col("least")).alias("node"))


def near_duplicates(df: DataFrame, percent: int = 85, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, text_hash, group): documents linked at ``percent`` share one component.

    It is named by its least id; ``group`` tells components apart that share that name, and is null for empty sets.
    """
    s = materialize(sketch(df, key, text), "nd-sketch")
    classes = materialize(numbered(s), "nd-classes")
    # One row of every class.
    one = (F.col("set_key") == F.col("c_key")) & (F.col("doc_id") == F.col("least")) & (F.col("text_hash") == F.col("c_hash"))
    nodes = s.join(classes.withColumnsRenamed({"set_key": "c_key", "text_hash": "c_hash"}), one).select("node", F.col("n_shingles").alias("n"), F.explode("bands").alias("bucket")).distinct()
    nodes = materialize(nodes, "nd-bands")
    buckets = nodes.groupBy("bucket").agg(F.count(F.lit(1)).alias("m"), F.min(F.struct("node", "n")).alias("leader")).filter("m > 1")
    members = materialize(nodes.join(buckets, "bucket").select("bucket", "node", "n", "m", F.col("leader.node").alias("leader"), F.col("leader.n").alias("leader_n")), "nd-members")

    star = members.select(F.col("leader").alias("a"), F.col("leader_n").alias("n_a"), F.col("node").alias("b"), F.col("n").alias("n_b"))
    few = members.filter(F.col("m") <= SMALL_BUCKET)
    each = few.select("bucket", F.col("node").alias("a"), F.col("n").alias("n_a")).join(few.select("bucket", F.col("node").alias("b"), F.col("n").alias("n_b")), "bucket").filter("a < b").drop("bucket")
    pairs = materialize(star.unionByName(each).filter(alike_in_size(percent)).select("a", "b").distinct(), "nd-pairs")
    # Texts of those nodes only that a pair may need: the row of the id and text that the class is named by.
    wanted = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).unionByName(members.filter(F.col("m") > SMALL_BUCKET).select("node")).distinct()
    # The list of wanted nodes grows with the documents, so it is never broadcast, however small it may be here.
    wanted = classes.select("node", "least", "text_hash").join(wanted.hint("merge"), "node").hint("merge")
    bodies = df.select(F.col(key).cast("long").alias("least"), F.xxhash64(text).alias("text_hash"), F.col(text).alias("body"))
    texts = bodies.join(wanted, ["least", "text_hash"]).dropDuplicates(["least", "text_hash"]).select("node", "body")
    texts = materialize(texts, "nd-texts")

    links = materialize(confirm(pairs, texts, percent), "nd-links")
    roots = materialize(components(links), "nd-roots")
    placed = members.filter(F.col("m") > SMALL_BUCKET).join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    placed = materialize(placed.select("bucket", "node", "m", "root"), "nd-placed")
    apart = placed.groupBy("bucket").agg(F.min("root").alias("r0"), F.max("root").alias("r1")).filter("r0 <> r1").select("bucket")
    mixed_rows = placed.join(apart, "bucket")
    if not mixed_rows.isEmpty():
        found = materialize(links_in_blocks(mixed_rows, texts, percent), "nd-links")
        roots = materialize(components(links.unionByName(found)), "nd-roots")
        forget(found)
    for used in (nodes, members, pairs, texts, links, placed):
        forget(used)

    names = roots.join(classes.select("node", "least"), "node").groupBy("root").agg(F.min("least").alias("name"))
    out = s.select("doc_id", "n_shingles", "text_hash", "set_key").join(classes.select("set_key", "node", "least"), "set_key", "left").join(roots, "node", "left").join(names, "root", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("name", "least", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), "text_hash", F.coalesce("root", "node").alias("group"))


def op9_superminhash(spark, sf_dir):
    d = near_duplicates(documents(spark, sf_dir))
    return d.select("doc_id", "n_shingles", "component_id", (F.col("doc_id") == F.col("component_id")).alias("kept"))
