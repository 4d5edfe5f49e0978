"""Near duplicates by MinHash with tensored banding.

Two small collections of bands are computed for every set of shingles, and a
table key is made of each pair of one band from either collection: T * T tables
from 2 * T bands. Documents with equal sets are one node from the start. Nodes
that share a key are candidates; links are confirmed on the full sets.

No bucket is expanded into all pairs. First each node is compared with the
most similar of the least nodes of its buckets; then, for every two components
that still share a bucket, the most similar such pair; in the end only buckets that
hold more than one component are left, and in them the nodes outside the bucket's
first component meet all others. Of these pairs, each at its first common key only,
those are compared that are in different components and may be alike. So a link
between different components is never dropped, and what is not compared is
already connected. Whether two sets may be alike is read from their sizes and from
bitmaps of PARITY bits, each the parity of the shingles that fall on it: two bitmaps
differ in no more bits than the sets in shingles, so this bound is exact.

Edge cases: words are runs between ASCII blanks, A-Z lower-cased. A text with
fewer words than a shingle is one shingle; an empty or NULL text has none, is
linked with nothing and is kept. Each row is a document of its own: rows that
repeat a doc_id get a result each, and a component's id is the smallest doc_id in
it (NULL if there is none). Columns beyond ``doc_id`` and ``text`` are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from polyad.session import release, stage, stages

from .common import by_size, tidy
from .words import Tokens, mixed

SHINGLE = 5
TABLES, ROWS = 12, 3  # bands of a collection, minhashes of a band: a pair at 0.75 shares a key with probability 0.997
SPLIT = 500  # comparisons with one node in a task
FILTER_BITS = 1 << 24  # of the filter that spares the sets of nodes without candidates; more nodes only make it less selective
PARITY = 512
_SEED = 0x9E3779B97F4A7C15


def _constants(n: int, salt: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mixed(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(_SEED) + np.uint64(salt))


def shingle_sets(texts: pa.Array, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of every text, sorted, one text after the other, and where each text's begin."""
    hashes, lengths = Tokens(texts).sequence()
    with np.errstate(over="ignore"):
        factors = _constants(size, 7) | np.uint64(1)
        starts = np.cumsum(lengths) - lengths
        place = np.arange(len(hashes)) - np.repeat(starts, lengths)
        left = np.repeat(lengths, lengths) - place  # words from here to the text's end
        sums = np.zeros(len(hashes), np.uint64)
        for k in range(size):
            there = left > k
            sums[there] += hashes[np.flatnonzero(there) + k] * factors[k]
        whole = (place == 0) & (left < size)
        sums[whole] += left[whole].astype(np.uint64)  # a short text is unlike a shingle
        found = mixed(sums)
    use = (left >= size) | whole
    doc, found = np.repeat(np.arange(len(lengths)), lengths)[use], found[use]
    order = np.lexsort((found, doc))
    doc, found = doc[order], found[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (found[1:] != found[:-1])
    doc, found = doc[new], found[new]
    return found, np.searchsorted(doc, np.arange(len(lengths) + 1))


def _reduced(function: np.ufunc, values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One value for every text with a shingle."""
    starts = ends[:-1][np.diff(ends) > 0]
    return function.reduceat(values, starts) if len(starts) else values[:0]


def signatures(docs: DataFrame, tables: int = TABLES, rows: int = ROWS, size: int = SHINGLE, carry: tuple[str, ...] = ()) -> DataFrame:
    """(key, doc_id, n, a, b, bands, sketch, parity): a set's size, 128-bit name, bands of both collections, a 64-bit sketch and its parities.

    Number columns named in ``carry`` go along.
    """
    count = 2 * tables * rows

    @tidy
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors, offsets = _constants(count, 1) | np.uint64(1), _constants(count, 2)
        salts = _constants(2 * tables, 3)
        for block in by_size(batches, "text", 4 << 20):
            found, ends = shingle_sets(block.column("text"), size)
            sizes = np.diff(ends)
            full = sizes > 0
            with np.errstate(over="ignore"):
                names = [np.zeros(len(sizes), np.uint64) for _ in range(2)]
                for k in range(2):
                    names[k][full] = mixed(_reduced(np.add, mixed(found ^ np.uint64(_SEED * (k + 1) % (1 << 64))), ends))
                bands = np.zeros((len(sizes), 2 * tables), np.uint64)
                sketch = np.zeros(len(sizes), np.uint64)
                for i in range(count):
                    least = _reduced(np.minimum, (found * factors[i] + offsets[i]) >> np.uint64(32), ends)
                    band = i // rows
                    bands[full, band] = mixed(bands[full, band] * np.uint64(31) + least + salts[band])
                    if i < 64:
                        sketch[full] |= (mixed(least) & np.uint64(1)) << np.uint64(i)
            flat = pa.array(bands.reshape(-1).view(np.int64))
            place = np.repeat(np.arange(len(sizes)), sizes) * PARITY + (mixed(found ^ np.uint64(_SEED >> 1)) % np.uint64(PARITY)).astype(np.int64)
            odd = (np.bincount(place, minlength=len(sizes) * PARITY) & 1).astype(bool)
            parity = pa.array(np.packbits(odd).view(np.int64))
            yield pa.record_batch(
                [
                    block.column("key"), block.column("doc_id").cast(pa.int64()), pa.array(sizes), *(pa.array(x.view(np.int64)) for x in names),
                    pa.ListArray.from_arrays(pa.array(np.arange(len(sizes) + 1) * 2 * tables, pa.int32()), flat), pa.array(sketch.view(np.int64)),
                    pa.ListArray.from_arrays(pa.array(np.arange(len(sizes) + 1) * (PARITY // 64), pa.int32()), parity),
                    *(block.column(c) for c in carry),
                ],
                names=["key", "doc_id", "n", "a", "b", "bands", "sketch", "parity", *carry],
            )

    keyed = docs.select(F.monotonically_increasing_id().alias("key"), "doc_id", "text", *[F.col(c).cast("long") for c in carry])
    more = "".join(f", {c} long" for c in carry)
    return keyed.mapInArrow(sign, "key long, doc_id long, n long, a long, b long, bands array<long>, sketch long, parity array<long>" + more)


def table_keys(nodes: DataFrame, tables: int = TABLES) -> DataFrame:
    """(key, node, i, j): T * T keys of a node, each from band i of the first collection and band j of the second."""
    first = F.posexplode(F.slice("bands", 1, tables)).alias("i", "x")
    second = F.posexplode(F.slice("bands", tables + 1, tables)).alias("j", "y")
    return nodes.select("node", "bands", first).select("node", "i", "x", second).select(
        F.xxhash64("i", "x", "j", "y").alias("key"), "node", F.col("i").cast("byte").alias("i"), F.col("j").cast("byte").alias("j")
    )


def _needed_sets(docs: DataFrame, needed: DataFrame, size: int) -> DataFrame:
    """(doc_id, a, b, shingles) of the documents named by ``needed``, and of a few more."""
    place = F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_BITS))
    words = (
        needed.select(place.alias("p")).groupBy(F.floor(F.col("p") / 64).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(p % 64 as int))")).alias("bits")).collect()
    )  # at most FILTER_BITS / 64 rows
    field = np.zeros(FILTER_BITS // 64, np.int64)
    for r in words:
        field[r.w] = r.bits
    shared = docs.sparkSession.sparkContext.broadcast(field)

    @tidy
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.unpackbits(shared.value.view(np.uint8), bitorder="little")
        for batch in batches:
            at = batch.column("place").to_numpy(zero_copy_only=False)
            chosen = batch.filter(pa.array(bits[at].astype(bool)))
            for block in by_size([chosen], "text", 4 << 20):
                found, ends = shingle_sets(block.column("text"), size)
                with np.errstate(over="ignore"):
                    names = [np.zeros(len(ends) - 1, np.uint64) for _ in range(2)]
                    for k in range(2):
                        names[k][np.diff(ends) > 0] = mixed(_reduced(np.add, mixed(found ^ np.uint64(_SEED * (k + 1) % (1 << 64))), ends))
                data = [found[i:j].tobytes() for i, j in zip(ends[:-1], ends[1:])]
                yield pa.record_batch([block.column("doc_id").cast(pa.int64()), *(pa.array(x.view(np.int64)) for x in names), pa.array(data, pa.binary())], names=["doc_id", "a", "b", "shingles"])

    return docs.select("doc_id", "text", place.alias("place")).mapInArrow(sets, "doc_id long, a long, b long, shingles binary")


def confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(u, v): the pairs (x, y) whose sets are alike enough. Many comparisons with one y are split over tasks."""
    pieces = pairs.groupBy("y").agg(F.ceil(F.count("*") / SPLIT).cast("int").alias("pieces"))
    dealt = pairs.select("x", "y").join(pieces, "y").select("x", "y", F.pmod(F.xxhash64("x"), F.col("pieces")).cast("int").alias("piece"))
    second = pieces.select(F.col("y").alias("node"), "y", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("piece"), F.lit(0).alias("other"))
    rows = dealt.select(F.col("x").alias("node"), "y", "piece", F.lit(1).alias("other")).unionByName(second)
    together = rows.join(sets, "node").select("y", "piece", "other", "node", "shingles")
    count = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    @tidy
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = np.zeros(0, np.uint64)
        for batch in batches:
            us, vs = [], []
            for y, other, node, data in zip(*(batch.column(c) for c in ("y", "other", "node", "shingles")), strict=True):
                theirs = np.frombuffer(data.as_buffer(), np.uint64)
                if not other.as_py():
                    mine = theirs
                    continue
                place = np.minimum(np.searchsorted(mine, theirs), len(mine) - 1)
                common = int((mine[place] == theirs).sum())
                if 100 * common >= percent * (len(mine) + len(theirs) - common):
                    us.append(node.as_py())
                    vs.append(y.as_py())
            yield pa.record_batch([pa.array(us, pa.int64()), pa.array(vs, pa.int64())], names=["u", "v"])

    return together.repartition(count, "y", "piece").sortWithinPartitions("y", "piece", "other").drop("piece").mapInArrow(compare, "u long, v long")


def components(links: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(node, root): the smallest node that each linked node reaches; roots themselves are left out.

    ``known`` is the result for earlier links, to which ``links`` are added. Every tree of linked nodes hangs on its
    least smaller neighbour, the trees are flattened, and so on with the links between trees until there are none.
    """
    roots, links = known, links.select("u", "v")
    while True:
        ends = links.selectExpr("u", "v", "u AS x", "v AS y") if roots is None else _with_roots(_with_roots(links, roots, "u", "x"), roots, "v", "y")
        between = ends.where("x <> y").select(F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v")).distinct()
        links = stage(between, "links", last_use_of=[links])
        if not links.count():
            release(links)
            return links.sparkSession.createDataFrame([], "node long, root long") if roots is None else roots
        tree = _flat(links.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root")))
        if roots is None:
            roots = tree
            continue
        joined = _with_roots(roots.select("node", F.col("root").alias("top")), tree, "top", "root").select("node", "root").unionByName(tree.select("node", "root"))
        roots = stage(joined, "roots", last_use_of=[tree] if roots is known else [tree, roots])


def _flat(tree: DataFrame) -> DataFrame:
    """(node, root, moved) from (node, root) with a parent for a root; each round halves the ways up, until none moved."""
    tree = stage(tree, "tree")
    while True:
        up = tree.select(F.col("node").alias("root"), F.col("root").alias("up"))
        higher = tree.join(up, "root", "left").select("node", F.coalesce("up", "root").alias("root"), F.col("up").isNotNull().alias("moved"))
        tree = stage(higher, "tree", last_use_of=[tree])
        if not tree.where("moved").count():
            return tree


def _with_roots(df: DataFrame, roots: DataFrame, node: str, into: str) -> DataFrame:
    found = roots.select(F.col("node").alias(node), F.col("root").alias(into))
    return df.join(found, node, "left").withColumn(into, F.coalesce(into, node))


def near_duplicates(docs: DataFrame, percent: int = 75, tables: int = TABLES, rows: int = ROWS, size: int = SHINGLE, carry: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs``.

    With ``carry``, those number columns of ``docs`` go along, and ``component_key`` tells components apart whose documents have no ids.
    """
    docs = docs.select("doc_id", "text", *carry)
    with stages(docs.sparkSession) as inside:
        signed = inside.keep(signatures(docs, tables, rows, size, carry), "signatures")
        labels = inside.keep(_labels(docs.select("doc_id", "text"), signed, percent, tables, size), "labels")
    out = signed.select("key", "doc_id", "n", "a", "b", *carry).join(labels, ["a", "b"], "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    out = out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"), *carry, F.coalesce("root", "key").alias("component_key"))
    return out if carry else out.drop("component_key")


def _labels(docs: DataFrame, signed: DataFrame, percent: int, tables: int, size: int) -> DataFrame:
    """(a, b, root, component_id) of every set."""
    classes = signed.where("n > 0").groupBy("a", "b").agg(F.min("key").alias("node"), F.min("doc_id").alias("least_id"))
    classes = stage(classes, "classes")
    nodes = signed.join(classes.select(F.col("node").alias("key")), "key", "left_semi").withColumnRenamed("key", "node")
    # buckets with company, and the least node of each
    bucket = Window.partitionBy("key")
    shared = table_keys(nodes, tables).withColumn("y", F.min("node").over(bucket)).withColumn("last", F.max("node").over(bucket)).where("y < last").select("key", "node", "y", "i", "j")
    shared = stage(shared, "buckets")
    about = stage(nodes.join(shared.select("node").distinct(), "node").select("node", "doc_id", "a", "b", "n", "bands", "sketch", "parity"), "nodes")
    raw = stage(_needed_sets(docs, about, size), "sets")
    named = about.select("node", "doc_id", "a", "b")
    sets = raw.join(named, [raw.doc_id.eqNullSafe(named.doc_id), raw.a == named.a, raw.b == named.b]).select("node", "shingles").dropDuplicates(["node"])
    sets = stage(sets, "sets", last_use_of=[raw])
    side = lambda x: about.select(F.col("node").alias(x), *(F.col(c).alias(f"{o}_{x}") for c, o in (("n", "n"), ("sketch", "s"), ("parity", "p"))))
    agree = 64 - F.bit_count(F.col("s_x").bitwiseXOR(F.col("s_y")))
    apart = " + ".join(f"bit_count(p_x[{k}] ^ p_y[{k}])" for k in range(PARITY // 64))
    able = f"100 * least(n_x, n_y) >= {percent} * greatest(n_x, n_y) AND {100 + percent} * ({apart}) <= {100 - percent} * (n_x + n_y)"
    stars = shared.where("node <> y").select(F.col("node").alias("x"), "y").distinct()
    stars = stage(stars.join(side("x"), "x").join(side("y"), "y").where(able).select("x", "y", agree.alias("agree")), "stars")
    best = F.max(F.struct("agree", -F.col("y"), -F.col("x"))).alias("best")
    first = stars.groupBy("x").agg(best).select("x", (-F.col("best.col2")).alias("y"))
    roots = components(confirm(first, sets, percent))
    # the most promising star between two components
    across = _with_roots(_with_roots(stars, roots, "x", "cx"), roots, "y", "cy").where("cx <> cy")
    second = across.groupBy(F.least("cx", "cy").alias("c"), F.greatest("cx", "cy").alias("d")).agg(best).select((-F.col("best.col3")).alias("x"), (-F.col("best.col2")).alias("y"))
    roots = components(confirm(stage(second, "pairs", last_use_of=[stars]), sets, percent), roots)
    # what still shares a bucket with another component
    placed = stage(_with_roots(shared.select("key", "node", "i", "j"), roots, "node", "c"), "placed", last_use_of=[shared])
    mixed_keys = placed.groupBy("key").agg(F.min("c").alias("first"), F.max("c").alias("last")).where("first < last").select("key", "first")
    rest = placed.join(stage(mixed_keys, "mixed"), "key").join(about.select("node", "n", "bands", "parity"), "node")
    rest = stage(rest, "rest", last_use_of=[placed])
    shown = (("node", "id"), ("c", "c"), ("n", "n"), ("bands", "b"), ("parity", "p"))
    left = rest.where("c > first").select("key", "i", "j", *(F.col(c).alias(f"{o}_x") for c, o in shown))
    right = rest.select("key", *(F.col(c).alias(f"{o}_y") for c, o in shown))
    # bands of different places are never equal, so overlapping slices share a band at one place
    earlier = f"arrays_overlap(slice(b_x, 1, i), slice(b_y, 1, i)) OR arrays_overlap(slice(b_x, {tables + 1}, j), slice(b_y, {tables + 1}, j))"
    third = left.join(right, "key").where(f"c_x > c_y AND {able} AND NOT ({earlier})").select(F.col("id_x").alias("x"), F.col("id_y").alias("y"))
    roots = components(confirm(stage(third, "pairs"), sets, percent), roots)
    rooted = _with_roots(classes, roots, "node", "root")
    names = stage(rooted.groupBy("root").agg(F.min("least_id").alias("component_id")), "names")
    return rooted.join(names, "root").select("a", "b", "root", "component_id")
