"""Document fingerprints from prefix polynomial hashes.

``Prefix`` holds two modular prefix arrays of a text. From them the hash of any
span is two look-ups, spans are compared without looking at their characters,
and the longest common extension of two positions is found by binary search. A
fingerprint is the sorted list of the smallest span hashes of a text, over all
spans of one length; likeness is the share of common hashes among the smallest
of both lists (an estimate of the Jaccard likeness of the two sets of spans).

Edge cases: NULL text counts as empty; an empty text has the empty fingerprint,
which is like itself (1) and unlike all others (0). A text shorter than a span
is one span. Equal texts have equal fingerprints, wherever they are computed.
Neighbours are taken in descending order of (doc_id, text), so rows that repeat
a doc_id follow each other and rows without doc_id come last; a table of one row
is its own neighbour. Rows without doc_id are one bucket, so one task. Columns beyond ``doc_id`` and ``text`` are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, worker_memory

PRIMES = (2_147_483_647, 2_147_483_629)  # below 2**31, so products fit in 64 bits
BASES = (1_000_003, 1_999_957)
SPAN = 24  # code points of a span
SIZE = 64  # hashes of a fingerprint


def _powers(n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each prime: powers of its base and of the base's inverse, ``n`` of them at least."""
    held = worker_memory("powers", lambda: [(np.ones(1, np.uint64), np.ones(1, np.uint64))] * 2)
    for k, (prime, base) in enumerate(zip(PRIMES, BASES, strict=True)):
        up, down = held[k]
        while len(up) < n:
            m = len(up)
            up = np.concatenate([up, up * np.uint64(pow(base, m, prime)) % np.uint64(prime)])
            down = np.concatenate([down, down * np.uint64(pow(pow(base, -1, prime), m, prime)) % np.uint64(prime)])
        held[k] = up, down
    return held


class Prefix:
    """Prefix hashes of one text."""

    def __init__(self, text: str):
        self.text = text
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1)
        self.size = len(codes)
        self.powers = _powers(self.size + 1)
        self.sums = []
        for prime, (up, _) in zip(PRIMES, self.powers, strict=True):
            terms = codes * up[: self.size] % np.uint64(prime)
            sums = np.zeros(self.size + 1, np.uint64)  # each term is below 2**31: no overflow below 2**33 code points
            np.cumsum(terms, out=sums[1:])
            self.sums.append(sums % np.uint64(prime))

    def spans(self, starts: np.ndarray, length: int) -> np.ndarray:
        """64-bit hashes of the spans of one length."""
        out = np.zeros(len(starts), np.uint64)
        for prime, (_, down), sums in zip(PRIMES, self.powers, self.sums, strict=True):
            p = np.uint64(prime)
            out = out << np.uint64(32) | (sums[starts + length] + p - sums[starts]) % p * down[starts] % p
        return out

    def span(self, start: int, length: int) -> int:
        return int(self.spans(np.array([start]), length)[0])


def common_extension(a: Prefix, i: int, b: Prefix, j: int) -> int:
    """Length of the longest common run of ``a`` from ``i`` and ``b`` from ``j``, by binary search on span hashes."""
    low, high = 0, min(a.size - i, b.size - j)
    while low < high:
        middle = (low + high + 1) // 2
        if a.span(i, middle) == b.span(j, middle):
            low = middle
        else:
            high = middle - 1
    return low


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection that makes the order of hashes independent of the polynomial."""
    with np.errstate(over="ignore"):
        x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
        return x ^ x >> np.uint64(31)


def fingerprint(text: str | Prefix, span: int = SPAN, size: int = SIZE) -> np.ndarray:
    """The ``size`` smallest distinct span hashes, in order."""
    prefix = text if isinstance(text, Prefix) else Prefix(text)
    if not prefix.size:
        return np.zeros(0, np.uint64)
    length = min(span, prefix.size)
    hashes = _mixed(prefix.spans(np.arange(prefix.size - length + 1), length))
    keep = min(len(hashes), 4 * size)
    distinct = np.unique(np.partition(hashes, keep - 1)[:keep])
    if len(distinct) < size and keep < len(hashes):  # many repeats among the smallest
        distinct = np.unique(hashes)
    return distinct[:size]


def likeness(a: np.ndarray, b: np.ndarray, size: int = SIZE) -> float:
    """Estimated Jaccard likeness of the texts' sets of spans; two empty texts are alike."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    union = np.union1d(a, b)[:size]
    return float(np.isin(union, a).__and__(np.isin(union, b)).mean())


def as_text(hashes: np.ndarray) -> str:
    return "".join(f"{int(h):016x}" for h in hashes)


def with_next(docs: DataFrame, buckets: int | None = None) -> DataFrame:
    """``doc_id, text, bucket, carried``: rows dealt to buckets of ascending (doc_id, text), each with one carried row.

    Within a bucket, the row before a row is the next one in descending order.
    The carried row of a bucket is the last of the bucket before it; the first
    bucket gets the last row of all. So a single shuffle of the texts brings every
    row beside its neighbour, in partitions that are streamed through.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    buckets = buckets or min(4096, max(8, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    cuts = docs.select(F.percentile_approx("doc_id", [i / buckets for i in range(1, buckets)], 10_000)).head()[0] or []
    edges = sorted(set(cuts))
    bucket = _bucket(edges)
    # the last row of a bucket: a doc_id per bucket first, then, among rows that share it, the largest text
    lasts = docs.groupBy(bucket.alias("bucket")).agg(F.max("doc_id").alias("doc_id")).collect()
    order = sorted(r.bucket for r in lasts)
    follows = {b: order[(k + 1) % len(order)] for k, b in enumerate(order)}
    ends = spark.createDataFrame([(r.doc_id, follows[r.bucket]) for r in lasts], "end_id long, bucket int")
    carried = (
        docs.join(F.broadcast(ends), F.col("doc_id").eqNullSafe(F.col("end_id")))
        .groupBy("bucket", "doc_id").agg(F.max("text").alias("text"))
        .select("doc_id", "text", "bucket", F.lit(0).alias("own"))
    )
    own = docs.select("doc_id", "text", bucket.alias("bucket"), F.lit(1).alias("own"))
    return own.unionByName(carried).repartitionById(buckets, "bucket").sortWithinPartitions("bucket", "own", F.asc_nulls_first("doc_id"), "text")


def _bucket(edges: list[int]):
    """The number of edges that are at most doc_id, by halving; rows without doc_id are first."""

    def half(low: int, high: int):
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(F.col("doc_id") < edges[middle], half(low, middle)).otherwise(half(middle + 1, high))

    return F.when(F.col("doc_id").isNull(), F.lit(0)).otherwise(half(0, len(edges)))


def edited(text: str, following: str) -> str:
    """The last third of ``text`` (rounded down) gives way to as many first code points of ``following``."""
    cut = len(text) // 3
    return text[: len(text) - cut] + following[:cut]


def neighbours(docs: DataFrame, span: int = SPAN, size: int = SIZE) -> DataFrame:
    """Fingerprints of every text, of its edited text, and their likenesses, one row per row of ``docs``.

    ``kept_chars``: the longest common extension of the text and its edited text from their start.
    """
    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, kept_chars long"

    def run(source: Iterator[tuple]) -> Iterator[list]:
        held, before, mark = [], "", np.zeros(0, np.uint64)
        for doc_id, text, _, own in source:
            prefix = Prefix(text)
            now = fingerprint(prefix, span, size)
            if own:
                changed = edited(text, before)
                new = Prefix(changed)
                other = fingerprint(new, span, size)
                digest = hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest()
                kept = common_extension(prefix, 0, new, 0)
                held.append((doc_id, len(text), digest, as_text(now), as_text(other), likeness(now, other, size), likeness(now, mark, size), kept))
            before, mark = text, now
            if len(held) >= 1000:
                yield [list(c) for c in zip(*held, strict=True)]
                held = []
        if held:
            yield [list(c) for c in zip(*held, strict=True)]

    return map_batches(with_next(docs), run, schema)
