"""Document fingerprints by threshold-scaled sketches.

A text's sketch keeps every hash of its distinct 5-word shingles below a fixed
fraction of the hash range. Because the threshold is the same for all, sketches
merge by union, and the share of the smaller sketch found in the larger one
estimates containment between texts of very unequal length. A text whose hashes
all lie above the threshold keeps its least one, so only texts without words
have an empty sketch. That hash marks the text but is not compared with a longer
text's, whose sketch could not hold it.

Defined results: null text counts as empty; the likeness of equal sketches is 1,
of an empty one and another 0, of one without a hash below the threshold and
another 0 as well, with ``estimated`` false (nothing of it could be compared); rows follow each other by id, null ids
first, then by text; an empty table gives no rows; other input columns are not
read.
"""
from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_words, map_texts, record_batch, shingle_hashes, slices, text_of

#: Share of the hash range that is kept, and bytes of a hash that are written.
FRACTION = 0.25
HASH_BYTES = 6

DIGESTS = ("n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
           "near_edited double, near_next double, edited_estimated boolean, next_estimated boolean")


def sketch(text: str, fraction: float = FRACTION) -> np.ndarray:
    """Sorted distinct hashes (upper 48 bits) below the threshold, or the least one."""
    hashes = shingle_hashes(byte_words(text))
    kept = hashes[:np.searchsorted(hashes, np.uint64(int(fraction * 2 ** 64) - 1), side="right")]
    if not len(kept):
        kept = hashes[:1]
    return np.unique(kept >> np.uint64(64 - 8 * HASH_BYTES))


def below(sketch_: np.ndarray, fraction: float = FRACTION) -> np.ndarray:
    """A sketch's hashes below the threshold."""
    last = (int(fraction * 2 ** 64) - 1) >> (64 - 8 * HASH_BYTES)
    return sketch_[:np.searchsorted(sketch_, np.uint64(last), side="right")]


def merge(a: np.ndarray, b: np.ndarray, fraction: float = FRACTION) -> np.ndarray:
    """The sketch of two texts' shingles together."""
    both = np.union1d(a, b)
    kept = below(both, fraction)
    return kept if len(kept) else both[:1]


def estimated(a: np.ndarray, b: np.ndarray, fraction: float = FRACTION) -> bool:
    """Whether the likeness of two sketches rests on a comparison: they are equal,
    one is empty, or both have hashes below the threshold."""
    return (not len(a) or not len(b) or np.array_equal(a, b)
            or bool(len(below(a, fraction)) and len(below(b, fraction))))


def likeness(a: np.ndarray, b: np.ndarray, fraction: float = FRACTION) -> float:
    """Share of the smaller sketch that the larger one holds, below the threshold:
    1 for equal sketches, 0 where one has no hash there."""
    if np.array_equal(a, b):
        return 1.0
    a, b = below(a, fraction), below(b, fraction)
    if not len(a) or not len(b):
        return 0.0
    return len(np.intersect1d(a, b, assume_unique=True)) / min(len(a), len(b))


def to_text(sketch_: np.ndarray) -> str:
    wide = sketch_.astype(">u8").view(np.uint8).reshape(-1, 8)
    return wide[:, 8 - HASH_BYTES:].tobytes().hex()


def from_text(text: str) -> np.ndarray:
    raw = np.frombuffer(bytes.fromhex(text), np.uint8).reshape(-1, HASH_BYTES)
    wide = np.zeros((len(raw), 8), np.uint8)
    wide[:, 8 - HASH_BYTES:] = raw
    return wide.reshape(-1).view(">u8").astype(np.uint64)


def fingerprint_documents(df: DataFrame, fraction: float = FRACTION) -> DataFrame:
    """doc_id and the fingerprint of every whole text."""
    return map_texts(df, lambda texts: {"fingerprint": [to_text(sketch(t, fraction)) for t in texts]},
                     "fingerprint string")


def _bucket(bounds: list, col: str) -> F.Column:
    """How many of the sorted bounds are at most the value (binary search)."""
    if not bounds:
        return F.lit(0)
    steps = len(bounds).bit_length()
    return F.expr(f"""aggregate(sequence(1, {steps}), named_struct('lo', 0, 'hi', {len(bounds)}),
        (s, i) -> CASE WHEN s.lo >= s.hi THEN s
                       WHEN element_at(array({', '.join(f'{b}L' for b in bounds)}),
                                       int((s.lo + s.hi) div 2) + 1) <= {col}
                       THEN named_struct('lo', int((s.lo + s.hi) div 2) + 1, 'hi', s.hi)
                       ELSE named_struct('lo', s.lo, 'hi', int((s.lo + s.hi) div 2)) END,
        s -> s.lo)""")


def with_next(df: DataFrame, buckets: int | None = None) -> DataFrame:
    """doc_id and text in buckets of neighbouring ids, each bucket followed by
    the first row of the one after it (``halo``); the last is followed by the
    first row of all. One exchange of the texts; the bounds are quantiles of the
    ids, one number for each bucket."""
    spark = df.sparkSession
    buckets = buckets or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = df.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    ids = docs.select("doc_id")
    bounds = sorted(set(map(int, ids.approxQuantile(
        "doc_id", [k / buckets for k in range(1, buckets)], 0.25 / buckets))))
    bucket = F.coalesce(_bucket(bounds, "doc_id"), F.lit(0))
    # A null id sorts first; firsts holds one row for each bucket that has rows.
    firsts = sorted((r["bucket"], r["none"], r["first"]) for r in
                    ids.groupBy(bucket.alias("bucket"))
                    .agg(F.max(F.col("doc_id").isNull()).alias("none"), F.min("doc_id").alias("first")).collect())
    first_of, before = ["CAST(NULL AS BIGINT)"] * (len(bounds) + 1), ["0"] * (len(bounds) + 1)
    for (b, none, first), previous in zip(firsts, [firsts[-1], *firsts[:-1]] if firsts else []):
        before[b] = str(previous[0])
        if not none:
            first_of[b] = f"{first}L"
    placed = docs.withColumn("bucket", bucket)
    is_first = F.expr(f"doc_id <=> element_at(array({', '.join(first_of)}), bucket + 1)")
    previous = F.expr(f"element_at(array({', '.join(before)}), bucket + 1)")
    own = F.struct(F.col("bucket"), F.lit(False).alias("halo"))
    return (placed.withColumn("at", F.explode(F.when(
                is_first, F.array(own, F.struct(previous.alias("bucket"), F.lit(True).alias("halo"))))
                .otherwise(F.array(own))))
            .select("at.bucket", "at.halo", "doc_id", "text")
            .repartition("bucket").sortWithinPartitions("bucket", "halo", "doc_id", "text"))


def edited_digests(df: DataFrame, fraction: float = FRACTION) -> DataFrame:
    """Fingerprints of every whole text and of its edited text: its last quarter
    of code points replaced by as many first ones of the next document."""
    schema = f"doc_id long, {DIGESTS}"

    def finish(row, following):
        doc, text, own = row
        part = len(text) // 4
        edited = text[:len(text) - part] + following[1][:part]
        changed = sketch(edited, fraction)
        return (doc, len(text), hashlib.sha256(edited.encode()).hexdigest(), to_text(own), to_text(changed),
                likeness(own, changed, fraction), likeness(own, following[2], fraction),
                estimated(own, changed, fraction), estimated(own, following[2], fraction))

    def run(batches):
        last, last_bucket = None, None
        for part in slices(batches):
            found = []
            for bucket, halo, doc, text in zip(*(c.to_pylist() for c in part.columns)):
                row = (doc, text, sketch(text, fraction))
                if last is not None and bucket == last_bucket:
                    found.append(finish(last, row))
                last, last_bucket = (None if halo else row), bucket
            if found:
                yield record_batch(schema, dict(zip((f.split(" ")[0] for f in schema.split(", ")), zip(*found))))

    return with_next(df).mapInArrow(run, schema)
