"""SimHash near-duplicates by meet-in-the-middle ball hashing.

A fingerprint bit is set if it is set in more than half of the hashes of a text's word
shingles. Fingerprints that differ in at most ``RADIUS`` bits are linked, and linked texts
form components.

The radius is odd, so half of it is not a whole number of bits. The 64 bits are therefore
split into four blocks: of two fingerprints that differ in 1 to 3 bits, some block holds at
least one of the differing bits, and outside that block at most two are left, one for each
side. So every fingerprint emits, for each block, all variants within one bit of itself with
that block left out (4 x 49 keys), and two linked fingerprints meet in at least one of them.
Colliding fingerprints are verified bit by bit. Only distinct fingerprints take part, so exact
copies cost one row, and a key can hold no more fingerprints than its free bits allow, whatever
the number of documents. In a key, fingerprints are joined to the smallest of their own
cluster; pairs within a group are not written out.

Defined cases: a null, empty or word-free text has fingerprint zero and is linked like any
other. Repeated rows get equal results. A null doc_id takes part, but never names a component
unless all its ids are null. Other columns are carried through.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stackweave.llm import common

BITS, BLOCKS, RADIUS = 64, 4, 3
SHINGLE, SEED = 3, 42
_HASHES_AT_ONCE = 1 << 14


def fingerprint(text: bytes | None) -> int:
    """The signed 64-bit SimHash of a whole text."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    parts = map(b" ".join, zip(*(words[k:] for k in range(SHINGLE)), strict=False))
    shingles = list(parts) if len(words) >= SHINGLE else [b" ".join(words)]
    votes = np.zeros(BITS, np.int64)
    for begin in range(0, len(shingles), _HASHES_AT_ONCE):
        some = shingles[begin : begin + _HASHES_AT_ONCE]
        hashed = np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in some), "<u8", len(some))
        votes += np.unpackbits(hashed.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = np.packbits(2 * votes > len(shingles), bitorder="little")
    return int(bits.view("<i8")[0])


def with_fingerprints(docs: DataFrame) -> DataFrame:
    """docs and their fingerprint as a long; no shuffle."""
    rows = docs.drop("fingerprint")

    def compute(batch: pa.RecordBatch) -> list:
        texts = batch.column("text").cast(pa.binary())
        return [[fingerprint(text.as_py()) for text in texts]]

    return common.with_arrow_columns(rows, [T.StructField("fingerprint", T.LongType())], compute)


def _keys() -> list[tuple[int, int, int]]:
    """(block left out, bits kept, bit flipped) for every key a fingerprint emits, as signed longs."""
    width, every = BITS // BLOCKS, (1 << BITS) - 1
    signed = lambda x: x - (1 << BITS) if x >> (BITS - 1) else x
    keys = []
    for block in range(BLOCKS):
        kept = every ^ (((1 << width) - 1) << (block * width))
        flips = [0, *(1 << bit for bit in range(BITS) if kept >> bit & 1)]
        keys += [(block, signed(kept), signed(flip)) for flip in flips]
    return keys


def _masks() -> np.ndarray:
    """All ways to change at most RADIUS bits."""
    ways = [0]
    for size in range(1, RADIUS + 1):
        ways += [sum(1 << bit for bit in bits) for bits in combinations(range(BITS), size)]
    return np.array(ways, np.uint64)


def clusters(members: np.ndarray, masks: np.ndarray) -> list[tuple[int, int]]:
    """(member, smallest member of its cluster) for members that linked members connect.

    Each member is compared with those not yet reached, or looked up under all masks where
    these are fewer, so the work for a member is bounded.
    """
    values = np.sort(members)
    unsigned = values.astype(np.int64).view(np.uint64)
    order = np.argsort(unsigned)
    ranked = unsigned[order]
    waiting = np.ones(len(values), bool)
    found = []
    for root in range(len(values)):
        if not waiting[root]:
            continue
        waiting[root] = False
        stack = [root]
        while stack:
            here = unsigned[stack.pop()]
            if len(values) <= len(masks):
                near = np.flatnonzero(waiting & (np.bitwise_count(unsigned ^ here) <= RADIUS))
            else:
                wanted = here ^ masks
                spot = np.minimum(np.searchsorted(ranked, wanted), len(ranked) - 1)
                near = order[spot[ranked[spot] == wanted]]
                near = near[waiting[near]]
            waiting[near] = False
            stack += near.tolist()
            found += [(int(values[k]), int(values[root])) for k in near]
    return found


def links(fingerprints: DataFrame) -> DataFrame:
    """Distinct fingerprints (fingerprint long) -> links (a long, b long) that keep every component."""
    # Dealt out anew: a fingerprint is small, but it becomes 196 rows.
    parts = int(fingerprints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    variants = fingerprints.repartition(parts, "fingerprint").select("fingerprint", F.inline(F.array(*(
        F.struct(F.lit(block).cast("tinyint").alias("block"), F.lit(kept).alias("kept"), F.lit(flip).alias("flip"))
        for block, kept, flip in _keys()
    )))).select("fingerprint", "block", F.col("kept").bitwiseAND(F.col("fingerprint")).bitwiseXOR(F.col("flip")).alias("variant"))
    key = ("block", "variant")
    # One shuffle: keys of a single fingerprint go before anything is gathered.
    met = variants.withColumn("size", F.count("*").over(Window.partitionBy(*key))).where("size > 1")
    groups = met.groupBy(*key).agg(F.collect_list("fingerprint").alias("members")).select("members")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        masks = _masks()
        for batch in batches:
            lists = batch.column("members")
            flat = lists.flatten().to_numpy()
            ends = np.concatenate(([0], np.cumsum(lists.value_lengths().to_numpy())))
            twos = ends[:-1][np.diff(ends) == 2]
            left, right = flat[twos], flat[twos + 1]
            close = np.bitwise_count((left ^ right).view(np.uint64)) <= RADIUS
            found = set(zip(left[close].tolist(), right[close].tolist(), strict=True))
            for k in np.flatnonzero(np.diff(ends) > 2):
                found.update(clusters(flat[ends[k] : ends[k + 1]], masks))
            pairs = np.array(list(found), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

    return groups.mapInArrow(verify, "a long, b long").distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """docs with fingerprint (long) and component_id, the smallest doc_id a document reaches."""
    return _named(with_fingerprints(docs.select("doc_id", "text")).drop("text")).select("doc_id", "fingerprint", "component_id")


def _named(found: DataFrame) -> DataFrame:
    """Rows with doc_id and fingerprint, and their component's smallest fingerprint (owner) and doc_id."""
    marked = common.WorkTable(found, "fingerprints").df
    first = marked.groupBy("fingerprint").agg(F.min("doc_id").alias("first"))
    joined = common.components(links(first.select("fingerprint")))
    owner = F.coalesce("component", "fingerprint")
    classes = first.join(joined, first.fingerprint == joined.node, "left").select("fingerprint", "first", owner.alias("owner"))
    least = classes.groupBy("owner").agg(F.min("first").alias("component_id"))
    named = classes.join(least, "owner").select("fingerprint", "owner", "component_id")
    return marked.join(named, "fingerprint", "left")


def hexadecimal(fingerprint: Column) -> Column:
    return F.lpad(F.lower(F.hex(fingerprint)), 16, "0")


def keep_one_each(docs: DataFrame) -> DataFrame:
    """Deduplicating stage: of each component the document with the smallest id, columns unchanged.

    Of rows of the component that repeat that id, the one whose text has the smallest hash stays.
    An id with several texts can name several components. Documents without an id stay.
    """
    mark = F.xxhash64("text").alias("_mark")
    found = _named(with_fingerprints(docs.select("doc_id", "text", mark)).drop("text"))
    # An id and a hash say which text, and so which component.
    chosen = found.where("doc_id = component_id").groupBy("owner", "component_id").agg(F.min("_mark").alias("_mark"))
    chosen = chosen.select(F.col("component_id").alias("doc_id"), "_mark")
    named = docs.where("doc_id is not null").select("*", mark)
    stay = named.join(chosen, ["doc_id", "_mark"], "left_semi").dropDuplicates(["doc_id", "_mark"]).select(*docs.columns)
    return stay.unionByName(docs.where("doc_id is null"))
