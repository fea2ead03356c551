"""Near duplicates by SimHash: fingerprints at few differing bits, met through Golay codewords.

A fingerprint of 64 bits is read as segments of 23, 23 and 18 bits. Three differing bits leave two segments with one
differing bit at most. A segment gives the index of the Golay codeword it decodes to and those it could
decode to with one bit changed, at most six of 4096; so two fingerprints that link share a pair of indices of the same
two segments, one of them through its own indices. Members of such a bucket are compared bit by bit.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sportmart.llm import golay
from sportmart.llm.common import NO_ID, importable, staged
from sportmart.llm.components import components, with_least

SEED = 42
WORDS = 3
MAX_BITS = 3
#: Bits of the segments, from the highest; the last fills up its codeword with zeros.
SEGMENTS = (23, 23, 18)
#: Shingles hashed at a time.
BLOCK = 1 << 16
#: Fingerprints whose keys, some 85 each, are made at a time.
KEYED = 1024
#: Members up to which a bucket's pairs are all compared together with those of other buckets.
SMALL = 16
#: Members beyond which a bucket is dealt out in blocks, every two of which are compared in a task of their own.
LARGE = 1 << 16


def fingerprint(text: bytes, words: int = WORDS) -> int:
    """Bits that over half of the shingle hashes have set. A-Z count as a-z; too few words make one shingle, none make 0."""
    import xxhash

    found = text.lower().split()
    if not found:
        return 0
    if len(found) <= words:
        return xxhash.xxh64_intdigest(b" ".join(found), SEED)
    digest, counts = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    n = len(found) - words + 1
    for at in range(0, n, BLOCK):
        part = found[at : at + BLOCK + words - 1]
        hashes = np.array(
            [digest(b" ".join(s), SEED) for s in zip(*(part[k:] for k in range(words)))], np.uint64
        )
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > n, bitorder="little").tobytes(), "little")


def fingerprints(words: int = WORDS):
    """A column function ``text -> long`` (the fingerprint's bits, signed); null has no words."""

    @F.arrow_udf("long")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            found = [fingerprint((t.as_py() or "").encode("utf-8", "replace"), words) for t in batch]
            yield pa.array(np.array(found, np.uint64).astype(np.int64), pa.int64())

    return of


def bucket_keys(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys of each fingerprint: the key, the fingerprint's place, and whether both indices are the segments' own."""
    shifts = (sum(SEGMENTS[1:]), SEGMENTS[2], 0)
    parts = [((prints >> np.uint64(s)) & np.uint64((1 << n) - 1)).astype(np.int64) for s, n in zip(shifts, SEGMENTS)]
    near = [golay.near_indices(p, n) for p, n in zip(parts, SEGMENTS)]
    own = [golay.decode(p) for p in parts]
    # Repeats stand as -1; the distinct ones, six at most, come to the front.
    near = [-np.sort(-x, axis=1)[:, :6] for x in near]
    keys, places, owns = [], [], []
    for pair, (i, j) in enumerate(((0, 1), (0, 2), (1, 2))):
        key = (pair << 24) | (near[i][:, :, None] << 12) | near[j][:, None, :]
        real = (near[i][:, :, None] >= 0) & (near[j][:, None, :] >= 0)
        mine = (near[i][:, :, None] == own[i][:, None, None]) & (near[j][:, None, :] == own[j][:, None, None])
        keys.append(key[real])
        places.append(np.broadcast_to(np.arange(len(prints))[:, None, None], real.shape)[real])
        owns.append(mine[real])
    return np.concatenate(keys), np.concatenate(places), np.concatenate(owns)


def emit_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, KEYED):
            prints = batch.column(0).slice(at, KEYED).to_numpy(zero_copy_only=False).astype(np.int64)
            key, place, own = bucket_keys(prints.view(np.uint64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(key), pa.array(prints[place]), pa.array(own)], ["key", "print", "own"]
            )


def differing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a.view(np.uint64) ^ b.view(np.uint64))


def small_links(key, prints, own, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of buckets of up to ``SMALL`` members, one distance in the sorted order after the other."""
    left, right = [], []
    for step in range(1, SMALL):
        if step >= len(key):
            break
        pair = np.flatnonzero((key[step:] == key[:-step]) & (own[step:] | own[:-step]))
        if not len(pair):
            continue
        pair = pair[differing(prints[pair], prints[pair + step]) <= max_bits]
        left.append(prints[pair])
        right.append(prints[pair + step])
    none = np.zeros(0, np.int64)
    return (np.concatenate(left), np.concatenate(right)) if left else (none, none)


def large_links(prints, own, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """A forest that connects the members of one bucket just as all its links do.

    Every member is visited once and compared with those not yet reached. So a bucket of near copies costs
    about as many comparisons as members and gives fewer links than members.
    """
    left, right = [], []
    waiting = np.arange(len(prints))
    while len(waiting):
        frontier, waiting = [int(waiting[0])], waiting[1:]
        while frontier and len(waiting):
            at = frontier.pop()
            near = differing(prints[waiting], np.full(len(waiting), prints[at])) <= max_bits
            near &= own[waiting] | own[at]
            reached, waiting = waiting[near], waiting[~near]
            left.append(np.full(len(reached), prints[at]))
            right.append(prints[reached])
            frontier.extend(reached.tolist())
    none = np.zeros(0, np.int64)
    return (np.concatenate(left), np.concatenate(right)) if left else (none, none)


def links_of_buckets(max_bits: int = MAX_BITS, large: int | None = None):
    """Rows sorted by key in, links ``a``, ``b`` out. The last bucket of a batch waits for the next batch.

    Of a bucket that waits with more than ``large`` members only the key (as ``a``) and its number of members ``n`` come out.
    """

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        passed, n = None, 0

        def rows(a, b, n=None) -> pa.RecordBatch:
            counts = pa.nulls(len(a), pa.int64()) if n is None else pa.array(n, pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), counts], ["a", "b", "n"])

        def found(key, prints, own) -> pa.RecordBatch:
            starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            sizes = np.diff(np.append(starts, len(key)))
            several = np.repeat(sizes, sizes)
            few = (several > 1) & (several <= SMALL)
            parts = [small_links(key[few], prints[few], own[few], max_bits)]
            for at, size in zip(starts[sizes > SMALL], sizes[sizes > SMALL]):
                parts.append(large_links(prints[at : at + size], own[at : at + size], max_bits))
            return rows(*(np.concatenate([p[k] for p in parts]) for k in (0, 1)))

        for batch in batches:
            columns = tuple(batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1, 2))
            if passed is not None:
                more = int(np.searchsorted(columns[0], passed, side="right"))
                n += more
                if more == batch.num_rows:
                    continue
                yield rows([passed], [passed], [n])
                passed, columns = None, tuple(x[more:] for x in columns)
            if not len(columns[0]):
                continue
            held.append(columns)
            if held[0][0][0] == columns[0][-1]:
                waiting = sum(len(h[0]) for h in held)
                if large is not None and waiting > large:
                    passed, n, held = int(columns[0][-1]), waiting, []
                continue
            joined = [np.concatenate([h[k] for h in held]) for k in (0, 1, 2)]
            cut = int(np.searchsorted(joined[0], joined[0][-1]))
            held = [tuple(x[cut:] for x in joined)]
            yield found(*(x[:cut] for x in joined))
        if passed is not None:
            yield rows([passed], [passed], [n])
        if held:
            yield found(*(np.concatenate([h[k] for h in held]) for k in (0, 1, 2)))

    return links


def linked_prints(prints: DataFrame, max_bits: int = MAX_BITS, large: int = LARGE) -> DataFrame:
    """Links ``a``, ``b`` between distinct fingerprints (column ``print``) that connect all that differ in
    ``max_bits`` bits or fewer; ``max_bits`` up to 3.

    A task holds ``large`` members of a bucket (and a batch). Members of a larger one are dealt out by their digest in
    blocks of half of that, and every two blocks meet in a group, which finds all links of its members.
    """
    if not 0 <= max_bits <= MAX_BITS:
        raise ValueError("the segments hold for 0 to 3 differing bits")
    spark = prints.sparkSession
    kind = "a long, b long, n long"
    keyed = prints.select("print").mapInArrow(emit_keys, "key long, print long, own boolean")
    in_order = keyed.repartition("key").sortWithinPartitions("key")
    found = staged(spark, in_order.mapInArrow(links_of_buckets(max_bits, large), kind), "links")
    links = found.where("n IS NULL").select("a", "b")
    crowded = found.where("n IS NOT NULL").select(F.col("a").alias("key"), F.ceil(F.col("n") * 2 / large).alias("blocks"))
    if not crowded.isEmpty():
        dealt = keyed.join(crowded, "key").withColumn("block", F.pmod(F.xxhash64("print"), F.col("blocks")))
        dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        group = F.xxhash64("key", F.least("block", "other"), F.greatest("block", "other"))
        dealt = dealt.where("block <> other").select(group.alias("key"), "print", "own")
        in_order = dealt.repartition("key").sortWithinPartitions("key")
        links = links.unionByName(in_order.mapInArrow(links_of_buckets(max_bits), kind).select("a", "b"))
    return links.distinct()


def near_duplicates(
    documents: DataFrame, id_column: str = "doc_id", text: str = "text", words: int = WORDS, max_bits: int = MAX_BITS
) -> DataFrame:
    """``id``, ``text_hash``, ``print``, ``root`` (one fingerprint of the group) and ``component`` (the smallest id that links
    reach) per row of ``documents``.

    Rows without an id count behind all others (``id`` is then ``NO_ID``). Null, empty and blank texts have
    fingerprint 0 and are linked like any other. Copies share a fingerprint and meet only once. Repeated rows
    stay repeated; no row, empty result.
    """
    spark = documents.sparkSession
    importable(spark)
    of = fingerprints(words)
    rows = documents.select(
        F.coalesce(F.col(id_column), F.lit(NO_ID)).alias("id"), F.xxhash64(text).alias("text_hash"),
        of(F.col(text)).alias("print"),
    )
    rows = staged(spark, rows, "prints")
    prints = staged(spark, rows.groupBy("print").agg(F.min("id").alias("first")), "distinct-prints")
    roots = components(linked_prints(prints, max_bits))
    known = prints.join(roots, prints["print"] == roots["node"], "left")
    known = known.select("print", "first", F.coalesce("root", "print").alias("root"))
    known = with_least(known, "root", "first", "print").select("print", "root", F.col("least").alias("component"))
    known = staged(spark, known, "components")
    return rows.join(known, "print").select("id", "text_hash", "print", "root", "component")


def linked_documents(documents: DataFrame, words: int = WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    named = lambda c: F.when(F.col(c) != NO_ID, F.col(c))
    return near_duplicates(documents, words=words, max_bits=max_bits).select(
        named("id").alias("doc_id"), F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"),
        named("component").alias("component_id"),
    )


def one_of_each(documents: DataFrame, words: int = WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """``documents`` with one row of each group of linked ones: the one with the smallest id, of several rows with that id
    the one whose text has the smallest digest. Columns stay as they are."""
    linked = near_duplicates(documents, words=words, max_bits=max_bits)
    heads = linked.where("id = component").groupBy("root").agg(
        F.min("component").alias("__id"), F.min("text_hash").alias("__text")
    ).drop("root")
    rows = documents.select(
        F.struct(*(F.col(f"`{c}`") for c in documents.columns)).alias("__row"),
        F.coalesce("doc_id", F.lit(NO_ID)).alias("__id"), F.xxhash64("text").alias("__text"),
    )
    kept = rows.join(heads, ["__id", "__text"]).dropDuplicates(["__id", "__text"])
    return kept.select(*(F.col(f"__row.`{c}`").alias(c) for c in documents.columns))
