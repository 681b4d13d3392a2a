"""Near-duplicate documents: MinHash bands, signature check, exact check, components.

Documents with the same shingle set are one class from the start, so copies
never meet each other. Of classes only the smallest doc_id goes on:

1. A signature holds the minima of `bands * rows` universal hashes; each band of
   `rows` minima is a bucket. At a similarity of 0.8 two documents share none of
   38 buckets of 6 with a probability of 1e-5.
2. Each member of a bucket is compared with the bucket's smallest doc_id; of a
   document's candidates the one with the best signature goes first. Candidates
   whose signatures are too unlike, by five standard deviations below the
   threshold, are left out; the others are confirmed on full shingle sets.
3. Links make components. Members of a bucket that belong to several components
   are then compared across them, within tasks of bounded size: two sets that are
   0.8 alike differ in size by a quarter at most, so a bucket is dealt out by
   classes of size, and a large class in blocks; of buckets with the same members
   one is enough. Signatures go first. Members that they match with another
   component are compared again on full sets, and only confirmed links that join
   two components are reported, so no link between components is lost and no
   pairs within one are listed.

A signature keeps 8 bits of each minimum: two different minima look equal once in
256 times, which lets through a few pairs more and never loses one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, slices, texts_of
from .components import components
from .hashed_words import runs, word_hashes

#: What a task takes from each of two blocks of a bucket's size class: members, and bytes of their sets.
BLOCK, BLOCK_BYTES = 500, 8 << 20
#: Members of blocks that a task compares by their signatures.
TASK_MEMBERS = 4_000
#: Ids beyond this many are joined by a shuffle; fewer (16 MB) are broadcast.
BROADCAST_IDS = 1_000_000


def shingle_sets(texts: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashed shingles, sorted within each text, and where each text's start.

    A text of fewer than n words has its whole sequence as the one shingle; one
    without words has none.
    """
    words, at = word_hashes(texts)
    hashes, of = runs(words, at, n)
    sizes = np.diff(at)
    for k in np.unique(sizes[(sizes > 0) & (sizes < n)]):
        short = np.flatnonzero(sizes == k)
        picked = np.concatenate([words[at[i] : at[i + 1]] for i in short])
        more, which = runs(picked, np.arange(len(short) + 1) * k, int(k))
        hashes, of = np.concatenate([hashes, more]), np.concatenate([of, short[which]])
    order = np.lexsort((hashes, of))
    hashes, of = hashes[order], of[order]
    first = np.ones(len(hashes), bool)
    first[1:] = (hashes[1:] != hashes[:-1]) | (of[1:] != of[:-1])
    return hashes[first], np.searchsorted(of[first], np.arange(len(texts) + 1))


def _hash_family(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Multiply-shift hashes of 32-bit values: a random multiplier and addend of 64 bits each."""
    draw = np.random.default_rng(20_011)
    return draw.integers(0, 2**64, n, np.uint64), draw.integers(0, 2**64, n, np.uint64)


def signatures(hashes: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """8 bits of the minima of n hashes over each non-empty run of `hashes`; zeros for empty runs."""
    out = np.zeros((len(at) - 1, n), np.uint8)
    full = np.flatnonzero(np.diff(at) > 0)
    if len(full):
        values, starts = hashes >> np.uint64(32), at[:-1][full]
        product = np.empty_like(values)
        high = product.view(np.uint32)[1::2]  # the upper halves, on little-endian machines
        minima = np.empty((n, len(full)), np.uint32)
        for i, (a, b) in enumerate(zip(*_hash_family(n), strict=True)):
            np.multiply(values, a, out=product)
            np.add(product, b, out=product)
            minima[i] = np.minimum.reduceat(high, starts)
        out[full] = (minima & 255).T  # the low bits: those of small values differ
    return out


def _sketches(docs: DataFrame, shingle: int, n: int) -> DataFrame:
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1 << 20):
            hashes, at = shingle_sets(texts_of(batch), shingle)
            found = signatures(hashes, at, n)
            ids = [xxhash.xxh3_128_digest(hashes[a:b].tobytes()) for a, b in zip(at[:-1], at[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("mark"), pa.array(np.diff(at)), pa.array(ids, pa.binary()), pa.array([row.tobytes() for row in found], pa.binary())],
                names=["doc_id", "mark", "n_shingles", "set_id", "signature"],
            )

    marked = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("mark"), "text")
    return marked.mapInArrow(sketch, "doc_id long, mark long, n_shingles long, set_id binary, signature binary")


def _least_alike(n: int, threshold: int) -> int:
    """Equal minima of n below which a pair at the threshold lies with a probability under 3e-7."""
    share = threshold / 100
    return max(1, int(n * share - 5 * (n * share * (1 - share)) ** 0.5))


def _with_ids(df: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of df whose doc_id is in ids (checkpointed, distinct); ids are broadcast only if they are few."""
    return df.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, "doc_id", "left_semi")


def confirmed(pairs: DataFrame, docs: DataFrame, shingle: int, threshold: int, scratch: Scratch) -> DataFrame:
    """The pairs (a, b) whose full shingle sets have 100 * intersection >= threshold * union.

    docs must have one row for each doc_id in pairs.
    """
    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(slices(batches, "text_a", 4 << 20), "text_b", 4 << 20):
            (left, at), (right, to) = (shingle_sets(texts_of(batch, c), shingle) for c in ("text_a", "text_b"))
            both = np.array([len(np.intersect1d(left[at[i] : at[i + 1]], right[to[i] : to[i + 1]], assume_unique=True)) for i in range(batch.num_rows)])
            keep = 100 * both >= threshold * (np.diff(at) + np.diff(to) - both)
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(keep)) for c in ("a", "b")], names=["a", "b"])

    ids = scratch.keep(pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct())
    texts = _with_ids(docs.select("doc_id", "text"), ids)
    joined = pairs.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")
    joined = joined.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a")
    return joined.select("a", "b", "text_a", "text_b").mapInArrow(confirm, "a long, b long")


def _alike(pairs: DataFrame) -> DataFrame:
    """Pairs (a, b, sa, sb) with `equal`, how many minima of their signatures are equal."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                sa, sb = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(batch.num_rows, -1) for c in ("sa", "sb"))
                yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array((sa == sb).sum(1).astype(np.int32))], names=["a", "b", "equal"])

    return pairs.select("a", "b", "sa", "sb").mapInArrow(count, "a long, b long, equal int")


def _block(members: pd.DataFrame, threshold: int) -> tuple[np.ndarray, np.ndarray, list]:
    """Of two blocks' members by size: labels, signatures, and for each the places of earlier ones to compare it with.

    Earlier ones are at least `threshold` per cent as large; one of a pair is in its own class, and
    the pair is in different blocks if the blocks are two.
    """
    n, own, side = (members[c].to_numpy() for c in ("n", "own", "_side"))
    within = members["_i"].iloc[0] == members["_j"].iloc[0]
    low = np.searchsorted(n, -(-threshold * n // 100))
    signature = np.frombuffer(b"".join(members["signature"]), np.uint8).reshape(len(n), -1)

    def partners(x: int) -> np.ndarray:
        w = slice(low[x], x)
        return np.flatnonzero((own[w] | own[x]) & (within | (side[w] != side[x]))) + low[x]

    return members["root"].to_numpy().copy(), signature, partners


_DEALT = "key long, grade int, _i int, _j int, doc_id long, root long, n long, own boolean, _side int"


def _matched(least: int, threshold: int):
    """Members whose signatures match one of another component, without their signatures."""
    def match(members: pd.DataFrame) -> pd.DataFrame:
        members = members.sort_values(["n", "doc_id"])
        label, signature, partners = _block(members, threshold)
        active = np.zeros(len(label), bool)
        for x in range(1, len(label)):
            near = partners(x)
            near = near[label[near] != label[x]]
            if len(near):
                near = near[(signature[near] == signature[x]).sum(1) >= least]
                active[near] = True
                active[x] |= len(near) > 0
        return members[active].drop(columns="signature")

    return match


def _joining(least: int, threshold: int):
    """Confirmed links (a, b) that join components among two blocks of a bucket's size class."""
    def compare(members: pd.DataFrame) -> pd.DataFrame:
        members = members.sort_values(["n", "doc_id"])
        ids, n = members["doc_id"].to_numpy(), members["n"].to_numpy()
        label, signature, partners = _block(members, threshold)
        sets = [np.frombuffer(x, np.uint64) for x in members["hashes"]]
        found: list[tuple[int, int]] = []
        for x in range(1, len(ids)):
            near = partners(x)
            near = near[label[near] != label[x]]
            if not len(near):
                continue
            alike = (signature[near] == signature[x]).sum(1)
            for h in near[np.argsort(-alike, kind="stable")[: int((alike >= least).sum())]]:
                if label[h] == label[x]:
                    continue
                at = np.minimum(np.searchsorted(sets[x], sets[h]), len(sets[x]) - 1)
                both = int((sets[x][at] == sets[h]).sum())
                if 100 * both >= threshold * (n[x] + n[h] - both):
                    found.append((min(ids[x], ids[h]), max(ids[x], ids[h])))
                    label[label == label[h]] = label[x]
        return pd.DataFrame(found, columns=["a", "b"]).astype("int64")

    return compare


def _sets(texts: DataFrame, shingle: int) -> DataFrame:
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 4 << 20):
            hashes, at = shingle_sets(texts_of(batch), shingle)
            sets = pa.array([hashes[a:b].tobytes() for a, b in zip(at[:-1], at[1:], strict=True)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.diff(at)), sets], names=["doc_id", "n", "hashes"])

    return texts.mapInArrow(build, "doc_id long, n long, hashes binary")


def _across(members: DataFrame, sketches: DataFrame, texts: DataFrame, roots: DataFrame, shingle: int, least: int, threshold: int, scratch: Scratch) -> DataFrame:
    """Confirmed links (a, b) within a bucket (key, doc_id, n) that join its components (node, root)."""
    labelled = members.join(roots, members["doc_id"] == roots["node"], "left").select("key", "doc_id", "n", F.coalesce("root", "doc_id").alias("root"))
    # A bucket's members as a set: their number and two sums of hashes.
    marks = [F.count("*").alias("size"), *(F.expr(f"bit_xor(xxhash64(doc_id, {k}))").alias(f"mark{k}") for k in (1, 2))]
    mixed = labelled.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"), *marks).filter("low <> high")
    mixed = mixed.groupBy("size", "mark1", "mark2").agg(F.min("key").alias("key")).select("key")
    across = scratch.keep(labelled.join(mixed, "key", "left_semi"))
    # A pair's classes of size are equal or next to each other; a member is also sent to the class above its own.
    grade = F.floor(F.log("n") / -np.log(threshold / 100)).cast("int")
    graded = across.withColumn("grade", grade)
    sent = graded.select("key", "doc_id", "root", "n", F.posexplode(F.array("grade", F.col("grade") + 1)).alias("above", "grade"))
    sent = sent.withColumn("own", F.col("above") == 0).drop("above")
    # Members of a class's main component, which has the most of them, are compared with the rest alone: so the
    # rest comes in blocks 0, 1, ..., the main component in those that follow, and few others cost few rows.
    parts = sent.groupBy("key", "grade", "root").agg(F.count("*").alias("size"), F.sum(8 * F.col("n")).alias("bytes"), F.max("own").alias("any"))
    most = F.max(F.struct("size", "bytes", "root")).alias("main")
    sizes = parts.groupBy("key", "grade").agg(most, F.sum("size").alias("size"), F.sum("bytes").alias("bytes"), F.max("any").alias("any")).filter("any AND size > main.size")
    blocks = lambda size, held: F.greatest(F.ceil(size / BLOCK), F.ceil(held / BLOCK_BYTES)).cast("int")
    rest = F.col("size") - F.col("main.size")
    sizes = sizes.select("key", "grade", F.col("main.root").alias("_main"), rest.alias("_rest"), F.col("main.size").alias("_most"), blocks(rest, F.col("bytes") - F.col("main.bytes")).alias("_n"), blocks(F.col("main.size"), F.col("main.bytes")).alias("_m"))
    sizes = scratch.keep(sizes)
    # Comparing takes its time on few bytes, so tasks are dealt out by members.
    tasks = 1 + (sizes.agg(F.expr("sum(_rest * (_n + _m) + _most * _n)")).first()[0] or 0) // TASK_MEMBERS
    dealt = sent.join(sizes.drop("_rest", "_most"), ["key", "grade"]).withColumn("_in", F.col("root") == F.col("_main"))
    spread = lambda n: F.pmod(F.xxhash64("doc_id"), n).cast("int")
    dealt = dealt.withColumn("_block", F.when(F.col("_in"), F.col("_n") + spread(F.col("_m"))).otherwise(spread(F.col("_n"))))
    # It is in the block pairs (i, j), i <= j, that its own block is part of; i is one of the rest.
    placed = dealt.withColumn("_other", F.explode(F.sequence(F.lit(0), F.when(F.col("_in"), F.col("_n") - 1).otherwise(F.col("_n") + F.col("_m") - 1))))
    placed = placed.withColumn("_i", F.least("_block", "_other")).withColumn("_j", F.greatest("_block", "_other")).withColumn("_side", (F.col("_block") != F.col("_i")).cast("int"))
    columns = [c.split()[0] for c in _DEALT.split(", ")]
    held = placed.select(*columns).join(sketches.select("doc_id", "signature"), "doc_id").select(*columns, "signature")
    block = ["key", "grade", "_i", "_j"]
    active = scratch.keep(held.repartition(int(tasks), *block).groupBy(*block).applyInPandas(_matched(least, threshold), _DEALT))
    ids = scratch.keep(active.select("doc_id").distinct())
    sets = _sets(_with_ids(texts, ids), shingle).select("doc_id", "hashes").join(sketches.select("doc_id", "signature"), "doc_id")
    whole = active.join(sets, "doc_id").groupBy(*block)
    links = scratch.keep(whole.applyInPandas(_joining(least, threshold), "a long, b long").distinct())
    scratch.drop(across, sizes, active, ids)
    return links


def near_duplicates(docs: DataFrame, shingle: int = 5, threshold: int = 80, bands: int = 38, rows: int = 6) -> DataFrame:
    """Per row of docs (doc_id, text): doc_id, n_shingles, component_id, kept.

    Documents are linked if 100 * intersection >= threshold * union of their
    shingle sets; component_id is the smallest doc_id reachable. A null or empty
    text, or one of white space, has no shingles and stays alone. Rows without
    doc_id take the component of their exact copies, or null, and are kept in
    that case. Rows that repeat a doc_id are one document: of its texts, the one
    with the smallest hash is compared, and all of them link it to their exact copies.

    The tables that the result reads stay in the shared folder; those on the way go.
    """
    with Scratch(docs.sparkSession, "near-copies") as scratch:
        return _near_duplicates(docs, shingle, threshold, bands, rows, scratch)[0]


def _near_duplicates(docs: DataFrame, shingle: int, threshold: int, bands: int, rows: int, scratch: Scratch) -> tuple[DataFrame, list[DataFrame]]:
    """`near_duplicates`, and the tables that it reads."""
    n = bands * rows
    sketched = scratch.keep(_sketches(docs, shingle, n))
    base = scratch.keep(sketched.drop("signature", "mark"))
    classes = scratch.keep(base.filter("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("set_id").agg(F.min("doc_id").alias("rep")))
    reps = classes.select(F.col("rep").alias("doc_id")).distinct()
    sketches = sketched.filter("n_shingles > 0").join(reps, "doc_id", "left_semi").groupBy("doc_id").agg(F.min_by("signature", "mark").alias("signature"), F.min_by("n_shingles", "mark").alias("n"))
    sketches = scratch.keep(sketches)
    scratch.drop(sketched)
    band = F.expr(f"explode(transform(sequence(0, {bands - 1}), i -> xxhash64(i, substring(signature, i * {rows} + 1, {rows}))))")
    buckets = sketches.select("doc_id", "n", band.alias("key"))
    shared = buckets.groupBy("key").agg(F.min("doc_id").alias("first"), F.count("*").alias("size")).filter("size > 1").drop("size")
    members = scratch.keep(buckets.join(shared, "key"))
    texts = docs.select(F.col("doc_id").cast("long"), "text")
    if docs.groupBy("doc_id").count().filter("count > 1 AND doc_id IS NOT NULL").limit(1).count():
        # One row for each doc_id: the text whose sketch is compared.
        worded = texts.filter(F.col("text").rlike("[^\\x20\\x09-\\x0D]"))
        texts = worded.groupBy("doc_id").agg(F.min_by("text", F.xxhash64("text")).alias("text"))

    least = _least_alike(n, threshold)
    stars = members.filter("doc_id <> first").select(F.col("first").alias("a"), F.col("doc_id").alias("b")).distinct()
    signed = stars.join(sketches.select(F.col("doc_id").alias("b"), F.col("signature").alias("sb")), "b")
    signed = _alike(signed.join(sketches.select(F.col("doc_id").alias("a"), F.col("signature").alias("sa")), "a"))
    best = signed.filter(F.col("equal") >= least).groupBy("b").agg(F.max_by("a", F.struct("equal", -F.col("a"))).alias("a"))
    tried = scratch.keep(best.select("a", "b"))
    links = confirmed(tried, texts, shingle, threshold, scratch)
    # Of a doc_id with several texts, all classes are one document.
    own = base.join(classes, "set_id").filter("doc_id <> rep").select("doc_id", "rep").distinct()
    twice = own.join(reps, "doc_id", "left_semi").select(F.col("rep").alias("a"), F.col("doc_id").alias("b"))
    links = scratch.keep(links.union(twice))
    scratch.drop(tried)
    roots = components(links.select(F.col("a").alias("u"), F.col("b").alias("v")), scratch)
    more = _across(members.select("key", "doc_id", "n"), sketches, texts, roots, shingle, least, threshold, scratch)
    scratch.drop(members, sketches)
    if more.limit(1).count():
        roots = components(links.union(more).select(F.col("a").alias("u"), F.col("b").alias("v")), scratch)
    scratch.drop(links, more)

    of = classes.join(roots, classes["rep"] == roots["node"], "left").select("set_id", F.coalesce("root", "rep").alias("component"))
    out = base.select("doc_id", "n_shingles", "set_id").join(of, "set_id", "left")
    alone = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component"))
    out = out.select("doc_id", "n_shingles", alone.alias("component_id")).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    return out, [base, classes]


def one_of_each(docs: DataFrame, shingle: int = 5, threshold: int = 80, bands: int = 38, rows: int = 6) -> DataFrame:
    """The rows of docs, all columns, but for near copies: of each component the smallest doc_id stays, once.

    Rows without doc_id cannot be named, so they stay. The ids to leave out are
    broadcast only if they are few.
    """
    with Scratch(docs.sparkSession, "near-copies") as scratch:
        found, read = _near_duplicates(docs, shingle, threshold, bands, rows, scratch)
        gone = scratch.keep(found.filter("NOT kept AND doc_id IS NOT NULL").select("doc_id").distinct())
        scratch.drop(*read)
    left = docs.join(F.broadcast(gone) if gone.count() <= BROADCAST_IDS else gone, "doc_id", "left_anti")
    if docs.groupBy("doc_id").count().filter("count > 1 AND doc_id IS NOT NULL").limit(1).count():
        left = left.filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"]).unionByName(left.filter("doc_id IS NULL"))
    return left.select(*docs.columns)
