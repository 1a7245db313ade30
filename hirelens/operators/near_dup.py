"""Near-duplicate postings: an exact set-similarity join that does not make all pairs of a group.

Texts are linked if their sets of word shingles are as alike as asked; groups are what links connect.
``set_join`` finds all candidates. To keep large groups of near copies from meeting pair by pair,
texts are first gathered into stars: MinHash bands propose a hub for a text, the distance decides.
One minus the Jaccard similarity is a metric, so two stars can hold a linked pair only if their hubs
are no further apart than the link and both radii allow. Stars that share a posting compare hubs; only
where that leaves the question open, and no chain of links connects them yet, do their members meet.
MinHash saves work and decides nothing.

Tables of keys, pairs and groups grow with the texts, and their files are small for what they hold, so
joins with them are merge joins and never left to be broadcast.

The number of steps is fixed, whatever the data; connecting links takes rounds that grow with the
logarithm of the longest chain.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelens.operators import set_join
from hirelens.operators.skew import lookup
from hirelens.session import collect_unused, new_path, shared_dir

SLACK = 1e-9  # for distances that are exactly at a bound


def connected_groups(edges: DataFrame, max_rounds: int = 50) -> DataFrame:
    """``node, group``: the smallest node of each connected part, for all nodes with an edge.

    Alternates two steps until only stars are left: each node links its larger neighbours, then its
    smaller ones, to the smallest node around it. Rounds grow with the logarithm of the longest
    chain. Every round is written to the shared checkpoint folder, which cuts the lineage and
    survives lost executors. Neighbour minima are aggregates; no node's edges are gathered.
    """
    spark = edges.sparkSession
    shared_dir(spark)

    def around(pairs: DataFrame) -> DataFrame:
        """Each pair with the smallest of ``u`` and all its neighbours."""
        smallest = pairs.groupBy("u").agg(
            F.least("u", F.min("v")).alias("m"), F.count(F.lit(1)).alias("n")
        )
        return lookup(pairs, smallest, "u", "n")

    def large_star(e: DataFrame) -> DataFrame:
        both = e.select(F.col("src").alias("u"), F.col("dst").alias("v")).union(
            e.select(F.col("dst").alias("u"), F.col("src").alias("v"))
        )
        linked = around(both).filter("v > u").select(F.col("v").alias("src"), F.col("m").alias("dst"))
        return linked.filter("src != dst").distinct()

    def small_star(e: DataFrame) -> DataFrame:
        down = e.select(F.col("src").alias("u"), F.col("dst").alias("v"))
        near = around(down)
        linked = near.select(F.col("v").alias("src"), F.col("m").alias("dst")).union(
            near.select(F.col("u").alias("src"), F.col("m").alias("dst"))
        )
        return linked.filter("src != dst").distinct()

    def stars_only(e: DataFrame) -> bool:
        """Whether all nodes have one edge to a smaller node or only edges from larger ones."""
        ends = e.selectExpr("src as node", "1 as up", "0 as down").union(e.selectExpr("dst", "0", "1"))
        seen = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
        return seen.filter("up + down > 1 and up > 0").isEmpty()

    down = edges.select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst"))
    current = down.filter("src != dst").distinct().checkpoint()
    for _ in range(max_rounds):
        if stars_only(current):
            break
        current = small_star(large_star(current)).checkpoint()
        collect_unused(spark)
    else:
        raise RuntimeError(
            f"groups still changing after {max_rounds} rounds: a chain is longer than 2^{max_rounds};"
            " call again with more rounds"
        )
    members = current.select(F.col("src").alias("node"), F.col("dst").alias("group"))
    centres = current.select(F.col("dst").alias("node"), F.col("dst").alias("group")).distinct()
    return members.union(centres)


def coefficients(count: int) -> np.ndarray:
    """``(a, b)`` of the hash functions ``a * h + b`` modulo 2^64: a fixed sequence, ``a`` odd."""
    state = np.arange(1, 2 * count + 1, dtype=np.uint64) * set_join.ODD
    state = (state ^ (state >> np.uint64(30))) * set_join.MIX
    return (state ^ (state >> np.uint64(27))).reshape(count, 2) | np.array([1, 0], np.uint64)


def minima(hashes: np.ndarray, functions: np.ndarray) -> np.ndarray:
    """The smallest value of each function over the hashes of a set."""
    least = np.full(len(functions), ~np.uint64(0))
    for start in range(0, len(hashes), 1 << 14):
        part = hashes[start : start + (1 << 14), None] * functions[:, 0] + functions[:, 1]
        least = np.minimum(least, part.min(axis=0))
    return least


def profile(df: DataFrame, shingle: int, bands: int, rows: int, words: str) -> DataFrame:
    """From one reading of ``key, text``: rows ``key, bucket``, one per band (there may be none), and rows
    ``shard, counts`` of the shingle counters. Of equal texts of a task one is looked at."""
    kind = df.schema["key"].dataType.simpleString()
    names = ["key", "bucket", "shard", "counts"]
    key_type = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind]
    types = [key_type, pa.int64(), pa.int32(), pa.binary()]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, seen = set_join.Shingler(shingle, words), set_join.Counters()
        functions = coefficients(bands * rows)
        keys, found = [], []

        def banded():
            columns = [
                pa.array(keys, key_type).take(pa.array(np.repeat(np.arange(len(keys)), bands))),
                pa.array(np.concatenate(found).view(np.int64)),
                pa.nulls(len(keys) * bands, pa.int32()),
                pa.nulls(len(keys) * bands, pa.binary()),
            ]
            return pa.RecordBatch.from_arrays(columns, names=names)

        for key, text in set_join.texts(batches, once=True):
            hashes = shingles(text)
            if not len(hashes):
                continue
            seen.add(hashes)
            if not bands:
                continue
            bucket = np.arange(bands, dtype=np.uint64)
            for least in minima(hashes, functions).reshape(rows, bands):
                bucket = (bucket ^ (bucket >> np.uint64(31)) ^ least) * set_join.ODD
            keys.append(key)
            found.append(bucket)
            if len(keys) == 10_000:
                yield banded()
                keys.clear()
                found.clear()
        if keys:
            yield banded()
        for shard, blob in seen.rows():
            yield pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in zip((None, None, shard, blob), types)], names=names
            )

    return df.select("key", "text").mapInArrow(
        run, f"key {kind}, bucket bigint, shard int, counts binary"
    )


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder, worked out once."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def star_pairs(buckets: DataFrame, firsts: DataFrame) -> DataFrame:
    """``src, dst``: each text with the smallest one of each of its buckets."""
    buckets = as_first(buckets.select("key", "bucket"), firsts).distinct()
    hubs = buckets.groupBy("bucket").agg(F.min("key").alias("dst"), F.count(F.lit(1)).alias("n"))
    met = lookup(buckets, hubs.filter("n > 1"), "bucket", "n").filter("dst < key")
    return met.select(F.col("key").alias("src"), "dst").distinct()


def as_first(df: DataFrame, firsts: DataFrame) -> DataFrame:
    """``df`` with every key replaced by that of the first equal text."""
    renamed = df.join(firsts.hint("merge"), "key", "left").withColumn("key", F.coalesce("first", "key"))
    return renamed.select(*df.columns)


def stars(links: DataFrame) -> DataFrame:
    """``key, hub, far`` for texts that are linked to a hub: the nearest hub, the smallest of these."""
    near = F.min(F.struct("far", "dst"))
    best = links.groupBy(F.col("src").alias("key")).agg(near.alias("near"))
    return best.select("key", F.col("near.dst").alias("hub"), F.col("near.far").alias("far"))


def member_pairs(
    posted: DataFrame, members: DataFrame, near: DataFrame, similarity: float
) -> DataFrame:
    """``src, dst``: texts of two stars that share enough postings and that no bound keeps apart.

    ``members`` has ``key, hub, far`` of texts that have a hub, ``near`` has ``src, dst`` (hubs, the larger
    first) and their distance ``far``.
    """
    sides = near.select(F.col("src").alias("ha"), F.col("dst").alias("hb"), F.col("far").alias("between"))
    wanted = near.select(F.col("src").alias("hub")).union(near.select("dst")).distinct()
    some = posted.join(wanted.hint("merge"), "hub", "left_semi")
    pairs = set_join.prefix_pairs(some, "key", similarity)
    hubs = wanted.select(F.col("hub").alias("key"), "hub", F.lit(0.0).alias("far"))
    places = members.unionByName(hubs.join(members.hint("merge"), "key", "left_anti"))
    a = places.select(F.col("key").alias("src"), F.col("hub").alias("h_src"), F.col("far").alias("f_src"))
    b = places.select(F.col("key").alias("dst"), F.col("hub").alias("h_dst"), F.col("far").alias("f_dst"))
    met = pairs.join(a.hint("merge"), "src").join(b.hint("merge"), "dst").withColumns(
        {"ha": F.greatest("h_src", "h_dst"), "hb": F.least("h_src", "h_dst")}
    )
    left = met.join(sides.hint("merge"), ["ha", "hb"]).filter(f"between - f_src - f_dst <= {1 - similarity + SLACK}")
    return left.filter("not (f_src = 0 and f_dst = 0)").select("src", "dst")


def apart_still(pairs: DataFrame, groups: DataFrame) -> DataFrame:
    """``pairs`` (``src, dst`` and more) whose ends are not in one of ``groups`` (``node, group``)."""
    a = groups.select(F.col("node").alias("src"), F.col("group").alias("g_src"))
    b = groups.select(F.col("node").alias("dst"), F.col("group").alias("g_dst"))
    met = pairs.join(a.hint("merge"), "src", "left").join(b.hint("merge"), "dst", "left")
    return met.filter("g_src is null or g_dst is null or g_src <> g_dst").select(*pairs.columns)


def alike(
    df: DataFrame,
    similarity: float,
    shingle: int,
    bands: int,
    rows: int,
    firsts: DataFrame,
    buckets: DataFrame | None = None,
    words: str = set_join.WORDS,
    in_bucket: float | None = None,
) -> DataFrame:
    """Links ``src, dst`` between texts of ``df`` (``key, text``) that connect whatever the pairs with
    at least the given Jaccard similarity connect.

    ``firsts`` names the first of equal texts (``key, first``; ``key`` without it stands for itself).
    ``buckets`` (``key, bucket``) proposes hubs in place of MinHash bands. With ``in_bucket``, texts that
    are as alike as that to the first of a bucket are linked to it too.
    """
    most = 1 - similarity + SLACK
    loose = most if in_bucket is None else max(most, 1 - in_bucket + SLACK)
    read = written(profile(df, shingle, bands if buckets is None else 0, rows, words), "profile")
    table = set_join.levels(read.filter("shard is not null"))

    # texts and hubs
    proposed = read.filter("shard is null") if buckets is None else buckets
    pairs = written(star_pairs(proposed, firsts), "pairs")
    asked = pairs.select(F.explode(F.array("src", "dst")).alias("key")).distinct()
    sets = set_join.shingle_sets(df, asked, shingle, words)
    together = written(set_join.distances(pairs, sets).filter(F.col("far") <= loose), "linked")
    collect_unused(df.sparkSession)
    linked = together.filter(F.col("far") <= most)
    members = stars(linked)
    radius = members.groupBy("hub").agg(F.max("far").alias("radius"))

    # hubs and hubs; a text meets its star as one row, before its prefix becomes many
    prefixes = as_first(set_join.prefixes(df, shingle, similarity, table, words), firsts)
    placed = prefixes.join(members.hint("merge"), "key", "left").withColumn("hub", F.coalesce("hub", "key"))
    posted = written(set_join.postings(placed), "postings")
    apart = set_join.prefix_pairs(posted, "hub", similarity).join(
        linked.hint("merge"), ["src", "dst"], "left_anti"
    )
    apart = written(apart, "apart")
    asked = apart.select(F.explode(F.array("src", "dst")).alias("key")).distinct()
    sets = set_join.shingle_sets(df, asked, shingle, words)
    of_src = radius.select(F.col("hub").alias("src"), F.col("radius").alias("r_src"))
    of_dst = radius.select(F.col("hub").alias("dst"), F.col("radius").alias("r_dst"))
    room = F.coalesce("r_src", F.lit(0.0)) + F.coalesce("r_dst", F.lit(0.0))
    hubs = set_join.distances(apart, sets).join(of_src.hint("merge"), "src", "left")
    hubs = hubs.join(of_dst.hint("merge"), "dst", "left")
    hubs = hubs.filter(F.col("far") <= room + most).select("src", "dst", "far", room.alias("room"))
    hubs = written(hubs, "hubs")
    collect_unused(df.sparkSession)
    links = together.select("src", "dst").union(hubs.filter(F.col("far") <= most).select("src", "dst"))

    # members of stars whose hubs leave it open and that are not in one group anyway
    near = hubs.filter((F.col("far") > most) & (F.col("room") > 0))
    if near.isEmpty():
        return links
    groups = connected_groups(links)
    near = written(apart_still(near, groups), "near")
    pairs = written(member_pairs(posted, members, near, similarity), "pairs")
    asked = pairs.select(F.explode(F.array("src", "dst")).alias("key")).distinct()
    sets = set_join.shingle_sets(df, asked, shingle, words)
    found = set_join.distances(pairs, sets).filter(F.col("far") <= most).select("src", "dst")
    # what is connected already is a star by now
    return groups.filter("node <> group").toDF("src", "dst").union(found)


def near_dup(
    df: DataFrame,
    key: str,
    text: Column,
    similarity: float = 0.8,
    shingle: int = 3,
    bands: int = 6,
    rows: int = 6,
    buckets: DataFrame | None = None,
    words: str = set_join.WORDS,
    in_bucket: float | None = None,
) -> DataFrame:
    """``key, group`` for all rows: the smallest key of the row's group, itself if it is alone.

    Equal texts are one group, whatever they hold. Other texts are linked if their shingle sets have
    the given Jaccard similarity, so those without a word stay apart; null texts are equal. A null
    key stays alone. No pair is missed: bands and rows, or ``buckets`` (``key, bucket``) of texts that
    are likely alike, change only the work, unless ``in_bucket`` names a lower similarity that links a
    text to the first of its bucket. ``words`` is the pattern of a word.
    """
    shared_dir(df.sparkSession)
    given = df.select(F.col(key).alias("key"), text.cast("string").alias("text"))
    hashed = given.select("key", F.md5(F.coalesce("text", F.lit("\0null"))).alias("content"))
    copies = hashed.groupBy("content").agg(F.min("key").alias("first"), F.count(F.lit(1)).alias("n"))
    hashed = written(lookup(hashed, copies, "content", "n").select("key", "first"), "firsts")
    firsts = hashed.filter("key <> first").distinct()
    known = given.filter("key is not null and text is not null")
    links = alike(known, similarity, shingle, bands, rows, firsts, buckets, words, in_bucket)
    groups = connected_groups(links)
    sizes = hashed.groupBy("first").agg(F.count(F.lit(1)).alias("n"))
    labelled = sizes.join(groups.hint("merge"), F.col("first") == F.col("node"), "left").select(
        "first", "n", F.coalesce("group", "first").alias("group")
    )
    return lookup(hashed, labelled, "first", "n").select(
        F.col("key").alias(key), F.when(F.col("key").isNotNull(), F.col("group")).alias("group")
    )
