"""Near-copies by exact Jaccard similarity of word shingles.

Two sources name pairs that may be alike: SimHash fingerprints at two or fewer bits, found through pivot distance tables, join most
copies cheaply; prefix filtering then finds every pair still missing. Whole sets decide on each pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventide.llm.common import components, kept, received, release, remove_folder, send, shared_folder, small_batches, word_blocks
from eventide.llm.simhash import near_links, one_each, row_mark

WORDS, SPREAD = 16, 1 << 22  # least longs of a parity sketch; places of a set of wanted rows


def shingle_set(data: bytes, shingle: int = 5) -> np.ndarray:
    """Sorted distinct XXH64 (seed 42, signed) of a whole text's shingles; a text of fewer words is one shingle, without words none."""
    parts, few = [], None
    for words in word_blocks(data.lower(), overlap=shingle - 1):
        if len(words) >= shingle:
            shingles = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
            parts.append(np.unique(np.array([xxhash.xxh64_intdigest(s, 42) for s in shingles], "<u8").view("<i8")))
        few = words
    if not parts:
        return np.array([xxhash.xxh64_intdigest(b" ".join(few), 42)] if few else [], "<u8").view("<i8")
    return np.unique(np.concatenate(parts)) if len(parts) > 1 else parts[0]


def node_of(found: np.ndarray) -> int:
    """A set's number: equal sets are one node."""
    return int(np.uint64(xxhash.xxh64_intdigest(found.tobytes(), 7)).astype(np.int64))


def sketch_of(found: np.ndarray) -> np.ndarray:
    """Bit i is set if an odd number of hashes fall on it: two sets' sketches differ in no more bits than the sets have tokens apart.

    It has a bit or more per token, in a power of two; one half over the other, by XOR, is the sketch of half the length.
    """
    longs = max(WORDS, 1 << max(0, (len(found) - 1) // 64).bit_length())
    bits = np.bincount(found & (64 * longs - 1), minlength=64 * longs) & 1
    return np.packbits(bits.astype(np.uint8), bitorder="little").view("<i8")


def fingerprint_of(found: np.ndarray) -> int:
    """SimHash of a set: a bit is 1 if set in over half the hashes; signed, 0 for the empty set."""
    ones = np.unpackbits(found.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(found), bitorder="little").view("<i8")[0])


def row_key(id_col: str, text_col: str) -> Column:
    return F.xxhash64(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")))


def _prefixes(docs: DataFrame, id_col: str, text_col: str, shingle: int, common: np.ndarray) -> DataFrame:
    """(_id, _mark, _key, node, n, fp, sketch, token) per row; ``token`` has those by which a similar set must be met.

    Of two sets at Jaccard >= 0.8 each holds 4/5 of the other's size in common tokens. So in any order of all tokens their first
    n - ceil(4 n / 5) + 1 tokens meet. The order here has tokens of ``common`` last, which keeps them out of most prefixes.
    """
    sent = send(docs.sparkSession, common)

    @F.pandas_udf("struct<node:long,n:int,fp:long,sketch:array<long>,token:array<long>>")
    def prefix(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        last = received(sent)
        for batch in batches:
            out = []
            for text in batch:
                found = shingle_set((text or "").encode(), shingle)
                name, n, fp, sketch = node_of(found), len(found), fingerprint_of(found), sketch_of(found)
                if n:
                    often = np.isin(found, last, assume_unique=True)
                    found = np.concatenate([found[~often], found[often]])[: n - (4 * n + 4) // 5 + 1]
                out.append((name, n, fp, sketch, found))
            yield pd.DataFrame(out, columns=["node", "n", "fp", "sketch", "token"])

    rows = docs.select(F.col(id_col).alias("_id"), row_mark(text_col).alias("_mark"), row_key(id_col, text_col).alias("_key"), prefix(text_col).alias("s"))
    return rows.select("_id", "_mark", "_key", "s.*")


def whole_sets(docs: DataFrame, id_col: str, text_col: str, shingle: int, wanted: np.ndarray | None = None) -> DataFrame:
    """(node, token) per row, ``token`` its whole set; with ``wanted``, bits by row key modulo SPREAD, of such rows only."""
    sent = send(docs.sparkSession, wanted)

    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bits = received(sent)
        for batch in batches:
            if bits is not None:
                at = batch["key"].to_numpy(np.int64)
                batch = batch[(bits[(at % SPREAD) >> 3] >> (at & 7) & 1).astype(bool)]
            found = [shingle_set((text or "").encode(), shingle) for text in batch["text"]]
            if found:
                yield pd.DataFrame({"node": [node_of(x) for x in found], "token": found})

    return docs.select(row_key(id_col, text_col).alias("key"), F.col(text_col).alias("text")).mapInPandas(sets, "node long, token array<long>")


def common_tokens(docs: DataFrame, id_col: str, text_col: str, shingle: int, rows: int = 4000, most: int = 200_000) -> np.ndarray:
    """Tokens that several of about ``rows`` texts hold, most frequent first; they only decide the order of tokens, never a result."""
    every = max(1, docs.count() // rows)
    some = docs.where(F.pmod(F.xxhash64(text_col), F.lit(every)) == 0)
    counts = whole_sets(some, id_col, text_col, shingle).select(F.explode("token").alias("token")).groupBy("token").count().where("count > 2")
    return np.sort(counts.orderBy(F.desc("count"), "token").limit(most).select("token").toPandas()["token"].to_numpy(np.int64))


def likely(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """``pairs`` (a, b) without those that sizes or sketches prove to be less than 0.8 alike: none at or over it is lost."""
    pairs = kept(pairs.distinct())
    sketches = nodes.select("node", "n", "sketch").join(_ends(pairs), "node", "left_semi")
    of = lambda side: sketches.select(F.col("node").alias(side), F.col("n").alias(f"_n{side}"), F.col("sketch").alias(f"_s{side}"))
    close = 5 * F.least("_na", "_nb") >= 4 * F.greatest("_na", "_nb")  # so one sketch is at most twice as long as the other
    longs = F.least(F.size("_sa"), F.size("_sb"))

    def cut(sketch: str) -> Column:
        folded = F.transform(F.slice(sketch, 1, longs), lambda x, i: x.bitwiseXOR(F.element_at(sketch, (longs + i + 1).cast("int"))))
        return F.when(F.size(sketch) > longs, folded).otherwise(F.col(sketch))

    differing = F.zip_with(cut("_sa"), cut("_sb"), lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    apart = F.aggregate(differing, F.lit(0), lambda total, x: total + x)
    met = pairs.join(of("a"), "a").join(of("b"), "b").where(close)
    return met.where(9 * apart <= F.col("_na") + F.col("_nb")).select("a", "b")


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()


def similar(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """Those of the ``pairs`` (a, b) whose whole sets have a Jaccard similarity of at least 0.8, in whole numbers.

    Only texts that may be in a pair become sets, one for each node: the driver gathers places of rows, SPREAD at most.
    """
    ends = _ends(pairs)
    keys = nodes.join(ends, "node", "left_semi").select(F.pmod("_key", F.lit(SPREAD)).alias("at")).distinct()
    wanted = np.zeros(SPREAD, bool)
    wanted[keys.toPandas()["at"].to_numpy(np.int64)] = True
    sets = whole_sets(docs, id_col, text_col, shingle, np.packbits(wanted, bitorder="little"))
    sets = sets.join(ends, "node", "left_semi").dropDuplicates(["node"])  # one exchange, which both joins share
    of = lambda side: sets.select(F.col("node").alias(side), F.col("token").alias(f"_{side}"))
    shared = F.size(F.array_intersect("_a", "_b"))
    return kept(pairs.join(of("a"), "a").join(of("b"), "b").where(9 * shared >= 4 * (F.size("_a") + F.size("_b"))).select("a", "b"))


def fingerprint_pairs(nodes: DataFrame) -> DataFrame:
    """(a, b) of nodes whose fingerprints are equal or near: each with the first node of its own or of a linked fingerprint."""
    first = kept(nodes.groupBy("fp").agg(F.min("node").alias("first")))
    own = nodes.select("fp", "node").join(first, "fp").where("node <> first").select(F.col("first").alias("a"), F.col("node").alias("b"))
    of = lambda side: first.select(F.col("fp").alias(side), F.col("first").alias(f"_{side}"))
    linked = near_links(first.select("fp")).join(of("a"), "a").join(of("b"), "b")
    return own.unionByName(linked.select(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b")))


def meetings(nodes: DataFrame) -> DataFrame:
    """(token, node, n, at, _node, _n, _core, _m) of tokens that several nodes have in their prefixes, with two of these.

    ``at`` is the token's place in the set's order. ``_core`` (of ``_m`` tokens) has it foremost: it has the fewest rarer tokens of its
    own, so it is nearest to what a large group of edited copies has in common, and most of them are alike to it where they aren't
    to each other. ``_node`` (of ``_n``) is chosen by a hash, which serves tokens that several groups have. One exchange brings a
    token's nodes together; tokens of one node, nearly all, go no further.
    """
    rows = nodes.select("node", "n", F.posexplode("token").alias("at", "token"))
    group = Window.partitionBy("token").orderBy(F.xxhash64("token", "node"), "node")
    whole = group.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    chosen = F.first(F.struct("node", "n")).over(group)
    core = F.min(F.struct("at", F.xxhash64("node").alias("_h"), "node", "n")).over(whole)
    another = F.lead("node").over(group).isNotNull() | (F.row_number().over(group) > 1)
    seen = rows.select("*", chosen.alias("_c"), core.alias("_f"), another.alias("_several")).where("_several")
    names = {"_c.node": "_node", "_c.n": "_n", "_f.node": "_core", "_f.n": "_m"}
    return seen.select("token", "node", "n", "at", *[F.col(c).alias(name) for c, name in names.items()])


def may_meet() -> Column:
    """Whether two sets that have their first common token at ``at`` and ``_at`` may be alike: from there on each must still hold all
    4 (n + _n) / 9 tokens that sets of these sizes have in common at 0.8. Alike sets pass where they first meet."""
    needed = 4 * (F.col("n") + F.col("_n"))
    return (9 * (F.col("n") - F.col("at")) >= needed) & (9 * (F.col("_n") - F.col("_at")) >= needed)


def roots_of(nodes: DataFrame, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, turns: int = 0) -> DataFrame:
    """(node, root) of sets linked to others by a chain of pairs at Jaccard >= 0.8; sets without such a pair don't appear.

    Pairs near by fingerprint are compared first. Then sets that share a prefix token: each with two of the token's sets, another
    in each of the ``turns``, which joins the members of a large group without all its pairs, and last all pairs that a token still has between sets not joined so far.
    """
    test = lambda pairs: similar(kept(likely(pairs, nodes)), nodes, docs, id_col, text_col, shingle)
    close = (5 * F.col("n") >= 4 * F.col("_n")) & (5 * F.col("_n") >= 4 * F.col("n"))
    ends = F.least("node", "_node").alias("a"), F.greatest("node", "_node").alias("b")
    live = kept(meetings(nodes))
    either = F.explode(F.array(F.struct("_node", "_n"), F.struct(F.col("_core").alias("_node"), F.col("_m").alias("_n")))).alias("_e")
    met = live.select("node", "n", either).select("node", "n", "_e.*").where((F.col("node") != F.col("_node")) & close).select(*ends)
    links = test(fingerprint_pairs(nodes).unionByName(met))
    release(docs.sparkSession)
    live = live.select("token", "node", "n", "at")

    def unjoined(known: DataFrame) -> DataFrame:
        named = known.select(live.columns).join(components(links), "node", "left").withColumn("root", F.coalesce("root", "node"))
        several = named.groupBy("token").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x <> y").select("token")
        return kept(named.join(several, "token"))

    left = unjoined(live)
    for turn in range(turns):
        chosen = left.groupBy("token").agg(F.min_by(F.struct("node", "n", "root"), F.struct(F.xxhash64("node", "token", F.lit(turn)), "node")).alias("c"))
        chosen = chosen.select("token", *[F.col(f"c.{c}").alias(f"_{c}") for c in ("node", "n", "root")])
        links = links.unionByName(test(left.join(chosen, "token").where((F.col("root") != F.col("_root")) & close).select(*ends)))
        left = unjoined(left)

    other = left.select("token", *[F.col(c).alias(f"_{c}") for c in ("node", "n", "at", "root")])
    apart = left.join(other, "token").where((F.col("node") < F.col("_node")) & (F.col("root") != F.col("_root")) & may_meet())
    rest = kept(likely(apart.select(*ends), nodes))
    release(docs.sparkSession)
    return components(links.unionByName(similar(rest, nodes, docs, id_col, text_col, shingle)) if not rest.isEmpty() else links)


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5) -> DataFrame:
    """One row of each group of near-copies in ``docs``, with all its columns: that with the smallest id.

    Near-copies share at least 0.8 of their distinct shingles of lower-cased words (Jaccard); groups are chains of such pairs. Texts
    of fewer words are one shingle; null and wordless texts are copies of each other. Shingles are compared by 64-bit hashes. Ids
    that repeat are told apart by their texts; of rows equal in both one stays.
    """
    spark = docs.sparkSession
    small_batches(spark)

    release(spark)
    places = [shared_folder(spark, name) for name in ("prefixes", "nodes")]
    _prefixes(docs, id_col, text_col, shingle, common_tokens(docs, id_col, text_col, shingle)).write.parquet(places[0])
    prefixes = spark.read.parquet(places[0])
    of_node = F.min_by(F.struct("_key", "n", "fp", "sketch", "token"), "_key").alias("_n")  # copies of a set are one node
    prefixes.groupBy("node").agg(of_node).select("node", "_n.*").write.parquet(places[1])
    thin = kept(prefixes.select("_id", "_mark", "node"))
    remove_folder(spark, places[0])
    release(spark)
    nodes = spark.read.parquet(places[1])
    roots = kept(roots_of(nodes, docs, id_col, text_col, shingle))
    remove_folder(spark, places[1])
    release(spark)
    return one_each(docs, thin, roots, id_col, text_col)
