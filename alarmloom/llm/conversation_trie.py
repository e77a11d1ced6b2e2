"""Prefix trie of conversations by depth-band roll-up.

A node is a distinct sequence of first turns (role and text); its members are the
conversations that begin with it. Depths are cut into bands of BAND. A node knows the
nodes above it within its band only, and is exploded to those at most. What a band root
gathers from its own band is rolled up over the band roots alone, which are again a trie,
BAND times less deep, cut into bands the same way; the completed totals of band roots
are then exploded to the nodes of the band above them. So a row is exploded to at most
BAND others, and rounds grow with the logarithm of the depth, whatever the conversations.

A node's name is a polynomial hash of its turns' digests, in four primes' residues (some
124 bits), so it comes from running sums instead of one round per depth. The sums are
taken over all turns in one order by ranges: a conversation may reach over any number of
partitions, and only one row per partition, for the conversation that is cut at its end,
passes through the driver.

Skew: counts are aggregated before they are shuffled. Parents with more than 1 / HOT of
all nodes as children (fewer than HOT of them) are met by broadcast, others by a join
none of whose keys then holds more. Ends of a node become texts of at most ID_SPAN ids
before they are hashed in order, one text in memory at a time.

Defined results: turns go by number, null first, those of one number by digest; null role
or text is empty; rows without conv_id belong to no conversation; repeated rows are turns
of their own; other columns are ignored; no conversations, no nodes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from alarmloom.llm.shared import written
from alarmloom.llm.sql_text import CRC_TABLE, crc32_sql

BAND = 8
HOT = 10_000
ID_SPAN = 512
WORDS = r"[^\x20\x09-\x0D]+"

PRIME = (1 << 31) - 1
BASES = 1_000_003, 727_272_727, 1_618_033_988, 314_159_265
PARTS = range(len(BASES))

NODE = "struct<depth:bigint,hi:bigint,lo:bigint>"
SEQUENCE = "conv_id bigint, words bigint, part int, at bigint, c0 bigint, c1 bigint, c2 bigint, c3 bigint"


@dataclass
class Trie:
    """nodes: node, conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved.

    ends: node, conv_id, the node at which each conversation ends.
    """

    nodes: DataFrame
    ends: DataFrame


# -- turns ---------------------------------------------------------------------


def digested(rows: DataFrame) -> DataFrame:
    """conv_id, turn, four numbers for role and text, words and uid of every turn."""
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    sha = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)
    numbers = [
        (F.conv(F.substring("sha", 8 * j + 1, 8), 16, 10).cast("long") % (PRIME - 1) + 1)
        .alias(f"g{j}")
        for j in PARTS
    ]
    return written(
        rows.where(F.col("conv_id").isNotNull())
        .select(
            F.col("conv_id").cast("long").alias("conv_id"),
            F.col("turn").cast("long").alias("turn"),
            sha.alias("sha"),
            F.regexp_count(text, F.lit(WORDS)).cast("long").alias("words"),
        )
        .select(
            "conv_id",
            "turn",
            *numbers,
            "words",
            F.monotonically_increasing_id().alias("uid"),
        )
    )


GIVEN = ["g0", "g1", "g2", "g3", "words"]


def turn_order() -> list[Column]:
    return [F.col("turn").asc_nulls_first(), *[F.col(c) for c in GIVEN], F.col("uid")]


def rebuilt(turns: DataFrame, every: int, kinds: int) -> tuple[DataFrame, DataFrame]:
    """Sequences that share beginnings, and the ids of all conversations.

    Conversation c gets the first h turns of conversation c - c % every, then its own
    turns after its first h; h = crc32(c) % kinds.
    """
    # the first turns are picked before the shuffle, so a long conversation sends few
    own = Window.partitionBy("conv_id").orderBy(*turn_order())
    first = written(
        turns.withColumn("place", F.row_number().over(own))
        .where(F.col("place") <= max(1, kinds - 1))
        .withColumn("h", F.crc32(F.col("conv_id").cast("string")) % kinds)
    )
    convs = first.where("place = 1").select("conv_id", "h")
    base = F.col("conv_id") - F.col("conv_id") % every
    heads = first.where(F.col("conv_id") % every == 0).select(
        F.col("conv_id").alias("base"), "place", *GIVEN, "uid"
    )
    begun = convs.select("conv_id", "h", base.alias("base")).join(heads, "base")
    left_out = first.where(F.col("place") <= F.col("h")).select("uid")
    sequence = (
        begun.where(F.col("place") <= F.col("h"))
        .select("conv_id", F.lit(0).alias("kind"), F.col("place").cast("long").alias("turn"), *GIVEN, "uid")
        .unionByName(
            turns.join(left_out, "uid", "left_anti").select(
                "conv_id", F.lit(1).alias("kind"), "turn", *GIVEN, "uid"
            )
        )
    )
    return sequence, convs.select("conv_id")


def as_given(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The sequences as they are, and the ids of all conversations."""
    return turns.withColumn("kind", F.lit(1)), turns.select("conv_id").distinct()


# -- names of prefixes ------------------------------------------------------------


def powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.int64)
    done = 1
    while done < n:
        more = min(done, n - done)
        out[done : done + more] = out[:more] * pow(base, done, PRIME) % PRIME
        done += more
    return out


def accumulate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Place and hash sums of each turn within its conversation and partition."""
    last, count, sums = None, 0, [0] * len(BASES)
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        conv = batch.column("conv_id").to_numpy()
        starts = np.flatnonzero(np.append(True, conv[1:] != conv[:-1]))
        run = np.zeros(n, np.int64)
        run[starts[1:]] = 1
        run = np.cumsum(run)
        place = np.arange(n) - starts[run]
        goes_on = conv[0] == last
        in_first = run == 0
        out = []
        for j, base in enumerate(BASES):
            term = batch.column(f"g{j}").to_numpy() * powers(base, n)[place] % PRIME
            if goes_on:
                term[in_first] = term[in_first] * pow(base, count, PRIME) % PRIME
            total = np.cumsum(term)
            here = total - (total[starts] - term[starts])[run]
            if goes_on:
                here[in_first] += sums[j]
            out.append(here % PRIME)
        if goes_on:
            place[in_first] += count
        last, count, sums = conv[-1], int(place[-1]) + 1, [int(x[-1]) for x in out]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("conv_id"),
                batch.column("words"),
                batch.column("part"),
                pa.array(place + 1),
                *[pa.array(x) for x in out],
            ],
            names=["conv_id", "words", "part", "at", "c0", "c1", "c2", "c3"],
        )


def prefixes(sequence: DataFrame) -> DataFrame:
    """conv_id, words and node of every first part of a sequence, but the empty one."""
    spark = sequence.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("conv_id"), F.col("kind"), *turn_order()]
    local = written(
        sequence.repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .select("conv_id", *GIVEN, F.spark_partition_id().alias("part"))
        .mapInArrow(accumulate, SEQUENCE)
    )
    sums = [f"c{j}" for j in PARTS]
    last = F.max_by(F.struct("conv_id", "at", *sums), F.struct("conv_id", "at"))
    # one row for each partition
    ends = local.groupBy("part").agg(F.min("conv_id").alias("first"), last.alias("last"))
    carried = carry([(r.part, r["first"], tuple(r["last"])) for r in ends.collect()])
    names = [f"{k}{j}" for k in ("in", "by") for j in PARTS]
    fields = ", ".join(f"{c} bigint" for c in ["conv_id", "ahead", *names])
    table = spark.createDataFrame(carried, f"part int, {fields}")
    met = local.join(F.broadcast(table), ["part", "conv_id"], "left")
    hashes = [
        (F.coalesce(f"in{j}", F.lit(0)) + F.coalesce(f"by{j}", F.lit(1)) * F.col(f"c{j}"))
        % PRIME
        for j in PARTS
    ]
    depth = F.col("at") + F.coalesce("ahead", F.lit(0))
    node = F.struct(
        depth.alias("depth"),
        (hashes[0] * (1 << 31) + hashes[1]).alias("hi"),
        (hashes[2] * (1 << 31) + hashes[3]).alias("lo"),
    )
    return met.select("conv_id", "words", node.alias("node"))


def carry(ends: list[tuple]) -> list[tuple]:
    """What the partitions before it hold of the conversation a partition begins with."""
    out, before, state = [], None, None
    for part, first, (last, count, *sums) in sorted(ends):
        if first == before:
            ahead, inner = state
            scale = [pow(base, ahead, PRIME) for base in BASES]
            out.append((part, first, ahead, *inner, *scale))
            if last == first:
                count += ahead
                sums = [(i + s * c) % PRIME for i, s, c in zip(inner, scale, sums)]
        before, state = last, (count, sums)
    return out


# -- bands ---------------------------------------------------------------------


def root() -> Column:
    return F.struct(*[F.lit(0).cast("long").alias(c) for c in ("depth", "hi", "lo")])


def in_bands(chain: DataFrame, height: int, step: int) -> DataFrame:
    """chain with ``up``: the nodes above each node within its band, band root first.

    Of the chain only depths divisible by ``step`` count; bands are ``height`` such high.
    A node at a band's end is also the root of the next, so a group of one conversation
    and band has at most height + 1 rows.
    """
    level = F.col("node.depth").cast("long")
    span = height * step
    ends = F.array(
        F.struct(F.floor((level - 1) / span).alias("band"), F.lit(True).alias("member")),
        F.struct(F.floor(level / span).alias("band"), F.lit(False).alias("member")),
    )
    used = F.when(level % span == 0, ends).otherwise(F.slice(ends, 1, 1))
    grouped = (
        chain.where(level % step == 0)
        .select("conv_id", "words", "node", F.explode(used).alias("in"))
        .groupBy("conv_id", F.col("in.band").alias("band"))
        .agg(F.array_sort(F.collect_list(F.struct("node", "words", "in.member"))).alias("all"))
    )
    nodes = F.transform("all", lambda x: x["node"])
    # the root of all is in no table of turns
    above = F.when(F.col("band") == 0, F.concat(F.array(root()), nodes)).otherwise(nodes)
    return (
        grouped.select("conv_id", "band", above.alias("above"), F.posexplode("all").alias("i", "x"))
        .where("x.member")
        .select(
            "conv_id",
            "x.node",
            "x.words",
            F.slice("above", F.lit(1), F.col("i") + F.when(F.col("band") == 0, 1).otherwise(0)).alias("up"),
        )
    )


VALUES = ["saved", "n_leaves"]


def summed(rows: DataFrame) -> DataFrame:
    return rows.groupBy("node").agg(*[F.sum(c).alias(c) for c in VALUES])


def subtree_sums(
    chain: DataFrame, links: DataFrame, own: DataFrame, deepest: int, height: int, step: int = 1
) -> DataFrame:
    """node and the sums of ``own`` over its subtree, itself included.

    links: node, up (see in_bands), the root of all with none.
    """
    span = height * step
    is_root = F.col("node.depth") % span == 0
    values = links.join(own, "node")
    whole = F.concat("up", F.array("node"))
    if deepest <= span:  # a single band
        return summed(values.select(F.explode(whole).alias("node"), *VALUES))
    above = F.when(is_root, F.array("node")).otherwise(whole)
    inner = written(summed(values.select(F.explode(above).alias("node"), *VALUES)))
    roots_above = in_bands(chain, height, span).groupBy("node").agg(F.any_value("up").alias("up"))
    roots = written(
        subtree_sums(
            chain, with_root(roots_above), inner.where(is_root), deepest, height, span
        )
    )
    below = F.filter("up", lambda x: x["depth"] % span != 0)
    hanging = (
        links.where(is_root)
        .join(roots, "node")
        .select(F.explode(below).alias("node"), *VALUES)
    )
    return roots.unionByName(summed(inner.where(~is_root).unionByName(hanging)))


def with_root(links: DataFrame) -> DataFrame:
    """links and the root of all, above which there is nothing."""
    nothing = F.array().cast(f"array<{NODE}>")
    top = links.sparkSession.range(1).select(root().alias("node"), nothing.alias("up"))
    return links.select("node", "up").unionByName(top)


# -- the trie ---------------------------------------------------------------------


def prefix_trie(sequence: DataFrame, convs: DataFrame, height: int = BAND) -> Trie:
    """The nodes of all first parts of the sequences (see digested, rebuilt, as_given).

    convs: the ids of all conversations, those without turns included.
    """
    if height < 2:
        raise ValueError("a band is at least two high")
    chain = prefixes(sequence)
    deepest = chain.agg(F.max("node.depth")).first()[0] or 0
    facts = ["conv_id", "n_convs", "words"]
    nodes = (
        in_bands(chain, height, 1)
        .groupBy("node")
        .agg(
            F.count(F.lit(1)).alias("n_convs"),
            F.min("conv_id").alias("conv_id"),
            F.any_value("words").alias("words"),
            F.any_value("up").alias("up"),
        )
    )
    top = convs.agg(
        F.count(F.lit(1)).alias("n_convs"),
        F.min("conv_id").alias("conv_id"),
        F.lit(0).cast("long").alias("words"),
    ).where("n_convs > 0")
    nothing = F.array().cast(f"array<{NODE}>")
    top = top.withColumns({"node": root(), "up": nothing})
    nodes = written(nodes.unionByName(top))
    parent = F.try_element_at("up", F.lit(-1))
    children = (
        nodes.where(F.size("up") > 0)
        .groupBy(parent.alias("node"))
        .agg(F.count(F.lit(1)).alias("n_children"))
    )
    counted = written(
        nodes.select("node", *facts)
        .join(children, "node", "left")
        .withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    )
    own = counted.select(
        "node",
        ((F.col("n_convs") - 1) * F.col("words")).alias("saved"),
        (F.col("n_children") == 0).cast("long").alias("n_leaves"),
    )
    links = nodes.select("node", "up")
    sums = subtree_sums(chain, links, own, deepest, height)
    parents = parent_ids(nodes.select("node", parent.alias("parent")), counted)
    last = chain.groupBy("conv_id").agg(F.max("node").alias("node"))
    ends = convs.join(last, "conv_id", "left").select(
        F.coalesce("node", root()).alias("node"), "conv_id"
    )
    found = counted.join(sums, "node").join(parents, "node", "left")
    return Trie(
        found.select(
            "node", "conv_id", F.col("node.depth").alias("depth"), "parent_conv_id",
            "n_convs", "n_children", *VALUES,
        ),
        ends,
    )


def parent_ids(nodes: DataFrame, counted: DataFrame) -> DataFrame:
    """node and parent_conv_id. Parents of very many nodes are fewer than HOT."""
    ids = counted.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"), "n_children")
    share = -(-counted.count() // HOT)
    many = F.col("n_children") > max(share, 1)
    hot = F.broadcast(ids.where(many).drop("n_children"))
    below = nodes.where(F.col("parent").isNotNull())
    return (
        below.join(hot, "parent")
        .unionByName(
            below.join(hot.select("parent"), "parent", "left_anti").join(
                ids.where(~many).drop("n_children"), "parent"
            )
        )
        .select("node", "parent_conv_id")
    )


def node_turns(nodes: DataFrame, turns: DataFrame) -> DataFrame:
    """nodes with role and text of their last turn, of conversations as given."""
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    told = turns.select(
        "conv_id", F.row_number().over(order).cast("long").alias("depth"), "role", "text"
    )
    return nodes.join(told, ["conv_id", "depth"], "left")


def ends_digest(ends: DataFrame) -> DataFrame:
    """node and the SHA-256 of the ids that end there, ascending, comma-joined."""
    ids = F.transform(F.sort_array(F.collect_list("conv_id")), lambda x: x.cast("string"))
    pieces = ends.groupBy("node", F.expr(f"conv_id div {ID_SPAN}").alias("piece")).agg(
        F.array_join(ids, ",").alias("ids")
    )
    ordered = pieces.repartition("node").sortWithinPartitions("node", "piece")
    fields = "depth bigint, hi bigint, lo bigint, ends_sha256 string"
    hashed = ordered.select("node.*", "ids").mapInArrow(hash_runs, fields)
    return hashed.select(F.struct("depth", "hi", "lo").alias("node"), "ends_sha256")


def hash_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest for each run of rows of a node, whose texts are joined by commas."""
    names = ["depth", "hi", "lo"]
    now, state = None, None
    for batch in batches:
        done = []
        for *node, ids in zip(*[batch.column(c).to_pylist() for c in (*names, "ids")]):
            if node == now:
                state.update(b",")
            else:
                if state:
                    done.append((*now, state.hexdigest()))
                now, state = node, hashlib.sha256()
            state.update(ids.encode())
        yield told(done)
    if state:
        yield told([(*now, state.hexdigest())])


def told(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
    columns = list(zip(*rows)) or [()] * 4
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), k) for c, k in zip(columns, kinds)],
        names=["depth", "hi", "lo", "ends_sha256"],
    )


EVERY, KINDS = 20, 4


def trie_report(conversations: DataFrame) -> DataFrame:
    """A row for each node of the conversations that share beginnings (see rebuilt)."""
    sequence, convs = rebuilt(digested(conversations), EVERY, KINDS)
    trie = prefix_trie(sequence, convs)
    found = trie.nodes.join(ends_digest(trie.ends), "node", "left")
    return found.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )


ORACLE = f"""
WITH {CRC_TABLE}, turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id
                            ORDER BY turn NULLS FIRST, role, text) AS place
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT conv_id, {crc32_sql("conv_id::VARCHAR")} % {KINDS} AS h
  FROM (SELECT DISTINCT conv_id FROM turns), crc_table
), sequence AS (
  SELECT c.conv_id, 0 AS kind, t.place, t.role, t.text
  FROM convs c JOIN turns t
    ON t.conv_id = c.conv_id - c.conv_id % {EVERY} AND t.place <= c.h
  UNION ALL
  SELECT c.conv_id, 1, t.place, t.role, t.text
  FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.place > c.h
), named AS (
  SELECT conv_id, row_number() OVER w AS depth,
         sha256(string_agg(sha256(len(role) || ':' || role || text), '') OVER w) AS node,
         len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS words
  FROM sequence WINDOW w AS (PARTITION BY conv_id ORDER BY kind, place)
), prefix AS (
  SELECT * FROM named
  UNION ALL SELECT conv_id, 0, 'root', 0 FROM convs
), nodes AS (
  SELECT node, any_value(depth) AS depth, min(conv_id) AS conv_id,
         count(*) AS n_convs, any_value(words) AS words
  FROM prefix GROUP BY node
), links AS (
  SELECT n.node, p.node AS above, p.depth = n.depth - 1 AS is_parent
  FROM nodes n JOIN prefix p ON p.conv_id = n.conv_id AND p.depth <= n.depth
), kids AS (
  SELECT above AS node, count(*) AS n_children FROM links WHERE is_parent GROUP BY above
), own AS (
  SELECT n.*, coalesce(k.n_children, 0) AS n_children, (n_convs - 1) * words AS saved
  FROM nodes n LEFT JOIN kids k USING (node)
), sums AS (
  SELECT l.above AS node, sum(o.saved)::BIGINT AS saved_tokens,
         count(*) FILTER (o.n_children = 0) AS n_leaves
  FROM links l JOIN own o ON o.node = l.node GROUP BY l.above
), last AS (
  SELECT conv_id, arg_max(node, depth) AS node FROM prefix GROUP BY conv_id
), ends AS (
  SELECT node, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS ends_sha256
  FROM last GROUP BY node
), parents AS (
  SELECT l.node, o.conv_id AS parent_conv_id
  FROM links l JOIN own o ON o.node = l.above WHERE l.is_parent
)
SELECT o.conv_id, o.depth, p.parent_conv_id, o.n_convs, o.n_children, s.n_leaves,
       s.saved_tokens, coalesce(e.ends_sha256, sha256('')) AS ends_sha256
FROM own o JOIN sums s USING (node) LEFT JOIN ends e USING (node)
LEFT JOIN parents p USING (node)
"""
