"""A trie of conversation prefixes, by peeling turns off the ends of conversations.

A node is a sequence of first turns that at least one conversation has. The peeling descends from the greatest depth: the
conversations that end there join the nodes that survive from below, equal sequences merge into one node, its totals are
final, its last turn is stripped, and what is left is regrouped one level up. So one pass discovers the nodes and sums up
their subtrees. A turn sequence is known by 128 bits that hash its turns with their places; a conversation of any length gets
the hashes of all its prefixes as running sums, over slices of rows where it is long.

Three things keep the peeling short and its groups bounded:

* Copies of a conversation are one sequence with a count.
* Where a sequence shares its prefix with no other, the turns are stripped all at once: the totals of a lonely path follow
  from running sums. The peeling proper starts where a sequence meets another one.
* Below the smallest depth at which no node has more than ``GROUP_ROWS`` shared turns under it, the nodes under each node of
  that depth are peeled in one task, many such groups in a task of bounded rows. Above it, a level is one grouping of all
  its rows, summed before they are shuffled, so a first turn that very many conversations share is no large group.

The ids of conversations that end at a node are hashed as they come from a sorted shuffle, in parts that ranges of rows
have joined before; no list of them is held.

Defined cases: a null conv_id is no conversation; null turns come first, equal turns are ordered by a hash of role and text,
so repeated rows are repeated turns; null roles and texts are empty; a conversation may end up without turns and is then a
member of the root only; an empty table has no node, not even a root; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.crc_resampling import CRC_ENTRIES, crc_sql
from tidemark.llm.registry import query, table
from tidemark.plans.ordered import following, number, order_rows, previous, running_sum
from tidemark.plans.staging import stage

#: Shared turns under a node that one task may peel, and that a task gets in all.
GROUP_ROWS, TASK_ROWS = 5_000, 200_000
#: Ids joined before they are hashed.
IDS_AT_ONCE = 500
#: Conversations of a family take up to ``MOST_HEAD_TURNS`` turns of its first member.
FAMILY, MOST_HEAD_TURNS = 20, 3
NO_ENDS = hashlib.sha256(b"").hexdigest()

NODE = "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint"


# --------------------------------------------------------------------------- turns


def turns(conversations: DataFrame) -> DataFrame:
    """conv_id, pos (from 1), a and b (hashes of role and text) and words of every turn."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        "turn",
        F.xxhash64(role, text).alias("a"),
        F.xxhash64(F.lit("second"), text, role).alias("b"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint").alias("words"),
    )
    rows = stage(rows, "turns")
    return order_rows(rows, ["conv_id"], ["turn", "a", "b"]).scan(pos=number()).rows().drop("turn")


def with_heads(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All conversations (conv_id), and their turns after each one's first turns gave way to those of its family's first.

    Turns are ordered by (part, pos).
    """
    rows = stage(rows, "numbered")
    replaced = lambda conv: F.crc32(conv.cast("string").cast("binary")) % (MOST_HEAD_TURNS + 1)
    convs = stage(rows.select("conv_id").distinct(), "conversations")
    heads = rows.filter((F.col("conv_id") % FAMILY == 0) & (F.col("pos") <= MOST_HEAD_TURNS)).withColumnRenamed("conv_id", "family")
    family = F.col("conv_id") - F.col("conv_id") % FAMILY
    first = convs.withColumn("family", family).join(heads, "family").filter(F.col("pos") <= replaced(F.col("conv_id")))
    columns = ["conv_id", "part", "pos", "a", "b", "words"]
    own = rows.filter(F.col("pos") > replaced(F.col("conv_id"))).withColumn("part", F.lit(1))
    return convs, first.withColumn("part", F.lit(0)).select(*columns).unionByName(own.select(*columns))


def prefixes(rows: DataFrame) -> DataFrame:
    """conv_id, depth, words, upto (words so far), last, and two hashes of the first ``depth`` turns (h, l) and of one turn less.

    The sums of 32-bit parts of hashes do not overflow below two thousand million turns. The root's hashes are zero.
    """
    rows = order_rows(stage(rows, "rebuilt"), ["conv_id"], ["part", "pos"]).scan(depth=number(), next=following("pos"))
    x, y = F.xxhash64(F.lit("x"), "depth", "a", "b"), F.xxhash64(F.lit("y"), "depth", "b", "a")
    low = lambda h: h.bitwiseAND(F.lit(0xFFFFFFFF))
    parts = [low(x), F.shiftrightunsigned(x, 32), low(y), F.shiftrightunsigned(y, 32)]
    sums = {f"s{i}": running_sum(part) for i, part in enumerate(parts)}
    rows = rows.scan(upto=running_sum("words"), **sums)
    keyed = rows.df.withColumns({"h": F.xxhash64("depth", *sums), "l": F.xxhash64(F.lit("l"), *reversed(sums), "depth")})
    rows = replace(rows, df=keyed).scan(ph=previous("h"), pl=previous("l")).rows()
    parent = [F.coalesce(c, F.lit(0)).alias(c) for c in ("ph", "pl")]
    return rows.select("conv_id", "depth", "h", "l", *parent, "words", "upto", F.col("next").isNull().alias("last"))


# --------------------------------------------------------------------------- ends


def ends(rows: DataFrame) -> DataFrame:
    """h, l and ends_sha256: the digest of the ascending conv_ids of each key, joined by commas.

    Ranges of (key, conv_id) are joined to strings of a few hundred ids first, so what one key sends to the task that
    hashes it is a stream of few rows.
    """
    columns = ["h", "l", "conv_id"]
    parts = max(rows.sparkSession.sparkContext.defaultParallelism, rows.count() // 1_000_000)

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h, l, conv = (c.to_numpy() for c in batch.columns)
            new = np.flatnonzero((np.diff(h) != 0) | (np.diff(l) != 0)) + 1
            starts = np.concatenate([[0], new]).astype(np.int64)
            sizes = np.diff(np.append(starts, len(h)))
            many = -(-sizes // IDS_AT_ONCE)
            within = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            cuts = np.repeat(starts, many) + within * IDS_AT_ONCE
            stops = np.append(cuts[1:], len(h))
            texts = [",".join(map(str, conv[a:b].tolist())) for a, b in zip(cuts.tolist(), stops.tolist())]
            arrays = [pa.array(x[cuts]) for x in (h, l, conv)] + [pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, names=[*columns, "ids"])

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest = None, None
        for batch in batches:
            found = []
            for row in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3))):
                if row[:2] == key:
                    digest.update(b",")
                else:
                    if key is not None:
                        found.append((*key, digest.hexdigest()))
                    key, digest = row[:2], hashlib.sha256()
                digest.update(row[2].encode())
            yield _digests(found)
        if key is not None:
            yield _digests([(*key, digest.hexdigest())])

    strings = rows.select(*columns).repartitionByRange(parts, *columns).sortWithinPartitions(*columns)
    strings = strings.mapInArrow(joined, "h bigint, l bigint, conv_id bigint, ids string")
    ordered = strings.repartition(parts, "h", "l").sortWithinPartitions(*columns)
    return ordered.mapInArrow(digested, "h bigint, l bigint, ends_sha256 string")


def _digests(found: list[tuple[int, int, str]]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.string())
    columns = zip(*found) if found else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["h", "l", "ends_sha256"])


# --------------------------------------------------------------------------- peeling

SUMS = ("n_convs", "n_children", "n_leaves", "saved_tokens")
PEELED = "above boolean, h bigint, l bigint, ph bigint, pl bigint, depth bigint, conv_id bigint, parent_conv_id bigint, " + ", ".join(
    f"{c} bigint" for c in SUMS
)


def peeled(rows: pd.DataFrame, stop: int) -> Iterator[pd.DataFrame]:
    """The nodes below depth ``stop`` (``above`` false), and what is left of them there (``above`` true).

    ``rows`` has, for every sequence and depth of its path, conv_id, words and the keys, and in ``SUMS`` what the sequence
    brings to the node where it joins, else zeros.
    """
    key, parent = ["h", "l"], ["ph", "pl"]
    by_depth = dict(list(rows.groupby("depth")))
    left = pd.DataFrame(columns=[*key, "conv_id", *SUMS], dtype="int64")
    below = None
    for depth in range(max(by_depth, default=stop), stop, -1):
        here = by_depth[depth]
        merged = pd.concat([here[left.columns], left]).groupby(key).agg({"conv_id": "min"} | {c: "sum" for c in SUMS})
        nodes = merged.join(here.drop_duplicates(key).set_index(key)[[*parent, "words"]]).reset_index()
        nodes["n_leaves"] = nodes["n_leaves"].where(nodes["n_children"] > 0, 1)
        nodes["saved_tokens"] += (nodes["n_convs"] - 1) * nodes["words"]
        if below is not None:
            names = nodes.set_index(key)["conv_id"].rename("parent_conv_id")
            yield below.join(names, on=parent)
        below = nodes.assign(above=False, depth=depth)
        # A node that lost its last turn is a child of what is left.
        left = nodes.assign(h=nodes["ph"], l=nodes["pl"], n_children=1)[left.columns]
    if below is not None:
        yield below.assign(parent_conv_id=None)
        left = left.groupby(key).agg({"conv_id": "min"} | {c: "sum" for c in SUMS}).reset_index()
        yield left.assign(above=True, depth=stop, ph=None, pl=None, parent_conv_id=None)


def peel_groups(rows: DataFrame, stop: int) -> DataFrame:
    """``peeled`` for all groups of rows that share their key at depth ``stop`` (gh, gl)."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    wanted = to_arrow_schema(_parse_datatype_string(PEELED))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [batch.to_pandas() for batch in batches if batch.num_rows]
        for found in peeled(pd.concat(held), stop) if held else ():
            for at in range(0, len(found), 50_000):
                yield pa.RecordBatch.from_pandas(found.iloc[at : at + 50_000], schema=wanted, preserve_index=False)

    tasks = max(rows.sparkSession.sparkContext.defaultParallelism, rows.count() // TASK_ROWS)
    columns = ["depth", "h", "l", "ph", "pl", "conv_id", "words", *SUMS]
    return rows.repartition(tasks, "gh", "gl").select(*columns).mapInArrow(run, PEELED)


def peel_level(rows: DataFrame, left: DataFrame | None, depth: int) -> DataFrame:
    """The nodes at ``depth``, from sequences that pass or end there and from what is ``left`` of the nodes below."""
    here = rows.filter(F.col("depth") == depth).select("h", "l", "ph", "pl", "words", "conv_id", *SUMS)
    both = here if left is None else here.unionByName(left, allowMissingColumns=True)
    first = [F.max(c).alias(c) for c in ("ph", "pl", "words")]  # equal in all rows that have them
    nodes = both.groupBy("h", "l").agg(*first, F.min("conv_id").alias("conv_id"), *[F.sum(c).alias(c) for c in SUMS])
    return nodes.select(
        "h", "l", "ph", "pl", F.lit(depth).cast("bigint").alias("depth"), "conv_id", F.lit(None).cast("bigint").alias("parent_conv_id"),
        "n_convs", "n_children", F.when(F.col("n_children") > 0, F.col("n_leaves")).otherwise(1).alias("n_leaves"),
        (F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens"),
    )


def _stripped(nodes: DataFrame) -> DataFrame:
    return nodes.select(
        F.col("ph").alias("h"), F.col("pl").alias("l"), "conv_id", "n_convs", F.lit(1).cast("bigint").alias("n_children"), "n_leaves", "saved_tokens"
    )


# --------------------------------------------------------------------------- the trie


def _sequences(convs: DataFrame, rows: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Conversations without turns; distinct sequences, named by their smallest conversation; the rows of these."""
    finals = rows.filter("last")
    found = finals.groupBy("h", "l").agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("copies"), F.max("depth").alias("length"), F.max("upto").alias("total")
    )
    found = stage(found.join(ends(finals), ["h", "l"]), "sequences")
    bare = convs.join(finals, "conv_id", "left_anti")
    paths = rows.drop("last").join(found.drop("h", "l"), "conv_id")
    return bare, found, stage(paths, "paths")


def _meeting(paths: DataFrame) -> DataFrame:
    """``paths`` with met: the greatest depth at which the sequence shares its prefix with another one, 0 for none."""
    shared = stage(paths.groupBy("h", "l").count().filter("count > 1").select("h", "l"), "shared")
    met = paths.join(shared, ["h", "l"], "left_semi").groupBy("conv_id").agg(F.max("depth").alias("met"))
    return stage(paths.join(met, "conv_id", "left").withColumn("met", F.coalesce("met", F.lit(0))), "met")


def _lonely_below(depth: Column) -> list[Column]:
    """What a sequence brings to the node where it joins: itself, and a lonely path below or nothing."""
    lonely = F.col("length") > depth
    return [
        F.col("copies").alias("n_convs"),
        lonely.cast("bigint").alias("n_children"),
        lonely.cast("bigint").alias("n_leaves"),
        ((F.col("copies") - 1) * (F.col("total") - F.col("upto"))).alias("saved_tokens"),
    ]


def _split_depth(shared: DataFrame, group_rows: int) -> int:
    """The smallest depth at which every node has at most ``group_rows`` shared turns under it."""
    under = shared.groupBy("depth", "h", "l").agg(F.sum(F.col("met") - F.col("depth")).alias("under"))
    most = dict(under.groupBy("depth").agg(F.max("under")).collect())  # one row per depth that is shared
    everything = shared.filter("depth = 1").agg(F.sum("met")).first()[0] or 0
    most[0] = everything
    return next(d for d in range(max(most) + 1) if most[d] <= group_rows)


def prefix_trie(conversations: DataFrame, group_rows: int = GROUP_ROWS) -> DataFrame:
    """The nodes of the trie of rebuilt conversations: the columns of ``NODE`` and ends_sha256."""
    convs, rebuilt = with_heads(turns(conversations))
    bare, sequences, paths = _sequences(convs, stage(prefixes(rebuilt), "prefixes"))
    paths = _meeting(paths)
    keys = ["h", "l", "ph", "pl"]

    alone = paths.filter("depth > met").select(
        *keys, "depth", "conv_id", F.when(F.col("depth") - 1 > F.col("met"), F.col("conv_id")).alias("parent_conv_id"),
        F.col("copies").alias("n_convs"), (F.col("depth") < F.col("length")).cast("bigint").alias("n_children"),
        F.lit(1).cast("bigint").alias("n_leaves"),
        ((F.col("copies") - 1) * (F.col("total") - F.col("upto") + F.col("words"))).alias("saved_tokens"),
        F.when(F.col("depth") == F.col("length"), F.col("ends_sha256")).otherwise(NO_ENDS).alias("ends_sha256"),
    )

    joins = F.col("depth") == F.col("met")
    brings = _lonely_below(F.col("depth"))
    shared = paths.filter("depth <= met").select(
        *keys, "depth", "conv_id", "words", "met", *[F.when(joins, b).otherwise(0).cast("bigint").alias(n) for b, n in zip(brings, SUMS)]
    )
    shared = stage(shared, "peeling")
    stop = _split_depth(shared, group_rows)
    deep = shared.filter(F.col("depth") > stop)
    if stop:
        group = shared.filter((F.col("depth") == stop) & (F.col("met") > stop)).select("conv_id", F.col("h").alias("gh"), F.col("l").alias("gl"))
        deep = deep.join(group, "conv_id")
    else:
        deep = deep.withColumns({"gh": F.lit(0), "gl": F.lit(0)})
    found = stage(peel_groups(deep, stop), "peeled")
    nodes = [found.filter("NOT above").drop("above")]
    left = found.filter("above").select("h", "l", "conv_id", *SUMS)
    for depth in range(stop, 0, -1):
        nodes.append(stage(peel_level(shared, left, depth), "level"))
        left = _stripped(nodes[-1])

    # Sequences that meet no other, and conversations without turns, join at the root.
    at_root = paths.filter("met = 0 AND depth = 1").withColumn("upto", F.lit(0)).select("conv_id", *_lonely_below(F.lit(0)))
    none = [F.lit(1 if c == "n_convs" else 0).cast("bigint").alias(c) for c in SUMS]
    total = left.drop("h", "l").unionByName(at_root).unionByName(bare.select("conv_id", *none))
    root = total.agg(F.min("conv_id").alias("conv_id"), *[F.sum(c).alias(c) for c in SUMS])
    ended = ends(bare.select(F.lit(0).cast("bigint").alias("h"), F.lit(0).cast("bigint").alias("l"), "conv_id"))
    root = stage(root.join(F.broadcast(ended.select("ends_sha256")), F.lit(True), "left").filter("conv_id IS NOT NULL"), "root")
    top = root.select("conv_id").first()
    root = root.select(
        "conv_id", F.lit(0).cast("bigint").alias("depth"), F.lit(None).cast("bigint").alias("parent_conv_id"), "n_convs", "n_children",
        F.when(F.col("n_children") > 0, F.col("n_leaves")).otherwise(1).alias("n_leaves"), "saved_tokens",
        F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"),
    )

    merged = nodes[0]
    for more in nodes[1:]:
        merged = merged.unionByName(more)
    ended = sequences.select("h", "l", "ends_sha256")
    merged = merged.join(ended, ["h", "l"], "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NO_ENDS)))
    merged = stage(merged, "nodes")
    every = alone.unionByName(merged)
    columns = [f.split()[0] for f in NODE.split(", ")] + ["ends_sha256"]
    first = every.filter("depth = 1").withColumn("parent_conv_id", F.lit(top and top[0]).cast("bigint"))
    known = every.filter("depth > 1 AND parent_conv_id IS NOT NULL")
    parents = merged.select(F.col("h").alias("ph"), F.col("l").alias("pl"), F.col("conv_id").alias("parent"))
    rest = every.filter("depth > 1 AND parent_conv_id IS NULL").join(parents, ["ph", "pl"]).withColumn("parent_conv_id", F.col("parent"))
    out = root.select(*columns)
    for part in (first, known, rest):
        out = out.unionByName(part.select(*columns))
    return out


# --------------------------------------------------------------------------- the query

ORACLE = f"""
WITH {CRC_ENTRIES},
turns AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS pos
    FROM conversations WHERE conv_id IS NOT NULL
), spelled AS (SELECT DISTINCT conv_id, hex(encode(conv_id::VARCHAR)) AS digits FROM turns),
convs AS (
    SELECT conv_id, conv_id - conv_id % 20 AS family, {crc_sql("digits")} % 4 AS replaced FROM spelled, entries
), rebuilt AS (
    SELECT c.conv_id, 0 AS part, pos, role, text FROM convs c JOIN turns t ON t.conv_id = c.family AND pos <= replaced
    UNION ALL
    SELECT c.conv_id, 1, pos, role, text FROM convs c JOIN turns t ON t.conv_id = c.conv_id WHERE pos > replaced
), numbered AS (
    SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY part, pos) AS depth,
        md5(length(role) || ':' || role || text) AS said, len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS words
    FROM rebuilt
), prefixes AS (
    SELECT conv_id, depth, words,
        array_to_string(list(said) OVER (PARTITION BY conv_id ORDER BY depth ROWS UNBOUNDED PRECEDING), ',') AS path FROM numbered
    UNION ALL
    SELECT conv_id, 0, 0, '' FROM convs
), lengths AS (SELECT conv_id, max(depth) AS length FROM prefixes GROUP BY conv_id),
ended AS (
    SELECT path, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS ends
    FROM prefixes JOIN lengths USING (conv_id) WHERE depth = length GROUP BY path
), found AS (
    SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words FROM prefixes GROUP BY path, depth
), above AS (
    SELECT n.*, p.path AS parent FROM found n LEFT JOIN prefixes p ON p.conv_id = n.conv_id AND p.depth = n.depth - 1
), children AS (SELECT parent AS path, count(*) AS n_children FROM above WHERE parent IS NOT NULL GROUP BY parent),
totals AS (
    SELECT x.path, sum((n.n_convs - 1) * n.words) AS saved, count(*) FILTER (c.n_children IS NULL) AS n_leaves
    FROM found n LEFT JOIN children c USING (path) JOIN prefixes x ON x.conv_id = n.conv_id AND x.depth <= n.depth GROUP BY x.path
)
SELECT a.conv_id, a.depth, p.conv_id AS parent_conv_id, a.n_convs, coalesce(n_children, 0) AS n_children, n_leaves,
    saved::BIGINT AS saved_tokens, coalesce(ends, sha256('')) AS ends_sha256
FROM above a LEFT JOIN found p ON p.path = a.parent LEFT JOIN children c ON c.path = a.path
    JOIN totals t ON t.path = a.path LEFT JOIN ended e ON e.path = a.path
"""


@query("op13_prefix_trie", ORACLE)
def conversation_trie(spark: SparkSession, folder: str) -> DataFrame:
    """The nodes of all conversations, each with the first turns of its family."""
    return prefix_trie(table(spark, folder, "conversations"))
