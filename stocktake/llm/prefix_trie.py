"""The tree of all beginnings of a conversation table, found on the distinct whole conversations.

Identical conversations collapse into one weighted sequence; a sequence that is
a proper beginning of another is found by an anti join, the others are the
leaves; nodes are aggregates over the beginnings of the weighted sequences.
Texts stay where they are read: a turn travels as 120 bits of the SHA-256 of
its role and text, its beginning as a sum of 128 bits over position and turn.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stocktake.session import new_work_path

NODE = ["depth", "ka", "kb"]
#: Ids of one node that travel in one row differ in the low bits only, so a row has 2 ** ID_BITS of them at most.
ID_BITS = 12
#: A node's rows meet their totals in this many parts, so no task gets all rows of a common beginning.
PARTS = 64
_LOW = 0xFFFFFFFF


def turns(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conv, place, a, b, chars``: numbered turns of each conversation, their content as a digest.

    Turns go by ``turn``, null first; equal ones by the SHA-256 of role and
    text, so that repeated rows have a defined order. A null role or text is
    empty, rows without a conversation's id belong to none and are left out,
    other columns are not read. Texts of any length are hashed whole.
    """
    role, text = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role_col, text_col))
    # The role's length first, so that role and text cannot be divided in two ways.
    content = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    hashed = conversations.where(F.col(f"`{id_col}`").isNotNull()).select(
        F.col(f"`{id_col}`").cast("long").alias("conv"), F.col(f"`{turn_col}`").alias("turn"), content.alias("h"), F.char_length(text).cast("long").alias("chars")
    )
    lanes = [F.conv(F.substring("h", begin, 15), 16, 10).cast("long").alias(name) for begin, name in ((1, "a"), (16, "b"))]
    order = Window.partitionBy("conv").orderBy(F.col("turn").asc_nulls_first(), "a", "b")
    return hashed.select("conv", "turn", *lanes, "chars").select("conv", F.row_number().over(order).cast("long").alias("place"), "a", "b", "chars")


def rebuilt(numbered: DataFrame, block: int, borrowed: Column, most: int) -> DataFrame:
    """Conversations that begin with turns of another one: ``conv, part, place, a, b, chars``.

    Of conversation c the first ``borrowed`` turns (a column of ``conv``, at most
    ``most``) are those of c - c % ``block`` as received, all if it has fewer,
    none if it is absent; its own turns after as many of its own follow. Every
    conversation also has a row of part -1, so one without turns stays known.
    """
    conv, place = F.col("conv"), F.col("place")
    heads = numbered.where((conv % block == 0) & (place <= most)).withColumnRenamed("conv", "head")
    known = numbered.where(place == 1).select("conv", (conv - conv % block).alias("head"), borrowed.alias("h"))
    taken = known.join(heads, (known["head"] == heads["head"]) & (place <= F.col("h"))).select("conv", F.lit(0).alias("part"), "place", "a", "b", "chars")
    own = numbered.where(place > borrowed).select("conv", F.lit(1).alias("part"), "place", "a", "b", "chars")
    zero = F.lit(0).cast("long")
    tops = known.select("conv", F.lit(-1).alias("part"), *(zero.alias(c) for c in ("place", "a", "b", "chars")))
    return tops.unionByName(taken).unionByName(own)


def paths(sequences: DataFrame) -> DataFrame:
    """Every beginning of every sequence: ``conv, depth, ka, kb, chars, last``.

    ``ka, kb`` name the beginning: the sums of 32-bit pieces of hashes of
    position and turn, so that they can be summed along a spilling window.
    """
    along = Window.partitionBy("conv").orderBy("part", "place")
    placed = sequences.select("conv", "part", "place", (F.row_number().over(along) - 1).cast("long").alias("depth"), "a", "b", "chars")
    x, y = F.xxhash64("depth", "a", "b"), F.xxhash64("b", "depth", "a")
    top = F.col("depth") == 0
    pieces = [F.when(top, 0).otherwise(piece) for value in (x, y) for piece in (F.shiftrightunsigned(value, 32), value.bitwiseAND(_LOW))]
    sums = [F.sum(piece).over(along).bitwiseAND(_LOW) for piece in pieces]
    ka, kb = (F.shiftleft(high, 32).bitwiseOR(low) for high, low in (sums[:2], sums[2:]))
    return placed.select("conv", "depth", ka.alias("ka"), kb.alias("kb"), "chars", F.lead("depth").over(along).isNull().alias("last"))


def _stream_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's ids, whose pieces come one after the other."""
    node, digest = None, None
    for batch in batches:
        done = []
        for *key, ids in zip(*(batch[c].to_pylist() for c in [*NODE, "ids"])):
            if key != node:
                if node is not None:
                    done.append((*node, digest.hexdigest()))
                node, digest = key, hashlib.sha256(ids.encode())
            else:
                digest.update(b"," + ids.encode())
        yield _node_digests(done)
    if node is not None:
        yield _node_digests([(*node, digest.hexdigest())])


def _node_digests(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * 4
    types = [pa.int64()] * 3 + [pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=[*NODE, "ends_sha256"])


def end_digests(ends: DataFrame) -> DataFrame:
    """SHA-256 of the comma-joined ids that end in each node, in numerical order.

    Ids of a range meet first; the ranges of a node are hashed one after the
    other as they stream by, so no list of a large group is held anywhere.
    """
    ids = F.concat_ws(",", F.transform(F.sort_array(F.collect_list("conv")), lambda c: c.cast("string")))
    ranges = ends.groupBy(*NODE, F.shiftright("conv", ID_BITS).alias("range")).agg(ids.alias("ids"))
    ordered = ranges.repartition(*NODE).sortWithinPartitions(*NODE, "range")
    return ordered.select(*NODE, "ids").mapInArrow(_stream_digests, "depth long, ka long, kb long, ends_sha256 string")


def prefix_trie(sequences: DataFrame) -> DataFrame:
    """One row per distinct beginning of ``sequences`` (as ``rebuilt`` or ``whole`` give them).

    ``conv_id`` is the smallest conversation that starts with it, ``depth`` its
    turns, ``parent_conv_id`` that of the beginning one turn shorter (null at the
    top), ``n_convs`` the conversations that start with it, ``n_children`` the
    beginnings one turn longer, ``n_leaves`` those below (itself included) that
    none continues, ``saved_tokens`` the code points that storing each beginning
    once saves below it, ``ends_sha256`` the digest of the ids that end here.
    No conversation: no row. Equal conversations, however many, are one weighted
    sequence after the first aggregate. Turns of one conversation are put in
    order by a spilling sort in one task, without their texts.
    """
    spark = sequences.sparkSession

    def stored(df: DataFrame, label: str) -> DataFrame:
        path = new_work_path(spark, label)
        df.write.parquet(path)
        return spark.read.parquet(path)

    every = stored(paths(sequences), "beginnings")
    ends = every.where("last").select("conv", *NODE)
    weighted = ends.groupBy(*NODE).agg(F.min("conv").alias("conv"), F.count(F.lit(1)).alias("weight"))
    kept = stored(every.join(weighted.select("conv", "weight"), "conv"), "sequences")

    inner = kept.where(~F.col("last")).select(*NODE).distinct()
    leaves = kept.where("last").select("conv", *NODE).join(inner, NODE, "left_anti").select("conv", F.lit(1).cast("long").alias("leaf"))
    marked = kept.join(leaves, "conv", "left").select("conv", "weight", *NODE, "chars", F.coalesce("leaf", F.lit(0)).alias("leaf"), F.pmod(F.xxhash64("conv"), F.lit(PARTS)).alias("part"))

    parts = marked.groupBy(*NODE, "part").agg(F.min("conv").alias("conv_id"), F.sum("weight").alias("n_convs"))
    totals = parts.groupBy(*NODE).agg(F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"))
    placed = marked.join(parts.select(*NODE, "part").join(totals, NODE), [*NODE, "part"])

    # Each node is counted on the one sequence that holds its smallest conversation.
    down = Window.partitionBy("conv").orderBy("depth")
    up = Window.partitionBy("conv").orderBy(F.desc("depth"))
    owned = (F.col("conv") == F.col("conv_id")).cast("long")
    below = F.sum(F.col("chars") * (F.col("weight") - owned)).over(up)
    child = F.coalesce(F.lag(owned).over(up), F.lit(0))
    parent = F.when(owned == 1, F.lag("conv_id").over(down))
    rows = placed.select(*NODE, "conv_id", "n_convs", "leaf", below.alias("below"), child.alias("child"), parent.alias("parent"))
    nodes = rows.groupBy(*NODE).agg(
        F.min("conv_id").alias("conv_id"), F.max("parent").alias("parent_conv_id"), F.max("n_convs").alias("n_convs"),
        F.sum("child").alias("n_children"), F.sum("leaf").alias("n_leaves"), F.sum("below").alias("saved_tokens"),
    )
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    return nodes.join(end_digests(ends), NODE, "left").select(*columns, F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))


def whole(numbered: DataFrame) -> DataFrame:
    """Conversations as received, in the form ``prefix_trie`` takes."""
    zero = F.lit(0).cast("long")
    tops = numbered.where("place = 1").select("conv", F.lit(-1).alias("part"), *(zero.alias(c) for c in ("place", "a", "b", "chars")))
    return tops.unionByName(numbered.select("conv", F.lit(0).alias("part"), "place", "a", "b", "chars"))
