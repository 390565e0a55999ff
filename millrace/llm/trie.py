"""Prefix trie of conversations by ROLLUP over positional turn-id columns.

A turn's id is 128 bits of its place, role and text, with its number of words.
A conversation is cut into blocks of ``WIDTH`` turns, each a row with one column
of turn ids per place, keyed by the node its earlier blocks lead to. ``GROUP BY
block, node, ROLLUP (t1, ..., t8)`` then aggregates the prefixes of all depths
at once, and ``grouping_id`` tells their depth. A node's key is the XOR of the
ids on its path: ids carry their place, so every block knows its key beforehand
and conversations of any length take the same two ROLLUPs, not one per block.

The trie is never walked. A node's sums over its subtree are sums over its
member conversations: a conversation owns the nodes whose smallest member it
is, the lower end of its path, and brings along the words of those nodes and
whether their last one is a leaf. ROLLUP adds these up with map-side combine.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from .heavy import lookup
from .shared import stored

#: Turns in a block.
WIDTH = 8
#: Turn numbers ordered together, blocks summed together, conversation ids joined together.
TURNS, BLOCKS, ENDS = 1024, 1024, 1024
WORDS = r"[^\x20\x09-\x0D]+"
ID = "struct<a:bigint,b:bigint,w:bigint>"


def ordered(turns, conv="conv_id", turn="turn", role="role", text="text"):
    """``conv_id, pos, a, b, w``: turns numbered from 1, with 128 bits of role and text and the number of words.

    Order: turn (null first), then role and text. Null roles and texts are
    empty; rows without a conversation id belong to no conversation; repeated
    rows are turns of their own. Rows are ordered in groups of 1,024 turn
    numbers, which are counted and added up, so that one endless conversation
    is not sorted in one task.
    """
    t = turns.filter(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv_id"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    t = t.withColumn("part", F.coalesce(F.floor(F.col("turn") / TURNS), F.lit(-(1 << 62))))
    inside = Window.partitionBy("conv_id", "part").orderBy(F.asc_nulls_first("turn"), "role", "text")
    t = t.select(
        "conv_id",
        "part",
        F.row_number().over(inside).cast("long").alias("nth"),
        F.xxhash64("role", "text").alias("a"),
        F.xxhash64("text", "role", F.lit(1)).alias("b"),
        F.regexp_count("text", F.lit(WORDS)).cast("long").alias("w"),
    )
    t = stored(t, "turns")
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = t.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("n"))
    later = counts.withColumn("skip", F.sum("n").over(before)).filter("skip > 0").drop("n")
    t = t.join(later, ["conv_id", "part"], "left")
    return t.select("conv_id", (F.col("nth") + F.coalesce("skip", F.lit(0))).alias("pos"), "a", "b", "w")


def rebuilt(own, every=20, kinds=4):
    """Conversations that begin like another one, from the turns of ``ordered`` (stored): ``(conversations, turns)``.

    Conversation ``c`` takes the first ``h`` turns of ``c - c % every`` (all if
    there are fewer, none if it is absent), then its own after the first ``h``;
    ``h`` is the CRC-32 of the decimal ``c``, modulo ``kinds``. ``c % every``
    has the sign of ``c``. A conversation may be left without turns.
    """
    base = F.col("conv_id") - F.col("conv_id") % every
    wanted = F.crc32(F.col("conv_id").cast("string")) % kinds
    convs = own.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).select("conv_id", base.alias("base"), wanted.alias("h"))
    heads = own.filter((F.col("conv_id") % every == 0) & (F.col("pos") < kinds)).groupBy(F.col("conv_id").alias("base"))
    heads = heads.agg(F.array_sort(F.collect_list(F.struct("pos", "a", "b", "w"))).alias("heads"))
    taken = F.slice("heads", F.lit(1), F.col("h").cast("int"))
    convs = convs.join(heads, "base", "left").select("conv_id", "h", F.coalesce(taken, F.expr("slice(array(), 1, 0)").cast("array<struct<pos:bigint,a:bigint,b:bigint,w:bigint>>")).alias("heads"))
    convs = stored(convs, "conversations")
    front = convs.select("conv_id", F.explode("heads").alias("t")).select("conv_id", "t.*")
    short = convs.select("conv_id", (F.col("h") - F.size("heads")).alias("gap")).filter("gap > 0")
    rest = lookup(own.filter(F.col("pos") > wanted), short, "conv_id")
    rest = rest.select("conv_id", (F.col("pos") - F.coalesce("gap", F.lit(0))).alias("pos"), "a", "b", "w")
    return convs.select("conv_id"), front.unionByName(rest)


def _xor(ids, field):
    return F.aggregate(ids, F.lit(0).cast("long"), lambda x, t: x.bitwiseXOR(t[field]))


def _words(ids):
    return F.aggregate(ids, F.lit(0).cast("long"), lambda n, t: n + t["w"])


def blocks(convs, turns, width=WIDTH):
    """One row per conversation and block: ``conv_id, block, node, t1, ..., ended``.

    ``node`` is the key of the turns before the block with their words; a
    conversation without turns has one empty block. ``ended`` marks a
    conversation's last block. Blocks are summed in runs of 1,024, so that no
    conversation's blocks meet in one task.
    """
    place = (F.col("pos") - 1) % width
    id = F.struct(F.xxhash64("pos", "a", "b").alias("a"), F.xxhash64("b", "a", "pos").alias("b"), "w")
    columns = [F.max(F.when(place == k, id)).alias(f"t{k + 1}") for k in range(width)]
    t = turns.groupBy("conv_id", F.floor((F.col("pos") - 1) / width).alias("block")).agg(*columns)
    names = [c for c in t.columns if c.startswith("t")]
    sums = F.filter(F.array(*names), lambda x: x.isNotNull())
    t = t.withColumns({"x": _xor(sums, "a"), "y": _xor(sums, "b"), "n": _words(sums), "run": F.floor(F.col("block") / BLOCKS)})
    t = stored(t, "blocks")
    key = ["x", "y", "n"]
    over = [F.bit_xor, F.bit_xor, F.sum]
    inside = Window.partitionBy("conv_id", "run").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    t2 = t.withColumns({f"{c}0": F.coalesce(f(c).over(inside), F.lit(0)) for c, f in zip(key, over)})
    earlier = Window.partitionBy("conv_id").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = t.groupBy("conv_id", "run").agg(*(f(c).alias(c) for c, f in zip(key, over)))
    runs = runs.select("conv_id", "run", *(F.coalesce(f(c).over(earlier), F.lit(0)).alias(f"{c}1") for c, f in zip(key, over)))
    t2 = t2.join(runs.filter("run > 0"), ["conv_id", "run"], "left")
    node = F.struct(
        *(F.col(f"{c}0").bitwiseXOR(F.coalesce(f"{c}1", F.lit(0))).alias(a) for c, a in (("x", "a"), ("y", "b"))),
        (F.col("n0") + F.coalesce("n1", F.lit(0))).alias("w"),
    )
    last = t.groupBy("conv_id").agg(F.max("block").alias("last"))
    empty = convs.join(last, "conv_id", "left_anti").select(
        "conv_id", F.lit(0).cast("long").alias("block"), F.expr(f"cast(struct(0, 0, 0) as {ID})").alias("node"), *(F.lit(None).cast(ID).alias(c) for c in names)
    )
    return t2.select("conv_id", "block", node.alias("node"), *names).unionByName(empty)


def _rolled(rows, values, width=WIDTH):
    """All nodes with ``values`` (SQL over ``rows``): ``depth, a, b, up_a, up_b, before, w`` and the values."""
    names = [f"t{k + 1}" for k in range(width)]
    listed = ", ".join(names)
    found = rows.sparkSession.sql(
        f"SELECT block, node, {listed}, grouping_id() AS gid, {values} FROM {{rows}} GROUP BY block, node, ROLLUP ({listed})", rows=rows
    )
    # grouping_id is 2**k - 1 where the last k columns are rolled up.
    level = (F.lit(width) - F.length(F.regexp_replace(F.bin("gid"), "0", ""))).cast("int")
    found = found.withColumn("level", level).withColumn("last", F.get(F.array(*names), F.col("level") - 1))
    # A rolled-up block is the node that the block before ends with; a missing last turn is a conversation's end.
    found = found.filter(((F.col("level") == 0) & (F.col("block") == 0)) | ((F.col("level") > 0) & F.col("last").isNotNull()))
    above = F.concat(F.array("node"), F.slice(F.array(*names), F.lit(1), F.greatest(F.col("level") - 1, F.lit(0))))
    own = lambda c: F.coalesce(F.col(f"last.{c}"), F.lit(0))
    kept = [c for c in found.columns if c not in ("block", "node", "gid", "level", "last", *names)]
    found = found.select((F.col("block") * width + F.col("level")).alias("depth"), above.alias("above"), "last", *kept)
    found = found.withColumns({"up_a": _xor("above", "a"), "up_b": _xor("above", "b"), "before": _words("above"), "w": own("w")})
    found = found.withColumns({"a": F.col("up_a").bitwiseXOR(own("a")), "b": F.col("up_b").bitwiseXOR(own("b"))})
    root = F.col("depth") == 0
    return found.withColumns({c: F.when(~root, F.col(c)) for c in ("up_a", "up_b")}).drop("above", "last")


def _digests(ends):
    """``a, b, ends_sha256`` of the conversation ids that end at each node, ascending, comma-joined.

    Ids are joined in chunks of 1,024 neighbours; the chunks of a node run
    through one digest in order, so no list of ids is ever whole anywhere.
    """
    chunk = F.shiftright("conv_id", ENDS.bit_length() - 1)
    ids = F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",")
    chunks = ends.groupBy("a", "b", chunk.alias("chunk")).agg(ids.alias("ids"))

    def run(batches):
        now, digest = None, None
        for batch in batches:
            done = []
            for a, b, ids in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "ids"))):
                if (a, b) == now:
                    digest.update(b"," + ids.encode())
                    continue
                if now is not None:
                    done.append((*now, digest.hexdigest()))
                now, digest = (a, b), hashlib.sha256(ids.encode())
            if done:
                yield _table(done)
        if now is not None:
            yield _table([(*now, digest.hexdigest())])

    return chunks.repartition("a", "b").sortWithinPartitions("a", "b", "chunk").mapInArrow(run, "a long, b long, ends_sha256 string")


def _table(rows):
    a, b, digest = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(digest)], names=["a", "b", "ends_sha256"])


def nodes(convs, turns, width=WIDTH):
    """One row per node of the trie of ``turns`` (``conv_id, pos, a, b, w``) over the conversations ``convs``.

    Returns ``conv_id`` (the smallest member), ``depth``, ``parent_conv_id``,
    ``n_convs``, ``n_children``, ``n_leaves`` and ``saved_tokens`` (over the
    subtree: a node's words once for every member but one), ``ends_sha256``,
    ``n_words`` (of the node's last turn) and ``prefix_words`` (of the path up
    to and with it). The root has depth 0 and all conversations as members; no
    conversations make no trie. A node is known by ``(conv_id, depth)``.
    """
    rows = stored(blocks(convs, turns, width), "rows")
    first = stored(_rolled(rows, "count(*) AS n_convs, min(conv_id) AS conv_id", width), "nodes")
    kids = first.filter("depth > 0").groupBy(F.col("up_a").alias("a"), F.col("up_b").alias("b")).agg(F.count(F.lit(1)).alias("n_children"))
    kids = stored(kids, "children")
    first = first.join(kids, ["a", "b"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    owned = first.groupBy("conv_id").agg(F.sum("w").alias("owned"), F.max((F.col("n_children") == 0).cast("long")).alias("leaf"))
    names = [f"t{k + 1}" for k in range(width)]
    ids = F.filter(F.array(*names), lambda x: x.isNotNull())
    words = rows.groupBy("conv_id").agg(F.sum(_words(ids)).alias("words"))
    zero = F.lit(0).cast("long")
    values = words.join(owned, "conv_id", "left").select("conv_id", "words", F.coalesce("owned", zero).alias("owned"), F.coalesce("leaf", zero).alias("leaf"))
    found = _rolled(
        lookup(rows, values, "conv_id"),
        "count(*) AS n_convs, sum(words) AS words, sum(owned) AS owned, sum(leaf) AS n_leaves, min(struct(conv_id, words, owned)) AS top",
        width,
    )
    # All members' words from here on, less those of the subtree's nodes: the smallest member owns its path from
    # here on, every other member what it owns at all.
    spoken = F.col("words") - F.col("n_convs") * F.col("before")
    once = F.col("top.words") - F.col("before") + F.col("owned") - F.col("top.owned")
    found = found.withColumns({"conv_id": F.col("top.conv_id"), "saved_tokens": spoken - once}).drop("words", "owned", "top")
    found = stored(found, "subtrees")
    parents = found.select(F.col("a").alias("up_a"), F.col("b").alias("up_b"), F.col("conv_id").alias("parent_conv_id"))
    out = lookup(found, parents, ["up_a", "up_b"])
    end = F.concat(F.array("node"), ids)
    last = rows.groupBy("conv_id").agg(F.max(F.struct("block", _xor(end, "a").alias("a"), _xor(end, "b").alias("b"))).alias("end"))
    ends = _digests(last.select("conv_id", "end.a", "end.b"))
    out = out.join(kids, ["a", "b"], "left").join(ends, ["a", "b"], "left")
    return out.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", zero).alias("n_children"), "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"), F.col("w").alias("n_words"),
        (F.col("before") + F.col("w")).alias("prefix_words"),
    )


def prefixes(turns, conv="conv_id", turn="turn", role="role", text="text", width=WIDTH):
    """The trie of the conversations as they are; see ``ordered`` for the handling of rows and ``nodes`` for the result."""
    own = stored(ordered(turns, conv, turn, role, text), "ordered")
    return nodes(own.select("conv_id").distinct(), own, width)


def rebuilt_prefixes(turns, width=WIDTH):
    """The trie of the conversations of ``rebuilt``."""
    convs, own = rebuilt(stored(ordered(turns), "ordered"))
    return nodes(convs, own, width)
