"""Document fingerprints by consistent weighted sampling.

A text is its words weighted by how often they occur. For sample ``j`` every
word draws ``r, c ~ Gamma(2, 1)`` and ``b ~ U(0, 1)`` from its hash; with
``t = floor(ln(w) / r + b)`` the word with the least
``ln(c) - r * (t - b) - r`` is sampled together with its ``t``. Two texts agree
in a sample with the probability of their generalised Jaccard similarity. The
least value stands for the sampled pair, as it depends on nothing else.

Only DataFrame functions: words are counted inside their row, exploded in place,
and reduced to minima before anything is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from .shared import stored

SAMPLES = 32
_SPACE = "[\\x20\\x09-\\x0D]+"


def _unit(bits):
    """32 bits to the middle of one of 2**32 cells of (0, 1)."""
    return (bits + F.lit(0.5)) / F.lit(float(1 << 32))


def _draw(term, log_weight, j):
    """The value that sample ``j`` minimises."""
    a, b, c = (F.xxhash64(term, F.lit(3 * j + k)) for k in range(3))
    high = lambda h: _unit(F.shiftrightunsigned(h, 32))
    low = lambda h: _unit(h.bitwiseAND(F.lit(0xFFFFFFFF)))
    r = -F.log(high(a) * low(a))
    log_c = F.log(-F.log(high(b) * low(b)))
    shift = high(c)
    t = F.floor(log_weight / r + shift)
    return log_c - r * (t - shift) - r


def term_counts(text):
    """Array of ``end`` positions of the runs of equal hashes, and the sorted hashes, as a struct."""
    words = F.filter(F.split(text, _SPACE), lambda w: w != "")
    hashes = F.sort_array(F.transform(words, lambda w: F.xxhash64(w)))

    def runs(s):
        n = F.size(s)
        places = F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.expr("cast(array() as array<int>)"))
        return F.struct(s.alias("s"), F.filter(places, lambda i: (i == n) | (F.get(s, i - 1) != F.get(s, i))).alias("ends"))

    return F.get(F.transform(F.array(hashes), runs), F.lit(0))


def signatures(texts, keys, columns, samples=SAMPLES):
    """``keys`` and, for each text column, an array of ``samples`` 32-bit cells under the same name.

    Rows must be told apart by ``keys``; a text without words has the same
    cells as any other such text.
    """
    out = texts.select(*keys, *[term_counts(F.col(c)).alias(c) for c in columns])
    which = F.explode(F.array(*[F.struct(F.lit(i).alias("kind"), F.col(c).alias("of")) for i, c in enumerate(columns)]))
    out = out.select(*keys, which.alias("x")).select(*keys, F.col("x.kind").alias("kind"), F.col("x.of.s").alias("s"), F.col("x.of.ends").alias("ends"))
    out = out.select(*keys, "kind", "s", "ends", F.posexplode_outer("ends").alias("at", "end"))
    term = F.get(F.col("s"), F.col("end") - 1)
    before = F.when(F.col("at") == 0, F.lit(0)).otherwise(F.get(F.col("ends"), F.col("at") - 1))
    out = out.select(*keys, "kind", term.alias("term"), F.log((F.col("end") - before).cast("double")).alias("lw"))
    least = [
        F.min(F.when(F.col("kind") == i, _draw(F.col("term"), F.col("lw"), j))).alias(f"m{i}_{j}")
        for i in range(len(columns))
        for j in range(samples)
    ]
    out = out.groupBy(*keys).agg(*least)
    cell = lambda i, j: F.shiftright(F.xxhash64(f"m{i}_{j}"), 32).cast("int")
    return out.select(*keys, *[F.array(*[cell(i, j) for j in range(samples)]).alias(c) for i, c in enumerate(columns)])


def likeness(a, b):
    """Share of equal cells of two signatures."""
    same = F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda n, x: n + x)
    return same / F.size(a).cast("double")


def printed(cells):
    """A signature as text, eight hexadecimal digits a cell."""
    return F.array_join(F.transform(cells, lambda x: F.lower(F.lpad(F.hex(x.cast("long").bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0"))), "")


def successors(keys, order):
    """Each row of ``keys``, which differ in ``order``, with the next one's ``order`` as the struct ``next``; the last has the first.

    Rows are cut into ranges, which are written once; within a range the next
    row is a window's, across ranges it is the first row of the next range.
    """
    spark = keys.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = [F.asc_nulls_first(c) for c in order]
    ranged = keys.repartitionByRange(parts, *ordered).withColumn("part", F.spark_partition_id())
    ranged = stored(ranged, "successors")
    row = F.struct(*order)
    inside = ranged.withColumn("later", F.lead(row).over(Window.partitionBy("part").orderBy(*ordered)))
    # One row for each range, at most as many as shuffle partitions.
    firsts = ranged.groupBy("part").agg(F.min(row).alias("first"))
    whole = Window.orderBy("part")
    firsts = firsts.select(
        "part", F.coalesce(F.lead("first").over(whole), F.first("first").over(whole.rowsBetween(Window.unboundedPreceding, 0))).alias("follower")
    )
    return inside.join(firsts, "part").select(*keys.columns, F.coalesce("later", "follower").alias("next"))


def edited_pairs(docs, id="doc_id", text="text"):
    """Every row of ``docs`` with its edited text and its next document.

    The edit replaces the last quarter of the code points (rounded down) by as
    many from the start of the next document in ascending id, or by all of it;
    the last document is followed by the first, a single one by itself. A null
    text is empty. A null id comes first; rows with one id follow each other by
    a hash of their text. Rows equal in id and text are one document with so
    many ``copies``; it is returned for each of them.
    """
    base = docs.select(F.col(id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    base = base.withColumn("h", F.xxhash64("text"))
    keys = base.groupBy("doc_id", "h", F.length("text").cast("long").alias("n_chars")).agg(F.count(F.lit(1)).alias("copies"))
    keys = stored(successors(keys, ["doc_id", "h"]), "documents-in-order")
    wanted = keys.select(
        F.col("next.doc_id").alias("next_id"), F.col("next.h").alias("next_h"), F.col("doc_id").alias("of_id"), F.col("h").alias("of_h"),
        "n_chars", "copies", F.floor(F.col("n_chars") / 4).cast("int").alias("quarter"),
    )
    heads = wanted.join(base, F.col("next_id").eqNullSafe(F.col("doc_id")) & (F.col("next_h") == F.col("h")))
    heads = heads.select("of_id", "of_h", "n_chars", "copies", "quarter", "next_id", "next_h", F.left("text", F.col("quarter")).alias("head"))
    heads = heads.dropDuplicates(["of_id", "of_h"])
    pairs = base.join(heads, F.col("doc_id").eqNullSafe(F.col("of_id")) & (F.col("h") == F.col("of_h")))
    edited = F.concat(F.left("text", (F.col("n_chars") - F.col("quarter")).cast("int")), F.col("head"))
    return pairs.select("doc_id", "h", "n_chars", "copies", "next_id", "next_h", "text", edited.alias("edited"))


def compare(docs, id="doc_id", text="text", samples=SAMPLES):
    """Fingerprints of all texts and of their edits, and how near both come to each other and to the next document's.

    See ``edited_pairs`` for nulls, ties and repeated rows. Other columns are not read.
    """
    pairs = edited_pairs(docs, id, text).withColumn("sha", F.unhex(F.sha2("edited", 256)))
    # Copies fall into one group, as minima do not count; they are set out again at the end.
    keys = ["doc_id", "h", "n_chars", "copies", "next_id", "next_h", "sha"]
    prints = stored(signatures(pairs, keys, ["text", "edited"], samples), "fingerprints")
    following = prints.select(F.col("doc_id").alias("n_id"), F.col("h").alias("n_h"), F.col("text").alias("following"))
    out = prints.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    out = out.join(following, F.col("next_id").eqNullSafe(F.col("n_id")) & (F.col("next_h") == F.col("n_h")))
    return out.select(
        "doc_id", "n_chars", F.lower(F.hex("sha")).alias("edited_sha256"), printed(F.col("text")).alias("fingerprint"),
        printed(F.col("edited")).alias("edited_fingerprint"), likeness("text", "edited").alias("near_edited"), likeness("text", "following").alias("near_next"),
    )
