"""Document fingerprints from closed syncmers over words, in DataFrame functions only.

The letters are words, hashed once. A k-mer of 5 words is chosen if the least of its 2-word substrings lies at one
of its ends, which depends on the k-mer alone: an edit changes only the k-mers it touches, and equal
passages give equal anchors at whatever place. The fingerprint of a document is the 48 least
hashes of its anchors; likeness is the share of common hashes among the 48 least of both.

Cases: a null text is empty; a text under 5 words has one anchor, all of it, and one in which no k-mer is chosen
has its first; equal texts have equal
fingerprints; rows equal in id and text count as one document among neighbours and each get its result; with one
document, it is its own next; null ids come last; an empty table gives no rows; other columns aren't read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rollspan.operators.windows import global_prefix
from rollspan.session import with_scalars

#: Words of a k-mer and of its inner substrings, and hashes kept of a document.
K, S, KEEP = 5, 2, 48


def _anchors(text: str, result: str) -> str:
    """SQL over ``h`` (word hashes), ``g`` (hashes of two words from each place) and ``j`` (anchors)."""
    last = K - S
    least = ", ".join(f"get(g, j + {i})" for i in range(last + 1))
    return f"""
      transform(array(transform(split({text}, '[ \\\\t\\\\n\\\\r\\\\f]+'), w -> xxhash64(w))), h ->
        transform(array(transform(h, (x, i) -> xxhash64(x, get(h, i + 1)))), g ->
          transform(array(if(size(h) < {K}, array(0),
                             filter(sequence(0, greatest(size(h) - {K}, 0)), j -> least({least}) in (get(g, j), get(g, j + {last}))))), found ->
            transform(array(if(size(found) = 0, array(0), found)), js ->
              {result})[0])[0])[0])[0]"""


_HASH = "xxhash64(get(g, j), get(g, j + 2), get(h, j + 4))"


def anchors(text: str) -> Column:
    """array<struct<place, hash>> of a text column, for positional matching."""
    return F.expr(_anchors(text, f"transform(js, j -> named_struct('place', j, 'hash', {_HASH}))"))


def sketch(text: str) -> Column:
    """The least distinct 32-bit anchor hashes of a text column, sorted."""
    return F.expr(f"slice(sort_array(array_distinct({_anchors(text, f'transform(js, j -> cast(({_HASH} & 4294967295L) - 2147483648L as int))')})), 1, {KEEP})")


def digest(hashes: str) -> Column:
    return F.expr(f"array_join(transform({hashes}, x -> lpad(lower(hex(x + 2147483648L)), 8, '0')), '')")


def likeness(a: str, b: str) -> Column:
    return F.expr(f"transform(array(slice(sort_array(array_union({a}, {b})), 1, {KEEP})), "
                  f"u -> size(array_intersect(array_intersect({a}, {b}), u)) / size(u))[0]")


def compare_edits(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of each text, of its edited text, and their likeness.

    The edited text ends in the beginning of the next document by descending id. Neighbours are
    found on ids alone; the texts are shuffled once, and the third that goes to a neighbour once more.
    """
    base = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(text, F.lit("")).alias("text"))
    base = base.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("k"), F.hash("text", "doc_id").alias("c"),
                       F.char_length("text").cast("long").alias("n"), sketch("text").alias("s"))
    ids = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(text, F.lit("")).alias("text"))
    ids = ids.select("doc_id", F.xxhash64("doc_id", "text").alias("k"), F.hash("text", "doc_id").alias("c"), F.char_length("text").alias("n")).distinct()
    ranked = global_prefix(ids, ["doc_id", "k", "c"], rank="rn", ascending=False)
    ranked = with_scalars(ranked, ranked.agg(F.count(F.lit(1)).alias("_total")))
    own = ranked.select(F.col("k").alias("_k"), F.col("c").alias("_c"), F.expr("n div 3").alias("_need"), F.expr("rn % _total + 1").alias("rn"))
    follows = ranked.select("k", "c", "rn").join(own, "rn").select("k", "c", "_k", "_c", "_need")
    # the id and length are used on both sides, so that both read one shuffle of the texts
    parts = base.join(follows, ["k", "c"]).select(
        F.col("_k").alias("k"), F.col("_c").alias("c"), F.col("_need"), F.expr("left(text, cast(least(_need, n) as int))").alias("_part"),
        F.col("s").alias("_s"), F.col("doc_id").alias("next_id")).dropDuplicates(["k", "c"])
    both = base.join(parts, ["k", "c"])
    both = both.withColumn("edited", F.expr("concat(left(text, cast(n - _need as int)), _part)")).withColumn("e", sketch("edited"))
    return both.select("doc_id", F.col("n").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"), digest("s").alias("fingerprint"),
                       digest("e").alias("edited_fingerprint"), likeness("s", "e").alias("near_edited"), likeness("s", "_s").alias("near_next"), "next_id")
