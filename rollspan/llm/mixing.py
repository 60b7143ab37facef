"""Mixing sources to target weights by Pfair scheduling, in DataFrame functions only.

Documents of a source form blocks of ``block`` rows. Target weights are whole units that add up to ``units``
or so; a round gives each source as many blocks as it has units. Within a round of L slots the j-th block of a source with n
blocks is released at slot floor((j - 1) L / n) and due at slot ceil(j L / n); of the released blocks
the one due first goes next. On one line of slots that rule meets all due times, so in every prefix a
source is less than one block away from its share. A source with fewer blocks than units in its last
round has what is left in that round, and none afterwards; the others go on with their units. Rounds that
hold the same numbers of blocks have the same order, so one order is computed for each kind of round: at
most two kinds for each source that ends, and at most ``units`` slots each, whatever the corpus.

Rows are numbered within a source without a window over the source: they are dealt to buckets by hash,
buckets are counted, and a row's number is its place in its bucket plus the rows of the buckets before it. All
rows are kept, each once.

Cases: a null source is a source of its own; a source without target takes one unit; a target without
rows is ignored; repeated rows and null ids are rows like any other; an empty table gives no rows; texts aren't
read by :func:`schedule`; other columns are kept by :func:`mixed` whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from rollspan.session import cut_lineage, with_scalars

#: Name under which a null source is counted.
NO_SOURCE = "\0none"


def tempered_units(counts: DataFrame, units: int, alpha: float) -> DataFrame:
    """``source``, ``units`` in proportion to rows ** alpha; at least one each."""
    total = counts.agg(F.sum(F.pow("rows", F.lit(alpha))).alias("_sum"))
    return with_scalars(counts, total).select("source", F.greatest(F.lit(1), F.round(F.pow("rows", F.lit(alpha)) / F.col("_sum") * units)).cast("long").alias("units"))


def target_units(counts: DataFrame, weights: dict[str, float], units: int) -> DataFrame:
    """``source``, ``units`` of given weights; a source without one takes one unit."""
    total = sum(weights.values())
    share = F.create_map(*[F.lit(x) for k, w in weights.items() for x in (k, max(1, round(w / total * units)))])
    return counts.select("source", F.coalesce(F.element_at(share, F.col("source")), F.lit(1)).cast("long").alias("units"))


def _round_order() -> Column:
    """Earliest due time first over the slots of one round: array of source places, slot by slot.

    ``_n`` holds the number of blocks by source place, ``_slots`` their sum.
    """
    return F.expr("""
        aggregate(sequence(0L, _slots - 1),
          named_struct('done', transform(_n, n -> 0L), 'order', cast(array() as array<int>)),
          (s, t) -> transform(array(array_min(transform(_n, (n, k) ->
              if(s.done[k] < n and (s.done[k] * _slots) div n <= t,
                 named_struct('due', ((s.done[k] + 1) * _slots + n - 1) div n, 'k', k), null))).k),
            pick -> named_struct('done', transform(s.done, (d, k) -> d + if(k = pick, 1L, 0L)), 'order', s.order || array(pick)))[0],
          s -> s.order)""")


def schedule(rows: DataFrame, columns: list[str], key: Column, source: Column, weights: dict[str, float] | None = None,
             units: int = 256, alpha: float = 0.5, block: int = 16, bucket_rows: int = 4096, tie: Column | None = None) -> DataFrame:
    """``columns`` of every row with its place in the mixture.

    Adds ``source``, ``block`` (from 0, within the source), ``place`` (in the block), ``slot`` (one block each),
    and the block's ``release`` and ``due`` slots. ``key`` spreads rows over buckets and orders them there, ``tie`` those
    of one key. Without
    ``weights``, targets are row counts to the power ``alpha``.
    """
    size = rows.agg(F.greatest(F.lit(1), F.expr(f"count(1) div {bucket_rows}")).alias("_buckets"))
    dealt = with_scalars(rows.select(*columns, F.coalesce(source.cast("string"), F.lit(NO_SOURCE)).alias("_source"), key.alias("_key"),
                                     (F.lit(0) if tie is None else tie).alias("_tie")), size)
    dealt = dealt.withColumn("_bucket", F.expr("pmod(_key, _buckets)"))
    buckets = cut_lineage(dealt.groupBy("_source", "_bucket").agg(F.count(F.lit(1)).alias("_rows")))
    before = Window.partitionBy("_source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = buckets.select("_source", "_bucket", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    counts = buckets.groupBy(F.col("_source").alias("source")).agg(F.sum("_rows").alias("rows"))
    given = target_units(counts, weights, units) if weights else tempered_units(counts, units, alpha)
    # one row: sources in a fixed order, with blocks and units
    sources = (counts.join(given, "source").select(F.struct("source", "units", F.expr(f"(rows + {block - 1}) div {block}").alias("blocks")).alias("s"))
                     .agg(F.array_sort(F.collect_list("s")).alias("_s")))
    # a round changes where a source enters its last, partial round, and after it
    kinds = sources.select("_s", F.explode(F.expr(
        "array_sort(array_distinct(flatten(transform(_s, x -> array(0L, x.blocks div x.units, (x.blocks + x.units - 1) div x.units)))))")).alias("_from"))
    kinds = kinds.withColumn("_n", F.expr("transform(_s, x -> greatest(0L, least(x.units, x.blocks - _from * x.units)))"))
    kinds = kinds.withColumn("_slots", F.expr("aggregate(_n, 0L, (a, b) -> a + b)")).where("_slots > 0")
    ahead = Window.orderBy("_from")  # one row per kind of round
    kinds = kinds.withColumn("_until", F.lead("_from").over(ahead))
    kinds = kinds.withColumn("_start", F.coalesce(F.sum(F.expr("(_until - _from) * _slots")).over(ahead.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    kinds = cut_lineage(kinds.withColumn("_order", _round_order()))
    slots = kinds.select("_from", "_until", "_start", "_slots", "_n", "_s", F.posexplode("_order").alias("_slot", "_k"))
    by_source = Window.partitionBy("_from", "_k").orderBy("_slot")
    pattern = cut_lineage(slots.select(
        F.expr("_s[_k].source").alias("_source"), F.expr("_s[_k].units").alias("_units"), "_from", "_until", "_start", "_slots", "_slot",
        (F.row_number().over(by_source) - 1).cast("long").alias("_j"), F.expr("_n[_k]").alias("_of")))
    rounds = pattern.select("_source", "_units", "_from", "_until").distinct().groupBy("_source", "_units").agg(
        F.array_sort(F.collect_set("_from")).alias("_froms"))
    place = Window.partitionBy("_source", "_bucket").orderBy("_key", "_tie")
    numbered = (dealt.withColumn("_i", F.row_number().over(place) - 1).join(offsets, ["_source", "_bucket"])
                     .withColumn("_nth", F.col("_before") + F.col("_i")).drop("_i", "_before", "_buckets", "_bucket", "_key", "_tie"))
    numbered = numbered.withColumns({"_block": F.expr(f"_nth div {block}"), "_place": (F.col("_nth") % block).cast("int")})
    # at most units x kinds rows, whatever the corpus
    numbered = numbered.join(F.broadcast(rounds), "_source").withColumn("_round", F.expr("_block div _units"))
    numbered = numbered.withColumn("_from", F.expr("array_max(filter(_froms, x -> x <= _round))")).withColumn("_j", F.expr("_block % _units"))
    found = numbered.join(F.broadcast(pattern.drop("_units", "_until")), ["_source", "_from", "_j"])
    base = F.expr("_start + (_round - _from) * _slots")
    return found.select(*columns, F.when(F.col("_source") != NO_SOURCE, F.col("_source")).alias("source"), F.col("_block").alias("block"),
                        F.col("_place").alias("place"), (base + F.col("_slot")).alias("slot"),
                        (base + F.expr("(_j * _slots) div _of")).alias("release"),
                        (base + F.expr("((_j + 1) * _slots + _of - 1) div _of")).alias("due"))


def mixed(docs: DataFrame, weights: dict[str, float] | None = None, doc_id: str = "doc_id", source: str = "source", text: str = "text",
          **options) -> DataFrame:
    """All rows of ``docs`` in the order of the mixture: ranges of slots, sorted within."""
    rows = docs.select(F.struct(*docs.columns).alias("_whole"), F.xxhash64(doc_id).alias("_hash"), F.col(source).alias("_from_source"),
                       F.xxhash64(text).alias("_text_hash"))
    placed = schedule(rows, ["_whole"], F.col("_hash"), F.col("_from_source"), weights, tie=F.col("_text_hash"), **options)
    return placed.orderBy("slot", "place").select(*[F.col("_whole").getField(c).alias(c) for c in docs.columns])
