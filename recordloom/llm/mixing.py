"""Mixing sources to target weights, by DataFrame functions only.

Documents are dealt to ``BUCKETS`` fine buckets of their source by a hash of id
and text, and neighbouring buckets make up the source's blocks, all of about the
same number of words. The blocks a source is drawn in are the first ones of a
random permutation, a new one each time the source is repeated, until its target
is met; the last of them is drawn in part, bucket by bucket.

Which shard draws how many blocks of a source is decided by a splitting tree: at
each node a random half of the node's blocks, drawn without replacement, goes
left, so the blocks of each source that go left follow the multivariate
hypergeometric law and every quota is exact. A shard draws its quota of a source
as a run of that source's permuted blocks, disjoint from the runs of all other
shards; inside a block documents are shuffled by a second hash.

All this is decided on sums per bucket, gathered in one scan. Blocks grow to
``BLOCK_WORDS`` words and then become more, so that a block can be shuffled by
one task at any size of the corpus; the blocks' numbers (one row a block and
repeat, about a million for a hundred terabytes) pass through one task at the
root of the tree, the sources' totals through another.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordloom.llm.common import staged

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
MAX_REPEATS = 3
SHARD_LEVELS = 4
# A corpus is cut into so many blocks, or into blocks of so many words if these are smaller.
BLOCKS = 4096
BLOCK_WORDS = 1 << 24
BUCKET_BITS = 20
BUCKETS = 1 << BUCKET_BITS
FRACTION = float(1 << 52)
SEED = 7
MADE = ("size", "source_size", "target", "draws")


def draw(*parts: Column) -> Column:
    """A number in [0, 1) fixed by the parts."""
    hexed = F.substring(F.md5(F.concat_ws("/", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])), 1, 13)
    return F.conv(hexed, 16, 10).cast("long") / F.lit(FRACTION)


def source_targets(sizes: DataFrame, weights=WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """``sid``, ``source``, ``source_size`` and ``target`` words of each source, one row per source.

    Sources take their share of all words by weight; where that exceeds
    ``max_repeats`` times the source, the rest is shared again among the others.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    sources = sizes.groupBy("source").agg(F.sum("words").alias("source_size"))
    place = F.row_number().over(by_name) - 1
    sources = sources.withColumn("sid", place).withColumn(
        "weight", F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("sid") % len(weights) + 1).cast("int"))
    )
    limit = F.col("source_size") * max_repeats
    by_ratio = Window.orderBy(limit / F.col("weight"), "sid")
    everything = Window.partitionBy()
    sources = sources.withColumns({
        "capped": F.coalesce(F.sum(limit).over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        "open": F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing)),
        "words": F.sum("source_size").over(everything),
    }).withColumn("level", (F.col("words") - F.col("capped")) / F.col("open"))
    ratio = limit / F.col("weight")
    first = F.min(F.when(ratio >= F.col("level"), F.struct(ratio.alias("ratio"), "sid", "level"))).over(everything)
    sources = sources.withColumn("level", first["level"])
    target = F.least(limit.cast("double"), F.coalesce(F.col("weight") * F.col("level"), limit.cast("double")))
    return sources.select("sid", "source", "source_size", target.alias("target"))


def block_quotas(units: DataFrame, seed: int, levels: int) -> DataFrame:
    """``sid``, ``shard`` and the run [``first``, ``last``) of the source's permuted blocks the shard draws.

    ``units`` has a row (``sid``, ``rank``) for each block of each source that is drawn.
    """
    nodes = units.select("sid", "rank", F.lit(0).alias("node"))
    for level in range(levels):
        here = Window.partitionBy("node")
        place = F.row_number().over(here.orderBy(draw(F.col("sid"), F.col("rank"), F.lit(level), F.lit(seed)), "sid", "rank"))
        left = F.floor((F.count("*").over(here) + 1) / 2)
        nodes = nodes.withColumn("right", (place > left).cast("int")).select("sid", "rank", (F.col("node") * 2 + F.col("right")).alias("node"))
    quotas = nodes.groupBy("sid", F.col("node").alias("shard")).agg(F.count("*").alias("quota"))
    upto = F.sum("quota").over(Window.partitionBy("sid").orderBy("shard"))
    return quotas.select("sid", "shard", (upto - F.col("quota")).alias("first"), upto.alias("last"))


def drawn_blocks(blocks: DataFrame, seed: int, max_repeats: int, levels: int) -> DataFrame:
    """``sid``, ``block`` and, for each time the block is drawn, ``epoch``, ``rank``, ``shard`` and ``left``, the words
    of the target that are left when its turn comes.

    ``blocks`` has ``sid``, ``block``, its ``words`` and the ``target`` of the source.
    """
    units = blocks.where("words > 0").withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(max_repeats - 1))))
    order = Window.partitionBy("sid").orderBy("epoch", draw(F.col("sid"), F.col("block"), F.col("epoch"), F.lit(seed)), "block")
    before = F.sum("words").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("words")
    units = units.select("sid", "block", "epoch", (F.row_number().over(order) - 1).alias("rank"), (F.col("target") - before).alias("left"))
    units = staged(units.where("left > 0"), "mix-units")
    runs = staged(block_quotas(units, seed, levels), "mix-runs")
    # One run at most holds a rank; a source has no more runs than there are shards.
    held = (units["sid"] == runs["sid"]) & (units["rank"] >= runs["first"]) & (units["rank"] < runs["last"])
    return units.join(runs, held).select(units["sid"], "block", "epoch", "rank", "shard", "left")


def drawn_buckets(sums: DataFrame, targets: DataFrame, seed: int, max_repeats: int, levels: int) -> DataFrame:
    """``source``, ``bucket``, the source's ``source_size`` and ``target``, and ``draws`` of the bucket, epoch by epoch."""
    every = F.sum("source_size").over(Window.partitionBy())
    block_words = F.greatest(F.lit(1), F.least(F.lit(BLOCK_WORDS), F.ceil(every / BLOCKS)))
    sized = staged(targets.withColumn("blocks", F.greatest(F.lit(1), F.least(F.lit(BUCKETS), F.ceil(F.col("source_size") / block_words))).cast("long")), "mix-targets")
    # Stored, so that the join deals out both its sides itself and can split a hot source.
    known = sized.withColumnRenamed("source", "_source")
    buckets = sums.join(known, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    buckets = buckets.withColumn("block", F.shiftright(F.col("bucket") * F.col("blocks"), BUCKET_BITS))
    inside = Window.partitionBy("sid", "block").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    buckets = staged(buckets.withColumn("before", F.sum("words").over(inside) - F.col("words")), "mix-places")
    blocks = buckets.groupBy("sid", "block", "target").agg(F.sum("words").alias("words"))
    units = drawn_blocks(blocks, seed, max_repeats, levels).groupBy("sid", "block").agg(
        F.sort_array(F.collect_list(F.struct("epoch", "shard", F.col("rank").cast("int").alias("rank"), "left"))).alias("units")
    )
    taken = F.filter("units", lambda u: (F.col("before") + F.col("words") / 2 <= u["left"]) & (F.col("words") > 0))
    draws = F.transform(taken, lambda u: F.struct(u["epoch"].alias("epoch"), u["shard"].alias("shard"), u["rank"].alias("block")))
    none = F.filter(F.array(F.struct(F.lit(0).alias("epoch"), F.lit(0).alias("shard"), F.lit(0).alias("block"))), lambda _: F.lit(False))
    return buckets.join(staged(units, "mix-draws"), ["sid", "block"], "left").select(
        "source", "bucket", "source_size", "target", F.coalesce(draws, none).alias("draws")
    )


def mixed_rows(
    docs: DataFrame, seed: int = SEED, weights=WEIGHTS, max_repeats: int = MAX_REPEATS, levels: int = SHARD_LEVELS,
) -> DataFrame:
    """``row``, a struct of all columns of ``docs``, with ``size``, ``source_size``, ``target`` and ``draws``."""
    size = F.coalesce(F.regexp_count(F.col("text"), F.lit(WORD)), F.lit(0)).cast("long")
    bucket = F.floor(draw(F.col("doc_id"), F.lit(seed), F.col("text")) * BUCKETS).cast("long")
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("source").cast("string").alias("source"), size.alias("size"), bucket.alias("bucket"),
        F.xxhash64("doc_id", "text", F.lit(seed)).alias("place"),
    )
    sums = staged(rows.groupBy("source", "bucket").agg(F.sum("size").alias("words")), "mix-buckets")
    buckets = staged(drawn_buckets(sums, source_targets(sums, weights, max_repeats), seed, max_repeats, levels), "mix-buckets")
    found = buckets.toDF("_source", "_bucket", "source_size", "target", "_draws")
    both = rows.join(found, F.col("source").eqNullSafe(F.col("_source")) & (F.col("bucket") == F.col("_bucket")))
    draws = F.transform(
        F.filter("_draws", lambda _: F.col("size") > 0),
        lambda d: F.struct(d["shard"].alias("shard"), d["block"].alias("block"), F.xxhash64(F.col("place"), d["epoch"]).alias("place")),
    )
    return both.select("row", "size", "source_size", "target", draws.alias("draws"))


def mixed(
    docs: DataFrame, seed: int = SEED, weights=WEIGHTS, max_repeats: int = MAX_REPEATS, levels: int = SHARD_LEVELS,
) -> DataFrame:
    """All rows of ``docs`` with ``size``, ``source_size``, ``target`` and ``draws``.

    ``draws`` has a struct (``shard``, ``block``, ``place``) for each time the mix
    takes the row: the shard, the number of the block in its source's permuted
    order, and a number to shuffle the block's rows by. Words are runs of
    anything but ASCII white space. The words taken of a source miss its target
    by half a document, or half a bucket (a millionth of the source) if that is
    more.

    A null source is a source of its own, the last; a null or empty text has no
    words and is never drawn; rows that agree in id and text share a bucket and
    are drawn alike; rows without an id are told apart by their texts; an empty
    table gives an empty result. Columns of ``docs`` called ``size``,
    ``source_size``, ``target`` and ``draws`` are replaced, all others kept.
    """
    rest = [F.col("row").getField(c).alias(c) for c in docs.columns if c not in MADE]
    return mixed_rows(docs, seed, weights, max_repeats, levels).select(*rest, *MADE)


def mixture(docs: DataFrame) -> DataFrame:
    """The rows of the mix, as often as they are drawn, with their own columns, a block after the other in shuffled order."""
    drawn = mixed_rows(docs).select("row", F.explode("draws").alias("draw")).select("row", "draw.*")
    blocks = drawn.repartition("shard", F.col("row.source"), "block").sortWithinPartitions("shard", F.col("row.source"), "block", "place")
    return blocks.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def _level_sql(level: int) -> str:
    return f"""
nodes{level + 1} AS (
  SELECT sid, rank, node * 2 + (place > (n + 1) // 2)::INT AS node FROM (
    SELECT *, count(*) OVER (PARTITION BY node) AS n,
      row_number() OVER (PARTITION BY node ORDER BY {_draw_sql("sid", "rank", str(level), str(SEED))}, sid, rank) AS place
    FROM nodes{level})),"""


def _draw_sql(*parts: str) -> str:
    texts = " || '/' || ".join(f"coalesce(CAST({p} AS VARCHAR), '')" for p in parts)
    return f"CAST(('0x' || substr(md5({texts}), 1, 13)) AS BIGINT) / {int(FRACTION)}.0"


# The same by SQL.
MIX_SQL = rf"""
WITH rows AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
    CAST(floor({_draw_sql("doc_id", str(SEED), "text")} * {BUCKETS}) AS BIGINT) AS bucket
  FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS sid
  FROM rows GROUP BY source),
weighed AS (SELECT *, sid % 3 + 1 AS weight, source_size * 3 AS most, source_size * 3 / (sid % 3 + 1) AS ratio FROM sources),
levels AS (
  SELECT *, (sum(source_size) OVER ()
             - coalesce(sum(most) OVER (ORDER BY ratio, sid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY ratio, sid ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed),
chosen AS (SELECT level FROM levels WHERE ratio >= level ORDER BY ratio, sid LIMIT 1),
targets AS (
  SELECT sid, source, source_size, CAST(least(most, coalesce(weight * (SELECT level FROM chosen), most)) AS DOUBLE) AS target,
    CAST(greatest(1, least({BUCKETS}, ceil(source_size / greatest(1, least({BLOCK_WORDS}, ceil(sum(source_size) OVER () / {BLOCKS})))))) AS BIGINT) AS blocks
  FROM weighed),
buckets AS (
  SELECT sid, target, bucket, (bucket * blocks) >> {BUCKET_BITS} AS block, sum(size) AS words
  FROM rows r JOIN targets t ON r.source IS NOT DISTINCT FROM t.source GROUP BY ALL),
places AS (SELECT *, sum(words) OVER (PARTITION BY sid, block ORDER BY bucket) - words AS before FROM buckets),
blocks AS (SELECT sid, block, target, sum(words) AS words FROM buckets GROUP BY ALL),
permuted AS (
  SELECT *, row_number() OVER w - 1 AS rank, target - (sum(words) OVER w - words) AS "left"
  FROM blocks, (SELECT unnest(range({MAX_REPEATS})) AS epoch) WHERE words > 0
  WINDOW w AS (PARTITION BY sid ORDER BY epoch, {_draw_sql("sid", "block", "epoch", str(SEED))}, block ROWS UNBOUNDED PRECEDING)),
units AS (SELECT * FROM permuted WHERE "left" > 0),
nodes0 AS (SELECT sid, rank, 0 AS node FROM units),
{"".join(_level_sql(level) for level in range(SHARD_LEVELS))}
quotas AS (SELECT sid, node AS shard, count(*) AS quota FROM nodes{SHARD_LEVELS} GROUP BY ALL),
runs AS (SELECT *, sum(quota) OVER (PARTITION BY sid ORDER BY shard) AS "last" FROM quotas),
draws AS (
  SELECT p.sid, p.bucket, u.epoch, r.shard, u.rank
  FROM places p JOIN units u ON u.sid = p.sid AND u.block = p.block AND p.before + p.words / 2 <= u."left" AND p.words > 0
  JOIN runs r ON r.sid = u.sid AND u.rank >= r."last" - r.quota AND u.rank < r."last"),
listed AS (
  SELECT sid, bucket, count(*) AS times, string_agg(shard, ',' ORDER BY epoch) AS shards, string_agg(rank, ',' ORDER BY epoch) AS blocks FROM draws GROUP BY ALL)
SELECT doc_id, size, source_size, target, CAST(CASE WHEN size > 0 THEN size * coalesce(times, 0) ELSE 0 END AS BIGINT) AS taken,
  CASE WHEN size > 0 THEN coalesce(shards, '') ELSE '' END AS shards, CASE WHEN size > 0 THEN coalesce(l.blocks, '') ELSE '' END AS blocks
FROM rows r JOIN targets t ON r.source IS NOT DISTINCT FROM t.source LEFT JOIN listed l ON l.sid = t.sid AND l.bucket = r.bucket
"""
