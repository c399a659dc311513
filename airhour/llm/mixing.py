"""Mixing sources to target weights: tempered shares, realised as budgeted block permutations.

The weight of a source is its share of all tokens to the power of an exponent between 0 (all
sources alike) and 1 (as they are), normalised. The exponent is bisected, to one part in 2**20: the least one at
which no source repeats more than ``max_repeats`` times, or the largest one at which the
weights' entropy is at least ``target_entropy`` (nats). Without ``budget_tokens`` the budget is the least that takes
every row once.

A source's budget is so many whole epochs and a rest. An epoch is a permutation of the
source's blocks, and of the rows in each; the rest takes rows in that order as long as their tokens
fit. Where the rest ends is one place for each source, so rows need no global order: each compares its own place.

A token is a run of characters other than ASCII white space. Only built-in functions are used.

Defined results: a null text has no tokens, and a null source counts as the empty name. Sources without tokens have
no weight and give every row once. Rows with the same ``doc_id`` in a source share a place and are taken
together. An empty table gives no rows. Extra columns are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from airhour.llm.common import prepare_text
from airhour.session import scratch_path

GRID = 20  # bits of the exponent
STEPS_A_JOB = 4
BLOCK_DIGITS = 3  # hexadecimal: 4096 blocks in a source
MAX_REPEATS = 2.0
# Sources up to which their table, five short values each, is sent to every executor.
BROADCAST_SOURCES = 50_000
SEED = "mix"
TOKEN = r"[^\x20\x09-\x0D]+"


def token_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(TOKEN)), F.lit(0)).cast("long")


def _key(*parts: str | Column) -> Column:
    return F.md5(F.concat_ws("|", *[F.lit(p) if isinstance(p, str) else p for p in parts]).cast("binary"))


def _row_key(seed: str) -> Column:
    return _key(seed, F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))


def _placed(rows: DataFrame, seed: str, epoch: Column) -> DataFrame:
    """Rows with ``block_place`` and ``row_place``: where each stands in an epoch of its source."""
    block = F.substring("row_key", 1, BLOCK_DIGITS)
    return rows.withColumns(
        {
            "block_place": _key(seed, F.col("mix_source"), epoch.cast("string"), block),
            "row_place": _key(seed, epoch.cast("string"), F.col("row_key")),
        }
    )


def _repeats_grow(exponent: float) -> Column:
    """How much more often the most repeated source is read than the least."""
    less = F.pow(F.col("share"), F.lit(exponent - 1.0))
    return F.max(less) / F.min(less)


def _entropy(exponent: float) -> Column:
    power = F.pow(F.col("share"), F.lit(exponent))
    total = F.sum(power)
    return F.log(total) - F.lit(exponent) * F.sum(power * F.log("share")) / total


def exponent_for(shares: DataFrame, max_repeats: float | None, target_entropy: float | None) -> float:
    """Bisects the exponent over the grid; a job gives the figures of all midpoints of the next steps."""
    if (max_repeats is None) == (target_entropy is None):
        raise ValueError("give either max_repeats or target_entropy")
    low, high = 0, 1 << GRID
    while low < high:
        step = max(1, (high - low) >> STEPS_A_JOB)
        points = list(range(low, high, step))
        if target_entropy is None:  # the first grid point at which it holds, low <= point <= high
            figures = shares.agg(*[_repeats_grow(p / (1 << GRID)) for p in points]).first()
            holds = [f is not None and f <= max_repeats for f in figures]
            first = holds.index(True) if True in holds else len(points)
            high = points[first] if first < len(points) else high
            low = high if first == 0 else points[first - 1] + 1
        else:  # the last one
            points = [min(p + step, high) for p in points]
            figures = shares.agg(*[_entropy(p / (1 << GRID)) for p in points]).first()
            holds = [f is not None and f >= target_entropy for f in figures]
            first = holds.index(False) if False in holds else len(points)
            low = points[first - 1] if first else low
            high = low if first == len(points) else points[first] - 1
    return low / (1 << GRID)


def mix(docs: DataFrame, *args, **kwargs) -> DataFrame:
    """Every column of ``docs``, with a row for each time it is read, and ``mix_tokens, mix_epoch, mix_place``.

    ``mix_place`` orders the rows of a source within an epoch. A column of ``docs`` keeps its name; one added here that
    has the same name gets underscores until it has its own. Arguments are those of ``repeated``.
    """
    taken, added = {c.lower() for c in docs.columns}, []
    for name in ("mix_tokens", "mix_epoch", "mix_place"):
        free = name
        while free in taken:
            free += "_"
        added.append(F.col(name).alias(free))
    return repeated(docs, *args, **kwargs).select("doc.*", *added)


def repeated(
    docs: DataFrame,
    max_repeats: float | None = MAX_REPEATS,
    target_entropy: float | None = None,
    budget_tokens: int | None = None,
    seed: str = SEED,
) -> DataFrame:
    """``doc``, a struct of all columns of ``docs``, once for each time it is read, and ``mix_tokens, mix_epoch, mix_place``."""
    spark = prepare_text(docs.sparkSession)
    keyed = {
        "mix_source": F.coalesce(F.col("source").cast("string"), F.lit("")),
        "mix_tokens": token_count("text"),
        "row_key": _row_key(seed),
    }
    # Counting tokens is the costly part; it is done once, and what the plan needs of it is narrow.
    path = scratch_path(spark, "mix")
    counted = docs.select(*[c.alias(n) for n, c in keyed.items()])
    counted.write.parquet(path)
    counted = spark.read.schema(counted.schema).parquet(path)

    blocks = counted.groupBy("mix_source", F.substring("row_key", 1, BLOCK_DIGITS).alias("block")).agg(
        F.sum("mix_tokens").alias("tokens")
    )
    path = scratch_path(spark, "mix-blocks")
    blocks.write.parquet(path)
    blocks = spark.read.schema("mix_source string, block string, tokens long").parquet(path)
    sources = blocks.groupBy("mix_source").agg(F.sum("tokens").alias("tokens"))
    total = sources.agg(F.sum("tokens")).first()[0] or 0
    shares = sources.filter("tokens > 0").withColumn("share", F.col("tokens") / F.lit(float(max(1, total))))
    exponent = exponent_for(shares, max_repeats, target_entropy)

    less = F.pow(F.col("share"), F.lit(exponent - 1.0))
    figures = shares.agg(F.min(less), F.sum(F.pow(F.col("share"), F.lit(exponent)))).first()
    least, normal = figures[0] or 1.0, figures[1] or 1.0
    scale = F.lit(least) if budget_tokens is None else F.lit(normal * total / budget_tokens)
    epochs = shares.withColumn("repeats", F.round(less / scale, 9)).select(
        "mix_source",
        F.floor("repeats").cast("int").alias("whole"),
        F.floor((F.col("repeats") - F.floor("repeats")) * F.col("tokens")).cast("long").alias("rest"),
    )

    # The block in which the rest of a source ends, and the place of the last row that fits.
    key = _key(seed, F.col("mix_source"), F.col("whole").cast("string"), F.col("block"))
    in_order = Window.partitionBy("mix_source").orderBy("block_place")  # a row for each block
    running = blocks.join(epochs, "mix_source").withColumn("block_place", key)
    running = running.withColumn("before", F.sum("tokens").over(in_order) - F.col("tokens"))
    ends = running.filter((F.col("before") <= F.col("rest")) & (F.col("before") + F.col("tokens") > F.col("rest")))
    ends = ends.filter("rest > 0").select(
        "mix_source", "block", "whole", F.col("block_place").alias("end_block"), (F.col("rest") - F.col("before")).alias("room")
    )
    few = sources.count() <= BROADCAST_SOURCES  # else joins that move the rows, whose skew Spark splits
    # Of a source only the rows of that block are met, one in 4096 or so.
    of_block = counted.withColumn("block", F.substring("row_key", 1, BLOCK_DIGITS))
    last = of_block.join(F.broadcast(ends) if few else ends, ["mix_source", "block"])
    last = _placed(last, seed, F.col("whole"))
    by_place = Window.partitionBy("mix_source").orderBy("row_place")  # rows of that block alone
    fits = last.withColumn("running", F.sum("mix_tokens").over(by_place)).filter("running <= room")
    fits = fits.groupBy("mix_source").agg(F.max("row_place").alias("end_row"))
    cuts = (
        epochs.select("mix_source", "whole")
        .join(ends.drop("block", "whole", "room"), "mix_source", "left")
        .join(fits, "mix_source", "left")
    )

    # Names of the columns of docs are out of reach here: each row keeps them in one struct.
    rows = docs.select(F.struct("*").alias("doc"), F.col("doc_id").alias("doc_id"), *[c.alias(n) for n, c in keyed.items()])
    if few:
        cuts = F.broadcast(cuts)
    rows = _placed(rows.join(cuts, "mix_source", "left"), seed, F.col("whole"))
    again = (F.col("block_place") < F.col("end_block")) | (
        (F.col("block_place") == F.col("end_block")) & (F.col("row_place") <= F.col("end_row"))
    )
    times = F.coalesce(F.col("whole"), F.lit(1)) + F.coalesce(again, F.lit(False)).cast("int")
    read = rows.withColumn("times", times).filter("times > 0")
    read = read.withColumn("mix_epoch", F.explode(F.sequence(F.lit(0), F.col("times") - 1)))
    read = _placed(read, seed, F.col("mix_epoch"))
    return read.select("doc", "mix_tokens", "mix_epoch", F.concat("block_place", "row_place").alias("mix_place"))


def op8(documents: DataFrame) -> DataFrame:
    return repeated(documents.select("doc_id", "text", "source")).select(
        "doc.doc_id",
        "doc.source",
        F.col("mix_tokens").alias("n_tokens"),
        F.col("mix_epoch").cast("long").alias("epoch"),
        F.col("mix_place").alias("place"),
    )


OP8_SQL = r"""
WITH RECURSIVE counted AS (
  SELECT doc_id, source, coalesce(source, '') AS mix_source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS n_tokens,
         md5('mix|' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS row_key
  FROM documents
), shares AS (
  SELECT mix_source, sum(n_tokens) AS tokens,
         CAST(sum(n_tokens) AS DOUBLE) / (SELECT CAST(sum(n_tokens) AS DOUBLE) FROM counted) AS share
  FROM counted GROUP BY mix_source HAVING sum(n_tokens) > 0
), ends AS (
  SELECT min(share) AS least, max(share) AS most FROM shares
), bisected(low, high) AS (
  SELECT 0, 1048576
  UNION ALL
  SELECT CASE WHEN ok THEN low ELSE (low + high) // 2 + 1 END, CASE WHEN ok THEN (low + high) // 2 ELSE high END
  FROM (
    SELECT low, high, pow(least, ((low + high) // 2) / 1048576.0::DOUBLE - 1)
                      / pow(most, ((low + high) // 2) / 1048576.0::DOUBLE - 1) <= 2.0 AS ok
    FROM bisected, ends WHERE low < high
  )
), chosen AS (
  SELECT low / 1048576.0::DOUBLE AS exponent FROM bisected WHERE low = high
), epochs AS (
  SELECT mix_source, tokens, CAST(floor(repeats) AS BIGINT) AS whole,
         CAST(floor((repeats - floor(repeats)) * tokens) AS BIGINT) AS rest
  FROM (
    SELECT mix_source, tokens, round(pow(share, exponent - 1) / min(pow(share, exponent - 1)) OVER (), 9) AS repeats
    FROM shares, chosen
  )
), placed AS (
  SELECT c.*, e.whole, e.rest,
         md5('mix|' || c.mix_source || '|' || e.whole || '|' || substr(c.row_key, 1, 3)) AS block_place,
         md5('mix|' || e.whole || '|' || c.row_key) AS row_place
  FROM counted c LEFT JOIN epochs e USING (mix_source)
), running AS (
  SELECT *, sum(n_tokens) OVER (PARTITION BY mix_source ORDER BY block_place, row_place) AS used FROM placed
), read AS (
  SELECT *, coalesce(whole, 1) + CASE WHEN rest > 0 AND used <= rest THEN 1 ELSE 0 END AS times FROM running
)
SELECT doc_id, source, n_tokens, epoch,
       md5('mix|' || mix_source || '|' || epoch || '|' || substr(row_key, 1, 3)) || md5('mix|' || epoch || '|' || row_key) AS place
FROM (SELECT *, unnest(range(times)) AS epoch FROM read)
"""
