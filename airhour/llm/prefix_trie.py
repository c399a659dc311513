"""Conversations as a prefix trie, by bursting containers.

A conversation is its path: a record of fixed width for each turn, the digest of role and text and the
number of words. Equal paths are one, with the number of conversations and the least of their ids. The
path is a suffix held in a container under a trie head, at first under the root:

1. A container is what starts with one turn after its head. One that holds more than a fair share of
   the paths bursts: the longest part that all its paths share becomes a head below the head, and its paths go to
   the containers of the next turn. That repeats until no container is oversized. At most ``4 *
   partitions`` containers can be at a time, so the heads are few; they alone reach the driver.
2. The remaining containers are dealt to tasks, sorted, and swept: a path is compared with the one before it,
   the nodes that it leaves are complete and go out. A sweep holds the nodes of one path. A second one in
   the opposite order gives each node its parent.
3. Heads add up what their containers and the heads below give.

The list of a node's conversations is hashed as it streams by: ids are sorted and joined in pieces over
ranges, in which a large group of copies is many tasks' work, and the pieces of a group follow each other.

A conversation's records (20 bytes a turn, never its texts) are one row, so they have to fit in a worker.

Defined results: rows with a null ``conv_id`` take no part. A null role or text is empty. Turns with the
same number, or none, follow each other by the digest of role and text; repeated rows are turns of their own. Ids
are dealt to bases by the remainder that truncates. An empty table gives no nodes, not even the root. Extra
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airhour.llm.common import prepare_text
from airhour.llm.mixing import token_count
from airhour.session import scratch_path

RECORD = 20  # bytes of a turn: 16 of its digest, 4 for its words
SHARED_TURNS = 3  # at most so many turns come from the base conversation
BASE = 20
FLOOR_BYTES = 64 << 10  # containers up to this size never burst
FEW = 16  # nor do containers of so few paths
CHAIN = 256  # turns that a container's paths are found to share at a time
PIECE_BYTES = 64 << 10
ROWS = 4096
NO_ENDS = hashlib.sha256(b"").hexdigest()


def _record() -> Column:
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    return F.concat(digest, F.lower(F.lpad(F.hex(token_count("text")), 2 * (RECORD - 16), "0")))


def rebuilt(conversations: DataFrame, base: int = BASE, shared: int = SHARED_TURNS) -> DataFrame:
    """``conv_id, path`` of every conversation, its first turns taken from its base.

    The first ``crc32(conv_id) % (shared + 1)`` turns are those of the conversation whose id is the next multiple of
    ``base`` below. Conversations of one base are dealt to one task, so turns move once.
    """
    own = F.col("conv_id").cast("long")
    rows = conversations.filter("conv_id is not null").select(
        own.alias("conv_id"), (own - own % base).alias("base"), F.col("turn").cast("long").alias("turn"), _record().alias("record")
    )
    turns = F.transform(F.sort_array(F.collect_list(F.struct("turn", "record"))), lambda t: t["record"])
    grouped = rows.repartition("base").groupBy("base", "conv_id").agg(turns.alias("turns"))
    first = F.first(F.when(F.col("conv_id") == F.col("base"), F.slice("turns", 1, shared)), ignorenulls=True)
    first = F.coalesce(first.over(Window.partitionBy("base")), F.array().cast("array<string>"))
    taken = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (shared + 1)).cast("int")
    both = F.concat(F.slice("first", F.lit(1), taken), F.slice("turns", taken + 1, F.size("turns")))
    return grouped.withColumn("first", first).select("conv_id", F.unhex(F.array_join(both, "")).alias("path"))


def whole(conversations: DataFrame) -> DataFrame:
    """``conv_id, path`` of every conversation as it is."""
    return rebuilt(conversations, shared=0)


# The ids of each path, hashed as they stream by


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of a key in order, as joined text of bounded size: ``key, low, many, ids``."""
    key, ids, size, waiting = None, [], 0, 0
    out: list[tuple] = []

    def batch_of() -> pa.RecordBatch:
        columns = list(zip(*out, strict=True)) if out else [()] * 4
        kinds = (pa.binary(), pa.int64(), pa.int64(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["key", "low", "many", "ids"])

    def close() -> None:
        out.append((key, ids[0], len(ids), ",".join(map(str, ids)).encode()))

    for batch in batches:
        for k, i in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if ids and (k != key or size >= PIECE_BYTES):
                close()
                waiting, ids, size = waiting + size, [], 0
                if len(out) >= ROWS or waiting >= PIECE_BYTES << 4:
                    yield batch_of()
                    out, waiting = [], 0
            key = k
            ids.append(i)
            size += 20  # about the longest decimal
    if ids:
        close()
    yield batch_of()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``key, ends`` of the keys with several ids; pieces come in order."""
    key, many, state = None, 0, hashlib.sha256()
    found: tuple[list, list] = ([], [])

    def batch_of() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(found[0], pa.binary()), pa.array(found[1], pa.string())], names=["key", "ends"])

    for batch in batches:
        for k, n, ids in zip(*[batch.column(c).to_pylist() for c in (0, 2, 3)], strict=True):
            if k != key:
                if many > 1:
                    found[0].append(key)
                    found[1].append(state.hexdigest())
                    if len(found[0]) >= ROWS:
                        yield batch_of()
                        found = ([], [])
                key, many, state = k, 0, hashlib.sha256()
            state.update(b"," + ids if many else ids)
            many += n
    if many > 1:
        found[0].append(key)
        found[1].append(state.hexdigest())
    yield batch_of()


def distinct_paths(conversations: DataFrame) -> DataFrame:
    """``path, n, first, ends`` of each distinct path of ``conv_id, path``: how many have it, the least id, and the hash of all."""
    spark = conversations.sparkSession
    key = F.unhex(F.md5("path"))
    paths = conversations.groupBy("path").agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("first"))
    alone = paths.filter("n = 1").withColumn("ends", F.sha2(F.col("first").cast("string").cast("binary"), 256))
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ids = conversations.select(key.alias("key"), "conv_id").repartitionByRange(partitions, "key", "conv_id")
    pieces = ids.sortWithinPartitions("key", "conv_id").mapInArrow(_pieces, "key binary, low long, many long, ids binary")
    hashed = pieces.repartition("key").sortWithinPartitions("key", "low").mapInArrow(_digests, "key binary, ends string")
    several = paths.filter("n > 1").withColumn("key", key).join(hashed, "key").select(*alone.columns)
    return alone.unionByName(several)


# Heads and containers


@dataclass
class Head:
    """A node whose container has burst, with the records on the way from the head above."""

    number: int
    above: int | None
    depth: int
    chain: bytes
    n: int = 0
    conv: int | None = None
    children: int = 0
    leaves: int = 0
    saved: int = 0  # of all below, then with the chain
    ends: str = NO_ENDS
    nodes: list[tuple] = field(default_factory=list)


def _container(depth: Column) -> Column:
    """The key of the container that a path is in under a head of this depth."""
    return F.unhex(F.md5(F.substring(F.col("path"), F.lit(1), (depth + 1) * RECORD)))


def _placed(paths: DataFrame, rounds: list[list[tuple[bytes, int, int]]]) -> DataFrame:
    """Paths with ``head`` and its ``depth``, the deepest head that each has, and whether the last round gave it."""
    spark = paths.sparkSession
    placed = paths.withColumns({"head": F.lit(0), "depth": F.lit(0), "fresh": F.lit(True)})
    for heads in rounds:  # at most 4 x partitions rows each
        below = F.broadcast(spark.createDataFrame(heads, "at binary, below int, below_depth int"))
        placed = placed.withColumn("at", _container(F.col("depth"))).join(below, "at", "left").select(
            *paths.columns,
            F.coalesce("below", "head").alias("head"),
            F.coalesce("below_depth", "depth").alias("depth"),
            F.col("below").isNotNull().alias("fresh"),
        )
    return placed.withColumn("at", _container(F.col("depth")))


def _shared(a: bytes, b: bytes) -> int:
    """How many records two paths have in common at the front."""
    low, high = 0, min(len(a), len(b)) // RECORD
    while low < high:
        middle = (low + high + 1) // 2
        if a[: middle * RECORD] == b[: middle * RECORD]:
            low = middle
        else:
            high = middle - 1
    return low


def burst(paths: DataFrame, floor: int = FLOOR_BYTES, few: int = FEW) -> tuple[list[Head], DataFrame]:
    """The heads, from the root on, and the paths with their head and container."""
    spark = paths.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    total = paths.agg(F.sum(F.octet_length("path") + RECORD)).first()[0] or 0
    limit = max(floor, total // (4 * partitions))
    heads, rounds = [Head(0, None, 0, b"")], []
    while True:
        placed = _placed(paths, rounds)
        inside = placed.filter(F.col("fresh") & (F.octet_length("path") > F.col("depth") * RECORD))
        size = inside.groupBy("at").agg(F.sum(F.octet_length("path") + RECORD).alias("size"), F.count(F.lit(1)).alias("many"))
        large = [(bytes(r.at),) for r in size.filter((F.col("size") > limit) & (F.col("many") > few)).collect()]
        if not large:
            return heads, placed
        rest = F.substring(F.col("path"), F.col("depth") * RECORD + 1, F.lit(CHAIN * RECORD))
        ends = (
            inside.join(F.broadcast(spark.createDataFrame(large, "at binary")), "at")
            .withColumn("rest", rest)
            .groupBy("at", "head", "depth")
            .agg(F.min("rest").alias("low"), F.max("rest").alias("high"))
            .orderBy("at")
            .collect()
        )
        below = []
        for row in ends:
            low = bytes(row.low)
            common = _shared(low, bytes(row.high))
            head = Head(len(heads), row["head"], row.depth + common, low[: common * RECORD])
            heads.append(head)
            below.append((bytes(row.at), head.number, head.depth))
        rounds.append(below)


# Sweeps

SWEPT = (
    "at binary, place long, head int, depth int, conv_id long, n_convs long, n_children long, n_leaves long, "
    "saved_tokens long, ends_sha256 string, top boolean"
)
_KINDS = (
    pa.binary(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_()
)


def _swept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of sorted containers, each after all below it."""
    names = [part.split()[0] for part in SWEPT.split(", ")]
    out: list[tuple] = []
    container, before, head, base, place = None, b"", 0, 0, 0
    stack: list[list] = []  # n, conv, children, leaves, saved, ends, words

    def batch_of() -> pa.RecordBatch:
        columns = list(zip(*out, strict=True)) if out else [()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, _KINDS, strict=True)], names=names)

    def leave(keep: int) -> None:
        nonlocal place
        while len(stack) > keep:
            n, conv, children, leaves, saved, ends, words = stack.pop()
            leaves, saved = leaves or 1, saved + (n - 1) * words
            depth = base + len(stack) + 1
            out.append((container, place, head, depth, conv, n, children, leaves, saved, ends, not stack))
            place += 1
            if stack:
                above = stack[-1]
                above[0] += n
                above[1] = conv if above[1] is None else min(above[1], conv)
                above[2] += 1
                above[3] += leaves
                above[4] += saved

    for batch in batches:
        for at, number, depth, path, n, first, ends in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if at != container:
                leave(0)
                container, head, base, before = at, number, depth, path[: depth * RECORD]
            common = _shared(before, path)
            leave(common - base)
            for k in range(common, len(path) // RECORD):
                words = int.from_bytes(path[k * RECORD + 16 : (k + 1) * RECORD], "big")
                stack.append([0, None, 0, 0, 0, NO_ENDS, words])
            own = stack[-1]
            own[0] += n
            own[1] = first if own[1] is None else min(own[1], first)
            own[5] = ends
            before = path
            if len(out) >= ROWS:
                yield batch_of()
                out = []
    leave(0)
    yield batch_of()


def _with_parents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of each container in the order opposite to the sweep's, so that each comes after its parent."""
    on_path: dict[int, int] = {}
    for batch in batches:
        parents = []
        depth, conv, top = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("depth", "conv_id", "top"))
        for d, c, t in zip(depth, conv, top, strict=True):
            parents.append(None if t else on_path[d - 1])
            on_path[d] = c
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(parents, pa.int64())], names=[*batch.schema.names, "parent_conv_id"])


def _add_up(heads: list[Head], tops: list, ended: list) -> None:
    """Figures of all heads, from the deepest up; ``tops`` has the sums of each head's containers."""
    for row in ended:
        head = heads[row["head"]]
        head.n, head.conv, head.ends = row.n, row["first"], row.ends
    for row in tops:
        head = heads[row["head"]]
        head.n += row.n
        head.conv = row.conv if head.conv is None else min(head.conv, row.conv)
        head.children, head.leaves, head.saved = row.children, row.leaves, row.saved
    for head in reversed(heads):
        head.leaves = head.leaves or 1
        records = [head.chain[k : k + RECORD] for k in range(0, len(head.chain), RECORD)]
        for k, record in enumerate(reversed(records)):
            head.saved += (head.n - 1) * int.from_bytes(record[16:], "big")
            children, ends = (head.children, head.ends) if k == 0 else (1, NO_ENDS)
            head.nodes.append((head.depth - k, head.n, children, head.leaves, head.saved, ends))
        if head.above is None:
            head.nodes.append((0, head.n, head.children, head.leaves, head.saved, head.ends))
            continue
        above = heads[head.above]
        above.n += head.n
        above.conv = head.conv if above.conv is None else min(above.conv, head.conv)
        above.children += 1
        above.leaves += head.leaves
        above.saved += head.saved


NODES = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def trie(conversations: DataFrame, floor: int = FLOOR_BYTES, few: int = FEW) -> DataFrame:
    """The nodes of the trie of all paths, from rows ``conv_id, path`` with each id once.

    The ``depth``-th record of the path of ``conv_id`` is a node's last turn.
    """
    spark = prepare_text(conversations.sparkSession)
    stored = scratch_path(spark, "conversations")
    conversations.select("conv_id", "path").write.parquet(stored)
    conversations = spark.read.schema("conv_id long, path binary").parquet(stored)
    stored = scratch_path(spark, "paths")
    distinct_paths(conversations).write.parquet(stored)
    paths = spark.read.schema("path binary, n long, first long, ends string").parquet(stored)

    heads, placed = burst(paths, floor, few)
    inside = placed.filter(F.octet_length("path") > F.col("depth") * RECORD)
    dealt = inside.select("at", "head", "depth", "path", "n", "first", "ends").repartition("at").sortWithinPartitions("at", "path")
    swept = dealt.mapInArrow(_swept, SWEPT).sortWithinPartitions("at", F.desc("place"))
    stored = scratch_path(spark, "nodes")
    swept.mapInArrow(_with_parents, f"{SWEPT}, parent_conv_id long").drop("at", "place").write.parquet(stored)
    nodes = spark.read.parquet(stored)

    # A row for each head at most.
    tops = nodes.filter("top").groupBy("head").agg(
        F.sum("n_convs").alias("n"),
        F.min("conv_id").alias("conv"),
        F.count(F.lit(1)).alias("children"),
        F.sum("n_leaves").alias("leaves"),
        F.sum("saved_tokens").alias("saved"),
    )
    ended = placed.filter(F.octet_length("path") == F.col("depth") * RECORD).select("head", "n", "first", "ends")
    _add_up(heads, tops.collect(), ended.collect())
    rows = []
    for head in heads if heads[0].n else ():
        parent = None if head.above is None else heads[head.above].conv
        for depth, n, children, leaves, saved, ends in head.nodes:
            first = depth == (0 if head.above is None else heads[head.above].depth + 1)
            rows.append((head.conv, depth, parent if first else head.conv, n, children, leaves, saved, ends))
    kinds = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
    of_heads = spark.createDataFrame(rows, kinds)
    convs = F.broadcast(spark.createDataFrame([(h.number, h.conv) for h in heads], "head int, head_conv long"))
    parent = F.when(F.col("top"), F.col("head_conv")).otherwise(F.col("parent_conv_id")).alias("parent_conv_id")
    below = nodes.join(convs, "head").select(*[parent if c == "parent_conv_id" else F.col(c).cast(dict(of_heads.dtypes)[c]) for c in NODES])
    return of_heads.unionByName(below)


def op11(conversations: DataFrame) -> DataFrame:
    return trie(rebuilt(conversations))


OP11_SQL = """
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
                            md5(concat(length(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, '')))) AS p
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT conv_id, xor(4294967295, list_reduce(
           list_concat([CAST(4294967295 AS BIGINT)], flatten(list_transform(range(1, length(s) + 1), lambda i:
             list_transform(range(0, 8), lambda j: (ascii(substr(s, CAST(i AS INTEGER), 1)) >> CAST(j AS INTEGER)) & 1)))),
           lambda c, m: xor(c >> 1, (xor(c, m) & 1) * 3988292384))) % 4 AS h
  FROM (SELECT DISTINCT conv_id, CAST(conv_id AS VARCHAR) AS s FROM conversations WHERE conv_id IS NOT NULL)
), rebuilt AS (
  SELECT c.conv_id, 0 AS part, t.p, role, text FROM convs c JOIN turns t ON t.conv_id = c.conv_id - c.conv_id % 20 AND t.p <= c.h
  UNION ALL
  SELECT c.conv_id, 1 AS part, t.p, role, text FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.p > c.h
), paths AS (
  SELECT c.conv_id, coalesce(string_agg(md5(concat(length(role), ':', role, text)), '' ORDER BY part, p) FILTER (WHERE p IS NOT NULL), '') AS path,
         coalesce(list(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) ORDER BY part, p) FILTER (WHERE p IS NOT NULL), []) AS words
  FROM convs c LEFT JOIN rebuilt r ON c.conv_id = r.conv_id GROUP BY c.conv_id
), prefixes AS (
  SELECT conv_id, unnest(range(0, length(path) // 32 + 1)) AS depth, path, words FROM paths
), nodes AS (
  SELECT depth, left(path, 32 * depth) AS prefix, min(conv_id) AS conv_id, count(*) AS n_convs,
         CASE WHEN depth = 0 THEN 0 ELSE min(words[depth]) END AS words,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE length(path) = 32 * depth), '')) AS ends_sha256
  FROM prefixes GROUP BY depth, left(path, 32 * depth)
), children AS (
  SELECT depth - 1 AS depth, left(prefix, 32 * (depth - 1)) AS prefix, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1, 2
), figures AS (
  SELECT n.*, coalesce(c.n_children, 0) AS n_children FROM nodes n LEFT JOIN children c ON n.depth = c.depth AND n.prefix = c.prefix
), below AS (
  SELECT up AS depth, left(prefix, 32 * up) AS prefix, count(*) FILTER (WHERE n_children = 0) AS n_leaves,
         CAST(sum((n_convs - 1) * words) AS BIGINT) AS saved_tokens
  FROM (SELECT *, unnest(range(0, depth + 1)) AS up FROM figures) GROUP BY 1, 2
)
SELECT f.conv_id, f.depth, p.conv_id AS parent_conv_id, f.n_convs, f.n_children, b.n_leaves, b.saved_tokens, f.ends_sha256
FROM figures f JOIN below b ON f.depth = b.depth AND f.prefix = b.prefix
LEFT JOIN nodes p ON p.depth = f.depth - 1 AND p.prefix = left(f.prefix, 32 * (f.depth - 1)) AND f.depth > 0
"""
