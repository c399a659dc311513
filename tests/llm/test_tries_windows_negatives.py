"""Operators 11 to 13 against their SQL on small tables with odd rows, and with small bounds."""

import random

import pyarrow.parquet as pq
import pytest
from parity import rows_of, spark_rows, sql_rows
from pyspark.sql import functions as F

from airhour.llm import decontamination, hard_negatives, prefix_trie

CLASH = "path string, base int, first int, at string, row int, items string, label2 int"


def as_file(spark, tmp_path, name, rows, schema):
    """The rows as one Parquet file that both engines read; the folder and the DataFrame."""
    frame = spark.createDataFrame(rows, schema)
    pq.write_table(frame.toArrow(), f"{tmp_path}/{name}.parquet")
    return spark.read.parquet(f"{tmp_path}/{name}.parquet").repartition(3)


TURNS = "conv_id long, turn long, role string, text string, " + CLASH


def conversations(seed=3):
    rng = random.Random(seed)
    texts = ["Hi there", "", None, "a b\tc", "ünï cödé words", " lead", "long " * 3000]
    rows = []
    for conv in [*range(0, 70), -40, -39, -3, 10**15, 10**15 + 7]:
        if conv in (20, 45):
            continue
        for turn in range(rng.randrange(1, 7)):
            rows.append((conv, rng.choice([turn, None, 1]) if conv % 9 == 4 else turn, rng.choice(["user", "assistant", None]), rng.choice(texts)))
    copied = [(1000 + k, t, "user", f"same {t}") for k in range(300) for t in range(3)]
    rows += copied + rows[:6] + [(None, 0, "user", "nobody")]
    return [(*r, "p", 1, 2, "a", 3, "i", 4) for r in rows]


@pytest.mark.parametrize(("floor", "few"), [(prefix_trie.FLOOR_BYTES, prefix_trie.FEW), (100, 1), (600, 2)])
def test_prefix_trie(spark, tmp_path, floor, few):
    frame = as_file(spark, tmp_path, "conversations", conversations(), TURNS)
    found = prefix_trie.trie(prefix_trie.rebuilt(frame), floor, few)
    assert spark_rows(found) == sql_rows(tmp_path, prefix_trie.OP11_SQL)


def test_prefix_trie_pieces(spark, tmp_path, monkeypatch):
    """Ids of a node that are joined from many pieces, over several ranges."""
    rows = [(20 * k + 20, 0, "user", "one") for k in range(3000)]
    frame = as_file(spark, tmp_path, "conversations", rows, "conv_id long, turn long, role string, text string")
    pieces = prefix_trie.distinct_paths(prefix_trie.whole(frame))
    assert [(r.n, r["first"]) for r in pieces.collect()] == [(3000, 20)]
    assert spark_rows(prefix_trie.op11(frame)) == sql_rows(tmp_path, prefix_trie.OP11_SQL)


def test_prefix_trie_long_chains(spark, tmp_path, monkeypatch):
    """Paths that part only after more turns than are looked at together, in oversized containers."""
    monkeypatch.setattr(prefix_trie, "CHAIN", 8)
    rows = []
    for k in range(40):
        rows += [(20 * k + 20, t, "user", f"turn {t}" if t < 20 + k % 3 else f"own {k}") for t in range(25)]
    frame = as_file(spark, tmp_path, "conversations", rows, "conv_id long, turn long, role string, text string")
    heads, _ = prefix_trie.burst(prefix_trie.distinct_paths(prefix_trie.whole(frame)).cache(), 100, 1)
    assert max(h.depth for h in heads) > prefix_trie.CHAIN
    found = prefix_trie.trie(prefix_trie.rebuilt(frame), 100, 1)
    assert spark_rows(found) == sql_rows(tmp_path, prefix_trie.OP11_SQL)


def test_turnless_conversation(spark, tmp_path):
    rows = [(c, 0, "user", "own") for c in range(21, 40)]  # without their base, some have no turn left
    frame = as_file(spark, tmp_path, "conversations", rows, "conv_id long, turn long, role string, text string")
    found = prefix_trie.op11(frame)
    assert found.filter("depth = 0").first().n_convs == 19
    assert spark_rows(found) == sql_rows(tmp_path, prefix_trie.OP11_SQL)


def test_empty_tables(spark):
    turns = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    docs = spark.createDataFrame([(1, "some words")], "doc_id long, text string")
    items = spark.createDataFrame([], "item_id long, text string")
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert prefix_trie.op11(turns).count() == 0
    assert hard_negatives.op13(vectors).count() == 0
    assert decontamination.op12(docs.limit(0), items).count() == 0
    row = decontamination.op12(docs, items).first()
    assert (row.n_words, row.n_hit, row.n_items, row.contaminated) == (2, 0, 0, False)


DOCS = "doc_id long, text string, source string, n_chars long, " + CLASH
ITEMS = "item_id long, text string, path string"


def benchmark_case(seed=9):
    rng = random.Random(seed)
    words = ["the", "a", "Of", "é", "ünder", "x1", "long" * 30, "end", "zwei", "o"]
    items = [(k, " ".join(rng.choices(words, k=rng.choice([1, 2, 9, 10, 11, 25])))) for k in range(40)]
    items += [(7, "another text of the same item id with more than ten words in it"), (None, "nobody knows this item")]
    items += [(50, None), (51, ""), (52, " ,.! "), (53, "Same Word"), (54, items[3][1]), (55, "w " * 40)]
    docs = []
    for k in range(120):
        parts = [" ".join(rng.choices(words, k=rng.randrange(0, 30)))]
        for _ in range(rng.randrange(3)):
            parts.insert(rng.randrange(len(parts) + 1), rng.choice(items)[1] or "")
        docs.append((k, rng.choice([" ", ", ", "\n", "-"]).join(parts)))
    docs += [(None, "nobody knows this item"), (None, None), (300, ""), (301, "\x00the"), (5, docs[5][1]), (302, "w " * 800)]
    docs.append((303, " ".join(rng.choices(words, k=2_500))))
    docs.append((304, "Nobody KNOWS--this\titém nobody knows this item"))
    return [(*d, "s", 1, "p", 1, 2, "a", 3, "i", 4) for d in docs], [(*i, "p") for i in items]


@pytest.mark.parametrize("shard_bytes", [decontamination.SHARD_BYTES, 1200])
def test_decontamination(spark, tmp_path, shard_bytes):
    docs, items = benchmark_case()
    docs = as_file(spark, tmp_path, "documents", docs, DOCS)
    items = as_file(spark, tmp_path, "benchmark", items, ITEMS)
    if shard_bytes < 10_000:
        assert len(list(decontamination.shards(items, shard_bytes=shard_bytes))) > 2
    found = decontamination.summarise(decontamination.find(docs, items, shard_bytes=shard_bytes))
    assert spark_rows(found) == sql_rows(tmp_path, decontamination.OP12_SQL)


def test_long_items_in_pieces(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(decontamination, "PIECE_WORDS", 25)
    rng = random.Random(1)
    words = [f"w{k}" for k in range(300)]
    items = [(1, " ".join(words)), (2, " ".join(words[100:140]))]
    docs = [(k, " ".join(words[k : k + rng.randrange(8, 40)])) for k in range(0, 280, 3)]
    docs = as_file(spark, tmp_path, "documents", docs, "doc_id long, text string")
    items = as_file(spark, tmp_path, "benchmark", items, "item_id long, text string")
    assert spark_rows(decontamination.op12(docs, items)) == sql_rows(tmp_path, decontamination.OP12_SQL)


def test_shifts_skip_positions():
    """The cursors look at few positions of a text that has no window."""
    item = decontamination.in_form([b"benchmark%d" % k for k in range(30)])
    searcher = decontamination.Searcher(decontamination.Shard([item], ["1"]))
    windows = searcher.classes[0]
    assert windows.last > 50 and int(windows.shift.max()) == windows.last + 1
    text = decontamination.Bytes([b" prose of other words " * 500])
    assert len(windows.candidates(text)) < len(text.flat) / 100


VECTORS = "vec_id long, embedding array<float>, label int, path string, kind int"


def vectors(seed=4, n=230, dims=5):
    rng = random.Random(seed)
    rows = [(k, [rng.choice([-1.0, -0.25, 0.1, 0.5, 0.9, 0.0]) for _ in range(dims)], rng.choice([0, 1, 1, 1, 9])) for k in range(n)]
    rows += [(None, [0.1] * dims, 1), (50, None, 1), (100, [0.1] * dims, None), (400, [float("nan")] + [0.1] * (dims - 1), 1)]
    rows += [(450, [float("inf")] + [0.2] * (dims - 1), 1), (500, [None] + [0.2] * (dims - 1), 1), (550, [0.0] * dims, 2)]
    return [(*r, "p", 1) for r in rows + rows[:60]]


@pytest.mark.parametrize(("block", "anchors"), [(hard_negatives.BLOCK_ROWS, hard_negatives.ANCHOR_ROWS), (30, 2)])
def test_hard_negatives(spark, tmp_path, block, anchors, monkeypatch):
    frame = as_file(spark, tmp_path, "embeddings", vectors(), VECTORS)
    label = F.col("label").cast("long")
    shifted = F.when(F.pmod("vec_id", F.lit(7)) == 0, (label + 1) % 10).otherwise(label)
    found = hard_negatives.mine(frame, F.pmod("vec_id", F.lit(50)) == 0, shifted, block_rows=block, anchor_rows=anchors)
    expected = sql_rows(tmp_path, hard_negatives.OP13_SQL)
    assert len(expected[1]) > 20
    assert spark_rows(found) == expected


def test_hard_negatives_large_components_and_dimensions(spark):
    """Beyond the exact doubles products are still right; vectors of another size are not compared."""
    big = 1e6
    rows = [(0, [big, big + 1 / 256], 1), (1, [big, big], 1), (2, [big * 0.9, big * 0.9], 2), (3, [1.0], 2), (50, [1.0], 2), (51, [2.0], 1), (52, [1.0], 2)]
    frame = spark.createDataFrame([(i, v, lab) for i, v, lab in rows], "vec_id long, embedding array<double>, label int")
    found = {(r.anchor_id, r.positive_id): r for r in hard_negatives.mine(frame, F.col("vec_id") % 50 == 0).collect()}
    one = found[(0, 1)]
    a = [int(256 * x) for x in rows[0][1]]
    assert one.positive_score == sum(x * int(256 * y) for x, y in zip(a, rows[1][1], strict=True))
    assert one.negative_id == 2
    assert set(found) == {(0, 1)}


def test_results_do_not_depend_on_partitions(spark):
    frame = spark.createDataFrame(vectors(8, 120), VECTORS)
    results = [rows_of(hard_negatives.op13(frame).columns, [tuple(r) for r in hard_negatives.op13(frame.repartition(n)).collect()]) for n in (1, 5)]
    assert results[0] == results[1]
