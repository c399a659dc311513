"""The text operators against brute force, on small tables with odd rows."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import xxhash
from parity import spark_rows, sql_rows
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from airhour.llm import bpe, chunk_fingerprints, language_id, mixing, nearest, pieces, quality, shingle_sets, simhash
from airhour.llm import suffix_dedup, suffix_order, token_files, toxicity
from airhour.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, ids string, component_id int"


def rows_of(seed=5, n=90):
    rng = random.Random(seed)
    phrases = ["".join(rng.choice("abcdeé ") for _ in range(rng.randrange(20, 130))) for _ in range(25)]
    phrases += ["ab" * 100, "x" * 300, "Héllo  wörld\n\t ", "<|endoftext|>", "one two three four five six "]
    ids = [None, *range(50)]
    out = []
    for _ in range(n):
        text = rng.choice([None, "", " \n"]) if rng.random() < 0.15 else "".join(rng.choice(phrases) for _ in range(rng.randrange(1, 12)))
        out.append((rng.choice(ids), text, rng.choice([None, "en", "de"]), rng.choice([None, "s0", "s1"]), None, 0.5, "x", 1))
    return out + out[:8] + [(60, "word " * 40_000, "en", "s0", None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows_of(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def plain(docs):
    return [(r.doc_id, r.text) for r in docs.collect()]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def in_order(rows):
    return sorted(map(tuple, rows), key=lambda r: tuple((x is not None, x) for x in r))


OPERATORS = {
    "op1": token_files.op1,
    "op3": chunk_fingerprints.op3,
    "op6": suffix_dedup.op6,
    "op7": simhash.op7,
    "op8": mixing.op8,
    "op9": bpe.op9,
    "op10": language_id.op10,
}


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(docs, name):
    assert OPERATORS[name](docs.limit(0)).count() == 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    assert spark_rows(QUERIES[name](spark, SF)) == sql_rows(SF, ORACLES[name])


def test_token_files(spark, docs, plain, tokenizer):
    rows = sorted(plain, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    expected, start = [], 0
    for doc, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        expected.append((doc, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    got = [tuple(r) for r in token_files.op1(docs).orderBy("start").collect()]
    assert sorted(r[1:] for r in got) == sorted(r[1:] for r in expected)
    assert in_order(got) == in_order(expected)


def test_token_files_find_a_document(spark, docs, tmp_path):
    folder = str(tmp_path / "tokens")
    token_files.write_tokens(docs, folder)
    found = token_files.read_tokens(spark, folder, [60])
    assert [len(r.ids) for r in found.collect()] == [token_files.read_tokens(spark, folder).filter("doc_id = 60").first().n_tokens]
    assert "In(doc_id" in found._jdf.queryExecution().toString() or "EqualTo(doc_id,60)" in found._jdf.queryExecution().toString()


def test_bpe_is_the_library(docs, plain, tokenizer):
    expected = []
    for doc, text in plain:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        back = tokenizer.decode(ids, skip_special_tokens=False)
        digest = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        expected.append((doc, len(ids), digest, hashlib.sha256(back.encode()).hexdigest()))
    assert in_order(bpe.op9(docs).collect()) == in_order(expected)


def test_bpe_random_unicode(tokenizer):
    known = bpe.vocabulary(bpe.vocabulary_path())
    rng = random.Random(2)
    letters = "abcdefgh  \n\t'sé日本語\x85\xa0 　½²_0123!?<|>" + "".join(map(chr, range(0x370, 0x460)))
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(80))) for _ in range(400)]
    texts += ["a" * 3000 + "!" * 500, "ab" * 700 + " " * 50, "x<|endoftext|>y <|endoftext|>"]
    flat, counts = known.encode([t.encode() for t in texts])
    ends = np.cumsum(counts)
    for text, end, n in zip(texts, ends, counts, strict=True):
        if "͸" <= max(text, default="") <= "͹":
            continue
        assert flat[end - n : end].tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def test_units_forget_and_learn_again(tokenizer):
    known = bpe.Vocabulary(bpe.vocabulary_path())
    known.units = pieces.Units(known._pieces, limit=40)
    for k in range(6):
        text = " ".join(f"word{i}" for i in range(k * 15, k * 15 + 30))
        assert known.encode([text.encode()])[0].tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_units_of_one_text_beyond_the_slots(tokenizer, monkeypatch):
    known = bpe.Vocabulary(bpe.vocabulary_path())
    known.units = pieces.Units(known._pieces, limit=40)
    remember = known.units._remember

    def bounded(hashes, units):
        assert len(units) <= 40  # more than the 128 slots would be searched for ever
        remember(hashes, units)

    monkeypatch.setattr(known.units, "_remember", bounded)
    text = " ".join(f"word{i} again{i % 7}" for i in range(500))
    for texts in ([text], ["word3 new", text, "", "word499 again6 last"], [text[:300]]):
        flat, counts = known.encode([t.encode() for t in texts])
        expected = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
        assert flat.tolist() == sum(expected, []) and counts.tolist() == [len(ids) for ids in expected]


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(points, distance=4):
    parent = {p: p for p in points}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in points:
        for b in points:
            if a < b and (a ^ b).bit_count() <= distance:
                parent[root(b)] = root(a)
    return {p: root(p) for p in points}


def test_simhash(docs, plain):
    prints = {(doc, text): brute_fingerprint(text) for doc, text in plain if text is None or len(text) < 10_000}
    got = {}
    for r in simhash.op7(docs.filter("length(text) < 10000 or text is null")).collect():
        got.setdefault(r.doc_id, set()).add((r.fingerprint, r.component_id))
    roots = brute_components({p for (doc, _), p in prints.items() if doc is not None})
    least = {}
    for (doc, _), p in prints.items():
        if doc is not None:
            least[roots[p]] = min(least.get(roots[p], doc), doc)
    expected = {}
    for (doc, _), p in prints.items():
        expected.setdefault(doc, set()).add((f"{p:016x}", None if doc is None else least[roots[p]]))
    assert got == expected


def test_crowded_cells_are_dealt_again(spark):
    rng = random.Random(4)
    centre = rng.getrandbits(64)
    points = {centre ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(9))) for _ in range(300)}
    signed = [p - (1 << 64) if p >> 63 else p for p in points]
    frame = spark.createDataFrame([(s,) for s in signed], "bits long")
    expected = brute_components({*points})
    for crowded in (4096, 5):
        links = simhash.links(frame, crowded=crowded).collect()
        got = brute_components({*points}, distance=-1)
        parent = dict(got)

        def root(x, parent=parent):
            while parent[x] != x:
                x = parent[x]
            return x

        for a, b in links:
            assert ((a ^ b) & (1 << 64) - 1).bit_count() <= 4
            parent[root(a % (1 << 64))] = root(b % (1 << 64))
        same = {frozenset(q for q in points if root(q) == root(p)) for p in points}
        assert same == {frozenset(q for q in points if expected[q] == expected[p]) for p in points}


def brute_kept(rows):
    """Ids of one row of each component of Jaccard similarity 0.8 or more on five-word shingles."""
    sets = []
    for _, text in rows:
        words = (text or "").lower().split()
        sets.append({tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))})
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if len(a & b) / len(a | b) >= 0.8:
                parent[root(i)] = root(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        key = (doc is None, doc or 0)
        least[root(i)] = min(least.get(root(i), key), key)
    return in_order((None if none else doc,) for none, doc in least.values())


def edited(rng, text, edits):
    words = text.split()
    for at in rng.sample(range(len(words)), edits):
        words[at] = f"new{rng.randrange(10**9)}"
    return " ".join(words)


def test_pipeline_near_duplicates(spark):
    rng = random.Random(12)
    passage = " ".join(f"same{i}" for i in range(60))
    texts = [" ".join(f"w{rng.randrange(5000)}" for _ in range(rng.randrange(80, 300))) for _ in range(25)]
    texts += [edited(rng, rng.choice(texts), k) for k in (1, 2, 3, 4, 5, 7, 9, 12) for _ in range(8)]
    texts += [f"{passage} {i} {rng.random()} {passage.upper() if i % 2 else ''}" for i in range(20)]
    texts += ["", None, " \n", "one two", "One  two", "one two three", texts[3].upper(), texts[30]]
    rows = list(zip(rng.sample(range(1000), len(texts)), texts, strict=True))
    frame = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.near_duplicates(spark, frame, SF)
    assert got.columns == frame.columns and in_order(got.select("doc_id").collect()) == brute_kept(rows)
    assert dict(rows).items() >= {(r.doc_id, r.text) for r in got.collect()}
    assert corpus_pipeline.near_duplicates(spark, frame.limit(0), SF).count() == 0


def test_pipeline_keeps_one_row_of_a_group(spark):
    rng = random.Random(13)
    a, b, c = (" ".join(f"w{rng.randrange(5000)}" for _ in range(120)) for _ in range(3))
    rows = [(3, a), (3, a), (7, edited(rng, a, 1)), (7, b), (None, a), (None, c), (None, c), (9, edited(rng, c, 2)), (None, "alone")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    kept = corpus_pipeline.near_duplicates(spark, frame, SF).collect()
    assert in_order(kept) == in_order([(3, a), (7, b), rows[7], (None, "alone")])
    assert in_order(r[:1] for r in kept) == brute_kept(rows)


def near_copies(rng, n, words=120, edits=2):
    base = [f"w{rng.randrange(5000)}" for _ in range(words)]
    return [" ".join(base), *(edited(rng, " ".join(base), rng.randrange(1, edits + 1)) for _ in range(n - 1))]


@pytest.mark.parametrize("block", [1, 3, 256])
def test_near_duplicates_by_blocks(spark, block):
    """Chains, of which hubs connect parts only, and groups of copies with many pairs about the limit."""
    rng = random.Random(22)
    words = [f"w{rng.randrange(10**6)}" for _ in range(600)]
    texts = [" ".join(words[k : k + 100]) for k in range(0, 500, 9)]
    texts += near_copies(rng, 40, edits=4) + near_copies(rng, 20, words=90, edits=5)
    rows = list(zip(rng.sample(range(1000), len(texts)), texts, strict=True))
    kept = shingle_sets.one_of_each(spark.createDataFrame(rows, "doc_id long, text string"), block=block)
    assert in_order(kept.select("doc_id").collect()) == brute_kept(rows)


def test_near_copies_make_no_row_for_every_pair(spark, monkeypatch, tmp_path):
    """What near_duplicates stores for a group of copies grows with the copies, not with their pairs."""
    n = 300
    texts = near_copies(random.Random(23), n, words=150, edits=3)
    monkeypatch.setattr(shingle_sets, "scratch_path", lambda _, name: f"{tmp_path}/{name}-{random.randrange(10**9)}")
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert [r.doc_id for r in shingle_sets.one_of_each(docs).collect()] == [r[0] for r in brute_kept(list(enumerate(texts)))]
    stored = [spark.read.parquet(str(path)).count() for kind in ("pairs", "blocks") for path in tmp_path.glob(f"{kind}-*")]
    assert n / 2 < sum(stored) <= 6 * n, stored


def test_bands_find_similar_sets():
    rng = np.random.default_rng(3)
    met = 0
    for _ in range(2000):
        a = rng.integers(0, 1 << 64, size=90, dtype=np.uint64)
        b = np.unique(np.concatenate([a[:80], rng.integers(0, 1 << 64, size=10, dtype=np.uint64)]))
        met += bool(np.any(shingle_sets.buckets_of(np.unique(a)) == shingle_sets.buckets_of(b)))
        assert shingle_sets.similar(np.unique(a), b)
    assert met == 2000


def brute_removed(rows, length=50):
    first = {}
    for doc, text in rows:
        data = (text or "").encode()
        if doc is not None:
            for p in range(len(data) - length + 1):
                piece = data[p : p + length]
                first[piece] = min(first.get(piece, doc), doc)
    out = []
    for doc, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        if doc is not None:
            for p in range(len(data) - length + 1):
                if first[data[p : p + length]] < doc:
                    gone[p : p + length] = b"\1" * length
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        kept = bytes(c for c, g in zip(data, gone, strict=True) if not g)
        out.append((doc, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("crowded", [1000, 2])
def test_suffix_dedup(docs, plain, crowded):
    short = docs.filter("length(text) < 10000 or text is null")
    cleaned = suffix_dedup.remove_repeats(short.select("doc_id", "text"), crowded=crowded)
    got = [
        (r.doc_id, r.n_bytes, sum(r.ends) - sum(r.starts), len(r.starts), hashlib.sha256(r.kept).hexdigest())
        for r in cleaned.collect()
    ]
    assert in_order(got) == in_order(brute_removed([r for r in plain if r[1] is None or len(r[1]) < 10_000]))


@pytest.mark.parametrize("bucket", [1 << 19, 40])
def test_suffix_order(monkeypatch, bucket):
    monkeypatch.setattr(suffix_order, "BUCKET", bucket)
    rng = random.Random(3)
    for _ in range(60):
        text = bytes(rng.choice(b"abc"[: rng.choice([1, 2, 3])]) for _ in range(rng.randrange(300)))
        text += text[: len(text) // 2] + b"\1" + text
        depth = rng.choice([8, 20, 50])
        order = suffix_order.suffix_array(text, depth).tolist()
        padded = text + bytes(400)
        keys = [padded[i : i + depth] for i in order]
        assert sorted(order) == list(range(len(text))) and keys == sorted(keys)


def test_mixing_meets_its_targets(spark, docs):
    shares = spark.createDataFrame([(0.5,), (0.3,), (0.15,), (0.05,)], "share double")
    assert abs(10 ** (1 - mixing.exponent_for(shares, 3.0, None)) - 3.0) < 1e-4
    weights = np.array([0.5, 0.3, 0.15, 0.05]) ** mixing.exponent_for(shares, None, 1.3)
    weights /= weights.sum()
    assert abs(-(weights * np.log(weights)).sum() - 1.3) < 1e-4
    read = mixing.mix(docs)
    assert read.columns[: len(docs.columns)] == docs.columns
    assert read.filter("mix_epoch = 0").count() == docs.count()
    assert read.agg(F.max("mix_epoch")).first()[0] <= 1


def test_fingerprints(docs, plain):
    rows = sorted(plain, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    expected = []
    for i, (doc, text) in enumerate(rows):
        text, following = text or "", rows[(i + 1) % len(rows)][1] or ""
        changed = text[: len(text) - len(text) // 4] + following[: len(text) // 4]
        a, b, c = chunk_fingerprints.fingerprints_of([t.encode() for t in (text, changed, following)])
        digest = hashlib.sha256(changed.encode()).hexdigest()
        near = (chunk_fingerprints.containment(a, b), chunk_fingerprints.containment(a, c))
        expected.append((doc, len(text), digest, chunk_fingerprints.written(a), chunk_fingerprints.written(b), *near))
    assert in_order(chunk_fingerprints.op3(docs).collect()) == in_order(expected)


def test_chunks_cover_the_text_and_resist_shifts():
    rng = random.Random(6)
    text = "".join(rng.choice("abcdefgh ") for _ in range(6000)).encode()
    data, places = chunk_fingerprints.boundaries([text, b"", b"new start " + text])
    assert places[0][0] == 0 and places[0][-1] == len(text) and len(places[1]) == 1
    sizes = np.diff(places[0])
    assert sizes[:-1].min() >= chunk_fingerprints.LEAST and sizes.max() <= chunk_fingerprints.GREATEST
    a, _, b = chunk_fingerprints.fingerprints_of([text, b"", b"new start " + text])
    assert chunk_fingerprints.containment(a, b) > 0.9


def test_nearest_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (100, [0.0, 2.0]), (1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, None), (None, [1.0, 1.0])]
    rows += [(4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (7, [1.0]), (8, [1.0, 1.0]), (9, [1.0, 0.0])]
    got = [tuple(r) for r in nearest.op5(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()]
    expected = []
    good = [(i, np.array(v)) for i, v in [(0, [1, 0]), (100, [0, 2]), (1, [1, 0]), (8, [1, 1]), (9, [1, 0])]]
    for q, x in good[:2]:
        near = sorted((float(np.sqrt(((v - x) ** 2).sum())), i) for i, v in good if i != q)
        expected += [(q, rank, i, s) for rank, (s, i) in enumerate(near, 1)]
    assert sorted(got) == sorted(expected)
    assert nearest.op5(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def brute_nearest(rows):
    distinct = sorted({(i, tuple(v)) for i, v in rows})
    pairs = {}
    for q, x in distinct:
        if q % 100 == 0:
            far = [(float(np.sqrt(np.cumsum((np.array(v) - np.array(x)) ** 2)[-1])), i) for i, v in distinct if i != q]
            pairs.setdefault(q, []).extend(far)
    return sorted((q, rank, i, s) for q, far in pairs.items() for rank, (s, i) in enumerate(sorted(far)[:10], 1))


VECTORS = "vec_id long, embedding array<double>"


@pytest.mark.parametrize("block", [1 << 14, 8])
def test_nearest_repeated_rows(spark, monkeypatch, block):
    monkeypatch.setattr(nearest, "BLOCK_ROWS", block)
    rng = random.Random(8)
    rows = [(i, [float(rng.randrange(-9, 9)) + 0.5 for _ in range(6)]) for i in [*range(30), 100, 200]]
    rows += [(i, rows[3][1]) for i in (40, 41, 42)] + [(3, rows[3][1])] * 12  # the smallest id hides no other
    rows += [(0, [x + k / 64 for x in rows[0][1]]) for k in range(1, 15)]  # a query's own rows are no neighbours
    got = nearest.op5(spark.createDataFrame(rows * 2, VECTORS)).collect()
    assert sorted(map(tuple, got)) == brute_nearest(rows)


def test_nearest_searches_each_number_of_dimensions(spark):
    rng = random.Random(10)
    rows = [(i, [rng.uniform(-9, 9) for _ in range(5 if i in (0, 7, 8) else 6)]) for i in [*range(40), 100, 200]]
    got = nearest.op5(spark.createDataFrame(rows, VECTORS)).collect()
    expected = [brute_nearest([r for r in rows if len(r[1]) == dims]) for dims in (5, 6)]
    assert sorted(map(tuple, got)) == sorted(expected[0] + expected[1]) and len(got) == 22


def test_nearest_deals_a_crowded_code(spark, monkeypatch):
    dealt, blocks = [], nearest._blocks

    def seen(*args):
        dealt.append(blocks(*args))
        return dealt[-1]

    monkeypatch.setattr(nearest, "_blocks", seen)
    monkeypatch.setattr(nearest, "BLOCK_ROWS", 50)
    rng = random.Random(9)
    rows = [(i, [5 + rng.random() / 1e6, -3 + rng.random() / 1e6, 9.0]) for i in range(1, 301)]
    rows += [(i, [rng.uniform(-99, 99) for _ in range(3)]) for i in [*range(301, 600), 600]]
    monkeypatch.setattr(nearest, "fit", lambda good: nearest.Coding(np.eye(3), np.zeros((1, 3))))
    got = nearest.op5(spark.createDataFrame(rows, VECTORS)).collect()
    assert sorted(map(tuple, got)) == brute_nearest(rows)
    sizes = [r["count"] for r in dealt[0][0].groupBy("block").count().collect()]
    assert sum(sizes) == 600 and max(sizes) < 100


def accuracy(frame, truth, name):
    rows = frame.join(truth, "doc_id").filter("held_out").select(name, "label").collect()
    return sum(r[0] == r[1] for r in rows) / len(rows)


def test_language_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    truth = docs.select("doc_id", F.col("lang").alias("label"))
    assert accuracy(language_id.op10(docs), truth, "lang_pred") > 0.97


def test_language_without_letters(docs):
    rows = language_id.op10(docs).join(docs.select("doc_id", "text"), "doc_id").filter("text is null or trim(text) = ''")
    assert language_id.op10(docs.withColumn("lang", F.lit(None).cast("string"))).filter("lang_pred != 'und'").count() == 0
    got = language_id.op10(docs.withColumn("text", F.lit("123 !?"))).select("lang_pred", "score").distinct().collect()
    assert [tuple(r) for r in got] == [("und", 0.0)] and rows.count() > 0


@pytest.mark.parametrize("operator, label, least", [(quality.op4, "quality", 0.93), (toxicity.op2, "toxic", 0.9)])
def test_classifiers_held_out(spark, operator, label, least):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    scored = operator(docs, labels)
    assert accuracy(scored, labels.select("doc_id", F.col(label).alias("label")), "predicted") > least
    assert scored.filter("score < 0 or score > 1 or score is null").count() == 0


@pytest.mark.parametrize("operator, label", [(quality.op4, "quality"), (toxicity.op2, "toxic")])
def test_classifiers_odd_rows(spark, docs, operator, label):
    labels = spark.createDataFrame([(i, i % 2, "x") for i in range(40)] + [(None, 1, "x"), (3, None, "x")], f"doc_id long, {label} int, score string")
    assert operator(docs, labels).count() == docs.count()
    assert operator(docs, labels.limit(0)).filter("score = 0").count() == docs.count()
    assert operator(docs.limit(0), labels).count() == 0


def test_isotonic_rises():
    at, values = toxicity.isotonic(np.array([0.0, 1, 2, 3, 4]), np.array([0, 1, 0, 1, 1]))
    assert (np.diff(at) > 0).all() and (np.diff(values) >= 0).all()


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    extra = spark.createDataFrame([(900, None, None, None, None), (901, "", "en", "s", 0)], docs.schema)
    now = docs.unionByName(extra).unionByName(docs.limit(1).withColumn("doc_id", F.lit(950).cast("long")))
    before = {r.doc_id for r in now.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, SF)
        assert now.columns == docs.columns, name
        kept = {r.doc_id for r in now.select("doc_id").collect()}
        assert kept <= before and len(kept) > 40
        if name == "language":
            assert not kept & {900, 901}
        if name == "near_duplicates":
            assert 950 not in kept
        before = kept
    last = corpus_pipeline.STAGES[-1][1](spark, now, SF)
    assert in_order(last.select("doc_id", "text").collect()) == in_order(now.select("doc_id", "text").collect())
    assert last.filter("n_tokens != size(ids)").count() == 0


def test_language_parts_equal_counts_of_lists():
    import pyarrow as pa

    lists = [[3, 9], [], [0, 7, 4095], [5]]
    counts = [[1, 3], [], [2, 2, 4], [6]]
    one = pa.table({"bucket": pa.array(lists[:2], pa.list_(pa.int32())), "n": pa.array(counts[:2], pa.list_(pa.int32()))})
    two = pa.table({"bucket": pa.array(lists[2:], pa.list_(pa.int32())), "n": pa.array(counts[2:], pa.list_(pa.int32()))})
    x = language_id._parts(pa.concat_tables([one, two, two.slice(1, 1)]))
    assert x.shape == (5, language_id.BUCKETS) and x.sum(axis=1).tolist() == [1, 0, 1, 1, 1]
    assert x[0, 9] == 0.75 and x[2, [0, 7, 4095]].tolist() == [0.25, 0.25, 0.5] and x[4, 5] == 1
