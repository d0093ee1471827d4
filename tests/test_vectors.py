import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from notegrove.functions.vectors import certainty, cosine, unit
from notegrove.operators import ivfpq
from notegrove.operators.embed import HashedEmbedder, OnnxEmbedder, embed
from notegrove.operators.hybrid import fuse, places_in
from notegrove.operators.ivfpq import ann_search, build_ann_index
from notegrove.operators.knn import _slabs, knn, store_queries, stored_blocks
from notegrove.plans.questions import AnnQuestions, StrictVectorQuestions, VectorQuestions

DIM = 16


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(3)
    m = rng.normal(size=(600, DIM)).astype(np.float32)
    m[400:] = m[100]  # a third of the rows are copies of one vector
    return m


@pytest.fixture(scope="module")
def vectors(spark, data):
    rows = [(i, v.tolist(), "A" if i % 2 else "B") for i, v in enumerate(data)]
    return spark.createDataFrame(rows, "id long, vector array<float>, country string").repartition(5)


@pytest.fixture(scope="module")
def queries(spark, data):
    rows = [(f"q{i}", data[i].tolist()) for i in (3, 100, 250)]
    return spark.createDataFrame(rows, "qid string, vector array<float>")


def brute(data, queries, k, keep=None):
    m = data.astype(np.float64)
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    out = {}
    for r in queries.collect():
        q = np.array(r.vector)
        s = np.round(m @ (q / np.linalg.norm(q)), 6)
        ids = [i for i in range(len(m)) if keep is None or keep(i)]
        out[r.qid] = [(i, s[i]) for i in sorted(ids, key=lambda i: (-s[i], i))[:k]]
    return out


def by_query(df):
    out = {}
    for r in df.orderBy("qid", "rank").collect():
        out.setdefault(r.qid, []).append((r.id, r.score))
    return out


def same(a, b):
    assert a.keys() == b.keys()
    for q in a:
        assert [i for i, _ in a[q]] == [i for i, _ in b[q]]
        assert np.allclose([s for _, s in a[q]], [s for _, s in b[q]], atol=2e-6)


def test_exact_search_is_brute_force(vectors, queries, data):
    same(by_query(knn(vectors, queries, 7)), brute(data, queries, 7))


def test_copies_are_ordered_by_id(vectors, queries, data):
    assert [i for i, _ in by_query(knn(vectors, queries, 5))["q100"]] == [100, 400, 401, 402, 403]


def test_blocks_of_queries_agree(vectors, queries):
    whole = by_query(knn(vectors, queries, 5))
    assert by_query(knn(vectors, queries, 5, max_block_bytes=8 * DIM)) == whole


def test_many_queries_take_one_scan(vectors, queries, data, plan, monkeypatch):
    stored = knn(vectors, queries, 7, max_block_bytes=8 * DIM)
    text = plan(stored)
    assert text.count("MapInArrow") == plan(knn(vectors, queries, 7)).count("MapInArrow")
    assert "Union" not in text and "NestedLoop" not in text
    same(by_query(stored), brute(data, queries, 7))
    many = vectors.select(F.concat(F.lit("m"), F.col("id").cast("string")).alias("qid"), "vector")
    monkeypatch.setattr("notegrove.operators.knn.query_blocks", None)  # nothing is collected in blocks
    found = by_query(knn(vectors, many, 1, max_block_bytes=100 * 8 * DIM))
    assert len(found) == len(data)
    assert all(hits[0][0] == (100 if int(q[1:]) >= 400 else int(q[1:])) for q, hits in found.items())


def test_slabs_do_not_change_the_answer(vectors, queries, data):
    path = store_queries(queries, "vector", DIM)
    table = pa.table({"id": np.arange(len(data)), "vector": list(data)})
    table = table.cast(pa.schema([("id", pa.int64()), ("vector", pa.list_(pa.float32()))]))
    batches = table.to_batches(max_chunksize=50)
    sizes = [len(ids) for ids, _ in _slabs(iter(batches), DIM, 8 * DIM * 120)]
    assert sizes == [150] * 4
    names = sorted(r.qid for r in queries.collect())
    for block in (1, 2, 100):
        blocks = list(stored_blocks(path, DIM, block))
        assert max(len(q) for q, _ in blocks) <= block
        assert sorted(n for q, _ in blocks for n in q.to_pylist()) == names


def test_stored_queries_of_a_wrong_length_are_refused(vectors, queries):
    short = queries.unionByName(queries.limit(1).select(F.lit("short").alias("qid"), F.slice("vector", 1, 3).alias("vector")))
    empty = queries.unionByName(queries.limit(1).select(F.lit("none").alias("qid"), F.lit(None).cast("array<float>").alias("vector")))
    for bad in (short, empty):
        with pytest.raises(Exception, match=f"every query vector must have {DIM} numbers"):
            knn(vectors, bad, 3, max_block_bytes=8 * DIM).collect()


def test_filter_before_or_after(vectors, queries, data):
    before = by_query(knn(vectors, queries, 5, prefilter=F.col("country") == "A"))
    same(before, brute(data, queries, 5, keep=lambda i: i % 2))
    hits = knn(vectors, queries, 5).join(vectors.select("id", "country"), "id")
    assert hits.where("country = 'A'").count() < 15


def test_wrong_dimension_is_refused(spark, queries):
    bad = spark.createDataFrame([(1, [1.0, 2.0])], "id long, vector array<float>")
    with pytest.raises(ValueError, match="every query vector must have 2 numbers"):
        knn(bad, queries)
    rows = [(1, [1.0] * DIM), (2, [1.0])]
    mixed = spark.createDataFrame(rows, "id long, vector array<float>").coalesce(1)
    with pytest.raises(Exception, match="every vector must have 16 numbers"):
        knn(mixed, queries).collect()


def test_no_vector_is_shuffled(vectors, queries, plan):
    text = plan(knn(vectors.coalesce(2), queries))
    tail = text[: text.index("MapInArrow")]
    assert "CartesianProduct" not in text and "NestedLoop" not in text
    assert "WindowGroupLimit" in tail


def test_expressions(spark, data):
    a, b = data[0].tolist(), data[1].tolist()
    df = spark.createDataFrame([(a, b, [0.0] * DIM)], "a array<float>, b array<float>, z array<float>")
    row = df.select(
        cosine(F.col("a"), F.col("b")).alias("c"),
        cosine(F.col("a"), F.col("z")).alias("none"),
        unit(F.col("a")).alias("u"),
        unit(F.col("z")).alias("uz"),
        certainty(F.lit(0.5)).alias("sure"),
    ).first()
    x, y = np.array(a), np.array(b)
    assert row.c == pytest.approx(x @ y / np.linalg.norm(x) / np.linalg.norm(y))
    assert row.none is None and row.sure == 0.75
    assert np.linalg.norm(row.u) == pytest.approx(1, abs=1e-6) and row.uz == [0.0] * DIM


@pytest.fixture(scope="module")
def ann(vectors):
    return build_ann_index(vectors, lists=4, subvectors=4, codes=64, rounds=4)


def test_all_lists_probed_without_codes_is_exact(ann, vectors, queries, data):
    same(by_query(ann_search(ann, queries, 7, nprobes=20, quantised=False)), brute(data, queries, 7))


@pytest.mark.parametrize("quantised", [False, True])
def test_all_lists_are_probed_however_many(vectors, queries, data, quantised):
    many = build_ann_index(vectors, lists=30, subvectors=4, codes=64, rounds=1)
    assert len(many.centroids) > 20
    found = by_query(ann_search(many, queries, 600, nprobes=None, refine=1, quantised=quantised))
    same(found, brute(data, queries, 600))
    assert all(len(hits) < 600 for hits in by_query(ann_search(many, queries, 600, quantised=quantised)).values())


def test_codes_with_refinement_find_most(ann, vectors, queries, data):
    got = by_query(ann_search(ann, queries, 5, refine=60))
    want = brute(data, queries, 5)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 12
    assert got["q3"][0] == (3, 1.0)


def test_fewer_probes_read_fewer_lists(ann, queries, plan):
    matrix = ivfpq.unit_rows(np.array([r.vector for r in queries.collect()]))
    near = np.zeros((3, 1), int)
    text = plan(ivfpq.first_pass(ann, pa.array(["a", "b", "c"]), matrix, near, "qid string, id long, score double", 5))
    assert "PartitionFilters: [" in text and "list_id" in text
    read = [line for line in text.split("\n") if "ReadSchema" in line][0]
    assert "codes" in read and "vector" not in read


def test_second_pass_reads_places(ann, queries, plan):
    """Vectors are fetched by place, and the codes alone need no vector at all."""
    text = plan(ann_search(ann, queries, 5, refine=2))
    assert "place" in text and "PushedFilters: [Or(" in text.replace("In(place", "Or(In(place", 1)
    text = plan(ann_search(ann, queries, 5, nprobes=1, refine=None))
    read = [line for line in text.split("\n") if "ReadSchema" in line]
    assert read and not any("vector" in line for line in read)


@pytest.mark.parametrize("zeros", [3, 599, 600])
def test_vectors_without_direction_are_filed(spark, data, queries, zeros):
    """A text without a word embeds as zeros; it trains no centre, but is indexed and found."""
    m = data.copy()
    m[:zeros] = 0
    rows = [(i, v.tolist()) for i, v in enumerate(m)]
    stored = spark.createDataFrame(rows, "id long, vector array<float>").repartition(5)
    index = build_ann_index(stored, lists=4, subvectors=4, codes=64, rounds=2)
    assert index.vectors.rows.count() == 600 and np.isfinite(index.centroids).all()
    want = by_query(knn(stored, queries, 600))
    same(by_query(ann_search(index, queries, 600, quantised=False)), want)
    same(by_query(ann_search(index, queries, 600, refine=2)), want)


@pytest.mark.parametrize("quantised", [False, True])
def test_rows_without_id_come_last_of_equal_ones(spark, data, queries, quantised):
    rows = [(i, v.tolist()) for i, v in enumerate(data)] + [(None, data[100].tolist()), (2**61 + 1, data[100].tolist())]
    stored = spark.createDataFrame(rows, "id long, vector array<float>").repartition(5)
    index = build_ann_index(stored, lists=4, subvectors=4, codes=64, rounds=2)
    found = by_query(ann_search(index, queries, 300, nprobes=None, refine=3, quantised=quantised))["q100"]
    assert [i for i, _ in found[:203]] == [100, *range(400, 600), 2**61 + 1, None]
    assert {s for _, s in found[:203]} == {1.0} and found[203][1] < 1
    named = by_query(ann_search(index, queries, 300, nprobes=None, refine=3, quantised=quantised, named=True))["q100"]
    assert [i for i, _ in named[:202]] == [100, *range(400, 600), 2**61 + 1] and len(named) == 300
    assert None not in {i for i, _ in named}


def test_index_keeps_every_row_once(ann):
    rows = ann.vectors.rows
    assert rows.count() == 600 and rows.select("id").distinct().count() == 600
    assert rows.select("place").distinct().count() == 600
    filed = ann.codes.groupBy("place").count()
    assert filed.count() == 600 and filed.agg(F.max("count")).first()[0] == 2


def test_number_of_lists_follows_the_vectors():
    assert [ivfpq.lists_for(n) for n in (3, 1000, 20_000, 10**6, 10**9)] == [3, 4, 4, 200, 200_000]


@pytest.mark.parametrize("nprobes", [1, 2, 3])
@pytest.mark.parametrize("refine", [None, 4])
def test_against_a_plain_quantiser(ann, queries, data, nprobes, refine):
    """The same lists, codes and books, searched in numpy."""
    m = data.astype(np.float64)
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    centres, books = ann.centroids, ann.books
    place = {r.id: r.place for r in ann.vectors.rows.collect()}
    distance = np.maximum(2 - 2 * m @ centres.T, 0)
    order = np.argsort(distance, axis=1, kind="stable")
    codes = {}
    for i, v in enumerate(m):
        first, second = order[i][:2]
        near = [first] + [second] * int(distance[i, second] <= 1.1**2 * max(distance[i, first], 1e-12))
        for c in near:
            parts = (v - centres[c]).reshape(len(books), -1)
            codes[i, c] = [int(np.argmin(((b - p) ** 2).sum(1))) for p, b in zip(parts, books)]
    want, k = {}, 5
    for r in queries.collect():
        q = np.array(r.vector) / np.linalg.norm(r.vector)
        probed = set(np.argsort(-(q @ centres.T), kind="stable")[:nprobes])
        share = np.einsum("mw,mcw->mc", q.reshape(len(books), -1), books)
        scores = {}
        for (i, c), code in codes.items():
            if c in probed:
                s = round(float(q @ centres[c] + sum(share[j, x] for j, x in enumerate(code))), 6)
                scores[i] = max(s, scores.get(i, -9))
        kept = sorted(scores, key=lambda i: (-scores[i], place[i]))[: k * (refine or 1)]
        final = {i: scores[i] if refine is None else round(float(m[i] @ q), 6) for i in kept}
        want[r.qid] = [(i, final[i]) for i in sorted(final, key=lambda i: (-final[i], i))[:k]]
    got = by_query(ann_search(ann, queries, k, nprobes=nprobes, refine=refine))
    for q, rows in want.items():
        assert np.allclose([s for _, s in got[q]], [s for _, s in rows], atol=2e-6)
        sure = {i for i, s in rows if s > rows[-1][1] + 2e-6}
        assert sure <= {i for i, _ in got[q]}


def test_embedding_is_deterministic_and_unit(spark):
    df = spark.createDataFrame([(1, "Red red wine"), (2, None), (3, "wine RED red")], "id int, t string")
    rows = {r.id: np.array(r.vector) for r in embed(df, "t", HashedEmbedder()).collect()}
    assert rows[1].shape == (384,) and np.array_equal(rows[1], rows[3])
    assert np.linalg.norm(rows[1]) == pytest.approx(1, abs=1e-6) and not rows[2].any()


def test_fusion(spark):
    a = spark.createDataFrame([(0, 1, 1), (0, 2, 2)], "qid int, id long, rank int")
    b = spark.createDataFrame([(0, 2, 1), (0, 3, 2)], "qid int, id long, rank int")
    assert [(r.id, r["rank"]) for r in fuse(a, b).orderBy("rank").collect()] == [(2, 1), (1, 2), (3, 3)]


@pytest.fixture(scope="module")
def wines(spark):
    rows = [
        (1, "North Xland", 85, 100.0, "red and dry"),
        (2, "North Xland", 86, 99.0, "red and dry"),
        (3, "South Yland", 99, 10.0, "red"),
        (4, "North Xland", 99, None, "white"),
    ]
    df = spark.createDataFrame(rows, "id long, country string, points int, price double, t string")
    return embed(df, "t", HashedEmbedder()).drop("t")


def test_vector_questions(wines):
    loose, strict = VectorQuestions(wines, HashedEmbedder()), StrictVectorQuestions(wines, HashedEmbedder())
    assert [r.id for r in loose.search("Dry RED and", 2).orderBy("rank").collect()] == [1, 2]
    assert {r.id for r in loose.search_by_filters("red", "North Xland").collect()} == {1, 2}
    assert {r.id for r in strict.search_by_filters("red", "xland").collect()} == {2}
    assert loose.count_by_country("North Xland").first()["count"] == 3
    assert loose.count_by_country("xland").first()["count"] == 0
    assert strict.count_by_country("xland").first()["count"] == 3
    assert loose.count_by_filters("North Xland").first()["count"] == 2
    assert strict.count_by_filters("North Xland").first()["count"] == 1
    row = loose.search("red and dry", 1).first()
    assert row.certainty == pytest.approx((1 + row.score) / 2)


def test_approximate_questions_filter_afterwards(wines):
    index = build_ann_index(wines, lists=2, subvectors=32, codes=4, rounds=2)
    asked = AnnQuestions(wines, HashedEmbedder(), index)
    assert {r.id for r in asked.search("red and dry", 2).collect()} == {1, 2}
    assert asked.search_by_country("red and dry", "South Yland", 2).count() == 0
    assert asked.count_by_country("South Yland").first()["count"] == 1


def field(number, kind, payload):
    head = bytes([number << 3 | kind])
    if kind == 0:
        return head + varint(payload)
    return head + varint(len(payload)) + payload


def varint(n):
    out = b""
    while n > 127:
        out, n = out + bytes([n & 127 | 128]), n >> 7
    return out + bytes([n])


def tiny_model(table):
    """An ONNX file with one lookup: token ids to rows of ``table``."""

    def shape(*dims):
        return b"".join(field(1, 2, field(2, 2, d) if isinstance(d, bytes) else field(1, 0, d)) for d in dims)

    def value(name, kind, *dims):
        tensor = field(1, 0, kind) + field(2, 2, shape(*dims))
        return field(1, 2, name) + field(2, 2, field(1, 2, tensor))

    weights = (
        field(1, 0, table.shape[0]) + field(1, 0, table.shape[1]) + field(2, 0, 1)
        + field(8, 2, b"table") + field(9, 2, table.astype("<f4").tobytes())
    )
    node = field(1, 2, b"table") + field(1, 2, b"input_ids") + field(2, 2, b"out") + field(4, 2, b"Gather")
    graph = (
        field(1, 2, node) + field(2, 2, b"g") + field(5, 2, weights)
        + field(11, 2, value(b"input_ids", 7, b"n", b"t"))
        + field(12, 2, value(b"out", 1, b"n", b"t", table.shape[1]))
    )
    return field(1, 0, 8) + field(7, 2, graph) + field(8, 2, field(1, 2, b"") + field(2, 0, 13))


@pytest.mark.parametrize("pooling", ["first", "mean"])
def test_onnx_model(spark, tmp_path, pooling):
    pytest.importorskip("onnxruntime")
    tokenizers = pytest.importorskip("tokenizers")
    table = np.arange(20, dtype=np.float32).reshape(5, 4)
    (tmp_path / "m.onnx").write_bytes(tiny_model(table))
    words = tokenizers.models.WordLevel({"[PAD]": 0, "red": 1, "dry": 2, "wine": 3, "[UNK]": 4}, "[UNK]")
    tokenizer = tokenizers.Tokenizer(words)
    tokenizer.pre_tokenizer = tokenizers.pre_tokenizers.Whitespace()
    tokenizer.save(str(tmp_path / "t.json"))
    model = OnnxEmbedder(str(tmp_path / "m.onnx"), str(tmp_path / "t.json"), dim=4, pooling=pooling, batch=2)
    df = spark.createDataFrame([(1, "Red wine"), (2, "dry"), (3, "dry red wine")], "id int, t string")
    got = {r.id: r.vector for r in embed(df, "t", model).collect()}
    if pooling == "first":
        assert got == {1: table[1].tolist(), 2: table[2].tolist(), 3: table[2].tolist()}
    else:
        assert got[1] == pytest.approx(table[[1, 3]].mean(axis=0).tolist())
        assert got[2] == table[2].tolist()


def test_long_texts_are_embedded_whole(tmp_path):
    pytest.importorskip("onnxruntime")
    tokenizers = pytest.importorskip("tokenizers")
    table = np.arange(20, dtype=np.float32).reshape(5, 4)
    (tmp_path / "m.onnx").write_bytes(tiny_model(table))
    words = tokenizers.models.WordLevel({"[PAD]": 0, "red": 1, "dry": 2, "wine": 3, "[UNK]": 4}, "[UNK]")
    tokenizer = tokenizers.Tokenizer(words)
    tokenizer.pre_tokenizer = tokenizers.pre_tokenizers.Whitespace()
    tokenizer.save(str(tmp_path / "t.json"))
    model = OnnxEmbedder(str(tmp_path / "m.onnx"), str(tmp_path / "t.json"), dim=4, pooling="mean", max_tokens=3, batch=2)
    model.load()
    got = model.encode(["red red dry wine dry dry wine", "wine", ""])
    assert got[0] == pytest.approx(table[[1, 1, 2, 3, 2, 2, 3]].mean(axis=0))
    assert got[1] == pytest.approx(table[3])


def test_words_of_any_script_count(spark):
    df = spark.createDataFrame([(1, "café crème"), (2, "caf cr me"), (3, "ワイン"), (4, "Café CRÈME")], "id int, t string")
    got = {r.id: np.array(r.vector) for r in embed(df, "t", HashedEmbedder()).collect()}
    assert (got[1] == got[4]).all() and (got[1] != got[2]).any() and got[3].any()


def test_too_few_vectors_for_the_codes(spark):
    vectors = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(10)], "id long, vector array<float>")
    with pytest.raises(ValueError, match="too few"):
        build_ann_index(vectors, lists=2, subvectors=2, codes=64)


def test_places_in_a_whole_list(spark):
    rows = [(i, float((i * 7) % 13)) for i in range(100)]
    scored = spark.createDataFrame(rows, "id long, score double")
    order = sorted(rows, key=lambda r: (-r[1], r[0]))
    want = {r[0]: i + 1 for i, r in enumerate(order)}
    got = {r.id: r.rank for r in places_in(scored, [3, 50, 99, 12, 777], [-F.col("score"), F.col("id")]).collect()}
    assert got == {i: want[i] for i in (3, 50, 99, 12)}


def test_embedding_takes_few_texts_at_a_time(spark):
    """A batch of Arrow may hold thousands of long texts; a model gets slices of it."""
    from notegrove.operators.embed import TEXTS_AT_ONCE

    class Sizes:
        dim = 2

        def load(self):
            pass

        def encode(self, texts):
            return np.array([[len(texts), len(t)] for t in texts], dtype=float)

    rows = spark.range(0, 1000, 1, 1).select("id", F.when(F.col("id") != 7, F.concat(F.lit("A"), "id")).alias("t"))
    got = {r.id: r.v for r in embed(rows, "t", Sizes(), "v").collect()}
    assert len(got) == 1000 and max(v[0] for v in got.values()) <= TEXTS_AT_ONCE
    assert got[7][1] == 0 and got[999][1] == 4
    assert embed(rows.limit(0), "t", Sizes(), "v").count() == 0


def test_training_keeps_a_bounded_number_of_vectors_a_task(spark, monkeypatch, tmp_path):
    """Equal vectors shrink to a small file, one split of it; in memory they do not."""
    rows = spark.range(0, 3000, 1, 1).select("id", F.array([F.lit(1.0).cast("float")] + [(F.col("id") % 7).cast("float")] * 7).alias("vector"))
    rows.write.parquet(str(tmp_path / "v"))
    stored = spark.read.parquet(str(tmp_path / "v"))
    monkeypatch.setattr(ivfpq, "VECTORS_PER_TASK", 100)
    sizes = []
    parts = ivfpq.training_parts

    def spy(*args):
        dealt = parts(*args)
        sizes.extend(dealt.rdd.mapPartitions(lambda p: [sum(1 for _ in p)]).collect())
        return dealt

    monkeypatch.setattr(ivfpq, "training_parts", spy)
    index = build_ann_index(stored, lists=4, subvectors=2, codes=4, rounds=1)
    assert sum(sizes) == 3000 and max(sizes) <= 200 and index.vectors.rows.count() == 3000
    assert parts(stored, 50).rdd.getNumPartitions() == stored.rdd.getNumPartitions()
