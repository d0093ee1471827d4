import random

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from notegrove.functions.edits import auto_edits, batch_swap_distances, typo_edits
from notegrove.functions.scores import share_of
from notegrove.functions.text import BOUNDED_WORDS, STANDARD, Analyzer, compose
from notegrove.operators import expansion
from notegrove.operators.expansion import expand_words, query_words
from notegrove.operators.keyword import (
    any_match,
    bm25_scores,
    bm25_search,
    min_should_match,
    phrase_match,
    ranked_search,
    with_rows,
)
from notegrove.operators.shards import FAR, Shard
from notegrove.operators.text_index import build_index, open_index
from notegrove.plans.questions import GraphQuestions, KeywordQuestions, RankedQuestions
from notegrove.schema import SearchSpec

ROWS = [
    (1, "Red blend", "a wine of the hills, red and dry", "Merlot", 90, 10.0, "X"),
    (2, "White blend", "dry and crisp", "Riesling", 95, 100.0, "X"),
    (3, "Dry hills", "hills hills hills", None, 80, None, "Y"),
    (4, "Quiet", "It's dry; the red is not", "Red Blend", 85, 30.0, "Y"),
    (5, "Crisp", None, "Riesling", 88, 50.0, "X"),
    (6, "", "...", "", 88, 50.0, "X"),
]
SCHEMA = (
    "id long, title string, description string, variety string, points int, price double, "
    "country string"
)


@pytest.fixture(scope="module")
def reviews(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def index(reviews):
    return build_index(reviews, ["title", "description", "variety"], buckets=4)


def ask(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "qid int, terms string")


def ids(df, qid=0):
    return sorted(r.id for r in df.where(F.col("qid") == qid).collect())


def test_analyzers(spark):
    text = F.lit("It's A LONG-ish naïve text, of 123 extraordinarilylongwords")
    row = spark.range(1).select(
        STANDARD.tokens(text).alias("a"),
        BOUNDED_WORDS.tokens(text).alias("b"),
        Analyzer(stop_words=("of", "a")).tokens(text).alias("c"),
        compose(F.lit(None).cast("string"), F.lit(" x "), F.lit(""), F.lit("y\n")).alias("d"),
    ).first()
    assert row.a == ["it's", "a", "long", "ish", "naïve", "text", "of", "123", "extraordinarilylongwords"]
    assert row.b == ["it's", "long", "ish", "naïve", "text", "123"]
    assert "of" not in row.c and "a" not in row.c
    assert row.d == "x  y"


def test_index_holds_every_token_once(index, reviews):
    listed = F.arrays_zip("ids", "lens", "tfs").alias("p")
    blocks = index.blocks.where("field = 'description'")
    rows = blocks.select("term", F.posexplode(listed).alias("i", "p"), "tfs", "positions").select(
        "term",
        F.col("p.ids").alias("id"),
        F.col("p.lens").alias("len"),
        F.col("p.tfs").alias("tf"),
        F.expr("slice(positions, int(aggregate(slice(tfs, 1, i), 0L, (a, x) -> a + x)) + 1, p.tfs)").alias("positions"),
    ).collect()
    got = {(r.id, r.term): (r.tf, list(r.positions), r.len) for r in rows}
    assert got[(3, "hills")] == (3, [0, 1, 2], 3)
    assert got[(1, "red")] == (1, [5], 8)
    assert (6, "") not in got and not [r for r in rows if r.id in (5, 6)]
    assert sum(r.tf for r in rows) == sum(
        len(r.t) for r in reviews.select(F.coalesce(STANDARD.tokens("description"), F.array()).alias("t")).collect()
    )
    df = {(r.term, r.field): r.df for r in index.term_stats.collect()}
    assert df[("dry", "description")] == 3 and df[("dry", "title")] == 1


def test_index_reopens(spark, index):
    again = open_index(spark, index.path, index.fields)
    assert again.buckets == 4
    assert again.blocks.count() == index.blocks.count() > 0
    other = open_index(spark.newSession(), index.path, index.fields)
    assert other.records.count() == len(ROWS)


def test_phrase_all_any_nest(spark, index):
    asked = ask(spark, "red blend", "dry", "hills hills", "nothing here")
    any_, phrase = any_match(index, asked), phrase_match(index, asked)
    assert ids(any_) == [1, 2, 4] and ids(phrase) == [1, 4]
    assert ids(any_, 1) == ids(phrase, 1) == [1, 2, 3, 4]
    assert ids(phrase, 2) == [3] and ids(any_, 3) == []


def test_minimum_counts_words_in_one_field(spark, index):
    asked = ask(spark, "crisp riesling", "crisp", "dry red", "crips drry", "crips drie")
    found = min_should_match(index, asked, fuzzy=False)
    assert ids(found) == []  # split over two fields
    assert ids(found, 1) == [2, 5]  # a single word is enough for a one-word query
    assert ids(found, 2) == [1, 4]
    fuzzy = min_should_match(index, asked)
    assert ids(fuzzy, 3) == [2]  # neighbours exchanged, and one letter too many
    assert ids(fuzzy, 4) == []  # four letters allow one edit, "drie" needs two


def test_no_budget_means_exact(spark, index):
    asked = ask(spark, "dry red", "ab it")
    words = query_words(asked, STANDARD).select(
        "word", F.lit(0).alias("edits"), F.lit(False).alias("prefix")
    )
    found = expand_words(words, index.vocabulary).collect()
    assert sorted((r.word, r.term, r.typos) for r in found) == [("dry", "dry", 0), ("red", "red", 0)]


def test_budgets(spark):
    words = spark.createDataFrame([("ab",), ("abc",), ("abcde",), ("abcdef",), ("abcdefghi",)], "w string")
    rows = words.select(auto_edits(F.col("w")).alias("a"), typo_edits(F.col("w"), 4, 9).alias("t")).collect()
    assert [r.a for r in rows] == [0, 1, 1, 2, 2]
    assert [r.t for r in rows] == [0, 0, 1, 1, 2]


def slow_swap_distance(a, b):
    if not a or not b:
        return len(a) + len(b)
    best = min(
        slow_swap_distance(a[1:], b) + 1,
        slow_swap_distance(a, b[1:]) + 1,
        slow_swap_distance(a[1:], b[1:]) + (a[0] != b[0]),
    )
    if len(a) > 1 and len(b) > 1 and a[0] == b[1] and a[1] == b[0]:
        best = min(best, slow_swap_distance(a[2:], b[2:]) + 1)
    return best


def words_of(rng, n, letters="abc"):
    return sorted({"".join(rng.choices(letters, k=rng.randint(1, 6))) for _ in range(n)})


def table_swap_distance(a, b):
    before, last = [], list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            cost = min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                cost = min(cost, before[j - 2] + 1)
            row.append(cost)
        before, last = last, row
    return last[-1]


def test_swap_distance_is_right():
    rng = random.Random(5)
    pairs = [(a, b) for a in ["", *words_of(rng, 25)] for b in ["", *words_of(rng, 25)]]
    for (a, b), got in zip(pairs, batch_swap_distances(*map(list, zip(*pairs)))):
        assert got == table_swap_distance(a, b) == slow_swap_distance(a, b), (a, b)


def test_swap_distance_of_long_words():
    """Words of one, two and more machine words, near ones and others, any script."""
    rng, pairs = random.Random(6), []
    for n in (3, 63, 64, 65, 127, 128, 129, 200, 300):
        for letters in ("ab", "abcdé\U0001f600"):
            for _ in range(12):
                a = b = "".join(rng.choices(letters, k=n))
                for _ in range(rng.randint(0, 6)):
                    i = rng.randrange(len(b) or 1)
                    b = rng.choice([b[:i] + b[i + 1 :], b[:i] + rng.choice(letters) + b[i:], b[:i] + b[i : i + 2][::-1] + b[i + 2 :]])
                pairs += [(a, b), (b, a), (a, "".join(rng.choices(letters, k=rng.randint(0, n))))]
    got = batch_swap_distances(*map(list, zip(*pairs)))
    assert list(got) == [table_swap_distance(a, b) for a, b in pairs]


@pytest.mark.parametrize("transpositions", [True, False])
@pytest.mark.parametrize("pushed", [True, False])
def test_expanding_matches_brute_force(spark, monkeypatch, tmp_path, transpositions, pushed):
    rng = random.Random(11)
    vocabulary, asked = words_of(rng, 400, "abcdé"), words_of(rng, 40, "abcdé")
    # Longer than the keys' beginning, with edits before, across and behind its end.
    stem = "thanedblerines"
    vocabulary += [stem, stem + "x", stem[:7] + stem[8:], stem[:7] + stem[8] + stem[7] + stem[9:], stem[1:], "x" + stem[1:], stem[:9] + "zz" + stem[9:]]
    asked += [stem, stem[:6] + stem[7:-1], "zz" + stem]
    wanted = [(w, i % 3, i % 5 == 0) for i, w in enumerate(asked)] + [(stem + "y", 2, True)]
    terms = spark.createDataFrame([(v,) for v in vocabulary + vocabulary[:50]], "term string")
    vocab = expansion.write_vocabulary(terms, str(tmp_path), 3)
    words = spark.createDataFrame(wanted, "word string, edits int, prefix boolean")

    def plain(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, old = [i], row
            for j, y in enumerate(b, 1):
                row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
        return row[-1]

    measure = table_swap_distance if transpositions else plain
    expected = set()
    for w, edits, prefix in wanted:
        for v in vocabulary:
            if prefix and v.startswith(w) and v != w:
                expected.add((w, v, 0, True))
            elif measure(w, v) <= edits:
                expected.add((w, v, measure(w, v), False))
    if not pushed:
        monkeypatch.setattr(expansion, "bounded_rows", lambda df: None)
    rows = expand_words(words, vocab, transpositions).collect()
    assert len(rows) == len(set(rows))
    assert {(r.word, r.term, r.typos, r.by_prefix) for r in rows} == expected
    assert expand_words(words.limit(0), vocab, transpositions).count() == 0


def test_expansion_reads_its_part_of_the_vocabulary(spark, plan, tmp_path):
    terms = spark.range(5000).select(F.format_string("w%05d", "id").alias("term"))
    vocab = expansion.write_vocabulary(terms, str(tmp_path), 32)
    words = spark.createDataFrame([("w00", 0, True)], "word string, edits int, prefix boolean")
    text = plan(expand_words(words, vocab))
    assert "StringStartsWith(term,w00)" in text and "SelectedBucketsCount: 1 out of 32" in text
    assert "deletion" not in text and "Generate" not in text


def test_scores_against_a_plain_computation(spark, index):
    import math

    docs = {
        (r[0], f): [t for t in str(r[c]).lower().replace(",", "").replace(";", "").replace(".", "").split()]
        for r in ROWS
        for f, c in (("title", 1), ("description", 2), ("variety", 3))
        if r[c] and str(r[c]).strip(". ")
    }
    expected = {}
    for field in ("title", "description", "variety"):
        mine = {k[0]: v for k, v in docs.items() if k[1] == field}
        mean = sum(map(len, mine.values())) / len(mine)
        for word in ("dry", "red"):
            df = sum(word in v for v in mine.values())
            for i, v in mine.items():
                if word in v:
                    w = math.log(1 + (len(mine) - df + 0.5) / (df + 0.5))
                    tf = v.count(word)
                    expected[i] = expected.get(i, 0) + w * tf / (tf + 1.2 * (0.25 + 0.75 * len(v) / mean))
    got = {r.id: r.score for r in bm25_scores(index, ask(spark, "dry red")).collect()}
    assert got == pytest.approx({k: round(v, 6) for k, v in expected.items()}, abs=1e-6)


def test_many_query_terms_run_in_blocks(spark, index, reviews, monkeypatch):
    from notegrove.operators import keyword

    asked = ask(spark, "dry red blend", "crisp hills", "quiet", "zzz")
    rows = reviews.select("id", "points")
    small = bm25_search(index, asked, rows).orderBy("qid", "rank").collect()
    msm = {q: ids(min_should_match(index, asked), q) for q in (0, 1)}
    monkeypatch.setattr(keyword, "bounded_rows", lambda df, *a: None)
    monkeypatch.setattr(keyword, "MAX_PARAMETER_ROWS", 4)
    assert bm25_search(index, asked, rows).orderBy("qid", "rank").collect() == small
    assert {q: ids(min_should_match(index, asked), q) for q in (0, 1)} == msm


def test_queries_longer_than_a_machine_word(spark, tmp_path):
    words = [f"w{i}" for i in range(150)]
    rows = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(words[:149]))], "id long, t string")
    index = build_index(rows, ["t"], buckets=4)
    found = min_should_match(index, ask(spark, " ".join(words)), minimum=150, fuzzy=False)
    assert ids(found) == [1]
    assert ids(phrase_match(index, ask(spark, " ".join(words)))) == [1]


SPEC = SearchSpec(
    searchable=("title", "description", "variety"), filterable=("price",), sortable=("points", "price"),
    displayed=("id", "title"), stop_words=("the", "a"),
)


def ranked(spark, index, reviews, text, **kw):
    rows = ranked_search(index, ask(spark, text), reviews.select("id", "points", "price"), spec=SPEC, **kw)
    return {r.id: r for r in rows.collect()}


def test_cascade_values(spark, index, reviews):
    got = ranked(spark, index, reviews, "dry the red", k=10)
    # "dry red" without the stop word; 1: red(5) and dry(7) in the description, reversed
    assert (got[1].words, got[1].proximity, got[1].attribute, got[1].exactness) == (2, 3, 0, 2)
    assert (got[4].words, got[4].proximity, got[4].attribute) == (2, 2, 1)
    assert (got[3].words, got[3].proximity, got[3].attribute) == (1, 8, 0)
    order = sorted(got.values(), key=lambda r: r["rank"])
    assert [r.id for r in order[:2]] == [4, 1]


def test_cascade_typos_and_prefix(spark, index, reviews):
    got = ranked(spark, index, reviews, "cripsy hil", k=10)
    assert got[3].words == 1 and got[3].typos == 0 and got[3].exactness == 0  # prefix only
    got = ranked(spark, index, reviews, "crips", k=10)
    assert {i: r.typos for i, r in got.items()} == {2: 1, 5: 1}


def test_sort_comes_before_exactness_and_points(spark, index, reviews):
    got = ranked(spark, index, reviews, "riesling", sort=[F.asc("points")], k=10)
    assert got[5]["rank"] == 1 and got[2]["rank"] == 2


def test_questions_respect_the_price_bound(spark, index, reviews):
    fuzzy = KeywordQuestions(reviews, index)
    assert [r.id for r in fuzzy.search("dry blend hills", 100).collect()] == [1]
    assert {r.id for r in fuzzy.search("crisp", 100.0).collect()} == {2, 5}
    strict = RankedQuestions(reviews, index, SPEC)
    assert [r.id for r in strict.search("crisp", 100.0).collect()] == [5]
    assert fuzzy.search("zzzzzz").count() == 0
    assert fuzzy.top_by_country("x").first().price_label == "100.0"


def test_graph_questions(spark, index, reviews):
    from notegrove.operators.adjacency import store_graph
    from notegrove.operators.graph import build_graph

    full = reviews.withColumns(
        {c: F.lit(None).cast("string") for c in ("province", "taster_name", "taster_twitter_handle", "winery")}
    )
    asked = GraphQuestions(store_graph(build_graph(full), buckets=2), index)
    found = asked.search("dry", 50.0).collect()
    assert {r.id for r in found} == {1, 4} and all(r.country in "XY" for r in found)
    # The words may stand in any indexed field, not only the variety.
    assert [tuple(r) for r in asked.most_by_variety("red blend", 85).collect()] == [("X", 2), ("Y", 1)]


def test_hits_are_broadcast_only_when_bounded(spark, reviews, plan):
    hits = spark.createDataFrame([(1,)], "id long").repartition(2)
    assert "BroadcastHashJoin" in plan(with_rows(hits, reviews, ["title"], at_most=5))
    assert "BroadcastHashJoin" not in plan(with_rows(hits, reviews, ["title"], at_most=10**9))


def test_postings_scan_is_pruned(spark, index, plan):
    text = plan(bm25_scores(index, ask(spark, "dry red")))
    assert "In(term" in text and "Bucketed: true" in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    read = [line for line in text.split("\n") if "ReadSchema" in line and "tfs" in line]
    assert read and "positions" not in read[0]


def test_only_the_best_are_shuffled(spark, index, plan):
    """Postings and records lie by shard; what moves is k rows per query and task."""
    rows = index.records
    assert "Exchange" not in plan(bm25_scores(index, ask(spark, "dry red"), among=rows))
    assert "Exchange" not in plan(min_should_match(index, ask(spark, "dry red"), fuzzy=False))
    assert "Exchange" not in plan(phrase_match(index, ask(spark, "dry red")))
    with_points = rows.withColumn("points", F.col("id"))
    text = plan(bm25_search(index, ask(spark, "dry red"), with_points))
    tree = text[: text.index("(1) ")]
    assert tree.count("Exchange") == 1 and tree.index("WindowGroupLimit") < tree.index("Exchange") < tree.rindex("WindowGroupLimit")


def test_word_in_every_record_is_in_every_shard(spark):
    rows = spark.range(4000).select("id", F.concat(F.lit("hot w"), F.col("id")).alias("t"))
    index = build_index(rows, ["t"], buckets=8)
    hot = index.blocks.where("term = 'hot'")
    assert hot.agg(F.sum(F.size("ids"))).first()[0] == 4000
    assert hot.select("shard").distinct().count() == index.shards
    assert hot.select(F.input_file_name()).distinct().count() > 4
    assert len(ids(any_match(index, ask(spark, "hot")))) == 4000
    assert ids(phrase_match(index, ask(spark, "hot w17"))) == [17]


@pytest.mark.parametrize("most", [1, 40, 10**6])
def test_shards_larger_than_a_run_are_laid_out_in_order(spark, monkeypatch, most):
    """Whole texts travel to the shards; each run of them gives blocks of ascending ids."""
    from notegrove.operators import text_index

    rng = random.Random(3)
    texts = {i: [rng.choice(["aa", "b", "ç", "dd", f"w{i}"]) for _ in range(rng.randrange(40))] for i in range(150)}
    rows = [(i, " ".join(t), "B aa" if i % 3 else None) for i, t in texts.items()]
    monkeypatch.setattr(text_index, "MOST_TOKENS", most)
    means = {"t": 7.0, "u": 2.0}
    held = {(i, "t"): t for i, t in texts.items() if t} | {(i, "u"): ["b", "aa"] for i in texts if i % 3}
    # Both steps as tasks run them, in one process so that they see the limit.
    frame = spark.createDataFrame(rows, "id long, t string, u string")
    pairs = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("text")) for f in ("t", "u")])
    tokens = frame.select("id", F.inline(pairs)).select("id", "field", STANDARD.tokens(F.col("text")).alias("tokens"))
    batches = tokens.toArrow().combine_chunks().to_batches(max_chunksize=64)
    forward = pa.Table.from_batches(list(text_index.group_tokens(iter(batches))))
    assert forward.num_rows == len(held)
    dealt = forward.append_column("shard", pc.cast(pc.equal(pc.bit_wise_and(forward["id"], 1), 1), pa.int32()))
    dealt = dealt.sort_by([("shard", "ascending"), ("id", "ascending")]).combine_chunks()
    got, seen = {}, {}
    for block in text_index.to_blocks(means)(iter(dealt.to_batches(max_chunksize=50))):
        for b in block.to_pylist():
            key, places = (b["shard"], b["term"], b["field"]), iter(b["positions"])
            assert b["first"] == b["ids"][0] >= seen.get(key, -1) and b["last"] == b["ids"][-1] and len(b["ids"]) <= 128
            seen[key] = b["last"] + 1
            assert b["peak"] == max(share_of(np.array(b["tfs"]), np.array(b["lens"]), means[b["field"]]))
            for i, size, tf in zip(b["ids"], b["lens"], b["tfs"], strict=True):
                assert i % 2 == b["shard"] and (i, b["field"], b["term"]) not in got
                got[i, b["field"], b["term"]] = (size, [next(places) for _ in range(tf)])
            assert next(places, None) is None
    assert got == {(i, f, w): (len(t), [p for p, x in enumerate(t) if x == w]) for (i, f), t in held.items() for w in set(t)}
    # One row a text is what is shuffled, not one row a posting.
    index = build_index(frame, ["t", "u"], buckets=2)
    assert index.forward.count() == len(held)


def test_blocks_without_a_query_are_not_searched(spark, monkeypatch):
    from notegrove.operators import keyword

    wanted = spark.createDataFrame([(1, f"w{i}") for i in range(9)], "qid int, term string")
    monkeypatch.setattr(keyword, "bounded_rows", lambda df, *a: None)
    monkeypatch.setattr(keyword, "MAX_PARAMETER_ROWS", 4)
    assert [len(rows) for rows in keyword._query_blocks(wanted)] == [9]


def test_terms_with_one_beginning_share_its_keys(spark, tmp_path):
    terms = spark.range(500).select(F.format_string("beginning%d", "id").alias("term"))
    one = expansion.write_vocabulary(terms.limit(1), str(tmp_path / "one"), 3)
    many = expansion.write_vocabulary(terms, str(tmp_path / "many"), 3)
    assert many.keys.count() == one.keys.count() > 0 and many.terms.count() == 500


# --- One shard ---


def shard_of(texts, candidates=None):
    """A shard of word lists, in blocks of four postings."""
    rows = []
    for term in sorted({w for t in texts.values() for w in t}):
        held = [(i, len(t), [p for p, w in enumerate(t) if w == term]) for i, t in sorted(texts.items()) if term in t]
        for k in range(0, len(held), 4):
            ids_, lens, places = zip(*held[k : k + 4])
            tfs = [len(p) for p in places]
            peak = max(share_of(np.array(tfs), np.array(lens), 10.0))
            rows.append((term, "t", ids_[0], ids_[-1], peak, ids_, lens, tfs, sum(places, [])))
    names = ["term", "field", "first", "last", "peak", "ids", "lens", "tfs", "positions"]
    blocks = pa.table(dict(zip(names, map(list, zip(*rows)))))
    records = None if candidates is None else pa.table({"id": pa.array(candidates, pa.int64())})
    return Shard(blocks, records, {"t": 10.0})


def random_texts(rng, n):
    weights = [2.0**-i for i in range(12)]
    return {10 * i: rng.choices("abcdefghijkl", weights, k=rng.randint(1, 25)) for i in range(n)}


@pytest.mark.parametrize("k", [1, 5, 40])
def test_cutting_early_loses_nothing(k):
    """The k best and all level with them, as a search without a cut finds them."""
    rng, skipped = random.Random(k), 0
    for _ in range(40):
        texts = random_texts(rng, 200)
        among = sorted(rng.sample(sorted(texts), 150)) + [7]
        terms = [(("abcdefghijkl"[i], "t"), 0.2 + i * i) for i in rng.sample(range(12), rng.randint(1, 8))]
        whole = shard_of(texts, among)
        hits, scores = whole.relevance(terms, None)
        assert set(whole.ids[hits]) == {i for i in among if i in texts and set(texts[i]) & {t for (t, _), _ in terms}}
        cut = shard_of(texts, among)
        best, best_scores = cut.relevance(terms, k)
        skipped += cut.skipped
        floor = sorted(scores)[-k] if len(scores) >= k else 0
        want = {i for i, s in zip(hits, scores) if s >= floor - 1e-9}
        assert want <= set(best)
        assert np.allclose(best_scores[np.isin(best, hits)], scores[np.searchsorted(hits, best)])
    assert skipped > 0 or k == 40


def test_smallest_gaps():
    rng = random.Random(4)
    for _ in range(30):
        texts = random_texts(rng, 40)
        shard = shard_of(texts)
        among = np.array(sorted(rng.sample(range(len(shard.ids)), 20)))
        got = shard.gaps([("a", "t"), ("c", "t")], [("b", "t")], among)
        for i, gap in zip(among, got):
            t = texts[shard.ids[i]]
            lead, follow = ([p for p, w in enumerate(t) if w in s] for s in ("ac", "b"))
            pairs = [b - a if b > a else a - b + 1 for a in lead for b in follow]
            assert gap == min(pairs + [FAR])


def test_cascade_cuts_only_what_is_behind():
    rng = random.Random(9)
    rules = ("words", "typo", "proximity", "attribute", "sort")
    for k in (1, 4, 15):
        texts = random_texts(rng, 120)
        words = {0: [("k", 0, False), ("c", 1, False)], 1: [("b", 0, False)], 2: [("l", 0, False), ("d", 0, True)]}
        shard = shard_of(texts)
        hits, whole = shard.cascade(words, 3, ["t"], rules, 10**6)
        best, cut = shard.cascade(words, 3, ["t"], rules, k)
        key = lambda v, i: (-v["words"][i], v["typos"][i], v["proximity"][i], v["attribute"][i])
        keys = {h: key(whole, i) for i, h in enumerate(hits)}
        last = sorted(keys.values())[k - 1]
        assert {h: key(cut, i) for i, h in enumerate(best)} == {h: x for h, x in keys.items() if x <= last}
