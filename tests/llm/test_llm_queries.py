"""The registered queries against SQL, brute force or invariants."""

import hashlib
import zlib
from collections import Counter

import numpy as np
import pytest
from check_oracles import compare, connect

import corpus_pipeline
from notegrove.llm import bag_minhash, decontaminate, html_extract, queries


@pytest.fixture(scope="module")
def con(folder):
    return connect(folder)


def frame(spark, folder, name, key):
    return queries.table(spark, folder, name).toPandas().set_index(key).sort_index()


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_against_sql(spark, folder, con, name):
    assert compare(queries.QUERIES[name](spark, folder), con, queries.ORACLES[name]) is None


def test_registered(spark):
    import __spark_entry__ as contract

    names = contract.queries()
    assert {f"op{n}" for n in range(1, 14)} == {k.split("_")[0] for k in names if k.startswith("op")}
    assert "pipeline" in names and set(contract.oracle_sql()) <= set(names)


def fold(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


@pytest.mark.parametrize(("name", "label", "threshold", "least"), [("op1_toxicity", "toxic", 0.5, 0.85), ("op9_quality_classifier", "quality", 0.3, 0.95)])
def test_held_out_accuracy(spark, name, label, threshold, least):
    folder = "/root/testdata/sf0.01"
    got = queries.QUERIES[name](spark, folder).toPandas()
    docs = frame(spark, folder, "documents", "doc_id")
    assert sorted(got.doc_id) == sorted(docs.index)
    assert (got.held_out == got.doc_id.map(fold)).all() and got.score.between(0, 1).all()
    assert ((got.score >= threshold).astype(int) == got.predicted).all()
    known = got[got.held_out].merge(frame(spark, folder, "labels", "doc_id").reset_index(), on="doc_id")
    assert (known.predicted == known[label]).mean() >= least


def test_packing(spark, folder):
    from tokenizers import Tokenizer

    got = queries.QUERIES["op4_best_fit_packing"](spark, folder).toPandas()
    plain = Tokenizer.from_file(queries.tokenizer_file())
    docs = frame(spark, folder, "documents", "doc_id")
    for doc_id, pieces in got.groupby("doc_id"):
        ids = np.array([*plain.encode(docs.text[doc_id], add_special_tokens=False).ids, 1], "<u4")
        pieces = pieces.sort_values("piece")
        assert list(pieces.piece) == list(range(len(pieces))) and pieces.length.sum() == len(ids)
        assert list(pieces.start) == list(range(0, len(ids), 4096))
        for p in pieces.itertuples():
            assert zlib.crc32(ids[p.start : p.start + p.length].tobytes()) == p.ids_crc32
    assert set(got.doc_id) == set(docs.index)
    for _, s in got.groupby("sequence_id"):
        s = s.sort_values("offset")
        assert list(s.offset) == [0, *s.length.cumsum()[:-1]] and s.length.sum() <= 4096
    assert got.sequence_id.nunique() <= 1.03 * got.length.sum() / 4096 + 1


def test_decontamination(spark, folder):
    """A plain search for the words of every item in every text."""
    got = queries.QUERIES["op5_benchmark_decontamination"](spark, folder).toPandas()
    docs, items = frame(spark, folder, "documents", "doc_id"), frame(spark, folder, "benchmark", "item_id")
    texts = {d: decontaminate.normal(t) for d, t in docs.text.items()}
    want = {(d, i) for i, t in items.text.items() for d, x in texts.items() if decontaminate.normal(t) in x}
    exact = {(r.doc_id, r.item_id) for r in got.itertuples() if r.distance == 0}
    assert exact == want
    for r in got.itertuples():
        passage, item = decontaminate.normal(docs.text[r.doc_id][r.start : r.stop]), decontaminate.normal(items.text[r.item_id])
        assert r.distance <= len(item) * decontaminate.EDIT_RATE
        assert r.distance or passage == item


def linked_by_force(vectors):
    """Cosines of all pairs of a label."""
    ids = vectors.index.to_numpy()
    links, root = np.zeros(len(ids), int), np.arange(len(ids))
    pairs = []
    for _, group in vectors.groupby("label"):
        at = np.searchsorted(ids, group.index)
        x = np.array([np.asarray(v, float) for v in group.embedding])
        x /= np.linalg.norm(x, axis=1)[:, None]
        i, j = np.nonzero(np.triu(x @ x.T >= 0.93, 1))
        pairs += list(zip(at[i], at[j], strict=True))
    for a, b in pairs:
        links[a] += 1
        links[b] += 1
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            low = min(root[a], root[b])
            changed |= root[a] != low or root[b] != low
            root[a] = root[b] = low
    return links, ids[root]


def test_embeddings(spark):
    """All embeddings of a sample, with near and equal copies added to them."""
    from notegrove.llm import embedding_dedup

    vectors = frame(spark, "/root/testdata/sf0.001", "embeddings", "vec_id").head(200)
    rng = np.random.default_rng(3)
    rows = [(int(i), [float(x) for x in r.embedding], int(r.label)) for i, r in vectors.iterrows()]
    for k in range(120):
        i, v, label = rows[int(rng.integers(0, 40))]
        noise = rng.standard_normal(len(v)) * np.linalg.norm(v) * rng.choice([0, 0.01, 0.03, 0.05]) / 2
        rows.append((1000 + k, [float(x) for x in np.array(v) + noise], label))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = embedding_dedup.near_duplicates(df).toPandas().set_index("vec_id").sort_index()
    links, component = linked_by_force(df.toPandas().set_index("vec_id").sort_index())
    assert links.sum() > 200
    assert got.n_links.sum() >= 0.98 * links.sum() and (got.n_links.to_numpy() <= links).all()
    assert (got.component_id.to_numpy() == component).mean() > 0.98
    assert (got.kept == (got.component_id == got.index)).all()


def components_by_force(texts, least=0.8):
    bags = []
    for t in texts:
        w = bag_minhash._WORD.findall(t.lower())
        bags.append(Counter(tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1 if w else 0))))
    root = list(range(len(texts)))
    for i, a in enumerate(bags):
        for j in range(i):
            b = bags[j]
            n, m = sum(a.values()), sum(b.values())
            if min(n, m) < least * max(n, m):
                continue
            both = sum((a & b).values()) if n else 0
            if texts[i] == texts[j] or n and both >= least * (n + m - both):
                x, y = root[i], root[j]
                root = [min(x, y) if r in (x, y) else r for r in root]
    return root


def test_near_duplicates(spark, folder):
    got = queries.QUERIES["op7_bag_minhash"](spark, folder).toPandas().set_index("doc_id").sort_index()
    docs = frame(spark, folder, "documents", "doc_id")
    root = components_by_force(list(docs.text))
    assert list(got.component_id) == [docs.index[r] for r in root]
    assert (got.kept == (got.component_id == got.index)).all()


def test_main_text(spark, folder):
    """Pages of one known make: the text of the paragraphs and headings of the article."""
    import html
    import re

    got = queries.QUERIES["op10_html_extraction"](spark, folder).toPandas().set_index("page_id")
    for page_id, page in frame(spark, folder, "pages", "page_id").iterrows():
        body = re.search(r"<article>(.*?)</article>", page.html, re.S)[1].replace("<br>", " ")
        blocks = [" ".join(html.unescape(re.sub("<[^>]+>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", body)]
        assert got.text[page_id] == "\n".join(filter(None, blocks))
        assert got.n_chars[page_id] == len(got.text[page_id]) and got.url[page_id] == page.url
    assert html_extract.read_page(None) == ([], [])


def test_pipeline(spark, folder):
    """Every stage against its operator's decisions, row by row."""
    docs = queries.table(spark, folder, "documents")
    assert [k for k, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "decontamination", "secrets", "packing"]
    steps = [docs.toPandas().set_index("doc_id").sort_index()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.schema == docs.schema
        path = spark.createDataFrame(out.collect(), docs.schema)
        docs = path
        steps.append(docs.toPandas().set_index("doc_id").sort_index())
    raw, clean, distinct, safe, hidden = steps
    scores = queries.QUERIES["op1_toxicity"](spark, folder).toPandas().set_index("doc_id")
    assert set(clean.index) == set(scores.index[scores.predicted == 0])
    root = components_by_force(list(clean.text))
    assert list(distinct.index) == [clean.index[i] for i, r in enumerate(root) if i == r]
    items = [decontaminate.normal(t) for t in frame(spark, folder, "benchmark", "item_id").text]
    holds = {d for d, t in distinct.text.items() if any(x in decontaminate.normal(t) for x in items)}
    assert holds and set(safe.index).isdisjoint(holds)
    assert len(distinct) - len(safe) <= 2 * len(holds)
    assert list(hidden.index) == list(safe.index)
    for d, t in hidden.text.items():
        assert len(t) == hidden.n_chars[d]
        assert t == safe.text[d] or "[secret]" in t
    packed = corpus_pipeline.run(spark, folder).toPandas()
    assert set(packed.doc_id) == set(hidden.index)


def test_chat_digests(spark, folder):
    got = queries.QUERIES["op8_chat_formatting"](spark, folder).toPandas().set_index("conv_id")
    turns = queries.table(spark, folder, "conversations").toPandas()
    for conv_id, t in turns.groupby("conv_id"):
        t = t.sort_values("turn")
        learnt = "".join(t.text[t.role == "assistant"])
        assert got.turns_sha256[conv_id] == hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in zip(t.role, t.text, strict=True)).encode()).hexdigest()
        assert got.loss_sha256[conv_id] == hashlib.sha256(learnt.encode()).hexdigest() and got.loss_chars[conv_id] == len(learnt)
