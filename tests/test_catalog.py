"""Every named query against its SQL counterpart on the smallest sample."""

import pytest
from check_oracles import compare, connect

from notegrove.operators import ivfpq
from notegrove.plans import catalog


@pytest.fixture(scope="module")
def con(folder):
    return connect(folder)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, folder, con, name):
    df = catalog.QUERIES[name](spark, folder)
    if name in catalog.ORACLES:
        assert compare(df, con, catalog.ORACLES[name]) is None
    else:
        assert df.count() > 0


@pytest.fixture
def many_lists(monkeypatch):
    """Indexes of many more lists than a search probes by default, as large tables have."""
    monkeypatch.setattr(ivfpq, "VECTORS_PER_LIST", 2)
    built = {key: made for key, made in catalog._built.items() if key[2] not in ("ann", "doc-ann")}
    monkeypatch.setattr(catalog, "_built", built)


def test_full_probe_of_documents_reads_every_list(spark, folder, con, many_lists):
    for name in ("ann_full_probe", "ann_full_probe_by_country", "ann_full_probe_by_filters"):
        assert compare(catalog.QUERIES[name](spark, folder), con, catalog.ORACLES[name]) is None, name
    assert len(catalog.doc_ann_index(spark, folder).centroids) > 50


def test_full_probe_of_embeddings_reads_every_list(spark, folder, con, many_lists):
    found = catalog.ivf_full_probe(spark, folder)
    assert compare(found, con, catalog.ORACLES["ivf_full_probe"]) is None
    assert len(catalog.ann_index(spark, folder).centroids) > 50


def test_contract(spark):
    import __spark_entry__ as contract

    assert contract.entry(spark).count() > 0
    assert set(contract.oracle_sql()) <= set(contract.queries())
