"""op12 against every item's score for every document, from the contract's formula."""

import math
import random
import re
from collections import Counter

import numpy as np

from fundlake.llm import dual_tree as D
from sf_dirs import SF_SMALL


def brute_force(docs, items, top=10):
    """Rows (item_id, rank, doc_id, score), documents and items as (id, text) rows."""
    def words(text):
        return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in re.findall(D.TERM, text or "")]

    held = [(i, Counter(words(t))) for i, t in docs]
    held = [(i, c, sum(c.values())) for i, c in held if c]
    n_docs, n_terms = len(held), sum(n for *_, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    rows = []
    for item_id, text in items:
        scores = []
        for doc_id, c, n in held:
            m = 100 - 75 + (75 * n * n_docs) // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                    for t in words(text) if t in c)
            if s > 0:
                scores.append((-s, doc_id is not None, doc_id or 0, doc_id))
        rows += [(item_id, r + 1, d, -s) for r, (s, _, _, d) in enumerate(sorted(scores, key=lambda x: x[:3])[:top])]
    return sorted(rows, key=str)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_whole_tables(spark):
    rows = lambda t, i: [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/{t}.parquet").select(i, "text").collect()]
    assert found(D.op12_dual_tree(spark, SF_SMALL)) == brute_force(rows("documents", "doc_id"), rows("benchmark", "item_id"))


def test_random_texts_in_blocks(spark):
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(60)] + ["É", "ñ", "A", "a-b", "x\x00y"]
    text = lambda k: rng.choice([" ", ".", "\n"]).join(rng.choices(vocabulary, [1 / (i + 1) for i in range(65)], k=k))
    docs = [(rng.choice([i, i, None]), text(rng.randint(0, 60))) for i in range(500)]
    docs += docs[:40] + [(9000, None), (9001, ""), (9002, " !? ")]
    items = [(i, text(rng.randint(0, 9))) for i in range(60)] + [(1, "w1 w1 w2"), (1, "w1 w1 w2"), (None, "w3"), (77, None), (78, "unseen")]
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    q = spark.createDataFrame(items, "item_id long, text string")
    expected = brute_force(docs, items)
    assert found(D.rank_documents(d, q)) == expected
    assert found(D.rank_documents(d, q, block_chars=600)) == expected


def test_odd_documents_and_empty_tables(spark, odd_documents):
    items = spark.createDataFrame([(1, "the cat"), (2, "le chien"), (3, "word")], "item_id long, text string")
    expected = brute_force([(r.doc_id, r.text) for r in odd_documents.collect()], [tuple(r) for r in items.collect()])
    assert expected and found(D.rank_documents(odd_documents, items)) == expected
    assert D.rank_documents(odd_documents.limit(0), items).count() == 0
    assert D.rank_documents(odd_documents, items.limit(0)).count() == 0


def _trees(rng, n_items, n_docs, width, dtype):
    def rows(n, k, top):
        picked = [np.sort(rng.choice(width, rng.integers(1, k), replace=False)) for _ in range(n)]
        starts = np.concatenate([[0], np.cumsum([len(p) for p in picked])])
        return D.Sparse(starts, np.concatenate(picked), rng.integers(1, top, starts[-1]))

    q, d = rows(n_items, 8, 9000), rows(n_docs, 12, 900_000)
    full = np.zeros((2, max(n_items, n_docs), width), np.int64)
    for side, s in enumerate((q, d)):
        for i in range(len(s)):
            full[side, i, s.row(i)[0]] = s.row(i)[1]
    return q, d, full[0, :n_items] @ full[1, :n_docs].T


def test_trees_are_exact_and_prune():
    rng = np.random.default_rng(1)
    for dtype in (np.float64, np.int64):
        q, d, scores = _trees(rng, 40, 900, 300, dtype)
        ids = rng.permutation(900)
        search = D.Search(D.ItemTree(q, 300, dtype), np.zeros(40, dtype))
        for at in range(0, 900, 300):
            search.add(D.DocTree(d.take(np.arange(at, at + 300)), ids[at : at + 300], 300, dtype))
        for place, i in enumerate(search.items.order):
            best = sorted((-s, k) for s, k in zip(scores[i].tolist(), ids.tolist()) if s > 0)[:10]
            assert list(zip((-search.scores[place]).astype(int).tolist(), search.ids[place].tolist())) == best
        assert 0 < search.scored < 40 * 900


def test_node_bounds_hold_for_all_below():
    rng = np.random.default_rng(2)
    q, d, scores = _trees(rng, 30, 200, 100, np.int64)
    items, docs = D.ItemTree(q, 100, np.int64), D.DocTree(d, np.arange(200), 100, np.int64)
    for k, item in enumerate(items.nodes):
        codes, largest = items.bounds[k]
        for n, doc in enumerate(docs.nodes):
            below = scores[np.ix_(items.order[item.first : item.last], docs.ids[doc.first : doc.last])]
            assert below.max() <= docs.bounds[n][codes] @ largest


def test_long_weights_use_whole_numbers(spark):
    docs = spark.createDataFrame([(i, "a " * (i + 1) + "b") for i in range(20)], "doc_id long, text string")
    items = spark.createDataFrame([(1, "b " * 2_000_000)], "item_id long, text string")
    assert found(D.rank_documents(docs, items)) == brute_force([tuple(r) for r in docs.collect()], [tuple(r) for r in items.collect()])
