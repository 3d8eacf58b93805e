"""Operators over documents against brute force, and on odd and empty tables."""

import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from fundlake.llm import context_tree, fast_sketch_dedup, mil_toxicity, nbsvm_quality, ppm_langid, raking, spaced_seeds, token_store, wavelet
from fundlake.llm.wavelet import WaveletMatrix, encode_shard

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id long, text string"


def test_context_tree_against_sums_over_all_contexts(spark):
    texts = ["the cat the hat", "a cat", "The  that\tthe", "", None, "zebra the cat cat"]
    learn = [True, True, False, True, True, False]
    depth = context_tree.DEPTH
    df = spark.createDataFrame(list(zip(range(6), texts, learn)), f"{DOCS}, l boolean")
    got = context_tree.score_documents(df, F.col("l")).orderBy("doc_id").collect()

    def decisions(text):
        words = WORD.findall((text or "").translate(LOWER))
        stream = b"\n" * depth + b"".join(w.encode() + b" " for w in words) + b"\n"
        for i in range(depth, len(stream)):
            for j in range(8):
                yield stream[i - depth : i], (1 << j) | (stream[i] >> (8 - j)), (stream[i] >> (7 - j)) & 1

    counts = {}
    for text, known in zip(texts, learn):
        for context, bits, bit in decisions(text) if known else ():
            for d in range(depth + 1):
                counts.setdefault((context[depth - d :], bits), [0, 0])[bit] += 1

    def kt(node):
        a, b = counts[node]
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    def weighted(node):
        if node not in counts or len(node[0]) == depth:
            return kt(node) if node in counts else 0.0
        longer = sum(weighted((bytes([x]) + node[0], node[1])) for x in range(256))
        return np.logaddexp(kt(node), longer) - math.log(2)

    def one(context, bits):
        mixed, rest, last = 0.0, 1.0, 0.5
        for d in range(depth + 1):
            node = (context[depth - d :], bits)
            if node not in counts:
                break
            last = (counts[node][1] + 0.5) / (sum(counts[node]) + 1)
            stop = 1.0 if d == depth else math.exp(kt(node) - math.log(2) - weighted(node))
            mixed, rest = mixed + rest * stop * last, rest * (1 - stop)
        return mixed + rest * last

    train = [w for t, k in zip(texts, learn) if k for w in [*WORD.findall((t or "").translate(LOWER)), "\n"]]
    for row, text in zip(got, texts):
        score = sum(math.log10(p if bit else 1 - p) for c, b, bit in decisions(text) for p in [one(c, b)])
        words = [*WORD.findall((text or "").translate(LOWER)), "\n"]
        base = sum(math.log10((train.count(w) + 1) / (len(train) + len(set(train)) + 1)) for w in words)
        assert row.score == pytest.approx(score, abs=1e-5) and row.base_score == pytest.approx(base, abs=1e-9)
        assert (row.n_tokens, row.n_known, row.train_tokens) == (len(words), sum(w in train for w in words), len(train))


def brute_components(texts):
    sets = {}
    for i, t in texts:
        w = WORD.findall((t or "").translate(LOWER))
        sets[i] = {tuple(w[k : k + 4]) for k in range(len(w) - 3)} if len(w) > 3 else ({tuple(w)} if w else set())
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(sets[i]), find(i)) for i in sets}


def test_near_duplicates_against_all_pairs(spark):
    """Copies with growing edits: some are linked with the first text, some with
    others of the group only, some with none."""
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(500)]
    texts = []
    for _ in range(4):
        base = rng.choices(vocabulary, k=150)
        for copy in range(45):
            words = list(base)
            for _ in range(rng.choice([0, 1, 2, 5, 9])):
                at = rng.randrange(len(words))
                words[at : at + 1] = [rng.choice(vocabulary)] if rng.random() < 0.6 else []
            texts.append((len(texts), " ".join(words).upper() if copy % 7 == 0 else " ".join(words)))
    got = fast_sketch_dedup.near_duplicates(spark.createDataFrame(texts, DOCS)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_components(texts)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_sketch_fills_every_coordinate_and_estimates_similarity():
    rng = np.random.default_rng(5)
    pool = rng.integers(0, 2**63, 1200).astype(np.uint64)
    sets = [np.sort(pool[:1000]), np.sort(pool[200:]), pool[:1], pool[:0]]
    offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    made = fast_sketch_dedup.sketch(np.concatenate(sets), offsets)
    assert (made[:3] != fast_sketch_dedup.EMPTY).all() and (made[3] == fast_sketch_dedup.EMPTY).all()
    assert abs((made[0] == made[1]).mean() - 800 / 1200) < 0.15


def test_no_substitutions_a_window_may_have_hide_it_from_all_masks():
    from itertools import combinations

    window, span = spaced_seeds.WINDOW, spaced_seeds.SPAN
    may = window - -(-spaced_seeds.SHARE * window // 100)
    for changed in combinations(range(window), may):
        assert any(not set(changed) & {at + p for p in mask} for mask in spaced_seeds.MASKS for at in range(window - span + 1)), changed


def test_every_pair_of_substitutions_in_a_copied_window_is_found(spark):
    """All 78 pairs in 13 copied words of an item of 20, other words around them."""
    from itertools import combinations

    item = [f"w{i}" for i in range(20)]
    docs = []
    for n, changed in enumerate(combinations(range(13), 2)):
        copied = [f"x{n}" if i in changed else w for i, w in enumerate(item[4:17])]
        docs.append((n, " ".join([f"a{n}", *copied, f"b{n}"])))
    items = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    got = spaced_seeds.overlaps(spark.createDataFrame(docs, DOCS), items).collect()
    assert len(docs) == 78 and sorted((r.doc_id, r.matched, r.start) for r in got) == [(n, 11, -3) for n in range(78)]


def test_spaced_seeds_tolerate_substitutions(spark):
    rng = random.Random(1)
    item = [f"b{i}" for i in range(30)]
    spoiled = [w if i % 8 else "other" for i, w in enumerate(item)]
    noise = lambda n: [f"n{rng.randrange(10**6)}" for _ in range(n)]
    docs = [(1, " ".join(noise(50) + item + noise(5))), (2, " ".join(noise(9) + spoiled)), (3, " ".join(noise(80))),
            (4, " ".join(item[:8] + noise(40))), (5, " ".join(noise(5000) + item)), (6, None)]
    items = spark.createDataFrame([(9, " ".join(item).upper()), (8, "too short"), (7, None)], "item_id long, text string")
    for bound in (10**6, 0):  # broadcast seeds, and shuffled ones
        got = {(r.doc_id, r.item_id, r.start) for r in spaced_seeds.overlaps(spark.createDataFrame(docs, DOCS), items, bound).collect()}
        assert got == {(1, 9, 50), (2, 9, 9), (5, 9, 5000)}


def test_raking_meets_its_targets(spark):
    rng = random.Random(2)
    cells = [(s, lang, t, rng.randint(50, 5000)) for s in "abc" for lang in ("x", "y") for t in range(3)]
    raked = raking.rake(spark.createDataFrame(cells, "source string, lang string, topic int, tokens long"), sweeps=40).collect()
    for margin in raking.MARGINS:
        sums = {}
        for r in raked:
            sums.setdefault(r[margin], [0.0, r[f"to_{margin}"]])[0] += r["weight"]
        assert all(a == pytest.approx(b, rel=1e-3) for a, b in sums.values())


def test_wavelet_matrix_round_trip():
    rng = np.random.default_rng(1)
    for ids in (np.zeros(0, int), np.array([5]), np.array([7] * 9), rng.integers(0, 3, 50), rng.zipf(1.3, 4000) % 49408):
        matrix = WaveletMatrix(encode_shard(ids.astype(np.uint32), np.array([1]), np.array([len(ids)])))
        assert (matrix.decode() == ids).all()
        assert [matrix.access(i) for i in range(0, len(ids), 37)] == ids[::37].tolist()
        for token in {*ids[:12].tolist(), 99999}:
            places = np.flatnonzero(ids == token)
            assert matrix.count(token) == len(places) and matrix.select(token, len(places)) == -1
            for k in range(0, len(places), 9):
                assert matrix.select(token, k) == places[k] and matrix.rank(token, int(places[k])) == k


def test_token_store_equals_the_tokenizer(spark, odd_documents):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(token_store.tokenizer_path())
    extra = [(20, "Don't ÉCOLE café!? <|endoftext|> x<|ENDOFTEXT|> a1b2 ﬁ ét x ΣΑΣ it's, ZZ__top??"), (21, "ß*** Ab*** straße...")]
    docs = odd_documents.select("doc_id", "text").unionAll(spark.createDataFrame(extra, DOCS))
    got = token_store.store_tokens(spark, docs).orderBy("start").collect()
    start = 0
    rows = sorted(docs.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text or ""))
    assert len(got) == len(rows)
    for row, doc in zip(got, rows):
        ids = np.array([*tokenizer.encode(doc.text or "", add_special_tokens=False).ids, 2], "<u4")
        assert (row.doc_id, row.start, row.n_tokens, row.ids_crc32) == (doc.doc_id, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_hinge_weights_reach_the_smallest_loss():
    """The regularised hinge loss of the fit, against a long run of subgradient steps."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(60, 6))
    y = (x[:, 0] - 0.5 * x[:, 1] + rng.normal(scale=0.8, size=60) > 0.3).astype(int)
    rows = [(np.arange(6), v) for v in x]
    costs, sign = nbsvm_quality.row_costs(y), np.where(y == 1, 1.0, -1.0)
    full = np.hstack([x, np.ones((60, 1))])

    def loss(w):
        return 0.5 * w @ w + costs @ np.maximum(0, 1 - sign * (full @ w))

    fitted = nbsvm_quality.dual_coordinate_descent(rows, y, 6, epochs=2000)
    w, best = np.zeros(7), np.inf
    for t in range(1, 40_001):
        w -= (w - full.T @ (costs * sign * (sign * (full @ w) < 1))) / t
        best = min(best, loss(w))
    assert loss(fitted) == pytest.approx(best, rel=1e-3)


def test_blocks_of_a_hub_are_compared_in_slices(monkeypatch):
    """Members of one hub, their differences cut into slices of seven, against sets."""
    import pandas as pd

    rng = random.Random(3)
    hub = set(range(200))
    members = []
    for i in range(40):
        kept = hub - set(rng.sample(sorted(hub), rng.randint(0, 40)))
        members.append(kept | set(rng.sample(range(200, 260), rng.randint(0, 30))))
    block = pd.DataFrame({
        "id": range(40), "root": range(40), "side": [i % 2 for i in range(40)], "hub_size": 200,
        "added": [sorted(m - hub) for m in members], "removed": [sorted(hub - m) for m in members],
    })
    monkeypatch.setattr(fast_sketch_dedup, "KINDS", 7)
    got = {tuple(r) for r in fast_sketch_dedup.confirm_block(block).itertuples(index=False)}
    assert got == {(i, j) for i in range(0, 40, 2) for j in range(1, 40, 2) if 100 * len(members[i] & members[j]) >= 80 * len(members[i] | members[j])}


def test_words_by_rank_equal_the_tokenizer():
    """Every entry of the file and random plain, odd and accented words."""
    import json

    from tokenizers import Tokenizer

    path = token_store.tokenizer_path()
    tokenizer, encoder = Tokenizer.from_file(path), token_store.WordEncoder(path)
    assert encoder.ranked
    alphabet = token_store.byte_level_alphabet()
    with open(path, encoding="utf-8") as f:
        entries = [bytes(alphabet[c] for c in e.removesuffix("</w>")).decode("utf-8", "replace") for e in json.load(f)["model"]["vocab"]]
    rng = random.Random(6)
    marks = "aAbcdeéßüöñÿçtheingon019'!?.,-_<|>&#\u2019日本ﬁ́\x00\x01"
    words = [e for e in entries if e.split() == [e]]
    words += ["".join(rng.choices(marks, k=rng.randint(1, 14))) for _ in range(20_000)]
    words += ["".join(rng.choices("aeiounrstlhdcm", k=rng.randint(1, 18))) for _ in range(20_000)]
    ids, offsets = encoder.words(pa.array(words, pa.large_string()))
    expected = [e.ids for e in tokenizer.encode_batch(words, add_special_tokens=False)]
    assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == expected


def test_words_of_every_case_equal_the_tokenizer():
    """Latin capitals, marks and digits, and what only looks or lower-cases like them."""
    from tokenizers import Tokenizer

    path = token_store.tokenizer_path()
    tokenizer, encoder = Tokenizer.from_file(path), token_store.WordEncoder(path)
    latin = [chr(c) for c in range(0xA1, 0x180)]
    near = ["\u212a", "\u212b", "\u0130", "\u1e9e", "\u0301", "\u0308", "\u03a3", "\u00ad", "\u01c5", "'", "'S", "\x00", "\x1f", "\x7f"]
    rng = random.Random(7)
    words = latin + near + [a + b for a in latin[::3] + near for b in ("e", "E", "7", "%%%", "\u00c9")]
    words += ["".join(rng.choices(latin[31:95] + near + list("aEiO09.,!$%<|"), k=rng.randint(1, 12))) for _ in range(20_000)]
    ids, offsets = encoder.words(pa.array(words, pa.large_string()))
    expected = [e.ids for e in tokenizer.encode_batch(words, add_special_tokens=False)]
    assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == expected
    for few in (["\u00c9", "a1"], ["it's"], []):
        ids, offsets = encoder.words(pa.array(few, pa.large_string()))
        expected = [e.ids for e in tokenizer.encode_batch(few, add_special_tokens=False)]
        assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == expected


def test_parts_of_words_are_encoded_once(monkeypatch):
    """A part that many words share is merged once; capitals do not need the tokenizer."""
    encoder = token_store.WordEncoder(token_store.tokenizer_path())
    seen, ranks = [], encoder._ranks
    monkeypatch.setattr(encoder, "_ranks", lambda text: seen.extend(text.split("\x00")) or ranks(text))
    asked = []

    class Library:
        def encode_batch(self, texts, **_):
            asked.extend(texts)
            return []

    monkeypatch.setattr(encoder, "tokenizer", Library())
    words = ["Thorhaan", "thorhaan.", "thorhaan%%%", "(thorhaan)", "\u00c9cole.", "\u00e9cole%%%", "11"]
    _, offsets = encoder.words(pa.array(words, pa.large_string()))
    assert not asked and (np.diff(offsets) > 0).all()
    assert sorted(filter(None, seen)) == sorted(["thorhaan", ".", "%%%", "(", ")", "\u00e9cole", "1"])


def test_ids_are_counted_without_sorting(monkeypatch):
    rng = np.random.default_rng(8)
    small = (rng.zipf(1.3, 5000) % 49408).astype(np.uint32)
    for ids in (small, np.append(small, np.uint32(wavelet.DENSE + 1)), np.zeros(0, np.uint32), np.array([wavelet.DENSE], np.uint32)):
        symbols, inverse, counts = np.unique(ids, return_inverse=True, return_counts=True)
        got = wavelet.distinct(ids)
        assert [x.tolist() for x in got] == [symbols.tolist(), inverse.tolist(), counts.tolist()]
        matrix = WaveletMatrix(encode_shard(ids, np.array([1]), np.array([len(ids)])))
        assert (matrix.decode() == ids).all()
    monkeypatch.setattr(np, "unique", None)  # a vocabulary's ids do not need it
    assert (WaveletMatrix(encode_shard(small, np.array([1]), np.array([5000]))).decode() == small).all()


def test_ppm_code_lengths_against_byte_loops():
    model = ppm_langid.PpmModel({"a": ["the cat then the hat"], "b": ["der hut und der hund"]})
    samples = {"a": "the cat then the hat", "b": "der hut und der hund"}
    for i, lang in enumerate(model.langs):
        counts = {}
        for word in samples[lang].split():
            s = word.encode() + b" "
            for at in range(len(s)):
                for k in range(min(ppm_langid.ORDER, at) + 1):
                    counts.setdefault(s[at - k : at], {}).setdefault(s[at], 0)
                    counts[s[at - k : at]][s[at]] += 1
        for word in ("the", "hund", "zzz", "hutch"):
            s, bits = word.encode() + b" ", 0.0
            for at in range(len(s)):
                for k in range(min(ppm_langid.ORDER, at), -2, -1):
                    seen = counts.get(s[at - k : at]) if k >= 0 else None
                    if k < 0:
                        bits -= 8
                    elif seen and s[at] in seen:
                        bits += math.log2(seen[s[at]] / (sum(seen.values()) + len(seen)))
                        break
                    elif seen:
                        bits += math.log2(len(seen) / (sum(seen.values()) + len(seen)))
            assert model.word_log2(pa.array([word]))[0][0, i] == pytest.approx(bits)


def held_out(rows, label_rows, column, bucket, buckets):
    labels = {r.doc_id: r[column] for r in label_rows}
    return [(r, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet").collect()
    found = held_out(nbsvm_quality.op10_nbsvm_quality(spark, sf).collect(), labels, "quality", 2, 4)
    assert np.mean([r.predicted == y for r, y in found]) > 0.9
    toxic = mil_toxicity.op5_mil_toxicity(spark, sf).collect()
    found = held_out(toxic, labels, "toxic", 0, 5)
    assert np.mean([r.predicted == y for r, y in found]) > 0.88
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    found = [r for r in ppm_langid.op7_ppm_langid(spark, sf).collect() if r.held_out]
    assert np.mean([r.lang_pred == langs[r.doc_id] for r in found]) > 0.97


def test_toxic_sentence_is_located():
    bad, good = "You are an idiot today.", "The sky is blue."
    texts = [f"{good} {bad} {good}" if i % 3 == 0 else f"{good} {good}" for i in range(300)]
    model = mil_toxicity.MilModel(texts, np.array([i % 3 == 0 for i in range(300)], int))
    _, p, q = model.sentences(pa.array([f"{good} {good}\n{bad} {good}", good, None]))
    assert p[:4].argmax() == 2 and q[0] > 0.5 > q[1] and q[2] == 0


def test_odd_documents(spark, odd_documents):
    n = odd_documents.count()
    scored = context_tree.score_documents(odd_documents, F.lit(True)).collect()
    assert len(scored) == n and {r.n_tokens for r in scored if r.doc_id in (2, 3, 4)} == {1}
    state = {r.doc_id: r for r in fast_sketch_dedup.near_duplicates(odd_documents).collect()}
    assert len(state) == n - 1 and not state[None].kept and state[None].component_id is None
    assert all(state[i].n_shingles == 0 and state[i].kept for i in (2, 3, 4))
    mixed = raking.mix(odd_documents).collect()
    assert len(mixed) == n and all(r.probability == 0 and not r.sampled for r in mixed if r.doc_id in (2, 3, 4))
    model = ppm_langid.PpmModel({"en": ["the cat sat on the mat"], "fr": ["le chat est sur la table"]})
    langs = {r.doc_id: r.lang_pred for r in ppm_langid.identify(odd_documents, model).collect()}
    assert [langs[i] for i in (2, 3, 4, 5)] == ["und"] * 4 and langs[6] == "fr"
    for model in (nbsvm_quality.NbSvm([], np.zeros(0, int)), nbsvm_quality.NbSvm(["a b", "c"] * 9, np.array([0, 1] * 9))):
        assert nbsvm_quality.classify(odd_documents, model).count() == n
    assert mil_toxicity.locate(odd_documents, mil_toxicity.MilModel([], np.zeros(0, int))).count() == n


def test_empty_tables(spark, odd_documents):
    none = odd_documents.limit(0)
    items = spark.createDataFrame([], "item_id long, text string")
    assert context_tree.score_documents(none, F.lit(True)).count() == 0
    assert fast_sketch_dedup.near_duplicates(none).count() == 0
    assert raking.mix(none).count() == 0
    assert spaced_seeds.overlaps(none, items).count() == 0
    assert spaced_seeds.overlaps(odd_documents, items).count() == 0
    assert token_store.store_tokens(spark, none).count() == 0
    assert ppm_langid.identify(odd_documents, ppm_langid.fit(none)).where("lang_pred <> 'und'").count() == 0


def test_pipeline_stages(spark, odd_documents):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = docs.limit(1).withColumn("doc_id", F.lit(10**9))  # an exact copy
    docs = docs.unionByName(extra)
    sizes = [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, SF)
        if name != "tokens":
            assert after.columns == docs.columns
        if name == "near_duplicates":
            want = brute_components([(r.doc_id, r.text) for r in docs.collect()])
            assert sorted(r.doc_id for r in after.collect()) == sorted(i for i, (_, root) in want.items() if root == i)
        docs = after
        sizes.append(docs.count())
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] == sizes[-2] > 0


def test_length_alone_is_not_toxic(spark):
    bad, good = "You are an idiot today.", "The sky is blue."
    texts = [f"{good} {bad} {good}" if i % 3 == 0 else f"{good} {good}" for i in range(300)]
    model = mil_toxicity.MilModel(texts, np.array([i % 3 == 0 for i in range(300)], int))
    long = " ".join([good] * 20_000)
    assert model.score(pa.array([long, f"{long} {bad}"])).round(3).tolist() == pytest.approx([0.0, 1.0], abs=0.2)
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()
    found = held_out(mil_toxicity.op5_mil_toxicity(spark, "/root/testdata/sf0.01").collect(), labels, "toxic", 0, 5)
    assert np.mean([r.predicted for r, y in found if y == 1]) > 0.6


def test_short_benchmark_items_are_found_with_all_allowed_substitutions(spark):
    """Items of 1 to 14 words: every substitution that the verification accepts, and none that it refuses."""
    items, docs, want, word = [], [], set(), iter(range(10**6))
    for n in range(1, 15):
        item = [f"i{n}x{k}" for k in range(n)]
        items.append((n, "  " + " ".join(item).upper() + "\n"))
        for wrong in [(), *[(a,) for a in range(n)], *[(a, b) for a in range(n) for b in range(a)], *([(0, 1, 2)] if n > 2 else [])]:
            text = [f"q{next(word)}" if k in wrong else w for k, w in enumerate(item)]
            doc = len(docs)
            docs.append((doc, " ".join([f"n{doc}"] * (doc % 3) + text + [f"m{doc}"] * (doc % 2))))
            window = min(13, n)
            matched = max(sum(k not in wrong for k in range(a, a + window)) for a in range(n - window + 1))
            if 100 * matched >= 80 * window:
                want.add((doc, n, matched, window, doc % 3))
    docs += [(10**6, None), (10**6 + 1, ""), (10**6 + 2, " ".join(["z"] * 5000 + [f"i9x{k}" for k in range(9)]))]
    want.add((10**6 + 2, 9, 9, 9, 5000))
    items += [(100, ""), (101, "  "), (102, None)]
    items = spark.createDataFrame(items, "item_id long, text string")
    for bound in (10**6, 0):
        got = spaced_seeds.overlaps(spark.createDataFrame(docs, DOCS), items, bound).collect()
        assert len(got) == len(want) and {(r.doc_id, r.item_id, r.matched, r.window, r.start) for r in got} == want


def test_language_sample_rests_on_many_texts(spark):
    rows = [("en", "the same text")] * 500 + [("en", f"text {i} of many") for i in range(20)] + [("fr", "mot " * 3000 + str(i)) for i in range(3)]
    docs = spark.createDataFrame(rows, "lang string, text string")
    got = ppm_langid.training_sample(docs, 30, 1000)
    assert sorted(got["en"]) == sorted({t for lang, t in rows if lang == "en"})
    assert got["fr"] and all(len(t) <= 100 and set(t.split()) == {"mot"} for t in got["fr"])


def test_mixing_keeps_rows_without_id(spark):
    rows = [(None if i < 3 else i, f"word{i % 3} text", "en", "a", i) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, p int")
    want = [r.sampled for r in raking.mix(docs).collect() if r.doc_id is None]
    got = raking.mixing_stage(spark, docs, SF)
    assert got.columns == docs.columns and len(want) == 3
    assert got.where("doc_id is null").count() == sum(want) > 0
    assert sorted(r.doc_id for r in got.where("doc_id is not null").collect()) == sorted(
        r.doc_id for r in raking.mix(docs).where("sampled and doc_id is not null").collect())
