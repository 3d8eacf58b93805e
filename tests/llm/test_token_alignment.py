"""op13 against direct sums over whole documents, without windows or memo."""

import hashlib
import json
import random
from collections import Counter
from functools import lru_cache

import numpy as np
import pytest
from tokenizers import Tokenizer

from fundlake.llm import token_alignment as T
from sf_dirs import SF_SMALL


@pytest.fixture(scope="module")
def sides():
    a, b = T.tokenizer_paths()
    return T.ByteLevel(a), T.Pieces(b)


@lru_cache
def library():
    tokenizer = Tokenizer.from_file(T.tokenizer_paths()[0])
    tokenizer.encode_special_tokens = True
    return tokenizer


def plain_alignment(sides, text):
    """(ids a, ids b, groups, links) of one text by whole-text encoding and set intersection."""
    a, b = sides
    if not text:
        return [], [], "", []
    ids_a = library().encode(" " + text, add_special_tokens=False).ids
    ids_b = b.model.encode(text)
    whole = (" " + text).encode()
    if b"".join(a.pieces[i] for i in ids_a) != whole or b"".join(b.pieces[i] for i in ids_b) != whole:
        return [], [], "", []
    ends = []
    for side, ids in ((a, ids_a), (b, ids_b)):
        at, found = 0, {}
        for k, i in enumerate(ids):
            at += len(side.pieces[i])
            found[at] = k
        ends.append(found)
    shared = sorted(ends[0].keys() & ends[1].keys())
    links, groups, i, j = [], [], 0, 0
    for e in shared:
        x, y = ends[0][e], ends[1][e]
        links.append((ids_a[x], ids_b[y]))
        groups.append(",".join(map(str, ids_a[i : x + 1])) + "|" + ",".join(map(str, ids_b[j : y + 1])))
        i, j = x + 1, y + 1
    return ids_a, ids_b, ";".join(groups), links


def expected_rows(sides, rows):
    done = [(doc_id, *plain_alignment(sides, text)) for doc_id, text in rows]
    counts = Counter(link for *_, links in done for link in links)
    best = Counter()
    for (x, y), n in counts.items():
        best[y] = max(best[y], n)
    return sorted(
        (
            (doc_id, len(a), len(b), len(links), len(links), sum(counts[p] == best[p[1]] for p in links),
             sum(counts[p] for p in links), hashlib.sha256(groups.encode()).hexdigest() if a else "")
            for doc_id, a, b, groups, links in done
        ),
        key=str,
    )


def test_every_document_equals_the_plain_alignment(spark, sides):
    found = sorted(map(tuple, T.op13_token_alignment(spark, SF_SMALL).collect()), key=str)
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    assert found == expected_rows(sides, rows)


def test_odd_documents_and_no_documents(spark, sides, odd_documents):
    found = sorted(map(tuple, T.align_corpus(spark, odd_documents).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect()), key=str)
    rows = [tuple(r) for r in odd_documents.select("doc_id", "text").collect()]
    assert found == expected_rows(sides, rows)
    assert T.align_corpus(spark, odd_documents.limit(0)).count() == 0


def test_odd_texts_equal_the_plain_alignment(spark, sides):
    rng = random.Random(5)
    alphabet = ["a", "B", "the", " ", "  ", "\n", "\t", "'s", "1", "22", "é", "日本", "▁", " ", "<|endoftext|>",
                "<s>", "<0x41>", "😀", "\x00", "-", "...", " word", "\r\n", "ﬁ", "é"]
    texts = ["".join(rng.choices(alphabet, k=rng.randint(1, 40))) for _ in range(400)]
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = T.align_corpus(spark, df, keep_groups=True)
    found = sorted(map(tuple, got.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect()), key=str)
    assert found == expected_rows(sides, rows)
    groups = {r.doc_id: r.groups for r in got.select("doc_id", "groups").collect()}
    assert all(groups[i] == plain_alignment(sides, t)[2] for i, t in rows)


def test_groups_are_written_as_the_contract_says(spark, sides):
    """A and B ids of a group apart by a bar, groups apart by a semicolon (`a1,a2|b1;a3|b2,b3`)."""
    a, b = sides
    ids_a, ids_b = library().encode(" the unhappily", add_special_tokens=False).ids, b.model.encode("the unhappily")
    assert len(ids_a) > 2 and a.pieces[ids_a[0]] == b.pieces[ids_b[0]] == b" the"
    row = T.align_corpus(spark, spark.createDataFrame([(1, "the unhappily")], "doc_id long, text string"), keep_groups=True).first()
    parts = [tuple(g.split("|")) for g in row.groups.split(";")]
    assert parts[0] == (str(ids_a[0]), str(ids_b[0])) and len(parts) == row.n_groups
    assert [int(i) for x, _ in parts for i in x.split(",")] == ids_a
    assert [int(i) for _, y in parts for i in y.split(",")] == ids_b
    assert row.groups_sha256 == hashlib.sha256(row.groups.encode()).hexdigest()


def test_a_run_too_long_for_the_split_is_encoded_by_the_library(spark, sides):
    text = "a" + " " * 1_200_000 + "b"
    found = T.align_corpus(spark, spark.createDataFrame([(1, text), (2, "a b")], "doc_id long, text string"))
    got = sorted(map(tuple, found.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect()), key=str)
    assert got == expected_rows(sides, [(1, text), (2, "a b")]) and got[0][1] > 1_000_000


def test_parts_of_long_texts_give_the_ids_of_the_whole(sides):
    rng = random.Random(9)
    words = ["alpha", "(beta)", "x.", "  two", "\n\nNew", "día", "日本語", "1,000", "it's", "A"]
    text = " " + " ".join(rng.choices(words, k=60_000))
    assert len(T.parts_of(text)) > 2 and "".join(T.parts_of(text)) == text
    for side in sides:
        whole = list(side.encode([text])[0])
        assert T.encode_documents(side, [text, " short"])[0].tolist() == whole
    assert T.parts_of(" " + "é" * 200_000) == [" " + "é" * 200_000]  # nowhere to cut


def test_memo_stays_within_its_bytes_and_changes_nothing(sides):
    a, b = sides
    texts = [f" word{i} another{i * 7} thing" for i in range(300)]
    big, tiny = T.Aligner(a, b), T.Aligner(a, b, memo_bytes=3000)
    for x, y in zip(T.encode_documents(a, texts), T.encode_documents(b, texts)):
        assert big.document(x, y) == tiny.document(x, y)
        assert tiny.held <= 3000
    assert len(big.memo) > len(tiny.memo)


def test_pairs_that_end_together_stay_below_the_bound(sides):
    a, b = sides
    suffixes = Counter(a.pieces)
    pairs = sum(suffixes[p[i:]] for p in b.pieces for i in range(len(p)))
    of_b = Counter(b.pieces)
    pairs += sum(of_b[p[i:]] for p in a.pieces for i in range(1, len(p)))
    assert pairs <= T.pair_bound(a, b) < 3_000_000
    assert int(np.iinfo(np.int64).max) > len(a.pieces) * len(b.pieces)


def test_every_code_point_has_the_library_s_ids(sides):
    """The file's ranks and the library split alike around every fourth code point."""
    a = sides[0]
    assert a.plain
    points = [c for c in range(0, 0x30000, 4) if not 0xD800 <= c < 0xE000]
    for at in range(0, len(points), 4096):
        texts = [f" a{c}b {c}{c} 1{c}2  {c} .{c}!\n{c}" for c in map(chr, points[at : at + 4096])]
        assert [list(x) for x in a.encode(texts)] == [e.ids for e in library().encode_batch(texts, add_special_tokens=False)]


def test_other_files_are_encoded_by_their_library(sides, tmp_path):
    held = json.loads(open(T.tokenizer_paths()[0], encoding="utf-8").read())
    held["normalizer"] = {"type": "Lowercase"}
    path = tmp_path / "other.json"
    path.write_text(json.dumps(held), encoding="utf-8")
    other = T.ByteLevel(str(path))
    assert not other.plain and list(other.encode([" A b"])[0]) == list(sides[0].encode([" a b"])[0])
