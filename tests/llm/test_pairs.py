"""The two joins against brute force, with nulls, empties, ties, repeats and clashing columns."""

import random

import numpy as np
import pyarrow as pa
import pytest

from textloom.llm import embedding_dedup, ngram_join
from textloom.llm.components import connected_components
from textloom.llm.scratch import Scratch


def components(n, links):
    root = {i: i for i in n}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in n}


def sets(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def corpus(seed=3):
    rng = random.Random(seed)
    words = ["w%d" % i for i in range(400)]
    passage = " ".join(rng.choice(words) for _ in range(40))
    rows = []
    for _ in range(60):
        base = [rng.choice(words) for _ in range(rng.choice([3, 8, 40, 120, 300]))]
        rows.append(" ".join(base))
        for _ in range(rng.choice([0, 0, 1, 4])):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 30))):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            rows.append(" ".join(copy))
    rows += [passage + " " + " ".join(rng.choice(words) for _ in range(20)) for _ in range(30)]
    big = [rng.choice(words) for _ in range(200)]
    for _ in range(60):
        copy = list(big)
        for _ in range(rng.randint(0, 5)):
            copy[rng.randrange(200)] = rng.choice(words)
        rows.append(" ".join(copy))
    rows += ["Same Text here", "same text HERE", None, "", " \t\n", "x", "a b c d", "a b c d", "z" * 5000, "long " * 30_000]
    return rows


def test_ngram_join_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", 16)
    rows = list(enumerate(corpus()))
    docs = spark.createDataFrame([(i, t, "q", i) for i, t in rows], "doc_id long, text string, cls string, n_shingles int")
    got = {r.doc_id: r for r in ngram_join.near_duplicates(docs).collect()}
    own = {i: sets(t) for i, t in rows}
    links = [(a, b) for a in own for b in own if a < b and own[a] and own[b] and 100 * len(own[a] & own[b]) >= 75 * len(own[a] | own[b])]
    assert len(links) > 500
    expected = components(own, links)
    assert {i: (r.n_shingles, r.component_id) for i, r in got.items()} == {i: (len(own[i]), expected[i]) for i in own}
    assert all(r.kept == (r.doc_id == r.component_id) for r in got.values())


def test_ngram_join_of_nothing_and_null_ids(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert ngram_join.near_duplicates(empty).collect() == []
    rows = spark.createDataFrame([(None, "a b c d e f"), (4, "a b c d e f"), (4, "a b c d e f"), (9, "A b c d e f")], "doc_id long, text string")
    got = sorted((r.doc_id or -1, r.component_id) for r in ngram_join.near_duplicates(rows).collect() if r.doc_id)
    assert got == [(4, 4), (4, 4), (9, 4)]
    assert [r.component_id for r in ngram_join.near_duplicates(rows).collect() if r.doc_id is None] == [None]


def test_ngram_join_makes_no_table_of_a_list(spark, monkeypatch):
    """A table of a Python list starts workers of another kind on every executor."""
    docs = spark.range(6).selectExpr("id doc_id", "concat('one two three four five six seven ', id div 2) text")
    made, make = [], type(spark).createDataFrame
    monkeypatch.setattr(type(spark), "createDataFrame", lambda self, data, *a, **b: made.append(type(data)) or make(self, data, *a, **b))
    found = ngram_join.near_duplicates(docs)
    assert sorted(r.component_id for r in found.collect()) == [0, 0, 2, 2, 4, 4] and list not in made


def test_ngram_join_tells_apart_what_a_weak_hash_does_not(spark):
    word = "a"
    for _ in range(11):
        word += word.translate(str.maketrans("ab", "ba"))
    docs = spark.createDataFrame([(1, word), (2, word.translate(str.maketrans("ab", "ba")))], "doc_id long, text string")
    assert sorted((r.doc_id, r.component_id) for r in ngram_join.near_duplicates(docs).collect()) == [(1, 1), (2, 2)]


def test_groups_of_one_prefix_are_expanded_and_verified(spark, monkeypatch):
    """Sets whose prefixes coincide by force: the whole table is a few groups, whose members link or not."""
    monkeypatch.setattr(ngram_join, "BLOCK", 8)
    plain = ngram_join._postings

    def few(width, num, den, frequent):
        def run(batches):
            for b in plain(width, num, den, frequent)(batches):
                member = np.asarray(b.column(1)) == ngram_join.MEMBER
                n = np.asarray(b.column(2))
                yield ngram_join.pa.record_batch([np.where(member, np.asarray(b.column(0)), n.astype(np.int64)), np.where(member, -1, 0).astype(np.int32), n, n.astype(np.int64)], names=["s", "salt", "n", "grp"])

        return run

    rng = random.Random(9)
    texts = []
    for _ in range(6):
        base = [f"w{rng.randrange(300)}" for _ in range(60)]
        for _ in range(7):
            copy = list(base)
            copy[rng.randrange(60)] = f"x{rng.randrange(300)}"
            texts.append(" ".join(copy))
    rows = list(enumerate(texts + texts[:5]))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    own = {i: sets(t) for i, t in rows}
    sizes = {len(s) for s in own.values()}
    expected = components(own, [(a, b) for a in own for b in own if a < b and len(own[a]) == len(own[b]) and 100 * len(own[a] & own[b]) >= 75 * len(own[a] | own[b])])
    monkeypatch.setattr(ngram_join, "_postings", few)
    got = {r.doc_id: r.component_id for r in ngram_join.near_duplicates(docs).collect()}
    assert len(sizes) <= 6 and got == expected and len(set(got.values())) > 5


def test_marks_rule_out_no_link():
    rng = np.random.default_rng(5)
    seen = {True: 0, False: 0}
    for _ in range(600):
        k, cut, add = int(rng.integers(1, 2500)), rng.random() / 2, rng.random() / 3
        a = np.unique(rng.integers(0, 1 << 63, k, dtype=np.uint64))
        b = np.unique(np.concatenate([a[int(cut * k) :], rng.integers(0, 1 << 63, 1 + int(add * k), dtype=np.uint64)]))
        both = len(np.intersect1d(a, b))
        columns = [pa.array([v]) for v in (1, 2, len(a), len(b), ngram_join._mark(a), ngram_join._mark(b))]
        batch = pa.record_batch(columns, names=list("abnmxy"))
        near = len(next(ngram_join._near(75, 100)([batch]))) == 1
        assert near or 100 * both < 75 * (len(a) + len(b) - both)
        seen[near] += 1
    assert min(seen.values()) > 50 and len(next(ngram_join._near(75, 100)([batch.slice(0, 0)]))) == 0


def test_keep_one_tells_rows_apart(spark, tmp_path):
    text = {k: " ".join(f"{k}{i}" for i in range(30)) for k in "ABC"}
    rows = [(1, text["A"]), (5, text["A"]), (5, text["B"]), (9, text["B"] + " x"), (7, text["C"]), (7, text["C"]), (None, text["C"]), (None, "lone words"), (3, None), (3, "")]
    docs = spark.createDataFrame([(i, t, "q") for i, t in rows], "doc_id long, text string, id string")
    got = ngram_join.keep_one(docs)
    assert got.columns == docs.columns
    found = sorted(((r.doc_id or 0), (r.text or "")[:2]) for r in got.collect())
    assert found == sorted([(1, "A0"), (5, "B0"), (7, "C0"), (0, "lo"), (3, ""), (3, "")])
    assert ngram_join.keep_one(docs.limit(0)).collect() == []

    # rows read from several files are told by file and place, without a copy
    for part in range(2):
        docs.repartition(2).write.mode("append").parquet(str(tmp_path / "docs"))
    stored = spark.read.parquet(str(tmp_path / "docs"))
    numbered = ngram_join._numbered(stored, ngram_join.Scratch(spark, "test"))
    assert "-rows/" not in "".join(numbered.inputFiles()) and numbered.select(ngram_join.ROW).distinct().count() == 20
    once = sorted(((r.doc_id or 0), (r.text or "")[:2]) for r in ngram_join.keep_one(stored).collect())
    assert once == sorted([*found, (3, ""), (3, "")])


def test_embeddings_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "PART", 32)
    rng = np.random.default_rng(2)
    x = rng.standard_normal((300, 16)).astype(np.float32)
    near = x[rng.integers(0, 300, 300)] + rng.standard_normal((300, 16)).astype(np.float32) * 0.12
    x = np.concatenate([x, near, x[:20], x[:20] * 3, np.repeat(x[:1], 50, 0), x[:1] + rng.standard_normal((60, 16)).astype(np.float32) * 0.15])
    label = rng.integers(0, 3, len(x))
    rows = [(i, v.tolist(), int(a)) for i, (v, a) in enumerate(zip(x, label))]
    odd = [(None, 1), ([0.0] * 16, 1), ([None] * 16, 1), ([float("nan")] * 16, 1), ([float("inf")] * 16, 1), (x[0].tolist(), None), ([1.0], 1), ([], 1)]
    rows += [(len(x) + k, v, a) for k, (v, a) in enumerate(odd)]
    table = spark.createDataFrame([(*r, "c", 1.0) for r in rows], "vec_id long, embedding array<float>, label int, codes string, error double")
    got = {r.vec_id: (r.n_links, r.component_id) for r in embedding_dedup.near_duplicates(table).collect()}
    y = x.astype(float)
    cos = (y @ y.T) / np.outer(np.sqrt((y * y).sum(1)), np.sqrt((y * y).sum(1)))
    linked = (cos >= 0.98) & (label[:, None] == label[None])
    np.fill_diagonal(linked, False)
    expected = components(range(len(rows)), [(a, b) for a, b in zip(*map(list, np.nonzero(linked))) if a < b])
    n = [*linked.sum(1), *[0] * len(odd)]
    assert sum(n) > 2000
    assert got == {i: (n[i], expected[i]) for i in range(len(rows))}
    empty = table.limit(0)
    assert embedding_dedup.near_duplicates(empty).collect() == []


def test_embeddings_of_all_lengths_and_magnitudes_link(spark):
    vectors = [[1.0, 2.0, 3.0]] * 3 + [[4.0, 5.0]] * 2 + [[1e200, 2e200, 3e200], [1e-200, 2e-200, 3e-200], [-0.0, 5.0], [0.0, 7.0], [5e-324, 0.0]]
    table = spark.createDataFrame([(i, v, "a") for i, v in enumerate(vectors)] + [(None, [4.0, 5.0], "a")], "vec_id long, embedding array<double>, label string")
    got = {r.vec_id: (r.n_links, r.component_id) for r in embedding_dedup.near_duplicates(table).collect()}
    assert [got[i] for i in range(10)] == [(4, 0)] * 3 + [(1, 3)] * 2 + [(4, 0)] * 2 + [(1, 7)] * 2 + [(0, 9)]


def test_embedding_lists_grow_and_recall_holds(spark, monkeypatch):
    """Lists of about eight vectors in 64 dimensions: links found, against brute force."""
    monkeypatch.setattr(embedding_dedup, "LIST", 8)
    rng = np.random.default_rng(5)
    x = rng.standard_normal((1500, 64))
    x = np.concatenate([x, x[:1000] + rng.standard_normal((1000, 64)) * 0.13]).astype(np.float32)
    table = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)], "vec_id long, embedding array<float>, label int")
    y = x.astype(float) / np.sqrt((x.astype(float) ** 2).sum(1))[:, None]
    n = ((y @ y.T) >= 0.98).sum(1) - 1
    got = {r.vec_id: r.n_links for r in embedding_dedup.near_duplicates(table).collect()}
    assert n.sum() > 1000 and all(got[i] <= n[i] for i in got) and sum(got.values()) >= 0.99 * n.sum()


@pytest.mark.parametrize("local", [0, 1000])
def test_components_both_ways(spark, local):
    edges = [(k, k + 1) for k in range(40)] + [(100, 90), (90, 95), (7, 7)] + [(200, 200 + k) for k in range(1, 30)]
    table = spark.createDataFrame(edges, "a long, b long")
    got = {r.vertex: r.component for r in connected_components(table, Scratch(spark, "t"), local=local).collect()}
    expected = components({x for e in edges for x in e}, edges)
    assert {k: v for k, v in expected.items() if k != 7 or v != 7} == got


def test_ngram_sets_come_once(spark, monkeypatch):
    """Copies whose ids share a bucket of the filter give one set, so that pairs are not multiplied; nor do repeated ids."""
    at = ngram_join._bucket(np.arange(200_000))
    order = np.argsort(at, kind="stable")
    k = int(np.flatnonzero(at[order][1:] == at[order][:-1])[0])
    x, y = (int(v) for v in order[k : k + 2])
    words = [f"w{i}" for i in range(40)]
    text, near = " ".join(words), " ".join(words + ["more"])
    held, verified = [], ngram_join._verified
    monkeypatch.setattr(ngram_join, "_verified", lambda pairs, sets, *a: (held.append([r.cls for r in sets.select("cls").collect()]), verified(pairs, sets, *a))[1])
    for rows in ([(x, text), (y, text), (300_000, near)], [(x, text), (x, text), (300_000, near)]):
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
        got = {r.doc_id: r.component_id for r in ngram_join.near_duplicates(docs).collect()}
        assert got == {r[0]: x for r in rows}
        assert all(sorted(set(h)) == sorted(h) and len(h) == 2 for h in held) and held
