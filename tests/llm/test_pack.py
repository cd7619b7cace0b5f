"""Packing against the reference tokenizer library, and the whole pipeline."""

import random
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from textloom.llm import pack
from textloom.llm.queries import QUERIES, tokenizer_path


def library():
    t = Tokenizer.from_file(tokenizer_path())
    t.encode_special_tokens = True
    return t


def test_character_classes_are_made_in_little_memory():
    tracemalloc.start()
    made = pack._classes.__wrapped__()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert made[ord("a")] == 1 and made[0x663] == 2 and made[0x3000] == 3 and made[0xD800] == 0 and peak < 60 << 20


def test_ids_equal_the_librarys():
    rng = random.Random(1)
    letters = list("ab's  \n\tt12!-'éreß½ lld日")
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 14))) for _ in range(4000)]
    texts += ["don't I'll you'VE 'tis '", "<|endoftext|> a", "\x1c a\x85b", "😀😀 a", " ", "\n\n x", ""]
    ids, row = pack.Encoder(tokenizer_path()).encode(pa.array(texts))
    for k, e in enumerate(library().encode_batch(texts, add_special_tokens=False)):
        assert ids[row[k] : row[k + 1]].tolist() == [*e.ids, 0], texts[k]


def test_sum_of_squares_fills_bins():
    sizes = np.sort(np.random.default_rng(0).integers(1, 100, 5000))[::-1]
    bins, offset = pack.sum_of_squares(sizes, 100)
    assert bins.max() + 1 <= 1.01 * -(-sizes.sum() // 100)
    for b in range(50):
        own = sorted(zip(offset[bins == b], sizes[bins == b]))
        assert [o for o, _ in own] == [sum(s for _, s in own[:k]) for k in range(len(own))] and sum(s for _, s in own) <= 100


def test_ids_of_strings_whose_hashes_are_weak():
    word = "a"
    for _ in range(11):
        word += word.translate(str.maketrans("ab", "ba"))
    texts = [word, word.translate(str.maketrans("ab", "ba")), word]
    ids, row = pack.Encoder(tokenizer_path()).encode(pa.array(texts))
    for k, e in enumerate(library().encode_batch(texts, add_special_tokens=False)):
        assert ids[row[k] : row[k + 1]].tolist() == [*e.ids, 0]


def test_ids_do_not_trust_hashes(monkeypatch):
    monkeypatch.setattr(pack.tx, "span_hashes", lambda data, starts, ends: (ends - starts).astype(np.uint64) << np.uint64(60))
    texts = ["one two six ten", "six one", "two ten one", "six six"]
    encoder = pack.Encoder(tokenizer_path())
    for _ in range(2):
        ids, row = encoder.encode(pa.array(texts))
        for k, e in enumerate(library().encode_batch(texts, add_special_tokens=False)):
            assert ids[row[k] : row[k + 1]].tolist() == [*e.ids, 0]


@pytest.mark.parametrize("weigh_new", [False, True])
def test_sum_of_squares_equals_the_plain_rule(weigh_new):
    rng = random.Random(4)
    for _ in range(20):
        capacity = rng.randint(3, 12)
        sizes = [rng.randint(1, capacity) for _ in range(40)]
        fill = []  # of each bin, in order of opening
        squares = lambda: sum(n * n for n in Counter(f for f in fill if f < capacity).values())
        bins, _ = pack.sum_of_squares(np.array(sizes), capacity, weigh_new)
        for k, s in enumerate(sizes):
            choices = []
            for b in sorted({f: i for i, f in enumerate(fill)}.values()):
                if fill[b] + s <= capacity:
                    fill[b] += s
                    choices.append((squares(), -fill[b]))
                    fill[b] -= s
            fill.append(s)
            new = squares()
            fill.pop()
            level = -min(choices)[1] - s if choices and not (weigh_new and new < min(choices)[0]) else None
            b = int(bins[k])
            assert (b == len(fill)) == (level is None)
            if level is None:
                fill.append(0)
            else:
                assert fill[b] == level
            fill[b] += s


def held(rows):
    places = {}
    for r in rows:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in places.values():
        own.sort()
        assert [o for o, _ in own] == [sum(n for _, n in own[:k]) for k in range(len(own))]
        assert sum(n for _, n in own) <= 2048
    return len(places)


def test_packing_query(spark):
    rows = QUERIES["op9_best_fit_packing"](spark, "/root/testdata/sf0.001").collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    got = {(r.doc_id, r.piece): r for r in rows}
    assert len(got) == len(rows)
    for i, t in texts.items():
        ids = [*library().encode(t or "", add_special_tokens=False).ids, 0]
        head = (len(ids) - 1) % 2048 + 1
        cuts = [0, *range(head, len(ids) + 1, 2048)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            r = got.pop((i, k))
            assert (r.start, r.length, r.ids_crc32) == (a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()))
    assert not got
    assert held(rows) <= 1.02 * -(-sum(r.length for r in rows) // 2048) + 1


def test_packing_of_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, 5), (1, "", 5), (None, "a b", 5), (2, "word " * 5000, 5), (3, "x" * 40_000, 5)], "doc_id long, text string, offset int")
    named = pack.pack(pack.tokenise(docs, tokenizer_path()).withColumn("row", F.lit("own")).withColumn("offset", F.lit("own")))
    assert {r.row for r in named.collect()} == {"own"} and dict(named.dtypes)["offset"] == "bigint"
    rows = pack.pack(pack.tokenise(docs, tokenizer_path()), group=2).collect()
    held(rows)
    assert sum(r.length for r in rows if r.doc_id == 1) == 2 and {r.piece for r in rows if r.doc_id == 2} == {0, 1, 2}
    assert pack.pack(pack.tokenise(docs.limit(0), tokenizer_path())).collect() == []


def test_pipeline_stages(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    extra = spark.createDataFrame([(-1, None, "en", "s", 0), (-2, "12 34", None, None, 5), (-3, "", "en", "s", 0)], docs.schema)
    kept, seen = docs.union(extra), []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, sf)
        assert kept.columns == docs.columns
        kept = spark.createDataFrame(kept.collect(), docs.schema)
        seen.append({r.doc_id: r for r in kept.collect()})
    assert set(seen[0]) == {r.doc_id for r in docs.collect()}
    assert set(seen[1]) == set(seen[0]) and all(r.n_chars == len(r.text) for r in seen[1].values())
    assert set(seen[3]) <= set(seen[2]) < set(seen[1])
    from .test_pairs import components, sets

    own = {i: sets(r.text) for i, r in seen[1].items()}
    group = components(own, [(a, b) for a in own for b in own if a < b and own[a] and own[b] and 100 * len(own[a] & own[b]) >= 75 * len(own[a] | own[b])])
    assert set(seen[2]) == {i for i in own if group[i] == i}
    rows = corpus_pipeline.STAGES[-1][1](spark, kept, sf).collect()
    assert {r.doc_id for r in rows} == set(seen[3])
    held(rows)


def test_pipeline_keeps_one_whole_document_of_a_copy_group(spark):
    copy = "\n".join(f"line {k} of the text that is copied" for k in range(8))
    rows = [(i, "a", f"menu\nbody {i} alone\nmore {i * i}") for i in range(100)] + [(200 + i, "a", copy) for i in range(10)]
    docs = spark.createDataFrame([(*r, len(r[2])) for r in rows], "doc_id long, source string, text string, n_chars long")
    cut = corpus_pipeline.line_deduplication(spark, docs, "")
    got = {r.doc_id: r.text for r in corpus_pipeline.ngram_deduplication(spark, cut, "").collect()}
    assert [i for i in got if i >= 200] == [200] and got[200] == copy
    assert got[3] == "body 3 alone\nmore 9"


def test_pipeline_of_odd_rows_and_empty_tables(spark):
    """Nulls in every column, repeated ids, equal rows, a very long text and columns named as the stages' own go through all stages."""
    sf, long = "/root/testdata/sf0.001", " ".join(f"w{k * k % 7919}x{k}" for k in range(60_000))
    texts = [(7, "one text of more than five words"), (7, "another text that shares its number with one"), (7, "one text of more than five words"), (None, "a row without a number but with words"), (8, long), (9, None), (10, ""), (11, "4 5 6"), (12, "short")]
    rows = [(i, t, None if k == 3 else "en" if k % 3 else "fr", "s" if k % 2 else None, None, f"n{k}", k, f"c{k}", k / 2) for k, (i, t) in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, n_lines string, row int, component_id string, n_dropped double")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, sf)
        assert kept.columns == docs.columns, name
        kept = spark.createDataFrame(kept.collect(), docs.schema)
    # rows without a letter go, of two equal texts one row stays, the rest is as it was
    assert sorted(r.row for r in kept.collect()) in ([0, 1, 3, 4, 8], [1, 2, 3, 4, 8])
    before = {r[6]: r for r in rows}
    assert all((r.doc_id, r.text, r.n_lines, r.component_id, r.n_dropped) == (before[r.row][0], before[r.row][1], before[r.row][5], before[r.row][7], before[r.row][8]) for r in kept.collect())
    packed = corpus_pipeline.STAGES[-1][1](spark, kept, sf).collect()
    held(packed)
    assert {r.doc_id for r in packed} == {7, None, 8, 12} and max(r.piece for r in packed) > 20
    none = docs.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, sf).collect() == [], name
