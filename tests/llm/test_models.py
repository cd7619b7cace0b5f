"""Learnt operators: held-out quality on the synthetic tables, and defined results for odd rows."""

import math
import random
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from textloom.llm import decontam, langid, lm, toxicity
from textloom.llm import text as tx
from textloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
ODD = [(1, None), (2, ""), (3, "  \n"), (4, "123 !!"), (None, "hello there"), (5, "x" * 300_000), (6, "the same"), (6, "the same")]


def odd(spark):
    return spark.createDataFrame([(i, t, None, "z") for i, t in ODD], "doc_id long, text string, lang string, score string")


def test_language_held_out_accuracy(spark):
    got = {r.doc_id: r for r in QUERIES["op5_language_id"](spark, SF).collect()}
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    held = [i for i in got if zlib.crc32(str(i).encode()) % 4 == 2]
    assert [i for i in got if got[i].held_out] == held
    assert sum(got[i].lang_pred == truth[i] for i in held) / len(held) > 0.98


def test_language_equals_plain_decoding(spark):
    """Log-odds summed gram by gram, a logistic loss for each bit, and the least weighted loss."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang").limit(150)
    model = langid.train(docs)
    got = {r.doc_id: r for r in langid.predict(docs, model).collect()}
    for r in docs.where("text is not null and length(text) < 3000").collect():
        data = bytes(c + 32 if 65 <= c <= 90 else c for c in r.text.encode())
        margin, n = np.zeros(model.code.shape[1]), 0
        for k, size in enumerate(langid.SIZES):
            for i in range(len(data) - size + 1):
                gram = int.from_bytes(data[i : i + size], "little")
                margin += model.odds[(gram * 0x9E3779B1 % 2**32 >> 17) + k * langid.BUCKETS]
                n += 1
        mean = margin / max(n, 1) * min(n, 60)
        loss = [sum(t * math.log1p(math.exp(-m * c)) for t, m, c in zip(trust, mean, code)) for trust, code in zip(model.trust, model.code)]
        best = int(np.argmin(loss))
        if got[r.doc_id].lang_pred != langid.UNKNOWN:
            assert got[r.doc_id].lang_pred == model.languages[best]
            assert abs(got[r.doc_id].score - 1 / sum(math.exp(loss[best] - x) for x in loss)) < 1e-4


def test_language_of_odd_rows(spark):
    train = spark.createDataFrame([("the cat and the dog", "en"), ("der hund und die katze", "de"), (None, "fr"), ("x", None)], "text string, lang string")
    model = langid.train(train)
    assert model.languages == ["de", "en"]
    got = [(r.doc_id, r.lang_pred) for r in langid.predict(odd(spark), model).collect()]
    assert len(got) == len(ODD) and sorted(i for i, p in got if p == "und") == [1, 2, 3, 4]
    assert langid.accept(odd(spark), model).count() == 4
    nothing = langid.train(train.limit(0))
    assert {r.lang_pred for r in langid.predict(odd(spark), nothing).collect()} == {"und"}
    apart = langid.codewords(9)
    assert min((a != b).sum() for i, a in enumerate(apart) for b in apart[:i]) >= 8


def test_toxicity_held_out(spark):
    got = {r.doc_id: r for r in QUERIES["op3_toxicity"](spark, SF).collect()}
    marks = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    held = [i for i in marks if got[i].held_out]
    hits = sum(got[i].predicted and marks[i] for i in held)
    assert hits / max(1, sum(got[i].predicted for i in held)) >= 0.8 and hits / sum(marks[i] for i in held) >= 0.5
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got.values())


@pytest.mark.parametrize("shown, plain", [("1d10t", "idiot"), ("i.d.i.o.t", "idiot"), ("stuuupid", "stupid"), ("m0r0n", "moron"), ("tra5h", "trash"), ("i d i o t", "idiot"), ("hello", "hello")])
def test_restoring(spark, shown, plain):
    docs = spark.createDataFrame([("idiot moron stupid trash hello " * 3,)], "text string")
    assert toxicity.restore(shown, toxicity.letter_model(docs)) == plain


def test_disguises_at_every_place_of_a_word(spark):
    listed = ["trash", "pathetic", "idiot", "disgusting", "worthless", "stupid", "clown", "scum", "loser", "moron"]
    costs = toxicity.letter_model(spark.createDataFrame([(" ".join(listed) + " you are a friend of the many words ",)] * 3, "text string"))
    stands: dict[str, list[str]] = {}
    for symbol, letters in toxicity.LEET.items():
        for letter in letters:
            stands.setdefault(letter, []).append(symbol)

    def found(shown):
        data, offsets = toxicity.tx.buffers(pa.array([f"so {shown} now"]))
        data = toxicity.tx._LOWER[data]
        return [w.decode() for w in toxicity._restored(data, *toxicity.tx.word_spans(data, offsets), costs)[0]]

    missed, tried = [], 0
    for word in listed:
        for i, letter in enumerate(word):
            for symbol in stands.get(letter, []):
                for form in ("{}", "({})", "{}!", "{}.", '"{},'):
                    shown, tried = form.format(word[:i] + symbol + word[i + 1 :]), tried + 1
                    # a word that stands in the open up to its last letter is found by its beginning
                    if not any(w.startswith(word) for w in found(shown)) and not (i == len(word) - 1 and len(word) > 4):
                        missed.append(shown)
    assert tried > 300 and len(missed) <= 0.02 * tried, missed
    assert found("5h17") and found("shi7") and found("idi0+!") == ["idiot"] and "idiot" in found("((1d10t))")
    assert found("12345") == [] and found("7:30") == [] and found("1,000.50!") == [] and found("plain.") == [] and "word" not in found("(word)")


def test_toxicity_of_disguised_and_odd_rows(spark):
    rows = [(i, f"the plain text number {i} of many words " + ("you idiot" if i % 4 == 0 else "you friend")) for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i, _ in rows], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    new = spark.createDataFrame([(1, "what an 1d10t he is"), (2, "i d i o t !"), (3, "what a friend"), (4, "IDIOOOT"), (5, "(idiot)")], "doc_id long, text string")
    got = {r.doc_id: r.score for r in toxicity.score(new, model).collect()}
    assert min(got[i] for i in (1, 2, 4, 5)) > 0.3 > got[3]
    assert toxicity.score(odd(spark), model).count() == len(ODD)
    assert toxicity.score(docs, toxicity.train(docs, labels.limit(0))).where("score >= 0.3").count() == 0


def every_reading(token, costs, split):
    """The least cost of any path through the lattice, and the readings that have it, by trying all."""
    symbol = lambda c: ord(c) - 96 if "a" <= c <= "z" else 27
    found = {}

    def walk(k, a, b, cost, out):
        if k == len(token):
            total = cost + costs[a, b, 0]
            found[out] = min(found.get(out, math.inf), total)
            return
        c = token[k]
        choices = [(x, toxicity.COST_LEET) for x in toxicity.LEET.get(c, "")]
        if c in toxicity.SEPARATORS:
            walk(k + 1, a, b, cost + toxicity.COST_DROP, out)
            if split and b:
                walk(k + 1, b, 0, cost + toxicity.COST_DROP + costs[a, b, 0], out + " ")
        else:
            choices.append((c, 0.0 if c.isalpha() else toxicity.COST_KEEP))
        for x, more in choices:
            walk(k + 1, b, symbol(x), cost + more + costs[a, b, symbol(x)], out + x)
            if out.endswith(x):
                walk(k + 1, a, b, cost + more + toxicity.COST_REPEAT, out)

    walk(0, 0, 0, 0.0, "")
    least = min(found.values())
    return {x for x, v in found.items() if v <= least + 1e-9}


def test_restoring_equals_trying_all_readings():
    rng = random.Random(7)
    costs = -np.log(np.random.default_rng(1).dirichlet(np.ones(28) * 0.3, (28, 28)) + 1e-6)
    for k in range(300):
        token = "".join(rng.choice("abio1106$.- é") for _ in range(rng.randint(1, 7)))
        got = toxicity.restore(token, costs, k % 2 == 0)
        best = every_reading(token, costs, k % 2 == 0)
        assert got in best, (token, got, best)


def test_restored_words_depend_on_the_model_given(spark):
    one, two = (toxicity.letter_model(spark.createDataFrame([(t,)], "text string")) for t in ("idiot idiot " * 20, "ldlot ldlot " * 20))
    read = lambda costs: sorted(toxicity._row_features(pa.array(["so 1d1ot"]), costs)[1].tolist())
    assert read(one) != read(two) and read(one) == read(one)
    for first, second in ((one, two), (two, one)):
        toxicity._WORDS.clear()
        alone = read(second)
        read(first)
        assert read(second) == alone


def test_toxicity_of_long_tokens(spark):
    rows = [(i, f"the plain text number {i} of many words " + ("you idiot" if i % 4 == 0 else "you friend")) for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.train(docs, spark.createDataFrame([(i, int(i % 4 == 0)) for i, _ in rows], "doc_id long, toxic int"))
    new = [(1, "i_d_i_o_t_" * 7), (2, "the.plain.text.of.many.words.the.plain.text.of.many.words.you.i.d.i.o.t"), (3, "the.plain.text.of.many.words." * 4), (4, "the-1d10t-" + "plain-text-" * 8)]
    got = {r.doc_id: r.score for r in toxicity.score(spark.createDataFrame(new, "doc_id long, text string"), model).collect()}
    assert min(got[1], got[2], got[4]) > 0.3 > got[3], got


def test_toxicity_of_letters_spaced_apart(spark):
    rows = [(i, f"the plain text number {i} of a man and many words " + ("you are a stupid idiot" if i % 4 == 0 else "you are a friend")) for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.train(docs, spark.createDataFrame([(i, int(i % 4 == 0)) for i, _ in rows], "doc_id long, toxic int"))
    assert toxicity.restore("a i d i o t", model.costs, True) == "a idiot"
    late = " ".join(("themanandthewords" * 6 + "idiot"))
    new = [(1, "a i d i o t"), (2, late), (3, "y o u   a r e   i d i o t"), (4, "t h e i d"), (5, "i o t a n d"), (6, "i  d  i  o  t")]
    new = spark.createDataFrame(new, "doc_id long, text string").coalesce(1)
    got = {r.doc_id: r.score for r in toxicity.score(new, model).collect()}
    assert min(got[i] for i in (1, 2, 3, 6)) > 0.3 > max(got[4], got[5])


def test_language_model(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang").union(odd(spark).select("doc_id", "text", "lang"))
    out = lm.score(docs, ~langid.held_out("doc_id", 7)).collect()
    rows = docs.collect()
    assert len(out) == len(rows)
    learns = lambda i: zlib.crc32(str("null" if i is None else i).encode()) % 7 != 2
    count, ends = Counter(), 0
    for r in rows:
        if learns(r.doc_id):
            count.update((r.text or "").encode().lower().split())
            ends += 1
    n, v = sum(count.values()) + ends, len(count) + 1
    key = lambda i: -1 if i is None else i
    expected = sorted(
        (key(r.doc_id), len(w := (r.text or "").encode().lower().split()) + 1, sum(count[x] > 0 for x in w) + 1, n,
         round(sum(math.log10(count[x] + 1) for x in w) + math.log10(ends + 1) - (len(w) + 1) * math.log10(n + v + 1), 4)) for r in rows
    )
    assert sorted((key(r.doc_id), r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in out) == expected
    assert all(r.score < 0 and r.bits_per_byte >= 0 for r in out)
    assert sum(10**r.score for r in {r.score: r for r in out}.values()) <= 1
    trained = [r for r in out if r.doc_id is not None and learns(r.doc_id) and r.n_tokens > 100]
    assert sum(r.score for r in trained) > sum(r.base_score for r in trained)


def test_language_model_without_frequent_table(spark, monkeypatch):
    docs = spark.createDataFrame([(i, "a b c " * (i % 4), "en") for i in range(20)], "doc_id long, text string, lang string")
    learn = ~langid.held_out("doc_id", 7)
    one = sorted((r.doc_id, r.n_known, round(r.base_score, 6)) for r in lm.score(docs, learn).collect())
    monkeypatch.setattr(lm, "FREQUENT", 1)
    got = lm.score(docs, learn).collect()  # with so few, all words are spelled
    assert sorted((r.doc_id, r.n_known, round(r.base_score, 6)) for r in got) == one and all(r.score < 0 for r in got)


def test_language_model_reads_in_order(spark):
    verse = "one small step for a man one giant leap for mankind".split()
    turned = [verse[k:] + verse[:k] for k in range(len(verse))]
    rows = [(i, " ".join(turned[i % len(turned)] * 3), "en") for i in range(60)]
    rows += [(-1, " ".join(verse), "en"), (-2, " ".join(sorted(verse)), "en"), (-3, " ".join(verse[::-1]), "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r.score for r in lm.score(docs, F.col("doc_id") >= 0).collect()}
    assert got[-1] > got[-2] + 3 and got[-1] > got[-3] + 3


def test_language_model_of_long_words(spark):
    rng = random.Random(1)
    long = ["x" * 32 + "".join(rng.choice("abcdefghij") for _ in range(300)) for _ in range(2)]
    docs = spark.createDataFrame([(i, long[i % 2], "en") for i in range(100)] + [(-1, long[0], "en"), (-2, "x" * 32 + "?!" * 150, "en")], "doc_id long, text string, lang string")
    got = {r.doc_id: r.bits_per_byte for r in lm.score(docs, F.col("doc_id") >= 0).collect()}
    assert got[-1] < 1 < got[-2]


def test_language_model_keeps_ids_and_takes_empty_tables(spark):
    docs = spark.createDataFrame([(None, "a b"), ("0", "a b"), ("x", None)], "doc_id string, text string")
    assert sorted(r.doc_id or "" for r in lm.score(docs, F.lit(True)).collect()) == ["", "0", "x"]
    numbers = spark.createDataFrame([(None, "a b"), (0, "a b")], "doc_id long, text string")
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in lm.score(numbers, F.lit(True)).collect()) == [(False, 0), (True, 0)]
    assert lm.score(docs.limit(0), F.lit(True)).collect() == []
    assert all(r.score < 0 for r in lm.score(docs, F.lit(False)).collect())


def trained(spark, docs, learn, monkeypatch):
    held = []
    train = lm.train
    monkeypatch.setattr(lm, "train", lambda *a: held.append(train(*a)) or held[-1])
    out = {r.doc_id: r for r in lm.score(docs, learn).collect()}
    return held[0], out


def plain_score(m, text):
    """The model's log10 probability of a text, symbol by symbol and bit by bit."""
    words = [w for w in (text or "").encode().lower().split()]
    h = [int(tx.words(pa.array([w.decode()]))[0][0]) for w in words]
    one = lambda x: int(tx.mix(np.array([x % 2**64], np.uint64))[0])

    def bits(mixer, symbol, contexts, group, expected):
        code, total, agrees = mixer.code, 0.0, expected is not None
        path = lambda x: range(code.start[x], code.start[x + 1])
        for depth, at in enumerate(path(symbol)):
            node, bit = int(code.nodes[at]), int(code.bits[at])
            levels = [int(mixer.known[((c + node * int(lm._NODE)) % 2**64 >> (64 - b)) + f]) for c, b, f in zip(contexts, mixer.slot_bits, mixer.first)]
            sure = lambda v: sum(abs(np.float32((v - 128) / lm.LEVELS)) > x for x in lm.SURE)
            says = 2 * int(code.bits[code.start[expected] + depth]) - 1 if agrees else 0
            gate = (sure(levels[0]) * (len(lm.SURE) + 1) + sure(levels[-1])) * 2 + agrees
            x = [mixer.odds[group, node], *[(v - 128) / lm.LEVELS for v in levels], says, 1]
            dot = min(max(sum(a * b for a, b in zip(mixer.weights[:, gate], x)), -lm.MOST), lm.MOST - 0.1)
            bucket = int(min(max(dot * 1.5 + 12, 0), lm.BUCKETS - 1))
            p = min(max(0.5 / (1 + math.exp(-dot)) + 0.5 * mixer.map[gate, bucket], lm.LEAST), 1 - lm.LEAST)
            total += math.log10(p if bit else 1 - p)
            agrees = agrees and int(code.bits[code.start[expected] + depth]) == bit
        return total

    def group(k):
        told = [m.prior[g] + sum(float(m.logs[g, x % lm.GROUPED]) for x in h[:k]) for g in range(len(m.prior))]
        return int(np.argmax(np.array(told) > max(told) - 1e-6))

    names, total, after = [int(lm._START)] * 2 + h + [int(lm._CLOSE)], 0.0, {}
    for k in range(len(h) + 1):
        older, before = names[k], names[k + 1]
        place = int(m.table.find(np.array([names[k + 2]], np.uint64))[0]) if k < len(h) else -1
        symbol = m.escape + 1 if k == len(h) else int(m.number[place]) if place >= 0 else m.escape
        first = one(before * 3 + 1)
        second = one(first + one(older + 5))
        total += bits(m.words, symbol, [first, second], group(k), after.get((older, before)))
        after[older, before] = symbol
        if symbol == m.escape:
            word = words[k]
            for i, c in enumerate([*word, lm.END_OF_WORD]):
                past = [one(sum((word[i - j] + 1) << 9 * (j - 1) for j in range(1, min(i, n) + 1)) + (n << 56)) for n in lm.SPELLED]
                total += bits(m.bytes, c, past, 0, None)
    return total


def test_language_model_equals_plain_coding(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    new = [(-1, "never seen wörds ööö and the of the of the of"), (-2, ""), (-3, None), (-4, "the of and " * 40)]
    monkeypatch.setattr(lm, "CODED", 3000)
    m, got = trained(spark, docs.unionByName(spark.createDataFrame([(*r, None) for r in new], docs.schema)), F.col("doc_id") >= 0, monkeypatch)
    short = docs.where("length(text) < 900").limit(6).collect()
    assert m.escape <= 3000
    for i, text in [*new, *[(r.doc_id, r.text) for r in short]]:
        assert abs(got[i].score - plain_score(m, text)) < 0.01 * abs(got[i].score) + 0.01, i


def test_language_model_beats_counts_on_held_out_texts(spark):
    total = QUERIES["op8_lm_scoring"](spark, SF).where("held_out").agg(F.sum("score").alias("model"), F.sum("base_score").alias("base")).first()
    assert total.model > total.base


@pytest.mark.parametrize("shard", [lm.SHARD, 100_000])
def test_language_model_does_not_depend_on_partitions(spark, monkeypatch, shard):
    monkeypatch.setattr(lm, "SHARD", shard)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    learn = ~langid.held_out("doc_id", 7)
    runs = []
    for n, size in ((1, "4096"), (8, "50")):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
        runs.append({r.doc_id: (r.score, r.base_score) for r in lm.score(docs.repartition(n, "text"), learn).collect()})
    held = [r.doc_id for r in docs.where(langid.held_out("doc_id", 7)).collect()]
    assert all(abs(runs[0][d][0] - runs[1][d][0]) <= 1e-6 * abs(runs[0][d][0]) for d in runs[0])
    if shard > 1_000_000:
        assert sum(runs[0][d][0] for d in held) > sum(runs[0][d][1] for d in held)


@pytest.mark.parametrize("counts", [[1, 1], [5, 1, 1, 9], [1] * 100, [2**k for k in range(40)]])
def test_codes_are_prefix_free_and_bounded(counts):
    code = lm.code_of(np.array(counts, np.int64))
    words = sorted("".join(map(str, code.bits[a:b])) for a, b in zip(code.start, code.start[1:]))
    assert all(not b.startswith(a) for a, b in zip(words, words[1:])) and max(map(len, words)) <= 31
    assert sum(2.0 ** -len(w) for w in words) == 1
    for k, key in enumerate(code.key):
        own = code.bits[code.start[k] : code.start[k + 1]]
        assert f"{key:032b}"[: len(own)] == "".join(map(str, own))


def test_lookup_finds_all_and_nothing_else():
    rng = np.random.default_rng(0)
    keys = np.unique(rng.integers(0, 2**64, 5000, dtype=np.uint64))
    look = lm.Lookup(keys)
    assert (look.find(keys) == np.arange(len(keys))).all() and (look.find(keys + np.uint64(1)) == -1).all()
    assert (lm.Lookup(keys[:0]).find(keys) == -1).all()


def test_decontamination(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    item = bench.where("item_id = 0").first().text.split()
    changed = [w if k % 6 else "other" for k, w in enumerate(item)]
    added = [(-1, "before it " + " ".join(item) + " after it"), (-2, " ".join(changed)), (-3, " ".join(item[: len(item) // 3])), (-4, None), (-5, ""), (-6, "long " * 50_000)]
    table = docs.union(spark.createDataFrame(added, "doc_id long, text string"))
    found = {(r.doc_id, r.item_id) for r in decontam.contamination(table, bench).collect()}
    assert {(-1, 0), (-2, 0)} <= found and not {-3, -4, -5, -6} & {d for d, _ in found}
    clean = lambda t: " ".join("".join(c if c.isalnum() else " " for c in t.lower()).split())
    texts = {r.doc_id: clean(r.text or "") for r in docs.collect()}
    exact = {(d, r.item_id) for r in bench.collect() for d, t in texts.items() if clean(r.text) in t}
    assert exact and exact <= found
    kept = {r.doc_id for r in decontam.remove_contaminated(table, bench).collect()}
    assert kept == {r.doc_id for r in table.collect()} - {d for d, _ in found}
    assert decontam.contamination(table.limit(0), bench).collect() == [] and decontam.contamination(table, bench.limit(0)).collect() == []


def test_decontamination_of_short_items_and_ties(spark):
    long = "the quick brown fox jumps over the lazy dog near the old river bank today"
    bench = spark.createDataFrame([(1, "forty two"), (2, "Forty, two!"), (3, long), (4, long), (5, None), (6, "?!")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "forty TWO"), (2, "forty two men"), (3, f"so {long} it goes"), (3, long), (None, "forty two"), (5, "?!")], "doc_id long, text string")
    found = sorted(((r.doc_id or 0), r.item_id) for r in decontam.contamination(docs, bench).collect())
    assert found == [(0, 1), (0, 2), (1, 1), (1, 2), (3, 3), (3, 3), (3, 4), (3, 4)]
    assert [(r.doc_id, r.text) for r in decontam.remove_contaminated(docs, bench).orderBy("doc_id").collect()] == [(2, "forty two men"), (5, "?!")]
    only = decontam.contamination(docs, bench.where("item_id < 3"))
    assert sorted(((r.doc_id or 0), r.item_id) for r in only.collect()) == [(0, 1), (0, 2), (1, 1), (1, 2)]


@pytest.mark.parametrize("rate, least", [(0.25, 0.95), (0.4, 0.85)])
def test_decontamination_finds_paraphrases(spark, rate, least):
    """Items with a share of words replaced by other words of the corpus, among unrelated text."""
    docs, bench = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    rng = random.Random(2)
    words = [w for r in docs.limit(200).collect() for w in (r.text or "").split()]
    noise = lambda n: " ".join(rng.choice(words) for _ in range(n))
    rows = [(-1 - r.item_id, noise(30) + " " + " ".join(rng.choice(words) if rng.random() < rate else w for w in r.text.split()) + " " + noise(30)) for r in bench.collect()]
    plain = [(-1000 - k, noise(100)) for k in range(200)]
    table = docs.select("doc_id", "text").union(spark.createDataFrame(rows + plain, "doc_id long, text string"))
    found = {(r.doc_id, r.item_id) for r in decontam.contamination(table, bench).collect()}
    assert sum((i, -1 - i) in found for i, _ in rows) >= least * len(rows)
    assert not any(d <= -1000 for d, _ in found)


def test_decontamination_fits_on_every_passage_and_finds_what_brute_force_finds(spark):
    """The basis holds what the best one of its rank holds of all passages' TF-IDF rows, and the search what an exact comparison of all passages finds."""
    docs, bench = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "benchmark"))
    rng = random.Random(4)
    words = [w for r in docs.limit(50).collect() for w in (r.text or "").split()]
    noise = lambda n: " ".join(rng.choice(words) for _ in range(n))
    items = sorted((r.item_id, r.text) for r in bench.collect())
    added = [(-1 - i, noise(20) + " " + " ".join(rng.choice(words) if rng.random() < 0.45 else w for w in t.split()) + " " + noise(20)) for i, t in items]
    table = docs.select("doc_id", "text").union(spark.createDataFrame(added, "doc_id long, text string"))
    rank = 40
    ix = decontam.build(items, table, "text", decontam.Scratch(spark, "test"), rank)
    split = lambda t: tx.words(pa.array([t], pa.string()), decontam._BREAKS)[0]
    texts = [(r.doc_id, split(r.text or "")) for r in table.collect()]
    cut = lambda h: [h[k : k + decontam.PASSAGE] for k in range(0, max(1, len(h) - decontam.PASSAGE + decontam.STRIDE), decontam.STRIDE)]
    place = {int(t): k for k, t in enumerate(ix.terms)}

    def rows(passages):
        out = []
        for p in passages:
            n = Counter(place[x] for x in p.tolist() if x in place)
            row = np.zeros(len(place))
            for t, k in n.items():
                row[t] = (1 + math.log(k)) * ix.idf[t]
            if n:
                out.append(row / np.linalg.norm(row))
        return np.array(out)

    corpus, own = rows(p for _, h in texts for p in cut(h)), rows(p for s in ix.items for p in cut(s))
    gram = corpus.T @ corpus + max(1.0, len(corpus) / len(own)) * own.T @ own
    q, _ = np.linalg.qr(ix.basis.astype(float))
    assert np.trace(q.T @ gram @ q) > 0.98 * np.linalg.eigvalsh(gram)[-rank:].sum()

    brute, answers = set(), decontam._answers(ix)
    for d, h in texts:
        for k, s in enumerate(ix.items):
            reach = max(0, len(s) - decontam.STRIDE) + max(4, len(s) // 4)
            for a in range(0, max(1, len(h) - decontam.PASSAGE + decontam.STRIDE), decontam.STRIDE):
                region = h[max(0, a - reach) : a + decontam.PASSAGE + reach].tolist()
                if len({*region} & {*answers[k]}) >= decontam.ANSWER * len(answers[k]) and decontam._lcs(s, region) >= decontam.LCS * len(s):
                    brute.add((d, ix.ids[k]))
    found = {(r.doc_id, r.item_id) for r in decontam.contamination(table, bench).collect()}
    assert brute and len(brute & found) >= 0.9 * len(brute) and found <= brute


def test_sums_of_pairs_are_the_same_dense_and_sparse(monkeypatch):
    rng = np.random.default_rng(0)
    lists = [rng.integers(0, 50, rng.integers(1, 33)).tolist() for _ in range(300)]
    batch = pa.record_batch([pa.array(lists, pa.list_(pa.int32())), pa.array(rng.uniform(1, 3, 300))], names=["row", "weight"])

    class Shared:
        value = rng.uniform(0.1, 5, 50)

    runs = []
    for dense in (decontam.DENSE, 2400):
        monkeypatch.setattr(decontam, "DENSE", dense)
        total = np.zeros((50, 50), np.int64)
        for part in decontam._products(Shared)([batch.slice(0, 90), batch.slice(90)]):
            for t, other, sums in zip(*(c.to_pylist() for c in part.columns)):
                total[t, other] += sums
        runs.append(total)
    plain = np.zeros((50, 50))
    for row, weight in zip(lists, batch.column(1).to_pylist()):
        t, w = decontam._row(np.array(row), Shared.value)
        plain[np.ix_(t, t)] += weight * np.outer(w, w)
    assert (runs[0] == runs[1]).all() and np.allclose(runs[0] / decontam.UNIT, np.triu(plain), atol=1e-3)


def test_sums_of_many_terms_pairs_take_little_memory():
    rng = np.random.default_rng(0)
    lists = [rng.integers(0, 4000, 32).tolist() for _ in range(2048)]
    batch = pa.record_batch([pa.array(lists, pa.list_(pa.int32())), pa.array(np.ones(2048))], names=["row", "weight"])

    class Shared:
        value = rng.uniform(0.1, 5, 4000)

    tracemalloc.start()
    rows = sum(len(part) for part in decontam._products(Shared)([batch]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == 4000 and peak < 90 << 20


def test_sums_of_pairs_fit_32_bits_and_carry():
    """4,000 terms' sums take half of what 64 bits would; products and sums beyond 32 bits are exact."""
    rng = np.random.default_rng(1)
    tracemalloc.start()
    sums = decontam._Sums(4000)
    total, seen = {}, 0
    for k in range(40):
        one = rng.integers(0, 4000, 5000)
        one[:256] = 7
        two = np.minimum(one + rng.integers(0, 30, 5000), 3999)
        two[:256] = 9
        value = rng.integers(0, 1 << 22, 5000)
        value[:256] = (1 << 22) - 1 if k % 2 else 1 << 45
        sums.add(one, two, value)
        for key, x in zip((one * 4000 + two).tolist(), value.tolist()):
            total[key] = total.get(key, 0) + x
        if k == 20:
            for key, x in sums.taken(whole=False):
                seen += len(key)
                for a, b in zip(key.tolist(), x.tolist()):
                    total[a] -= b
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    for key, x in sums.taken():
        for a, b in zip(key.tolist(), x.tolist()):
            total[a] -= b
    assert seen and not any(total.values()) and not sums.dense.any() and peak < 60 << 20


def test_decontamination_makes_no_table_of_a_list(spark, monkeypatch):
    """A table of a Python list starts workers of another kind on every executor."""
    docs = spark.range(40).selectExpr("id doc_id", "concat('one two three four five six ', id) text")
    bench = spark.sql("select 1L item_id, 'one two three four five six 7' text")
    made, make = [], type(spark).createDataFrame
    monkeypatch.setattr(type(spark), "createDataFrame", lambda self, data, *a, **b: made.append(type(data)) or make(self, data, *a, **b))
    found = {r.doc_id for r in decontam.contamination(docs, bench).collect()}
    assert 7 in found and list not in made


def test_levels_and_gates_are_the_same_by_tables_and_by_bounds():
    level = np.arange(1, 256, dtype=np.uint8)
    assert (lm._stretched(level) == lm._STRETCH[1:]).all() and (lm._sure(level) == lm._GATE[1:]).all()
    x = np.linspace(-20, 20, 40_011).astype(np.float32)
    assert np.mean(lm._sure_of(x) != lm._GATE[lm._level(x)]) < 1e-3


def test_learner_equals_plain_learning_and_holds_counts_in_single_precision():
    """One step of the learner: gradients summed gate by gate, and counts of both tables."""
    rng = np.random.default_rng(1)
    m = lm.fresh(rng.integers(1, 50, (2, 40)), (12, 12))
    learner = lm._Learner(m, 4)
    n = 300
    s = lm.Stream(rng.integers(0, 40, n), [rng.integers(0, 2**64, n, dtype=np.uint64) % np.uint64(7) * lm._NODE for _ in range(2)], rng.integers(0, 2, n).astype(np.int8), np.full(n, -1))
    s.expected[::3] = rng.integers(0, 40, len(s.expected[::3]))
    for learnt in range(3):
        before = learner.m.weights.copy(), learner.power.copy(), [t.copy() for t in learner.near]
        (l,) = lm._lanes(learner.m, s, n)
        x = []
        for slot, f, near in zip(l.slots, m.first, before[2]):
            zero, one = near.astype(float).reshape(-1, 2)[(slot - f) >> learner.shift].T
            x.append(np.log((one + lm.DELTA) / (zero + lm.DELTA)))
        match = np.zeros(len(l.bit))
        match[l.matched] = l.match
        told = np.isin(np.arange(len(l.bit)), l.matched)
        sure = [lm._GATE[lm._level(v)] for v in x]
        gate = (sure[0] * (len(lm.SURE) + 1) + sure[1]) * 2 + told
        inputs = np.stack([l.own, *x, match, np.ones(len(match))])
        mixed = 1 / (1 + np.exp(-np.clip((before[0][:, gate] * inputs).sum(0), -lm.MOST, lm.MOST - 0.1)))
        learner.learn(s)
        for g in np.unique(gate):
            slope = (inputs * (l.bit - mixed))[:, gate == g].mean(1)
            power = before[1][:, g] + slope**2
            assert np.allclose(learner.m.weights[:, g], before[0][:, g] + lm.RATE * slope / np.sqrt(power), atol=2e-3), (learnt, g)
        assert learner.near[0].dtype == np.float32 and learner.near[0].sum() == (learnt + 1) * len(l.bit)
        assert learner.total.sum() == 2 * (learnt + 1) * len(l.bit)


def test_pipeline_decontamination_fits_on_all_passages_of_what_it_is_given(spark, monkeypatch):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").where("doc_id % 2 = 0")
    rows, svd = [], decontam._randomised_svd
    monkeypatch.setattr(decontam, "_randomised_svd", lambda *a: rows.append(a[0].count()) or svd(*a))
    corpus_pipeline.decontamination(spark, docs, sf)
    cut = lambda t: [h[k : k + decontam.PASSAGE].tolist() for h in [tx.words(pa.array([t], pa.string()), decontam._BREAKS)[0]] for k in range(0, max(1, len(h) - decontam.STRIDE), decontam.STRIDE)]
    items = [p for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect() for p in cut(r.text)]
    known = {w for p in items for w in p}
    assert rows == [len(items) + sum(not known.isdisjoint(p) for r in docs.collect() for p in cut(r.text or ""))]


def test_pipeline_language_is_learnt_from_all_rows(spark):
    import corpus_pipeline

    held = [k for k in range(60) if zlib.crc32(str(k).encode()) % 4 == 2]
    docs = spark.createDataFrame([(k, "some words of a text", "en") for k in held], "doc_id long, text string, lang string")
    assert held and corpus_pipeline.language_id(spark, docs, "").count() == len(held)
