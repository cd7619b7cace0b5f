"""Elkan clustering, the prefix trie and adaptive quality rules against plain versions."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np

from textloom.llm import elkan, quality, trie
from textloom.llm.scan import Fold, scan
from textloom.llm.scratch import Scratch


# --- clustering ---------------------------------------------------------------------------------------------


def plain_kmeans(rows, k, rounds):
    """rows: [(id, ints)]; every distance worked out."""
    d = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    seeds = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest() if i is not None else "z", v) for i, v in rows)
    centres = [list(v) for _, v in seeds[:k]]
    for r in range(rounds + 1):
        at = [min((d(v, c), j) for j, c in enumerate(centres)) for _, v in rows]
        if r < rounds:
            for j in range(len(centres)):
                own = [v for (_, v), (_, a) in zip(rows, at) if a == j]
                if own:
                    centres[j] = [sum(x) // len(own) for x in zip(*own)]
    each = Counter()
    for far, j in at:
        each[j] += far
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted((repr(i), j, far, each[j], sum(each.values()), sha[j]) for (i, _), (far, j) in zip(rows, at))


def test_clusters_equal_plain_kmeans_with_ties(spark):
    rng = random.Random(5)
    for dim, k, most, n in ((2, 5, 2, 300), (4, 16, 9, 400), (64, 7, 40, 120)):
        rows = [(i, tuple(rng.randint(-most, most) for _ in range(dim))) for i in range(n)]
        rows += [(n + i, rows[i][1]) for i in range(40)] + [(3, rows[3][1]), (None, rows[0][1])]
        table = spark.createDataFrame([(i, [x / 64 for x in v], 7, "q") for i, v in rows], "vec_id long, embedding array<double>, cluster int, v string").repartition(5)
        got = elkan.cluster(table, k=k, rounds=3, dim=dim).collect()
        assert sorted((repr(r.vec_id), r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in got) == plain_kmeans(rows, k, 3)


def test_bounds_skip_most_distances(spark):
    rng = np.random.default_rng(2)
    x = rng.integers(-60, 60, (16, 64))[rng.integers(0, 16, 2000)] + rng.integers(-3, 4, (2000, 64))
    table = spark.createDataFrame([(i, [float(c) / 64 for c in v]) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = elkan.cluster(table, k=16, rounds=3).collect()
    assert sum(r.calculated for r in got) < 0.35 * len(got) * 16 * 4
    assert sorted((repr(r.vec_id), r.cluster, r.distance) for r in got) == [r[:3] for r in plain_kmeans([(i, tuple(map(int, v))) for i, v in enumerate(x)], 16, 3)]


def test_bounds_hold_at_large_values():
    rng = np.random.default_rng(3)
    x, centres = rng.integers(-(1 << 26), 1 << 26, (500, 64)), rng.integers(-(1 << 26), 1 << 26, (9, 64))
    at, upper, lower, _ = elkan.Round(centres, np.zeros(9)).assign(x, np.zeros(500, np.int64), np.full(500, np.inf), np.zeros((500, 9), np.float32))
    for step in range(4):
        exact = [[sum((int(a) - int(b)) ** 2 for a, b in zip(v, c)) for c in centres] for v in x]
        assert list(at) == [min((d, j) for j, d in enumerate(row))[1] for row in exact]
        roots = np.array([[math.isqrt(d) for d in row] for row in exact], np.float64)
        assert (upper >= roots[np.arange(500), at]).all() and (lower <= roots + 1).all()
        after = centres + rng.integers(-1000, 1000, centres.shape)
        moved = elkan._up(np.sqrt(elkan.squared(after, centres).astype(np.float64)))
        centres = after
        at, upper, lower, _ = elkan.Round(centres, moved).assign(x, at, upper, lower)


def test_clusters_of_odd_rows(spark):
    odd = [None, [], [1.0] * 63, [1.0] * 65, [float("nan")] + [0.0] * 63, [float("inf")] + [0.0] * 63, [None] + [0.0] * 63, [1e30] + [0.0] * 63]
    good = [[0.0] * 64, [0.5] * 64, [0.5] * 64]
    table = spark.createDataFrame([(i, v) for i, v in enumerate(odd + good)], "vec_id long, embedding array<double>")
    got = {r.vec_id: (r.cluster, r.distance, r.inertia) for r in elkan.cluster(table).collect()}
    assert sorted(got) == [8, 9, 10] and got[9] == got[10] and all(v[1:] == (0, 0) for v in got.values())
    assert elkan.cluster(table.where("vec_id < 8")).collect() == [] and elkan.cluster(table.limit(0)).collect() == []


# --- trie ---------------------------------------------------------------------------------------------------


def plain_trie(rows):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()[:32]
            convs[c].append(((turn is not None, turn or 0), role, digest, text))
    convs = {c: [(r, t) for _, r, _, t in sorted(v)] for c, v in convs.items()}
    built = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = convs.get(c - c % 20, [])[:h] + own[h:]
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    children = Counter(n[:-1] for n in members if n)
    leaves, saved = Counter(), Counter()
    for n, own in members.items():
        value = (len(own) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", n[-1][1])) if n else 0
        for d in range(len(n) + 1):
            saved[n[:d]] += value
            leaves[n[:d]] += n not in children
    sha = lambda ids: hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest()
    return sorted((min(own), len(n), -1 if not n else min(members[n[:-1]]), len(own), children[n], leaves[n], saved[n], sha(ends[n])) for n, own in members.items())


def trie_rows(table):
    return sorted((r.conv_id, r.depth, -1 if r.parent_conv_id is None else r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in trie.prefix_trie(table).collect())


def test_trie_equals_plain_trie(spark):
    rng = random.Random(9)
    rows = []
    for c in rng.sample(range(400), 150):
        for turn in range(rng.randint(1, 7)):
            rows.append((c, turn, rng.choice(["user", "assistant"]), rng.choice(["hi there", "a b c", "", "x"])))
    # a long conversation, copies of it that part from it, turnless ones, nulls, ties, repeated rows
    long = [(turn, "user", f"turn {turn} of many") for turn in range(2600)]
    rows += [(1000, *t) for t in long] + [(1020, *t) for t in long[:2000]] + [(1040, *t) for t in long] + [(1060, *t) for t in long[:1500] + [(1500, "user", "else")]]
    turnless = next(c for c in range(2001, 2020) if zlib.crc32(str(c).encode()) % 4 == 3)
    rows += [(turnless, 0, "user", "gone"), (None, 1, "user", "nobody"), (77777, None, None, None), (77777, 3, "user", None), (77777, 3, "user", "b"), (77777, 3, "user", "a"), (77777, 3, "user", "a")]
    rng.shuffle(rows)
    table = spark.createDataFrame([(*r, 1, "q", "q") for r in rows], "conv_id long, turn long, role string, text string, depth int, node string, key string").repartition(7)
    assert trie_rows(table) == plain_trie(rows)


def test_trie_of_copies_takes_few_rounds(spark):
    rows = [(20 * c, turn, "user", "same " * turn) for c in range(3000) for turn in range(3)] + [(20 * c + 20 * 3000, 0, "user", f"own {c % 7}") for c in range(500)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert trie_rows(table) == plain_trie(rows)


def test_trie_of_empty_and_long_tables(spark):
    table = spark.createDataFrame([(5, 0, "user", "w " * 500_000)], "conv_id long, turn long, role string, text string")
    assert trie_rows(table) == plain_trie([(5, 0, "user", "w " * 500_000)])
    assert trie.prefix_trie(table.limit(0)).collect() == [] and trie.prefix_trie(table.where("false").repartition(3)).collect() == []


def test_scan_carries_over_partitions(spark):
    rng = random.Random(1)
    rows = [(0, i, rng.randint(-5, 5)) for i in range(3000)] + [(k, i, k) for k in range(1, 40) for i in range(k % 4 + 1)]
    table = spark.createDataFrame(rows, "key long, at long, x long").repartition(6)
    total = Fold("total long", lambda x: (x,), lambda a, b: (a[0] + b[0],))
    got = scan(table, ["at"], ["x"], total, Scratch(spark, "scan"), "sums")
    seen, want, size = Counter(), [], Counter(k for k, *_ in rows)
    for k, i, x in sorted(rows):
        seen[k] += x
        want.append((k, i, x, seen[k], i + 1 == size[k]))
    assert sorted(map(tuple, got.collect())) == want


# --- quality ------------------------------------------------------------------------------------------------


def plain_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {i + j for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for j in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), len(lines)


def plain_verdicts(rows):
    """rows: [(id, lang, source, text)]."""
    counts = [dict(zip(quality.BASE, plain_counts(t))) for *_, t in rows]
    failed = [c["n_words"] < 10 or 100 * c["n_repeat_words"] > 20 * c["n_words"] for c in counts]

    def edge(v):
        cut = max(v.bit_length() - quality.BITS - 1, 0)
        return v >> cut << cut

    def fence(rule, own):
        edges = sorted(edge(rule.scale * c[rule.part] // c[rule.whole]) for c in own if c[rule.whole])
        return len(edges), *(edges[max(0, -(-q * len(edges) // 4) - 1)] if edges else None for q in (1, 3))

    out = []
    for (i, lang, source, _), c, bad in zip(rows, counts, failed):
        reasons = []
        for rule in quality.RULES:
            own = [x for r, x, f in zip(rows, counts, failed) if not f and r[1:3] == (lang, source)]
            wider = [x for r, x, f in zip(rows, counts, failed) if not f and r[1] == lang]
            every = [x for x, f in zip(counts, failed) if not f]
            n, q1, q3 = next((found for group in (own, wider) if (found := fence(rule, group))[0] >= quality.LEAST_GROUP), fence(rule, every))
            if c[rule.whole] and q1 is not None:
                v, wide, slack = rule.scale * c[rule.part] // c[rule.whole], quality.FENCE * max(q3 - q1, rule.spread), rule.noise / math.sqrt(c[rule.whole])
                if v > q3 + wide + slack or rule.low and v < q1 - wide - slack:
                    reasons.append(rule.name)
        out.append((repr(i), *c.values(), bad, not bad and not reasons, ",".join(reasons)))
    return sorted(out)


def quality_rows(seed=4):
    rng = random.Random(seed)
    word = lambda n: "".join(rng.choice("aeioustrné") for _ in range(max(1, n)))

    def text(mean, symbols=0.0, lines=0):
        t = " ".join(word(round(rng.gauss(mean, 1))) + ("#" if rng.random() < symbols else "") + (rng.choice([" ", "\n", "\t", "  "]) if rng.random() < 0.1 else "") for _ in range(rng.randint(5, 90)))
        return t + "".join("\nsame line here" for _ in range(lines))

    rows = [(i, lang, source, text(mean)) for lang, source, mean, n in (("en", "a", 5, 90), ("en", "b", 9, 60), ("en", "few", 5, 9), ("de", "a", 6, 20), (None, None, 5, 5)) for i in range(n)]
    rows += [(1000 + i, "en", "a", text(5, 0.6)) for i in range(6)] + [(2000 + i, "en", "b", text(5)) for i in range(6)] + [(3000 + i, "en", "a", text(15)) for i in range(6)] + [(4000 + i, "en", "a", text(5, 0, 30)) for i in range(3)]
    return rows + [(5000, "en", "a", None), (5001, "en", "a", ""), (None, "en", "a", " \n\t\n"), (5002, None, "a", "a b c d e f g h i j k a b c d e"), (5002, None, "a", "a b c d e f g h i j k a b c d e"), (5003, "xx", None, "\r\n".join(["l one", "l one", " "] * 9))]


def test_quality_equals_plain_rules(spark):
    rows = quality_rows()
    table = spark.createDataFrame([(*r, 1, "q", "q") for r in rows], "doc_id long, lang string, source string, text string, n_words int, kept string, __id string").repartition(5)
    got = sorted((repr(r[0]), *r[1:]) for r in map(tuple, quality.judge(table).collect()))
    assert got == plain_verdicts(rows)
    dropped = {int(r[0]) for r in got if r[-1]}
    # what is common in one source is not in another
    assert len([i for i in dropped if 1000 <= i < 1100]) >= 5 and len([i for i in dropped if 3000 <= i < 3100]) >= 4 and len([i for i in dropped if i < 90]) <= 2
    kept = quality.keep(table)
    assert kept.columns == table.columns and sorted(repr(r.doc_id) for r in kept.collect()) == sorted(r[0] for r in got if r[-2])
    assert quality.judge(table.limit(0)).collect() == [] and quality.keep(table.limit(0)).collect() == []


def test_sketches_merge_by_adding(spark):
    rows = quality_rows(8)
    table = spark.createDataFrame(rows, "doc_id long, lang string, source string, text string")
    measured = quality.measure(table, "text", ("lang", "source")).persist()
    whole = quality.sketches(measured, ("lang",)).collect()
    parts = quality.sketches(measured, ("lang", "source")).groupBy("lang", "rule", "edge").sum("n").collect()
    assert sorted(map(repr, map(tuple, whole))) == sorted(map(repr, map(tuple, parts)))
    assert sorted(map(repr, map(tuple, quality.judge(table.repartition(1)).collect()))) == sorted(map(repr, map(tuple, quality.judge(table.repartition(11)).collect())))


def test_counts_of_very_long_texts(spark):
    text = "Word word é #x\n" * 60_000 + "a" * 3_000_000 + "\n" + " ".join(f"w{i}" for i in range(50_000))
    got = quality.measure(spark.createDataFrame([(1, text), (2, "x y")], "doc_id long, text string"), "text", ("doc_id",)).orderBy("doc_id").collect()
    assert tuple(got[0])[1:] == plain_counts(text) and tuple(got[1]) == (2, 2, 2, 0, 0, 0, 1)
