"""Line dedup, URL filter and chat formatting on small tables."""

import hashlib
import random
import re

from textloom.llm import chat, line_dedup, url_filter
from textloom.llm.queries import URL_RULES


def test_line_dedup(spark):
    rows = [(i, "a", f"menu\nbody {i}\n\nbody {i}\nmenu") for i in range(8)] + [(8, "a", None), (9, "a", ""), (10, None, "menu\nx"), (11, "b", "menu\nx"), (12, "a", "menu")]
    pages = spark.createDataFrame([(*r, "z") for r in rows], "doc_id long, source string, text string, n_lines string")
    got = {r.doc_id: r for r in line_dedup.drop_boilerplate(pages, ratio=0.5, least_pages=3).collect()}
    assert got[3].text == "body 3\n\nbody 3" and (got[3].n_lines, got[3].n_dropped) == (5, 2)
    assert (got[8].text, got[8].n_lines, got[9].text, got[9].n_lines) == (None, 0, "", 1)
    assert got[10].text == "menu\nx" and got[11].text == "menu\nx" and got[12].text == ""
    assert line_dedup.drop_boilerplate(pages.limit(0)).collect() == []


def test_plans_of_native_operators_have_no_python(spark):
    pages = spark.createDataFrame([(1, "http://a.org/x", "<a href='http://b.com/'>")], "page_id long, url string, html string")
    plans = [url_filter.judge(pages, [url_filter.Rule(*r) for r in URL_RULES]), line_dedup.drop_boilerplate(pages.selectExpr("page_id as doc_id", "url as source", "html as text"))]
    assert not any("Python" in p._jdf.queryExecution().toString() or "Arrow" in p._jdf.queryExecution().toString() for p in plans)


def test_url_rules_and_graph(spark):
    urls = ["HTTP://WWW.Example.ORG/es/1?q", "http://example.org/en/17", "http://example.org/en/2#t", "http://x.com/de/1", "http://x.com/fr", "http://x.com/fr/", None, "no-scheme/org/",
            "http://bad.net/", "http://good.net/", "http://lone.net/", "http://spam.com/de/9", "ftp://u@h.org", "http://notorg/", "http://", ""]
    html = {8: "<a HREF='http://spam.com/x'>", 2: '<a href="//good.net/a">', 3: None}
    pages = spark.createDataFrame([(i, u, html.get(i, "")) for i, u in enumerate(urls)], "page_id long, url string, html string")
    got = {r.page_id: r for r in url_filter.judge(pages, [url_filter.Rule(*r) for r in URL_RULES]).collect()}
    assert [got[i].rule for i in range(len(urls))] == ["example.org/es/", "example.org/en/1", "org/", "com/de/", None, "com/fr/", None, None, None, None, None, "com/de/", None, None, None, None]
    assert (got[0].host, got[0].path) == ("www.example.org", "/es/1") and (got[6].host, got[6].path) == ("", "") and (got[7].host, got[7].path) == ("", "")
    assert got[12].host == "u@h.org" and got[12].path == ""
    assert [got[i].verdict for i in (0, 1, 2, 3, 5, 6, 8, 9, 10)] == ["block", "block", "allow", "block", "allow", "allow", "block", "allow", "allow"]
    assert got[9].trust > 0 and got[8].distrust > got[8].trust
    assert url_filter.judge(pages.limit(0), [url_filter.Rule(*URL_RULES[0])]).collect() == []


def power_iteration(edges, seeds, damping=0.85):
    """Personalised PageRank along edges {(src, dst): weight} from seeds {host: share}, until it stands still."""
    out = {}
    for (a, _), w in edges.items():
        out[a] = out.get(a, 0) + w
    rank = dict(seeds)
    for _ in range(500):
        after = {h: (1 - damping) * s for h, s in seeds.items()}
        for (a, b), w in edges.items():
            after[b] = after.get(b, 0) + damping * rank.get(a, 0) * w / out[a]
        rank = after
    return rank


def test_url_ranks_equal_power_iteration(spark):
    rng = random.Random(3)
    hosts = [f"h{k}.net" for k in range(12)] + ["a.org", "b.org", "c.com", "d.com"]
    rows, edges = [], {}
    for k in range(120):
        host = rng.choice(hosts)
        to = [rng.choice(hosts[: 6 if host.endswith("org") else 12] if rng.random() < 0.8 else ["hub.net"]) for _ in range(rng.randint(0, 4))]
        rows.append((k, f"http://{host}/de/{k}", " ".join(f'<a href="https://{t.upper()}/x">' for t in to)))
        for t in to:
            if t != host:
                edges[host, t] = edges.get((host, t), 0) + 1
    rows += [(200, "http://lone.net/", None), (201, "http://lone.net/", "<a href='//lone.net/'>")]
    pages = spark.createDataFrame([(*r, "q", "q") for r in rows], "page_id long, url string, html string, trust string, src string")
    got = {r.host: r for r in url_filter.judge(pages, [url_filter.Rule(*r) for r in URL_RULES]).collect()}
    judged = [h for h in hosts if h.endswith(("org", "com")) and any(f"//{h}/" in u for _, u, _ in rows)]
    shares = lambda end: {h: 1 / len(judged) for h in judged if h.endswith(end)}  # noqa: E731  each host's judged pages are all of one kind
    trust = power_iteration(edges, shares("org"))
    distrust = power_iteration({(b, a): w for (a, b), w in edges.items()}, shares("com"))
    assert len(edges) > 50 and sum(t > 0 for t in trust.values()) > 8
    for host, r in got.items():
        assert abs(r.trust - trust.get(host, 0)) < 1e-5 and abs(r.distrust - distrust.get(host, 0)) < 1e-5, host
        if r.rule is None:
            assert r.verdict == ("block" if r.distrust > r.trust else "allow")
    assert (got["lone.net"].trust, got["lone.net"].verdict) == (0, "allow")


def test_hosts_without_links_go_as_most_of_their_own_pages_do(spark):
    urls = [f"http://mixed.com/fr/{k}" for k in range(4)] + [f"http://mixed.com/de/{k}" for k in range(3)] + ["http://mixed.com/x", "http://bad.com/de/1", "http://bad.com/x", "http://even.com/de/1", "http://even.com/fr/1", "http://even.com/x"]
    urls += [f"http://big.org/{k}" for k in range(200)]  # many allowed pages elsewhere take nothing from mixed.com
    pages = spark.createDataFrame([(k, u, "") for k, u in enumerate(urls)], "page_id long, url string, html string")
    got = {r.url: r.verdict for r in url_filter.judge(pages, [url_filter.Rule(*r) for r in URL_RULES]).collect()}
    assert [got[f"http://{h}.com/x"] for h in ("mixed", "bad", "even")] == ["allow", "block", "allow"]


def test_linked_pages_get_verdicts_from_their_links(spark):
    from textloom.llm.queries import linked_url_filter, with_links

    rows = {r.page_id: r for r in linked_url_filter(spark, "/root/testdata/sf0.01").collect()}
    pages = with_links(spark.read.parquet("/root/testdata/sf0.01/pages.parquet")).collect()
    edges, good, bad = {}, {}, {}
    for p in pages:
        r = rows[p.page_id]
        for to in re.findall(r'href="(https?://[^"]*)"', p.html):
            host = to.split("://", 1)[1].split("/")[0].split("?")[0].split("#")[0].lower()
            if host != r.host:
                edges[r.host, host] = edges.get((r.host, host), 0) + 1
        if r.rule:
            side = good if r.verdict == "allow" else bad
            side[r.host] = side.get(r.host, 0) + 1
    judged = set(good) | set(bad)
    share = lambda own: {h: own.get(h, 0) / (good.get(h, 0) + bad.get(h, 0)) / len(judged) for h in judged}
    trust, distrust = power_iteration(edges, share(good)), power_iteration({(b, a): w for (a, b), w in edges.items()}, share(bad))
    assert len(edges) > 100 and any(r.rule is None and r.verdict == "block" for r in rows.values())
    for r in rows.values():
        assert abs(r.trust - trust.get(r.host, 0)) < 1e-5 and abs(r.distrust - distrust.get(r.host, 0)) < 1e-5
        assert r.rule is not None or r.verdict == ("block" if r.distrust > r.trust else "allow")


def test_url_domains_speak_for_each_other_where_asked(spark):
    pages = spark.createDataFrame([(1, "http://a.com/de/1", ""), (2, "http://b.com/x", "")], "page_id long, url string, html string")
    rules = [url_filter.Rule(*r) for r in URL_RULES]
    assert {r.page_id: r.verdict for r in url_filter.judge(pages, rules).collect()} == {1: "block", 2: "allow"}
    assert {r.page_id: r.verdict for r in url_filter.judge(pages, rules, domains=True).collect()} == {1: "block", 2: "block"}


def test_very_long_texts_of_native_operators_and_chat(spark):
    url = "http://" + "a" * 100_000 + ".org/" + "b" * 100_000
    pages = spark.createDataFrame([(1, url, "<a href='http://x.net/'>" * 20_000)], "page_id long, url string, html string")
    got = url_filter.judge(pages, [url_filter.Rule(*r) for r in URL_RULES]).first()
    assert (got.rule, got.verdict, len(got.host), len(got.path)) == ("org/", "allow", 100_004, 100_001)
    text = "\n".join(["same"] * 50_000 + ["word " * 200_000])
    out = line_dedup.drop_boilerplate(spark.createDataFrame([(k, "s", text) for k in range(6)], "doc_id long, source string, text string")).collect()
    assert all((r.n_lines, r.n_dropped, r.text) == (50_001, 50_001, "") for r in out)
    long = "a<[&" * 300_000
    turns = chat.format_conversations(spark.createDataFrame([(1, 0, "user", long), (1, 1, "assistant", long)], "conv_id long, turn long, role string, text string"))
    d = chat.digests(turns).first()
    assert (d.n_turns, d.loss_chars, d.loss_sha256) == (2, len(long), hashlib.sha256(long.encode()).hexdigest())


def test_chat_round_trip(spark):
    turns = [(1, 1, "user", "a & <|turn|> &lt; </s> [INST] \\ é"), (1, 0, "system", ""), (1, 2, "user", "<|next|>"), (1, 3, "assistant", "&amp;</s>"), (1, 3, "assistant", "x"), (1, 4, None, None),
             (2, None, "user", "hi"), (2, 1, "assistant", None), (3, 5, "assistant", "a\nb"), (3, 5, "assistant", "a\nb"), (4, 1, "<|text|>", "t")]
    table = spark.createDataFrame([(*t, "q") for t in turns], "conv_id long, turn long, role string, text string, formatted string")
    out = chat.format_conversations(table)
    read = {r.conv_id: [tuple(t) for t in r.turns] for r in out.select("conv_id", chat.read_back(out.formatted).alias("turns")).collect()}
    digest = {r.conv_id: r for r in chat.digests(out).collect()}
    for conv in (1, 2, 3, 4):
        own = sorted(((t[1] if t[1] is not None else -1, t[2] or "", t[3] or "") for t in turns if t[0] == conv))
        assert read[conv] == [(r, x) for _, r, x in own]
        loss = "".join(x for _, r, x in own if r == "assistant")
        assert digest[conv].n_turns == len(own) and digest[conv].loss_chars == len(loss)
        assert digest[conv].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
        assert digest[conv].turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in own).encode()).hexdigest()
    text = {r.conv_id: r.formatted for r in out.collect()}
    assert text[3] == "<|turn|>assistant<|text|>a\nb<|next|>a\nb</s>"
    assert text[1].count("</s>") == 4 and "[INST]" not in text[1]
    assert digest[1].formatted_chars == len(text[1])
    assert chat.format_conversations(table.limit(0)).collect() == []
