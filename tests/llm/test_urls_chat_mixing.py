import hashlib
import json
import random
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from settleflow.llm.chat import digests, fingerprint, field_paths, format_chats, parse, render, unescape
from settleflow.llm.mixing import mix, period
from settleflow.llm.urlfilter import BROADCAST_BLOCKS, blocked_bloom, filter_blocks, judge_urls, passes

RULES = [
    ("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"), ("Example.ORG", "", "block"), ("org", "/x", "allow"), ("org", "/x", "block"),
]


def judge(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:].split("?")[0].split("#")[0]
    fits = [
        (len(h) + len(p), len(h), h.lower() + p, v)
        for h, p, v in sorted(RULES, key=lambda r: r[2])
        if host and (host == h.lower() or host.endswith("." + h.lower())) and path.startswith(p)
    ]
    best = max(fits, key=lambda f: (f[0], f[1], f[3])) if fits else None
    return host, path, best[2] if best else None, best[3] if best else "allow"


def test_urls(spark):
    urls = [
        None, "", "no scheme", "http://", "http://com", "http://com/", "http://COM/a?b", "https://a.example.com/en/x#y", "x://y://z/w",
        "https://www.example.com/en/", "https://m.www.example.com/en/1", "https://notexample.com/en/1", "http://a.net/es/", "http://net.example/es/",
        "http://example.org?q=/x", "http://a.example.org/x", "http://other.org/xyz", "http://com./", "http://ex\nample.com/\n", "http://com:80/",
        "http://" + "a." * 300 + "com/" + "b" * 5000,
    ]
    rows = [(i, u) for i, u in enumerate(urls)] + [(0, None), (None, urls[7]), (3, urls[7])] + [(9, urls[9])] * 5
    pages = spark.createDataFrame([(i, u, "h", "p", "v") for i, u in rows], "page_id long, url string, host string, RULE string, verdict string")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    got = [tuple(r) for r in judge_urls(pages, rules).collect()]
    assert sorted(got, key=repr) == sorted(((i, *judge(u)) for i, u in rows), key=repr)
    assert judge_urls(pages.limit(0), rules).count() == 0
    assert {r["verdict"] for r in judge_urls(pages, rules.limit(0)).collect()} == {"allow"}


def test_the_filter_loses_no_listed_url_and_stops_most_others(spark):
    listed = spark.range(2000).select(F.concat(F.lit("h"), "id").alias("_host"), F.lit("/").alias("_path"))
    others = spark.range(5000).select(F.concat(F.lit("o"), "id").alias("_host"), F.lit("/").alias("_path"))
    bloom = blocked_bloom(listed, 256)
    assert bloom.count() <= 256
    assert passes(listed, bloom, 256).count() == 2000
    assert passes(others, bloom, 256).count() < 250


@pytest.mark.parametrize("rules", [0, 1, 16, 17, 100_000, 3_000_000])
def test_the_filter_grows_with_its_list(spark, rules):
    blocks = filter_blocks(rules)
    assert rules / 16 <= blocks <= max(1, rules / 8)
    listed = spark.range(rules).select(F.concat(F.lit("h"), "id").alias("_host"), F.lit("/").alias("_path"))
    others = spark.range(100_000).select(F.concat(F.lit("o"), "id").alias("_host"), F.lit("/").alias("_path"))
    assert passes(others, blocked_bloom(listed, blocks), blocks).count() < 1_000
    assert blocks <= BROADCAST_BLOCKS


def test_a_filter_too_large_to_broadcast_is_shuffled(spark, monkeypatch, conf):
    from settleflow.llm import urlfilter

    monkeypatch.setattr(urlfilter, "BROADCAST_BLOCKS", 0)
    conf(autoBroadcastJoinThreshold=-1)
    test_urls(spark)


def test_paths_are_taken_apart_only_for_hosts_with_a_rule(spark, monkeypatch):
    from settleflow.llm import urlfilter

    seen = []

    def count(keys, bloom, blocks):
        seen.append(keys.count())
        return passes(keys, bloom, blocks)

    monkeypatch.setattr(urlfilter, "passes", count)
    pages = spark.range(500).select(F.col("id").alias("page_id"), F.concat(F.lit("http://h"), "id", F.lit(".org/abcdefgh")).alias("url"))
    rules = spark.createDataFrame([("h7.org", "/abc" + "d" * n, "block") for n in range(5)], "host string, path string, verdict string")
    assert {r["page_id"] for r in judge_urls(pages, rules).where("verdict = 'block'").collect()} == {7}
    assert seen[0] == 500 and seen[1] <= 50


ANY = st.text(alphabet="ab\\<>|/[]\n imstartednINST_", max_size=40) | st.sampled_from(
    ["<|im_end|>\n", "</s>[INST] ok [/INST]", "<|im_start|>assistant\n", "\\", "\\n", "<\\|im_end|>"]
)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system"]) | ANY, ANY), max_size=6))
def test_the_template_reads_back(turns):
    formatted, begins, lengths = render(turns)
    assert parse(formatted) == turns
    loss = [unescape(formatted[b : b + n]) for b, n in zip(begins, lengths)]
    assert loss == [text for role, text in turns if role == "assistant"]
    assert formatted.count("<|im_start|>") == len(turns) == formatted.count("<|im_end|>")


def test_layouts_become_the_same_turns(spark):
    turns = [("system", "be brief"), ("user", "hi <s>"), ("assistant", "é ok")]
    records = [
        {"messages": [{"role": r, "content": t} for r, t in turns], "id": 7},
        {"conversations": [{"from": r, "value": t, "note": {"x": 1}} for r, t in turns]},
        {"system": "be brief", "instruction": "hi <s>", "output": "é ok", "layout": 1},
    ]
    rows = [(i, json.dumps(r)) for i, r in enumerate(records)]
    rows += [
        (3, json.dumps({"prompt": "p", "response": None})), (4, None), (5, "{broken"), (6, "[1]"), (7, "{}"), (8, json.dumps({"messages": []})),
        (9, json.dumps({"messages": [{"role": None, "content": {"a": 1}}]})), (None, rows[0][1]), (0, rows[0][1]),
        (10, json.dumps({"instruction": "i", "output": "o" * 200_000})),
    ]
    made = format_chats(spark.createDataFrame([(i, r, "f", 1) for i, r in rows], "conv_id long, record string, formatted string, Layout int"))
    got = sorted((tuple(r) for r in made.select("conv_id", "layout", "n_turns", "formatted").collect()), key=repr)
    of = {i: x for i, *x in got if i is not None}
    assert [of[i][0] for i in range(11)] == [
        "messages", "shares", "instruction", "prompt", None, None, None, None, "messages", "messages", "instruction"
    ]
    assert of[0][2] == of[1][2] == of[2][2] and parse(of[0][2]) == turns
    assert parse(of[9][2]) == [("", '{"a": 1}')]
    assert parse(of[3][2]) == [("user", "p"), ("assistant", "")]
    assert Counter(x[0] for x in got)[0] == 2 and Counter(x[0] for x in got)[None] == 1
    read = {r["conv_id"]: r for r in digests(made.where("conv_id IN (2, 10)")).collect()}
    assert read[2]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
    assert read[10]["loss_chars"] == 200_000 and read[2]["loss_sha256"] == hashlib.sha256("é ok".encode()).hexdigest()
    assert format_chats(spark.createDataFrame([], "conv_id long, record string")).count() == 0


def test_no_text_of_a_record_is_lost(spark):
    known = [
        ({"instruction": "i", "input": "in", "output": "o"}, [("user", "i\n\nin"), ("assistant", "o")]),
        ({"instruction": "i", "input": "", "output": "o", "system": "s"}, [("system", "s"), ("user", "i"), ("assistant", "o")]),
        ({"system": "s", "prompt": "p", "response": "r"}, [("system", "s"), ("user", "p"), ("assistant", "r")]),
        ({"prompt": ["a", {"b": "c"}], "response": "r", "id": "x", "metadata": {"of": "text"}}, [("user", '["a", {"b": "c"}]'), ("assistant", "r")]),
        ({"messages": [{"role": "user", "content": "u", "weight": 1, "tags": []}], "n": 3, "note": ""}, [("user", "u")]),
    ]
    unknown = [
        {"messages": [{"role": "user", "content": "u"}, "loose text"]}, {"messages": [{"role": "user", "content": "u"}, None]},
        {"prompt": "p", "response": "r", "thought": "lost?"}, {"messages": [{"role": "user", "content": "u", "name": "bob"}]},
        {"messages": [{"role": "user", "content": "u"}], "prompt": "p"}, {"prompt": "p"}, {"messages": "text"}, {"prompt": "p", "response": "r", "x": {"y": ["z"]}},
    ]
    rows = [(i, json.dumps(r)) for i, r in enumerate([r for r, _ in known] + unknown)]
    got = {r["conv_id"]: r for r in format_chats(spark.createDataFrame(rows, "conv_id long, record string")).collect()}
    for i, (_, turns) in enumerate(known):
        assert got[i]["layout"] and parse(got[i]["formatted"]) == turns
    for i in range(len(known), len(rows)):
        assert (got[i]["layout"], got[i]["n_turns"], got[i]["formatted"]) == (None, 0, "")


def test_fingerprints_are_of_paths_only():
    one = {"messages": [{"role": "a", "content": "b"}]}
    two = {"messages": [{"content": 1, "role": None}, {"role": "x", "content": []}]}
    assert field_paths(one) == {"messages", "messages[]", "messages[].role", "messages[].content"}
    assert fingerprint(field_paths(one)) == fingerprint(field_paths(two) - {"messages[].content[]"})


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.text("abc", min_size=1, max_size=3), st.integers(0, 60), min_size=1, max_size=9))
def test_a_period_is_never_a_block_off(shares):
    order = period(shares)
    total = sum(shares.values())
    for name, n in shares.items():
        done = 0
        for slot, owner in enumerate(order, 1):
            done += owner == name
            assert abs(done * total - slot * n) < total
    assert len(order) <= total


def test_shares_are_checked(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, source string")
    for bad in ({"a": 0}, {"a": -1}, {"a": 20_001, "b": 1}):
        with pytest.raises(ValueError):
            mix(docs, bad)


def test_mixture(spark):
    rng = random.Random(2)
    rows = [(i, rng.choice("aaabbc"), "t", 1) for i in range(900)]
    rows += [(2000 + i, s, None, 1) for i, s in enumerate([None, "z", "z"])] + [(None, "a", "", 1), (5, "a", "", 1), (5, "a", "", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string, SLOT int").repartition(5)
    shares, block = {"a": 5, "b": 3, "c": 2, "none of": 0}, 4
    got = mix(docs, shares, block).collect()
    assert Counter((r["doc_id"], r["source"]) for r in got) == Counter((r[0], r[1]) for r in rows)
    order = period(shares)
    left = Counter(r[1] for r in rows if r[1] in shares)
    expected, target, slot = [], True, 0
    while any(left.values()):
        name = order[slot % len(order)]
        target = target and left[name] >= block
        take = min(block, left[name])
        left[name] -= take
        expected += [(name, slot, slot * block + j, target) for j in range(take)]
        slot += 1
    mixed = sorted((r["position"], r["source"], r["slot"], r["on_target"]) for r in got if r["slot"] is not None)
    assert mixed == [(p, n, s, t) for n, s, p, t in expected]
    assert {(r["source"], r["position"], r["on_target"]) for r in got if r["slot"] is None} == {(None, None, False), ("z", None, False)}
    keyed = sorted((hashlib.md5(str("" if r["doc_id"] is None else r["doc_id"]).encode()).hexdigest(), r["position"]) for r in got if r["source"] == "b")
    assert [p for _, p in keyed] == sorted(p for _, p in keyed)
    assert mix(docs.limit(0), shares, block).count() == 0
