"""URL filter, chat formatting, the pipeline and the registered queries."""

import pytest

import corpus_pipeline
from pelagia.llm import chat, urls
from pelagia.llm.queries import QUERIES
from pelagia.llm.scratch import give_back


def test_urls(spark):
    cases = {
        "http://A.Example.org/es/1?x": ("a.example.org", "/es/1", "example.org/es/", "block"),
        "https://example.org/en/19#t": ("example.org", "/en/19", "example.org/en/1", "block"),
        "https://x.com/fr/1": ("x.com", "/fr/1", "com/fr/", "allow"), "https://x.com/de/1": ("x.com", "/de/1", "com/de/", "block"),
        "http://cheappills.net/": ("cheappills.net", "/", None, "block"), "http://citymuseum.net?q": ("citymuseum.net", "", None, "allow"),
        "http://notorg/": ("notorg", "/", None, "allow"), "no scheme": ("", "", None, "allow"), "http://wonderorg.net/x": ("wonderorg.net", "/x", None, "allow"),
    }
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(cases)] + [(99, None, None), (None, "http://a.org/", "")], "page_id long, url string, host string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.judge_urls(pages).collect()}
    for i, (u, want) in enumerate(cases.items()):
        assert got[i] == want, u
    assert got[99] == ("", "", None, "allow") and got[None][2] == "org/"
    assert urls.judge_urls(pages.limit(0)).count() == 0
    split = urls.Segmenter({}, 0).segment
    assert split("freecasinobonus") == ("free", "casino", "bonus") and split("") == () and split("zqx") == ("zqx",)


def test_words_of_the_pages_are_learnt(spark):
    for name in ("uploads", "downloads", "sussex", "essex", "window", "winter", "linkedin", "roads"):
        assert urls.Segmenter({}, 0).segment(name) == (name,)
    html = "<html><script>var secret = 1;</script><p class='x'>Whale <b>song</b> whale</p></html>"
    pages = spark.createDataFrame([(i, "http://whalesong.net/", html) for i in range(50)] + [(90, "http://x.net/", None)], "page_id long, url string, html string")
    counts, total = urls.unigrams(pages)
    assert (counts, total) == ({"whale": 100, "song": 50}, 150)
    assert urls.Segmenter({}, 0).segment("whalesong") == ("whalesong",)
    assert urls.Segmenter(counts, total).segment("whalesong") == ("whale", "song")
    assert urls.judge_urls(pages).count() == 51 and urls.unigrams(pages.limit(0)) == ({}, 0)


def test_segment_brute_force():
    own = urls.Segmenter({"new": 50, "news": 900, "sfarm": 2, "farm": 40}, 5_000_000)

    def cost(words):
        return sum(own.cost.get(w, own.base + own.letter * len(w)) for w in words)

    def splits(s):
        return [[s]] + [[s[:i], *r] for i in range(1, len(s)) for r in splits(s[i:])] if s else [[]]

    for name in ("winfree", "zbetsq", "adsx", "newsfarm", "newfarms"):
        assert cost(own.segment(name)) == pytest.approx(min(map(cost, splits(name))))


def test_naive_bayes_brute_force():
    from math import log, prod

    bad, good = (" ".join(x).split() for x in (urls.UNWANTED, urls.WANTED))
    size = len({*bad, *good})
    for words in (["free", "casino"], ["city", "news", "free"], ["nothing", "known"], ["ads", "track", "en", "ads"]):
        chance = [len(names) / 58 * prod((own.count(w) + 1) / (len(own) + size) for w in words if w in {*bad, *good}) for names, own in ((urls.UNWANTED, bad), (urls.WANTED, good))]
        assert urls.odds(words) == pytest.approx(log(chance[0] / chance[1]))


def test_chat(spark):
    rows = [(c, t, ("user", "assistant")[t % 2], f"turn {t} of {c}?" if t % 2 == 0 else f"Sure, an answer {t}.\nIt has\n\ntwo lines") for c in range(40) for t in range(6)]
    rows += [(100, 0, "system", "be kind"), (100, 1, "user", "hi"), (101, 0, "user", None), (102, 0, "robot", "x"), (None, 0, "user", "lost"), (103, None, "user", "when"), (0, 0, "user", "turn 0 of 0?")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumnRenamed("x", "y")
    got = chat.recover_turns(turns).collect()
    assert {r.conv_id for r in got} == {*range(40), 100, 101, 102, 103, None}
    assert [(r.n_turns, r.n_given, r.rendered) for r in got if r.conv_id in (101, 102)] == [(0, 0, "")] * 2
    judged = [r for r in got if r.held_out]
    assert len(judged) > 8 and sum(r.same_roles for r in judged) / len(judged) > 0.95
    assert next(r for r in got if r.conv_id == 100).rendered == "<|system|>\nbe kind\n<|end|>\n<|user|>\nhi\n<|end|>\n"
    assert chat.recover_turns(turns.limit(0)).count() == 0
    assert chat.parse("", chat.Model({}, {}, {})) == []


def test_chat_keeps_every_row_and_line(spark):
    code = "look:\n\ndef f():\n    if x:\n\n        return 1\n\treturn 2"
    rows = [(c, t, ("user", "assistant")[t % 2], f"turn {t} of {c}" + "\n\nmore\n    of it" * (t % 2 * 2)) for c in range(30) for t in range(4)]
    rows += [(50, 0, "user", "again")] * 3 + [(50, 1, "assistant", "yes")]
    rows += [(51, None, "user", "same")] * 600
    rows += [(52, 0, "user", "\n \nshow me"), (52, 1, "assistant", code + " \n\n"), (53, 0, "user", "\u00a0"), (53, 1, "assistant", "nul \0 here")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {}
    for r in chat.recover_turns(turns).collect():
        got.setdefault(r.conv_id, []).append(r)
    assert got[50][0].n_given == got[50][0].n_turns == 4 and got[50][0].rendered.count(">\nagain\n<|end|>") == 3
    assert sum(r.n_given for r in got[51]) == 600 and len(got[51]) == 3 and sum(r.rendered.count("same") for r in got[51]) == 600
    assert got[52][0].rendered == chat.render([("user", "show me"), ("assistant", code)])
    assert got[53][0].rendered == chat.render([("user", "\u00a0"), ("assistant", "nul \0 here")])


def test_long_parts_keep_the_order_of_turns(spark):
    rows = [(1, t, ("user", "assistant")[t % 2], f"turn {t} copy {k}") for t in range(40) for k in range(9)]
    rows += [(2, t, ("user", "assistant")[t % 2], f"turn {t}") for t in range(600)]
    got = chat.transcripts(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).orderBy("conv_id", "part", "spill").collect()
    for c in (1, 2):
        own = [r for r in got if r.conv_id == c]
        said = [int(n) for r in own for n in __import__("re").findall(r"turn (\d+)", r.transcript)]
        assert said == sorted(said) and len(said) == sum(x[0] == c for x in rows)


def test_viterbi_brute_force():
    from itertools import product

    model = chat.Model({2: 3}, {(2, 4): 5, (4, 5): 2, (5, 2): 4}, {(2, "muser"): 6, (4, "massistant"): 6, (5, "mnone"): 4})
    lines = [chat.features("User: hi?", True), chat.features("AI: yes", False), chat.features("more", False), chat.features("bye", True)]

    def score(path):
        return model.start[path[0]] + sum(model.move[a][b] for a, b in zip(path, path[1:], strict=False)) + sum(model.emission(s, f) for s, f in zip(path, lines, strict=True))

    assert score(model.viterbi(lines)) == pytest.approx(max(map(score, product(range(6), repeat=4))))


def test_pipeline(spark):
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert 0 < out.count() < docs.count() and out.columns == [*docs.columns, "tokens", "p_en", "p_de", "p_fr", "p_es", "rate", "copies"]
    assert out.where("text is not null").count() > 0
    names = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        names = stage(spark, names, "/root/testdata/sf0.001")
        assert names.columns == docs.columns


def test_pipeline_of_odd_rows(spark, tmp_path):
    long = " ".join(f"t{i}" for i in range(3000))
    schema = "doc_id long, text string, lang string, source string, n_chars long, node long, k string, _pii_new string"
    rows = [(1, None, "en"), (2, "", None), (None, "mail j.doe@firm.com now", "en"), (3, long, "de"), (4, long, "de"), (5, "a b c d e f", "xx"), (5, "a b c d e f", "xx"), (6, "one two three four five six seven", "fr")]
    docs = spark.createDataFrame([(i, t, lang, None, len(t or ""), 7, "k", "x") for i, t, lang in rows], schema)
    labels = spark.createDataFrame([(1, 1, 0), (3, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([(9, "one two three four five six seven"), (None, None)], "item_id long, text string")
    for name, some in (("full", docs), ("none", docs.limit(0))):
        for table, rows in (("documents", some), ("labels", labels), ("benchmark", bench)):
            rows.write.parquet(f"{tmp_path}/{name}/{table}.parquet")
    got = corpus_pipeline.run(spark, f"{tmp_path}/full").collect()
    # one of the copies and of the repeated rows, no benchmark text; rows without an id stay
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in got) == [(False, 1), (False, 2), (False, 3), (False, 5), (True, 0)]
    assert all(r.rate >= 0 for r in got) and corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_runs(spark, name):
    assert QUERIES[name](spark, "/root/testdata/sf0.001").count() > 0


def test_freed_memory_of_the_driver_is_given_back(spark):
    assert give_back(spark).startswith("Trim native heap")
