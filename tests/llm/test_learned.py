"""Operators 2, 3, 4, 7 and 8, and the pipeline."""

import hashlib
import random
import re
import time

import numpy as np
import pytest
from llm_fixtures import LOWER, table_of
from pyspark.sql import functions as F

from tessera.llm import dom_model, pseudo_lm, reply_trees, sparse_suffix, url_rules
from tessera.llm.labelled_pages import labelled_pages


def test_op2_held_out_pages():
    model, wrong, all_ = dom_model.trained(), 0, 0
    for html in labelled_pages(200, seed=99):
        page = dom_model.Page(html)
        found = model.marginals(page)
        for k in page.text:
            m, c, b = found[k]
            wrong += (c > b and c > m) != (page.label[k] in "cm")
            all_ += 1
    assert wrong < 0.01 * all_


def test_op2_messages_are_exact():
    """Marginals of a small tree against the sum over all assignments."""
    model = dom_model.trained()
    page = dom_model.Page("<div class=menu><a href=x>one</a></div><p>Two three four.</p>")
    tree = page.tree()
    place = {k: n for n, (k, _, _) in enumerate(tree)}
    total = np.zeros((len(tree), 3))
    for code in range(3 ** len(tree)):
        y = [code // 3**n % 3 for n in range(len(tree))]
        p = 1.0
        for n, (_, parent, found) in enumerate(tree):
            p *= model.local(found)[y[n]] * (model.start[y[n]] if parent < 0 else model.step[y[place[parent]]][y[n]])
        for n in range(len(tree)):
            total[n, y[n]] += p
    want = total / total.sum(1, keepdims=True)
    got = model.marginals(page)
    assert np.allclose([got[k] for k, _, _ in tree], want)


PAGE = ("<html><head><title>t</title><style>p{{}}</style></head><body><nav><ul><li><a href=/>Home</a></li></ul></nav><div class='ad'>Buy this now. Cheap.</div>"
        "<article><h1>A title</h1><p><b>First &amp; long   paragraph\nof text, with more.<br><p>Second <a href=x>link</a> one&nbsp;here.{}</article>"
        "<section class='comments'><p>I like this very much. Great.</p></section><form><label>Mail</label><input></form><footer>&copy; me</footer>")


def test_op2_pages(spark):
    rows = [(1, "u", PAGE.format("")), (2, "u", None), (3, None, ""), (4, "u", PAGE.format("")), (5, "u", PAGE.format("<p>" + "word " * 50_000)),
            (6, "u", "<article>" + "<div>" * 3000 + "Deep text here." + "</div>" * 3000 + "</article>"), (7, "u", "<script>var a='</p>'</script><!-- x -->")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("taken"))
    got = {r["page_id"]: r["text"] for r in dom_model.extract(pages).collect()}
    want = "A title\nFirst & long paragraph of text, with more.\nSecond link one here."
    assert got[1] == got[4] == want and got[2] == got[3] == got[7] == "" and got[6] == "Deep text here."
    assert got[5] == want + "\n" + " ".join(["word"] * 50_000)
    assert dom_model.extract(pages.limit(0)).count() == 0


def test_op2_optional_tags():
    """Pages without the tags that HTML lets one omit have the same text."""
    model, whole = dom_model.trained(), PAGE.format("")
    want = dom_model.main_text(whole, model)
    assert want
    cuts = [("</head>",), ("</head>", "<body>"), ("<head>", "</head>"), ("<head>", "</head>", "<body>"), ("<html>", "</head>", "<body>"), ("<body>",)]
    for gone in cuts:
        html = whole
        for tag in gone:
            html = html.replace(tag, "")
        assert dom_model.main_text(html, model) == want, gone
    assert dom_model.main_text(whole.replace("</head>", "<meta name=x><noscript><link></noscript>\n"), model) == want
    assert dom_model.main_text(whole.replace("<nav>", "<head><nav>"), model) == want  # a second head is none
    texts = lambda html: [t for t in dom_model.Page(html).text.values()]
    assert texts("<head><title>t</title> plain text") == [" plain text"]
    assert texts("<head><template><p>hidden</p></template><script>x</script><img>shown") == ["shown"]


RULES = {"com/": "allow", "example.com/en/": "block", "www.example.com/en/": "allow", "net/es/": "block", "net/fr/": "block"}


def test_op3_rules(spark):
    urls = ["HTTP://WWW.Example.com/en/1?x=/net/fr/", "http://m.example.com/en/1", "https://example.com/de/", "http://a.net/es/1", "http://a.net/es", "http://net/fr/#x",
            "http://other.org/", "no scheme", None, "", "://", "http://xexample.com/en/", "http://example.com"]
    want = [("www.example.com", "/en/1", "www.example.com/en/", "allow"), ("m.example.com", "/en/1", "example.com/en/", "block"), ("example.com", "/de/", "com/", "allow"),
            ("a.net", "/es/1", "net/es/", "block"), ("a.net", "/es", None, "allow"), ("net", "/fr/", "net/fr/", "block"), ("other.org", "/", None, "allow"),
            ("", "", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"), ("xexample.com", "/en/", "com/", "allow"), ("example.com", "", None, "allow")]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("rule", F.lit("taken"))
    none = spark.createDataFrame([], "url string, bad boolean")
    got = sorted(url_rules.judge(pages, url_rules.mine(none), RULES).collect(), key=lambda r: r["page_id"])
    assert [(r["host"], r["path"], r["rule"], r["verdict"]) for r in got] == want


def test_op3_mined_rules(spark):
    r = random.Random(1)
    urls = [f"http://h{r.randrange(5)}.org/{r.choice(['en', 'buy', 'de'])}/{k}{r.choice(['', '.html'])}" for k in range(600)]
    bad = ["buy" in u and "h3" in u for u in urls]
    labelled = spark.createDataFrame(list(zip(urls, bad)), "url string, bad boolean")
    mined = url_rules.mine(labelled)
    pages = labelled.unionByName(labelled.limit(5)).withColumn("page_id", F.monotonically_increasing_id())
    got = url_rules.judge(pages, mined, {}).collect()
    assert len(got) == 605 and all((x["verdict"] == "block") == x["bad"] for x in got)
    # brute force over all rules and urls
    rules = [(set(x["items"]), x["rule_id"]) for x in mined.collect()]
    for x in pages.select("url", url_rules.items_of(F.col("url")).alias("items")).distinct().collect():
        fits = {name for need, name in rules if need <= set(x["items"])}
        said = {y["mined_rule"] for y in got if y["url"] == x["url"]}
        assert said <= (fits or {None})


def test_op3_fixed_segments(spark):
    """Urls of one host with many segments that always occur together: rules grow with the items, not with their subsets."""
    fixed = "/".join(f"s{k}" for k in range(40))
    urls = [(f"http://one.host.org/{fixed}/{k}", k % 2 == 0) for k in range(200)] + [(f"http://two.host.org/{fixed}/buy-now/{k}", True) for k in range(100)]
    urls += [(f"http://three.org/now/{k}", False) for k in range(300)] + [("http://three.org/" + "x/" * 9, None), (None, True)]
    mined = url_rules.mine(spark.createDataFrame(urls, "url string, bad boolean"))
    rules = {tuple(r["items"]): r for r in mined.collect()}
    assert 0 < len(rules) <= len({x for r in urls if r[0] for x in r[0].split("/")}) * 2
    half = spark.createDataFrame(urls[:200], "url string, bad boolean")
    assert url_rules.mine(half).count() == 0 and url_rules.mine(half, min_confidence=0.5).count() < 100
    names = [set(r) for r in rules]
    assert not any(a < b for a in names for b in names)
    got = url_rules.judge(spark.createDataFrame(urls[:600], "url string, bad boolean"), mined, {}).collect()
    assert all((r["verdict"] == "block") == r["bad"] for r in got if "two" in r["url"] or "three" in r["url"])
    items = {r["url"]: (set(r["items"]), r["bad"]) for r in spark.createDataFrame(urls, "url string, bad boolean").where("bad is not null").select(
        "url", "bad", url_rules.items_of(F.col("url")).alias("items")).collect()}
    for need, r in rules.items():
        held = [bad for have, bad in items.values() if set(need) <= have]
        assert sum(held) >= 5 and abs(r["confidence"] - sum(held) / len(held)) < 1e-12 and r["confidence"] >= 0.6


def test_op3_few_rows_make_no_rule(spark):
    urls = [(f"http://h{k}.org/a{k}", k % 4 == 0) for k in range(86)]
    assert url_rules.mine(spark.createDataFrame(urls, "url string, bad boolean")).count() == 0


def test_op3_combinations(spark):
    """Neither item alone is a rule; together they are, with whatever always comes with them."""
    r = random.Random(4)
    urls = [f"http://h{r.randrange(4)}.org/{r.choice(['buy', 'en', 'de'])}-{r.choice(['win', 'see'])}/{k}" for k in range(900)]
    rows = [(u, "/buy-" in u and "-win" in u and (k % 9 > 0)) for k, u in enumerate(urls)]
    mined = url_rules.mine(spark.createDataFrame(rows, "url string, bad boolean")).collect()
    assert {"path:buy-win"} in [set(x["items"]) for x in mined]
    rows = [(f"http://{a}.{b}.org/x{k % 7}", a == "q" and b == "z") for k in range(40) for a in "pqr" for b in "xyz"]
    mined = url_rules.mine(spark.createDataFrame(rows, "url string, bad boolean"))
    got = url_rules.judge(spark.createDataFrame(rows + [("http://q.new.z.org/", True), ("http://q.x.org/", False)], "url string, bad boolean"), mined, {}).collect()
    assert all((x["verdict"] == "block") == x["bad"] for x in got if ".new." not in x["url"])


def test_op2_unclosed_elements():
    """A hundred thousand open elements take time in proportion."""
    model = dom_model.trained()
    text = "A whole sentence stands here, and is long enough. " * 3
    for junk in ("<div>", "<p><table><span>", "<b><li>", "<td><i></b>"):
        began = time.process_time()
        page = dom_model.Page("<article><p>" + text + junk * (100_000 // junk.count("<")))
        model.marginals(page)
        assert time.process_time() - began < 30, junk


def _repeats(rows, length):
    first, out = {}, {}
    for d, t in sorted(rows, key=lambda r: r[0]):
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER))
        windows = [tuple(w[p:p + length]) for p in range(len(w) - length + 1)]
        out[d] = {p + k for p, x in enumerate(windows) if x in first for k in range(length)}
        for x in windows:
            first.setdefault(x, d)
    return {d: hit for d, hit in out.items() if hit}


def _planted():
    r = random.Random(8)
    word = lambda: f"w{r.randrange(4000)}"
    passages = [[word() for _ in range(n)] for n in (49, 50, 51, 60, 75, 130)]
    texts = [None, "", "x", "And " * 400]
    for k in range(80):
        w = [word() for _ in range(r.randrange(5, 60))]
        for p in r.sample(passages, r.randrange(3)):
            w += [*p, *(word() for _ in range(r.randrange(1, 30)))]
        texts.append(" ".join(w))
    return texts + [texts[10].upper()]


def test_op4_repeats(spark):
    texts = _planted()
    docs = table_of(spark, texts)
    got = {r["id"]: {p for s in r["spans"] for p in range(s["start"], s["end"])} for r in sparse_suffix.repeats(docs).collect()}
    assert got == _repeats(list(enumerate(texts)), 50)


def test_op4_real_text(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    found = {r["id"]: r["spans"] for r in sparse_suffix.repeats(docs).collect()}
    got = {d: {p for s in spans for p in range(s["start"], s["end"])} for d, spans in found.items()}
    assert got == _repeats(rows, 50)
    left = {r["doc_id"]: r["text"] for r in sparse_suffix.remove(docs).collect()}
    for d, t in rows:
        own = re.findall(r"[^\x20\x09-\x0D]+", t)
        keep = [w for p, w in enumerate(own) if p not in got.get(d, ())]
        assert re.findall(r"[^\x20\x09-\x0D]+", left[d]) == keep if keep else d not in left
        assert d in got or left[d] == t


def test_op4_hot_passage_over_borders(spark):
    """One passage in most documents: its suffixes lie in many partitions."""
    r = random.Random(2)
    passage = " ".join(f"p{k}" for k in range(70))
    texts = [f"a{r.random()} {passage} b{r.random()}" for _ in range(400)] + ["alone " + str(k) for k in range(20)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        docs = table_of(spark, texts).withColumn("pos", F.lit(1)).withColumn("id", F.lit("taken"))
        left = sparse_suffix.remove(docs)
        assert left.columns == docs.columns
        texts_left = [x["text"] for x in left.collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(texts_left) == 420 and sum(passage in t for t in texts_left) == 1


def _found(docs):
    return {r["id"]: {p for s in r["spans"] for p in range(s["start"], s["end"])} for r in sparse_suffix.repeats(docs).collect()}


def test_op4_smallest_document_has_less(spark):
    """The smallest documents quote under 50 words of passages that the others hold whole."""
    r = random.Random(12)
    word = lambda: f"w{r.randrange(9000)}"
    passages = [[word() for _ in range(56)] for _ in range(30)]
    texts = [" ".join([word() for _ in range(9)] + p[:n] + [word() for _ in range(9)]) for n in (40, 48) for p in passages]
    for _ in range(5):
        for p in passages:
            w = p if r.random() < 0.7 else p[r.randrange(6):][:50]
            texts.append(" ".join([word() for _ in range(r.randrange(9))] + w + [word() for _ in range(r.randrange(9))]))
    want = _repeats(list(enumerate(texts)), 50)
    assert len(want) > 110 and _found(table_of(spark, texts)) == want


def test_op4_partitions(spark):
    """A hot passage that documents share to different lengths has the same spans in 1 and in 60 partitions."""
    r = random.Random(5)
    passage = [f"p{k}" for k in range(90)]
    texts = []
    for k in range(300):
        a, n = (0, 90) if k == 0 or r.random() < 0.2 else (r.randrange(20), r.randrange(50, 70))
        texts.append(" ".join([f"a{r.random()}", *passage[a:a + n], f"b{r.random()}"]))
    texts.append("And " * 700)
    texts.append("And " * 90)
    docs, was, got = table_of(spark, texts), spark.conf.get("spark.sql.shuffle.partitions"), []
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for n in ("1", "60"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            got.append({r["id"]: r["spans"] for r in sparse_suffix.repeats(docs).collect()})
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got[0] == got[1]
    assert {d: {p for s in spans for p in range(s["start"], s["end"])} for d, spans in got[0].items()} == _repeats(list(enumerate(texts)), 50)


def test_op4_odd_tables(spark):
    p = " ".join(f"q{k}" for k in range(60))
    odd = spark.createDataFrame([(None, p), (1, p), (1, p), (2, None), (3, "")], "doc_id long, text string")
    assert sorted((str(r["doc_id"]), r["text"]) for r in sparse_suffix.remove(odd).collect()) == [("2", None), ("3", ""), ("None", p)]
    assert sparse_suffix.remove(odd.limit(0)).count() == 0


def test_op4_texts_of_one_id(spark):
    """Many different texts without an id: each is cut by its own spans alone."""
    passage = " ".join(f"q{k}" for k in range(60))
    rows = [(None, f"a{k} {passage} b{k}" if k % 3 == 0 else f"only{k}") for k in range(900)]
    left = [r["text"] for r in sparse_suffix.remove(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert len(left) == 900 and {t for d, t in rows if "only" in t} <= set(left)
    digests = sparse_suffix._digest([t.encode() for _, t in rows])
    assert len(set(digests.to_pylist())) == 900 and {len(d) for d in digests.to_pylist()} == {16}


def test_op7_scores(spark):
    r = random.Random(3)
    text = lambda n: " ".join(("the cat sat on a mat . " if r.random() < 0.5 else "le chat dort sur un lit ! ") * 1 for _ in range(n))
    texts = [text(30) for _ in range(300)]
    words = " ".join(texts[:40]).split()
    r.shuffle(words)
    mixed = [" ".join(words[k * 200:(k + 1) * 200]) for k in range(20)]
    docs = table_of(spark, texts + mixed + [None, "", " \n", "one", texts[0]]).withColumn("n_words", F.lit("taken"))
    got = {x["doc_id"]: x for x in pseudo_lm.score(docs).collect()}
    good, odd = [got[k]["mean_log_likelihood"] for k in range(300)], [got[300 + k]["mean_log_likelihood"] for k in range(20)]
    assert min(good) > max(odd)
    assert [(got[k]["n_words"], got[k]["log_likelihood"], got[k]["mean_log_likelihood"]) for k in (320, 321, 322)] == [(0, 0.0, None)] * 3
    assert got[323]["n_words"] == 1 and abs(got[324]["log_likelihood"] - got[0]["log_likelihood"]) < 1e-4
    assert pseudo_lm.score(docs.limit(0)).count() == 0


def test_op7_sums_are_probabilities():
    lex = pseudo_lm.Lexicon.of_counts(np.arange(pseudo_lm.CELLS, dtype=float))
    net = pseudo_lm.Network.start(lex.prior)
    _, s = net.log_probs([np.array([k, 5]) for k in range(4)])
    assert np.allclose(np.exp(s).sum(1), 1, atol=1e-4)
    assert np.allclose(np.bincount(lex.of, np.exp(lex.share)), 1, atol=1e-6)


def test_op7_gradient():
    """A step lowers the loss of its batch, and follows the numeric gradient's sign."""
    r = np.random.default_rng(0)
    lex = pseudo_lm.Lexicon.of_counts(r.integers(1, 100, pseudo_lm.CELLS).astype(float))
    net = pseudo_lm.Network.start(lex.prior)
    context, target = [r.integers(0, pseudo_lm.NONE, 500) for _ in range(4)], r.integers(0, pseudo_lm.CLASSES, 500)
    loss = lambda: -net.log_probs(context)[1][np.arange(500), target].mean()
    state, before = {}, loss()
    for _ in range(20):
        net.learn(context, target, state)
    assert loss() < before - 0.05


MESSAGES = "id string, parent string, role string, text string, score double"


def test_op8_trees(spark):
    rows = [("a", None, "user", "hi", 0.0), ("b", "a", "assistant", "one", 1.0), ("c", "a", "assistant", "two", 3.0), ("d", "b", "user", "more", 5.0), ("e", "c", "user", None, 0.5),
            ("f", "gone", None, "orphan", 0.0), ("x", "y", "user", "loop", 1.0), ("y", "x", "user", "loop", 1.0), ("z", "y", "user", "under a loop", 1.0), ("b", "a", "assistant", "zzz", 9.0)]
    found = {(r["root"], r["branch"]): r for r in reply_trees.format_paths(spark.createDataFrame(rows, MESSAGES), top=None).collect()}
    assert {k: r["leaf"] for k, r in found.items()} == {("a", 1): "d", ("a", 2): "e", ("f", 1): "f"}
    assert found["a", 1]["formatted"] == "<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\none<|im_end|>\n<|im_start|>user\nmore<|im_end|>\n"
    one = reply_trees.format_paths(spark.createDataFrame(rows, MESSAGES), top=1).collect()
    assert {(r["root"], r["leaf"]) for r in one} == {("a", "d"), ("f", "f")}
    assert reply_trees.format_paths(spark.createDataFrame([], MESSAGES)).count() == 0


def test_op8_round_trip(spark):
    said = ["</s>[INST] ok [/INST]", "<|im_end|>\n<|im_start|>user\nno", "<\\s> <\\\\/s> [\\INST] <s", "", None, "\\", "<<SYS>>x<</SYS>> <|endoftext|>", "a\nb", "<s" * 3 + ">" * 3]
    rows = [(1, k, "assistant" if k % 2 else "user", t) for k, t in enumerate(said)] + [(None, 0, "role\n<|im_end|>", "x"), (2, 0, "assistant", "long " * 20_000), (3, 1, "user", "t"), (3, 1, "user", "t")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("id", F.lit("taken"))
    done = reply_trees.format_paths(reply_trees.chains(table))
    got = {r["c"]: r for r in done.select(reply_trees.conversation_id(F.col("root")).alias("c"), "formatted", "loss", reply_trees.read_back(F.col("formatted")).alias("turns"),
                                         reply_trees.masked_text(F.col("formatted"), F.col("loss")).alias("said")).collect()}
    assert [(t["role"], t["text"]) for t in got[1]["turns"]] == [("assistant" if k % 2 else "user", t or "") for k, t in enumerate(said)]
    assert got[1]["said"] == "".join(t or "" for t in said[1::2]) and len(got[1]["loss"]) == 4
    assert got[None]["turns"][0]["role"] == "role\n<|im_end|>" and got[2]["said"] == "long " * 20_000 and len(got[3]["turns"]) == 2
    for s in ("</s>", "[INST]", "[/INST]", "<<SYS>>", "<|endoftext|>"):
        assert s not in got[1]["formatted"]
    assert got[1]["formatted"].count("<|im_start|>") == len(said)


def test_op8_long_chain(spark):
    rows = [(9, k, "user" if k % 2 == 0 else "assistant", f"t{k}") for k in range(150)]
    done = reply_trees.format_paths(reply_trees.chains(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")))
    r = done.select(reply_trees.masked_text(F.col("formatted"), F.col("loss")).alias("said")).collect()
    assert [x["said"] for x in r] == ["".join(f"t{k}" for k in range(1, 150, 2))]


def test_pipeline_stages(spark, corpus, tmp_path):
    import corpus_pipeline

    good = [" ".join(f"{chr(97 + k % 26)}{k}x{j}" for j in range(80)) for k in range(40)]
    leak = " ".join(f"leak{j}" for j in range(30))
    passage = " ".join(f"pass{j}" for j in range(60))
    texts = good + [good[0], good[1].replace("b1x79", "other"), "too short", "*** " * 100, good[2] + " " + leak, good[3].replace("x", "y") + " " + passage, good[4].replace("x", "z") + " " + passage]
    docs = table_of(spark, texts)
    docs.coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    left, ids = docs, set(range(len(texts)))
    gone = [{42, 43}, {40, 41}, set(), {44}]
    for (name, stage), out in zip(corpus_pipeline.STAGES[:-1], gone):
        left = stage(spark, left, str(tmp_path))
        left.write.parquet(str(tmp_path / name))
        left = spark.read.parquet(str(tmp_path / name))
        ids -= out
        assert left.columns == docs.columns and {r["doc_id"] for r in left.collect()} == ids, name
    last = {r["doc_id"]: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    kept = {r["doc_id"]: r["text"] for r in left.collect()}
    assert passage in kept[45] and "pass1" not in kept[46] and set(last) == ids
    assert all(last[d]["decoded_sha256"] == hashlib.sha256(t.encode()).hexdigest() for d, t in kept.items())


@pytest.mark.parametrize("name", ["op3_url_rules", "op8_reply_trees", "op10_host_rules"])
def test_native_plans(spark, name):
    from tessera.llm import queries

    plan = queries.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
