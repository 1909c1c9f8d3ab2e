"""Every operator against its plain version: on the whole small tables, on a
fixture of odd rows, and on tables without rows."""

import hashlib

import brute as B
import pytest
from pyspark.sql import functions as F

from framewise.llm import (chat, decontam, html_text, licenses, line_dedup, line_rules, ppm, queries,
                           setsketch, warc)

KEY = lambda r: tuple((x is None, x if x is not None else 0) for x in r)


def same(got, want):
    assert sorted(map(tuple, got), key=KEY) == sorted(map(tuple, want), key=KEY)


def table(spark, sf, name):
    return spark.read.parquet(f"{sf}/{name}.parquet")


@pytest.fixture(scope="module")
def docs(spark, sf_small):
    return [(r.doc_id, r.text) for r in table(spark, sf_small, "documents").collect()]


# ---------------------------------------------------------------- whole tables

def test_line_dedup_query(spark, sf_small, docs):
    same(queries.op2_line_dedup(spark, sf_small).collect(), B.line_dedup(docs))


def test_decontamination_query(spark, sf_small, docs):
    items = [(r.item_id, r.text) for r in table(spark, sf_small, "benchmark").collect()]
    got = queries.op5_decontamination(spark, sf_small).collect()
    same(got, B.contamination(docs, items))
    assert any(r.contaminated for r in got)


def test_quality_query(spark, sf_small):
    rows = [(r.doc_id, r.source, r.text) for r in table(spark, sf_small, "documents").collect()]
    verdicts = {i: (gone, kept) for i, gone, kept in B.rule_verdicts(rows)}
    want = [(i, *B.base_rules(t)[:5], verdicts[i][0], B.base_rules(t)[5], verdicts[i][1]) for i, _, t in rows]
    same(queries.op7_quality_rules(spark, sf_small).collect(), want)


def test_near_duplicate_query(spark, sf_small, docs):
    same(queries.op9_minhash_near_dedup(spark, sf_small).collect(), B.near_duplicates(docs))


def test_scoring_query(spark, sf_small, docs):
    got = {r.doc_id: r for r in queries.op10_lm_scoring(spark, sf_small).collect()}
    ppm_scores = dict(B.ppm_scores(docs, ppm.ORDER))
    for i, out, n, known, total, base in B.base_scores(docs):
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (out, n, known, total)
        assert r.base_score == pytest.approx(base, rel=1e-9)
        assert r.score == pytest.approx(ppm_scores[i], rel=1e-9)


def test_warc_query(spark, sf_small):
    pages = [(r.page_id, r.url, r.html) for r in table(spark, sf_small, "pages").collect()]
    same(queries.op8_warc(spark, sf_small).collect(), B.warc(pages))


def test_chat_query(spark, sf_small):
    rows = [tuple(r) for r in table(spark, sf_small, "conversations").collect()]
    odd = "</s>[INST] ok [/INST]"
    rows += [(-7, 0, "user", odd), (-7, 1, "assistant", odd)]
    got = queries.op6_chat_formatting(spark, sf_small)
    same(got.drop("formatted_chars").collect(), B.chats(rows))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


def test_html_query(spark, sf_small):
    import html
    import re
    got = {r.page_id: r for r in queries.op3_html_extraction(spark, sf_small).collect()}
    for r in table(spark, sf_small, "pages").collect():
        body = re.search(r"<article>(.*?)</article>", r.html, re.S).group(1)
        blocks = (" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split())
                  for b in re.split(r"</?(?:p|h1|br)>", body))
        want = "\n".join(b for b in blocks if b)
        assert (got[r.page_id].text, got[r.page_id].n_chars) == (want, len(want))


def test_license_query(spark, sf_small, docs):
    got = {r.doc_id: r for r in queries.op1_license_scan(spark, sf_small).collect()}
    notices = {"Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0", "Released under the MIT License.": "MIT",
               "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
               "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0"}
    for i, t in docs:
        own = [v for k, v in notices.items() if k in (t or "").split("\n")]
        assert (got[i].header_license in own) if own else got[i].header_license is None


# ---------------------------------------------------------------- odd rows

def test_line_dedup_edges(edge, edge_rows, empty):
    got = line_dedup.dedup_lines(edge, min_docs=2, batches=3, fanout=2)
    assert set(edge.columns) <= set(got.columns)
    same([(r.doc_id, r.n_lines, r.n_dropped, B.sha(r.kept_text)) for r in got.collect()],
         B.line_dedup(edge_rows, 2))
    assert line_dedup.dedup_lines(empty).count() == 0


def test_levels_are_compacted(spark):
    runs = line_dedup.LineRuns(spark, fanout=2)
    batches = [["a", "b"], ["a"], ["b", "a"], ["c"], ["a\na"]]
    for b in batches:
        runs.add(spark.createDataFrame([(x,) for x in b], "text string"))
    assert [len(level) for level in runs.levels] == [1, 0, 1]  # binary counter of five batches
    n = {r.n for level in runs.levels for run in level for r in run.collect()}
    assert runs.frequent(4).count() == 1 and runs.frequent(2).count() == 2 and max(n) <= 4
    runs.clear()


def test_decontamination_edges(spark, edge, edge_rows, empty):
    long = " ".join(f"w{i % 977} x{i % 31}" for i in range(500, 520))
    items = [(1, long), (1, long), (2, "TWO words!"), (None, "one"), (4, None), (5, "--"), (6, "same line second"),
             (7, "a b a"), (8, "b a"), (9, "body of text goes on and on for more than five words there and then")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontam.find_hits(edge, bench)
    items = [("null" if i is None else i, t) for i, t in items]
    same([(r.doc_id, r.n_words, r.n_hit, len(r.hit_items), B.sha(",".join(r.hit_items)), r.contaminated)
          for r in got.collect()], B.contamination(edge_rows, items))
    assert {r["__odd"] for r in got.collect()} == {"own"}
    cut = {r.doc_id: r.text for r in decontam.remove_spans(got).collect()}
    assert cut[5] == "" and cut[0] is None and cut[17].endswith("foot line")
    assert decontam.find_hits(empty, bench).count() == 0
    none = decontam.find_hits(edge, spark.createDataFrame([], bench.schema))
    assert none.where("n_hit > 0 or contaminated").count() == 0


def test_decontamination_in_blocks(edge, edge_rows, spark, monkeypatch):
    items = [(i, f"w{i} x{i % 31} w{i + 1} x{(i + 1) % 31}") for i in range(20)] + [(99, "one")]
    monkeypatch.setattr(decontam, "BLOCK_WORDS", 12)
    got = decontam.find_hits(edge, spark.createDataFrame(items, "item_id long, text string"))
    same([(r.doc_id, r.n_words, r.n_hit, len(r.hit_items), B.sha(",".join(r.hit_items)), r.contaminated)
          for r in got.collect()], B.contamination(edge_rows, items))


def test_long_item_in_parts(edge, edge_rows, spark, monkeypatch):
    words = max((t or "" for _, t in edge_rows), key=len).split()
    items = [("long", " ".join(words[40:140])), ("short", "two words"), ("same", "The same body of text goes on and on")]
    monkeypatch.setattr(decontam, "BLOCK_WORDS", 30)
    blocks = list(decontam._item_blocks(spark.createDataFrame(items, "item_id string, text string"),
                                        "item_id", "text", 13))
    assert len(blocks) > 4  # parts of at most a block each
    got = decontam.find_hits(edge, spark.createDataFrame(items, "item_id string, text string"))
    same([(r.doc_id, r.n_words, r.n_hit, len(r.hit_items), B.sha(",".join(r.hit_items)), r.contaminated)
          for r in got.collect()], B.contamination(edge_rows, items))


@pytest.mark.parametrize(("max_span", "coverage"), [(0, None), (12, None), (12, 20), (8, 3), (500, None)])
def test_spans_over_limits(edge, edge_rows, spark, max_span, coverage):
    items = [(1, "The same body of text goes on and on for more than five words"), (2, "one"), (3, "other"),
             (4, " ".join(f"w{i % 977} x{i % 31}" for i in range(30, 50)))]
    hits = decontam.find_hits(edge, spark.createDataFrame(items, "item_id long, text string"))
    got = decontam.remove_spans(hits, max_span=max_span, coverage=coverage).collect()
    want = B.without_spans(edge_rows, items, max_span, coverage)
    assert sorted(map(repr, ((r.doc_id, r.text) for r in got))) == sorted(map(repr, want))
    if coverage is None:  # the same in one pass
        once = decontam.find_hits(edge, spark.createDataFrame(items, "item_id long, text string"), max_span=max_span)
        assert sorted(map(repr, ((r.doc_id, r.text) for r in once.collect()))) == sorted(map(repr, want))


def test_quality_edges(edge, empty):
    rows = [(r.doc_id, r.source, r.text) for r in edge.collect()]
    got = line_rules.judge(edge, max_docs=1)
    assert "__odd" in got.columns
    want = [(i, *B.base_rules(t), gone, kept) for (i, _, t), (_, gone, kept)
            in zip(rows, B.rule_verdicts(rows, 1))]
    same([(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed,
           r.boiler_chars, r.kept) for r in got.collect()], want)
    assert line_rules.judge(empty).count() == 0


def test_boilerplate_documents_are_rejected(spark):
    body = [" ".join(f"t{k}w{i}" for i in range(60)) for k in range(40)]
    notice = " ".join(f"n{i}" for i in range(60))
    rows = [(k, "h", body[k] + "\n" + notice) for k in range(40)]  # a notice below every text
    rows += [(100 + k, "h", f"t{k}\n{notice}") for k in range(3)]  # nearly nothing but the notice
    rows += [(200 + k, "other", notice) for k in range(3)]  # another host
    got = {r.doc_id: r.kept for r in line_rules.judge(
        spark.createDataFrame(rows, "doc_id long, source string, text string"), max_docs=20).collect()}
    assert all(got[k] for k in range(40)) and not any(got[100 + k] for k in range(3))
    assert all(got[200 + k] for k in range(3))


def test_notices_of_several_lines(spark):
    notice = [" ".join(f"n{k}w{i}" for i in range(60)) for k in range(3)]
    copy = "\n".join(" ".join(f"c{k}w{i}" for i in range(60)) for k in range(3))
    body = [" ".join(f"t{k}w{i}" for i in range(200)) for k in range(30)]
    rows = [(k, "h", "\n".join([f"first {k}", *notice])) for k in range(30)]  # only the notice under a first line
    rows += [(100 + k, "h", "\n".join([*notice, body[k]])) for k in range(30)]
    rows += [(200 + k, "h", copy) for k in range(30)]  # copies of a text are one document
    got = {r.doc_id: (r.boiler_chars, r.kept) for r in line_rules.judge(
        spark.createDataFrame(rows, "doc_id long, source string, text string"), max_docs=20).collect()}
    chars = sum(len(x.replace(" ", "")) for x in notice)
    assert got[0] == (0, True)  # the first document keeps the notice
    assert all(got[k] == (chars, False) for k in range(1, 30))
    assert all(got[100 + k] == (chars, True) for k in range(30))
    assert all(got[200 + k] == (0, True) for k in range(30))


def test_quality_sql_where_a_host_passes_the_limit(spark, tmp_path):
    """The SQL and the operator on a table whose rules all bite: notices of
    two lines in more documents than the limit, copies, documents that are
    little but notice, lines just at the limit, null hosts."""
    import duckdb

    from framewise.llm.oracle import SQL

    notice = "\n".join(" ".join(f"n{k}w{i}" for i in range(60)) for k in range(2))
    body = lambda k, n: " ".join(f"t{k}w{i}" for i in range(n))
    limit = line_rules.MAX_DOCS
    rows = [(k, "h", f"{body(k, 60)}\n{notice}") for k in range(limit + 20)]
    rows += [(1000 + k, "h", f"{body(1000 + k, 2)}\n{notice}") for k in range(20)]  # depleted
    rows += [(2000 + k, "at", f"{body(2000 + k, 60)}\n{notice}") for k in range(limit)]  # not above the limit
    rows += [(3000 + k, "copies", f"{body(0, 60)}\n{notice}") for k in range(limit + 20)]  # one content
    rows += [(4000 + k, None, f"{body(4000 + k, 60)}\n  {notice.upper()} ") for k in range(limit + 5)]
    rows += [(5000, "h", None), (5001, "h", ""), (5002, "h", "a b a b " * 40)]
    spark.createDataFrame(rows, "doc_id long, source string, text string").coalesce(1).write.parquet(
        f"file://{tmp_path}/documents.parquet")
    got = [tuple(r) for r in queries.op7_quality_rules(spark, f"file://{tmp_path}").collect()]
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    names = [d[0] for d in con.execute(SQL["op7_quality_rules"]).description]
    want = [tuple(r) for r in con.execute(SQL["op7_quality_rules"]).fetchall()]
    columns = queries.op7_quality_rules(spark, f"file://{tmp_path}").columns
    same(got, [tuple(r[names.index(c)] for c in columns) for r in want])
    of = {r[0]: dict(zip(columns, r)) for r in got}
    assert of[0]["boiler_chars"] == 0 and of[1]["boiler_chars"] > 0 and of[1]["kept"]
    assert not of[1005]["kept"] and not of[1005]["base_failed"]
    assert of[2005]["boiler_chars"] == 0 and of[3005]["boiler_chars"] == 0 and of[4005]["boiler_chars"] > 0


def test_near_duplicate_edges(spark, edge, empty):
    rows = [(r.doc_id, r.text) for r in edge.collect()]
    got = setsketch.near_duplicates(edge).collect()
    assert len(got) == len(rows)
    by_set = {}
    for i, t in rows:
        s = B.shingle_set(t)
        if s and i is not None:
            by_set[s] = min(i, by_set.get(s, i))
    want = []
    for i, t in rows:
        s = B.shingle_set(t)
        comp = by_set.get(s) if s else i
        want.append((i, len(s), comp, comp == i if comp is not None else True))
    same([(r.id, r.n_shingles, r.component_id, bool(r.kept)) for r in got],
         [(i, n, c, bool(k) if i is not None or c is None else False) for i, n, c, k in want])
    assert setsketch.near_duplicates(empty).count() == 0


def test_chains_stars_and_large_groups(spark):
    """A star around one origin whose copies are unlike each other, a chain
    whose ends are unlike, and a group of exact copies."""
    import random
    rng = random.Random(3)
    word = lambda: f"v{rng.randrange(10**6)}"
    rows, origin = [], [word() for _ in range(120)]
    rows.append((500, " ".join(origin)))
    for i in range(150):  # each changes one block: near the origin, further from the others
        c = list(origin)
        k = rng.randrange(110)
        c[k:k + 5] = [word() for _ in range(5)]
        rows.append((501 + i, " ".join(c)))
    chain = [word() for _ in range(400)]
    for i in range(30):
        chain = chain[12:] + [word() for _ in range(12)]
        rows.append((1000 + i, " ".join(chain)))
    rows += [(2000 + i, "one text that is copied " * 9) for i in range(200)]
    rows += [(3000 + i, " ".join(word() for _ in range(80))) for i in range(50)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    same([(r.id, r.n_shingles, r.component_id, r.kept) for r in setsketch.near_duplicates(df).collect()],
         B.near_duplicates(rows))


def test_sketches_estimate_similarity():
    import numpy as np
    rng = np.random.default_rng(5)
    a = rng.integers(0, 2**63, 900).astype(np.uint64)
    for share in (300, 600, 880):
        b = np.concatenate([a[:share], rng.integers(0, 2**63, 900 - share).astype(np.uint64)])
        least = setsketch.registers(np.concatenate([a, b]), np.array([0, 900, 1800]))
        regs = setsketch.quantised(least)
        j = setsketch.estimate(regs[:1], regs[1:], np.array([900.0]), np.array([900.0]))[0]
        assert j == pytest.approx(share / (1800 - share), abs=0.15)
        both = setsketch.quantised(setsketch.registers(np.unique(np.concatenate([a, b])),
                                                       np.array([0, 1800 - share])))
        assert (setsketch.merge(regs[0], regs[1]) == both[0]).all()


def test_scoring_edges(edge, edge_rows, empty):
    short = edge.where("doc_id is null or doc_id not in (17, 18)")
    rows = [(i, t) for i, t in edge_rows if i not in (17, 18)]
    got = sorted(((r.id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 8),
                   round(r.score, 8)) for r in ppm.score(short).collect()), key=KEY)
    scores = [s for _, s in B.ppm_scores(rows, ppm.ORDER)]
    want = sorted(((*r[:5], round(r[5], 8), round(s, 8)) for r, s in zip(B.base_scores(rows), scores)), key=KEY)
    assert got == want
    assert ppm.score(empty).count() == 0
    alone = edge.where("doc_id in (2)")  # nothing to train on, if it is held out
    assert ppm.score(alone).count() == 1


def test_scoring_in_shards(edge, edge_rows, monkeypatch):
    rows = edge.where("doc_id < 15")
    whole = {(r.id, round(r.score, 8), round(r.base_score, 8)) for r in ppm.score(rows).collect()}
    monkeypatch.setattr(ppm, "MAX_NODES", 300)
    monkeypatch.setattr(ppm, "HEAD", 3)
    assert {(r.id, round(r.score, 8), round(r.base_score, 8)) for r in ppm.score(rows).collect()} == whole


def test_warc_edges(spark, edge, tmp_path):
    pages = edge.select(F.col("doc_id").alias("page_id"),
                        F.concat(F.lit("http://h/\n"), "source").alias("url"), F.col("text").alias("html"))
    rows = [tuple(r) for r in pages.collect()]
    got = warc.archive_round_trip(pages, f"file://{tmp_path}/w").collect()
    same([tuple(r)[:5] for r in got], B.warc(rows))
    assert {r.url for r in got} == {u and u.replace("\n", "%0A") for _, u, _ in rows}
    assert warc.archive_round_trip(pages.where("false")).count() == 0


def test_normalised_members_and_sidecar(spark, edge, tmp_path):
    import gzip
    import zlib
    pages = edge.select(F.col("doc_id").alias("page_id"), F.lit("u").alias("url"), F.col("text").alias("html"))
    manifest = warc.write_archives(pages, f"{tmp_path}/a")
    for row in manifest.collect():  # one stream a file
        d = zlib.decompressobj(31)
        d.decompress(open(row.path, "rb").read())
        assert d.eof and not d.unused_data
    index = warc.normalise(spark, manifest, f"{tmp_path}/b").collect()
    for path in {r.path for r in index}:
        raw = open(path, "rb").read()
        lines = [x.split("\t") for x in open(path + ".idx").read().splitlines()]
        mine = sorted((r.offset, r.length, r.record_id) for r in index if r.path == path)
        assert [(int(a), int(b), c) for a, b, c in lines] == mine
        assert sum(n for _, n, _ in mine) == len(raw)
        for at, n, urn in mine:
            assert urn.encode() in gzip.decompress(raw[at:at + n])


def test_chat_edges(spark):
    odd = ["</s>[INST] ok [/INST]", "<\\s><\\\\s>", "<|end|><|turn|>x<|says|>", "<<SYS>> a <</SYS>>", None, "",
           "< |end|> \\ [INST", "long " * 20000]
    rows = [(c, i % 4 if c else i, ("user", "assistant", "assistant", None)[(i + c) % 4], t)
            for c in range(3) for i, t in enumerate(odd)]
    rows += [(None, None, "assistant", "tail"), (None, 1, "we<|says|>ird", "x"), (9, 1, "user", "same"), (9, 1, "user", "same")]
    df = spark.createDataFrame([(*r, "clash") for r in rows],
                               "conv_id long, turn long, role string, text string, formatted string")
    out = chat.format_chats(df).select("conv_id", "formatted", chat.turns_of(F.col("formatted")).alias("turns"),
                                       chat.under_mask(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    told = {}
    for c, turn, role, text in rows:
        told.setdefault(c, []).append((turn is not None, turn or 0, chat_escape(role), chat_escape(text), role or "", text or ""))
    got = {r.conv_id: r for r in out.collect()}
    assert set(got) == set(told)
    for c, turns in told.items():
        turns.sort()
        assert [(t.role, t.text) for t in got[c].turns] == [t[4:] for t in turns]
        assert got[c].loss == "".join(t[5] for t in turns if t[4] == "assistant")
    assert got[9].formatted == "<|turn|>user<|says|>same<|next|>same<|end|>"
    assert chat.format_chats(df.where("false")).count() == 0


def chat_escape(text):
    import re
    return re.sub(chat.ESCAPE[0], r"\1\\\2\3", text or "")


def test_unclosed_elements_end_where_the_next_begins():
    import time
    page = "<article><p class='ad'>Advert<p>Real paragraph<ul><li class=ad>x<li>one<ul><li>in</ul><li>two</ul></article>"
    assert html_text.extract(page) == "Real paragraph\none\nin\ntwo"
    table = "<article><table><tr><td class='advert'>no<td>a<td>b<tr><td>c<p>d<td>e</table><p><b>f<div>g</div></article>"
    assert html_text.extract(table) == "a\nb\nc\nd\ne\nf\ng"
    began = time.process_time()
    deep = "<article>" + "<p>word words" * 20_000 + "<div>word words" * 20_000 + "</span>" * 20_000
    assert html_text.extract(deep).count("\n") == 39_999
    assert time.process_time() - began < 10  # it was quadratic: minutes


PAGES = {
    "<html><body><nav>Menu words here</nav><p>First para.</p><p>Second &amp; last</p><footer>foot</footer>":
        "First para.\nSecond & last",
    "<header>Site</header><main><h1>Title</h1><p>One<br>two <b>bold</b>\n text</p>"
    "<aside>side</aside><div class='comments'><article class='comment'>I think</article></div></main>":
        "Title\nOne\ntwo bold text",
    "<article><p>Kept &lt;b&gt; &#233; &nbsp;x</p><script>var a='<p>no</p>'</script><form>sign up</form>"
    "<div id='cookie-notice'>We use cookies</div><p hidden>no</p></article><p>outside</p>": "Kept <b> é x",
    "<article><p>cut off <b>here": "cut off here",
    "<nav><a href=x>unclosed menu<article><p>still read</p></article>": "still read",
    "<p>a</p><script>never closed <p>b</p>": "a",
    "plain text only": "plain text only",
    "<!-- <p>x</p> --><style>p{}</style>": "",
    "<ul><li><a href=1>Home</a></li><li><a href=2>About</a></li></ul><p>The long main paragraph of this page, "
    "which has many words.</p><p>Short.</p><p>Another long paragraph of the page with more words in it.</p>"
    "<div class=sidebar>Related things</div>":
        "The long main paragraph of this page, which has many words.\nShort.\n"
        "Another long paragraph of the page with more words in it.",
    "<a title=\"a>b\" href='x'>": "",
}


@pytest.mark.parametrize("page", PAGES)
def test_main_text(page):
    assert html_text.extract(page) == PAGES[page]


def test_distribution_on_all_pages():
    five = [f"{k} " + "x" * 98 for k in range(5)]
    long, links = "y" * 5000, "<p><a href=1>one</a></p>" * 5
    paras = lambda texts: "".join(f"<p>{t}</p>" for t in texts)
    whole = "\n".join([*five, long])
    assert html_text.extract(paras([*five, long])) == whole  # one long paragraph does not raise the threshold
    assert html_text.extract(paras(five) + links + paras([long])) == whole  # all blocks
    assert html_text.extract(paras(["ab", "cd", "ef", "gh", *five])) == "\n".join(["ef", "gh", *five])
    # on a marked page too: strokes before the text surge nowhere, a title and a byline do
    assert html_text.extract("<article>" + paras(["|", "|", "|", "|", "|", *five]) + "</article>" + paras(["x" * 300])) \
        == "\n".join(["|", "|", *five])
    head = ["A title", "By Ann", "1 May"]
    assert html_text.extract("<article>" + paras([*head, *five, long]) + "</article>") == "\n".join([*head, whole])


def test_marks_raise_weights_and_zero_nothing(monkeypatch):
    text = "words of the article, many more of them than elsewhere " * 2
    three = "".join(f"<p>{c * 150}</p>" for c in "abc")
    page = f"<p>short outside</p><article><p>{text}</p><p>{text}</p></article>{three}"
    inside = "\n".join([text.strip()] * 2)
    outside = "\n".join(c * 150 for c in "abc")
    # a surge outside the mark is main text too, less is not
    assert html_text.extract(page) == inside + "\n" + "\n".join(outside.split("\n"))
    assert html_text.extract(page.replace("b" * 150, "b")) == inside
    monkeypatch.setattr(html_text, "WINDOW", 1)  # no line alone reaches the surge
    assert html_text.extract(page) == inside


def test_all_articles_and_exact_class_names():
    long = "the longer article has more words than the other"
    assert html_text.extract(f"<article><h1>One</h1><p>short</p></article><article><p>{long}</p></article>") \
        == f"One\nshort\n{long}"
    for kept in ("share-price", "related-work", "searchResults", "job ad-hoc", "noticeable", "shareholder"):
        assert html_text.extract(f"<article><p>{long}</p><p class='{kept}'>kept</p></article>") == long + "\nkept"
    for cut in ("share", "share-buttons", "related-posts", "cookieNotice", "post__comments", "lead ad", "ad-300x250",
                "site-footer", "Newsletter-Signup", "top_ad"):
        assert html_text.extract(f"<article><p>{long}</p><p class='{cut}'>gone</p></article>") == long


def test_html_edges(spark, edge, empty):
    long = "<article>" + "".join(f"<p>para {i} &amp; more</p>" for i in range(50_000)) + "</article>"
    df = edge.select(F.col("doc_id").alias("page_id"), F.col("text").alias("html"), F.lit("clash").alias("text"))
    df = df.unionByName(spark.createDataFrame([(77, long, "c"), (78, None, None)],
                                              "page_id long, html string, text string"))
    got = html_text.main_text(df).collect()
    assert len(got) == df.count()
    by = {r.page_id: r.text for r in got}
    assert by[0] == by[78] == "" and by[77].count("\n") == 49_999 and by[77].startswith("para 0 & more\n")
    assert html_text.main_text(df.where("false")).count() == 0


def test_license_inheritance(spark, edge, empty):
    mit, apache = "Released under the MIT License.", "Licensed under the Apache License, Version 2.0."
    body = "def f(): return 1\n" * 30
    rows = [(1, "r/LICENSE", mit), (2, "r/a/x.py", body), (3, "r/a/b/LICENSE", apache), (4, "r/a/b/c/y.py", body),
            (5, "r/z.py", apache + "\n" + body), (6, "other/q.py", body), (7, None, None), (8, "top.py", ""),
            (9, "r/a/b/NOTICE", mit), (9, "r/a/b/NOTICE", mit),
            (10, "docs/one.txt", mit), (11, "docs/two.txt", body), (12, "docs/COPYING.txt.d/x", body)]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "id long, path string, text string, license string")
    got = {r.id: (r.license, r.origin, r.from_dir) for r in licenses.scan(df, "id", "path").collect()}
    assert got == {1: ("MIT", "file", None), 2: ("MIT", "inherited", "r"), 3: ("Apache-2.0", "file", None),
                   4: ("Apache-2.0", "inherited", "r/a/b"), 5: ("Apache-2.0", "header", None), 6: (None, None, None),
                   7: (None, None, None), 8: (None, None, None), 9: ("MIT", "file", None),
                   # a document that is a notice does not license its directory
                   10: ("MIT", "file", None), 11: (None, None, None), 12: (None, None, None)}
    assert licenses.scan(edge, "doc_id", "source").count() == edge.count()
    assert licenses.scan(empty, "doc_id", "source").count() == 0


def test_full_length_licenses(spark):
    text = dict(licenses.TEXTS)
    body = "def f(): return 1\n" * 30
    mit = "Copyright (c) 2020 Some Holder\n\n" + text["MIT"]
    wrapped = ("# This program is free software: you can redistribute it and/or modify\n# it under the terms of "
               "the GNU General Public License as published by\n# the Free Software Foundation, either version 3 "
               "of the License, or\n# (at your option) any later version.\nimport os\n" + body)
    prose = "the quick brown fox of the hill and the dog in a house to be or not to be that is the question " * 9
    rows = [(f"{n}/LICENSE", t) for n, t in text.items()] + [(f"{n}/src/x.py", body) for n in text]
    rows += [("held/LICENSE", mit), ("held/a/b.py", body), ("gpl.py", wrapped), ("prose.txt", prose),
             ("mit.py", "/*\n * " + mit.replace("\n", "\n * ") + "\n */\n" + body)]
    got = {r.path: (r.license, r.origin, r.from_dir) for r in licenses.scan(
        spark.createDataFrame(list(enumerate(rows)), "id long, f struct<path: string, text: string>")
        .select("id", "f.*"), "id", "path").collect()}
    for n in text:
        assert got[f"{n}/LICENSE"] == (n, "file", None) and got[f"{n}/src/x.py"] == (n, "inherited", n)
    assert got["held/LICENSE"] == ("MIT", "file", None) and got["held/a/b.py"] == ("MIT", "inherited", "held")
    assert got["gpl.py"] == ("GPL-3.0", "header", None) and got["mit.py"] == ("MIT", "header", None)
    assert got["prose.txt"] == (None, None, None)


def test_license_cosine_is_exact(spark):
    import numpy as np
    texts = ["Released under the MIT License.", "the the license of things", "nothing here"]
    v = licenses.Vectors(np.arange(len(licenses.vocabulary()), dtype=float), 100)
    h, first = licenses._hashed(texts)
    score, which = v.best(np.repeat(np.arange(3), np.diff(first)), h, 3)
    words = [B.ALNUM.findall(B.lower(t)) for t in texts]
    weight = {int(w): i for w, i in zip(v.words, v.idf)}
    one = lambda w: int(licenses._hashed([w])[0][0])

    def vector(ws):
        return {w: ws.count(w) * weight.get(one(w), v.rare) for w in set(ws)}

    def cosine(a, b):
        dot = sum(x * b.get(w, 0) for w, x in a.items())
        return dot / np.sqrt(sum(x * x for x in a.values()) * sum(x * x for x in b.values()))

    for k, ws in enumerate(words):
        all_ = [cosine(vector(ws), vector(B.ALNUM.findall(B.lower(t)))) for _, t in licenses.TEMPLATES]
        assert score[k] == pytest.approx(max(all_)) and (max(all_) == 0 or all_[which[k]] == pytest.approx(max(all_)))


def test_word_hashes_over_blocks(monkeypatch):
    """Texts cut into small blocks give the same words as whole ones."""
    import pyarrow as pa

    from framewise.llm import common
    texts = ["", None, "alpha Beta\ngamma", "x" * 50, " y " * 30, "é ü " * 9, "end", "tail" * 9 + " z"]
    data, offsets = common.utf8(pa.array(texts, pa.string()))
    codes = common.byte_codes("space", True)
    whole = common.word_hashes(data, offsets, codes)
    words = [B.WORD.findall(t or "") for t in texts]
    assert list(whole[3]) == [sum(len(w) for w in words[:k]) for k in range(len(texts) + 1)]
    raw = data.tobytes()
    assert [raw[a:b].decode() for a, b in zip(whole[1], whole[2])] == [w for ws in words for w in ws]
    assert len(set(whole[0])) == len({B.lower(w) for ws in words for w in ws})
    for block in (8, 16, 32):
        monkeypatch.setattr(common, "BLOCK", block)
        common._tables.cache_clear()
        part = common.word_hashes(data, offsets, codes)
        assert [list(x) for x in part[1:]] == [list(x) for x in whole[1:]]
        short = [b - a <= block for a, b in zip(whole[1], whole[2])]
        assert [h for h, k in zip(part[0], short) if k] == [h for h, k in zip(whole[0], short) if k]
    monkeypatch.undo()
    common._tables.cache_clear()


def test_digest_columns():
    assert B.sha("") == hashlib.sha256(b"").hexdigest()


@pytest.mark.parametrize("name", ["op2_line_dedup", "op5_decontamination", "op6_chat_formatting",
                                  "op7_quality_rules", "op8_warc", "op9_minhash_near_dedup"])
def test_query_equals_sql(spark, sf_small, name):
    import duckdb

    from framewise.llm.oracle import SQL
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    df = queries.QUERIES[name](spark, sf_small)
    out = con.execute(SQL[name])
    names = [d[0] for d in out.description]
    assert sorted(names) == sorted(df.columns) and set(SQL) <= set(queries.QUERIES)
    same(df.select(*names).collect(), out.fetchall())


@pytest.mark.parametrize("small,shared", [(12, 256), (8, 24)])
def test_widely_spread_group(spark, monkeypatch, small, shared):
    """Copies that differ from their origin by nothing to most of it, some by
    deletions only, with copies of copies; small bounds force further rounds."""
    import random
    rng = random.Random(11)
    word = lambda: f"v{rng.randrange(10**6)}"
    origin = [word() for _ in range(140)]

    def copy(base, edits, delete):
        c = list(base)
        for _ in range(edits):
            k = rng.randrange(len(c))
            if delete:
                del c[k]
            else:
                c[k] = word()
        return c

    copies = [copy(origin, rng.choice((0, 1, 1, 2, 3, 4, 6, 12)), rng.random() < 0.4) for _ in range(160)]
    copies += [copy(rng.choice(copies), rng.choice((1, 2, 3)), rng.random() < 0.4) for _ in range(60)]
    second = copy(origin, 8, False)
    copies += [copy(second, rng.choice((1, 2, 3)), False) for _ in range(40)]
    rows = list(enumerate(" ".join(c) for c in copies))
    rng.shuffle(rows)
    monkeypatch.setattr(setsketch, "SMALL", small)
    monkeypatch.setattr(setsketch, "SHARED", shared)
    got = setsketch.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    same([(r.id, r.n_shingles, r.component_id, r.kept) for r in got.collect()], B.near_duplicates(rows))


def test_members_without_a_shared_difference(spark):
    """A member equal to the reference stands in for the links of all members
    that differ from it each in its own way."""
    import numpy as np
    import pyarrow as pa

    from framewise.llm import common
    words = [f"w{k}" for k in range(204)]  # 200 shingles
    texts = {1: words, 7: words}
    for b in range(2, 6):  # 10 to 25 shingles changed, no place twice
        c = list(words)
        for k in range(b):
            c[6 + 50 * (b - 2) + 7 * k] = f"new{b}.{k}"
        texts[b] = c
    codes = common.byte_codes("space", True)
    data, offsets = common.utf8(pa.array([" ".join(words)]))
    h, _, _, word = common.word_hashes(data, offsets, codes)
    reference = setsketch.shingles(h, word)[0].tobytes()
    rows = [(1, 0, None, reference, " ".join(words))] + [
        (1, 0, b, None, " ".join(t)) for b, t in sorted(texts.items()) if b != 1]
    batch = pa.RecordBatch.from_arrays(
        [pa.array([r[k] for r in rows], t) for k, t in enumerate(
            (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.string()))],
        names=["a", "salt", "b", "reference", "text"])
    out = pa.Table.from_batches(setsketch._differ([batch], 85)).to_pandas()
    assert sorted(out.loc[out.side == 2, "rep"]) == [2, 3, 4, 5, 7]  # 7 equals the reference
    sets = {b: B.shingle_set(" ".join(t)) for b, t in texts.items()}

    def linked(x, y):
        both = len(sets[x] & sets[y])
        return 100 * both >= 85 * (len(sets[x]) + len(sets[y]) - both)

    got = {(r.a, r.b) for r in setsketch._centres(spark.createDataFrame(out), 85, 1).collect()}
    assert {x for x, _ in got} == {7} and {b for _, b in got} == {b for b in range(2, 6) if linked(7, b)}
    assert np.all([linked(x, y) for x, y in got]) and len(got) >= 2
    assert not linked(2, 5) and not linked(3, 4)


def test_similarity_of_eighty(spark):
    """At 80 % with bands of five registers, pairs on both sides of it."""
    import random
    rng = random.Random(8)
    word = lambda: f"v{rng.randrange(10**6)}"
    rows = []
    for k in range(60):
        base = [word() for _ in range(150)]
        near = list(base)
        at = rng.randrange(130)
        n = rng.randrange(8, 18)
        near[at:at + n] = [word() for _ in range(n)]
        rows += [(10 * k, " ".join(base)), (10 * k + 1, " ".join(near))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = B.near_duplicates(rows, 80)
    same([(r.id, r.n_shingles, r.component_id, r.kept)
          for r in setsketch.near_duplicates(df, percent=80, rows_per_band=5).collect()], want)
    assert 10 < sum(not k for *_, k in want) < 60 and want != B.near_duplicates(rows)


def test_members_that_share_little_are_not_paired(spark):
    """Members that share one difference of many are no candidates, however
    many they are; those that may be linked are all paired."""
    import random

    import pyarrow as pa

    from framewise.llm import common
    rng = random.Random(5)
    words = [f"w{k}" for k in range(204)]
    texts = {1: words}
    for b in range(2, 32):
        c = list(words)
        c[6] = "shared"
        for k in rng.sample(range(12, 204, 6), 7):
            c[k] = f"new{b}.{k}"
        texts[b] = c
    texts[40], texts[41] = list(texts[2]), list(texts[3])
    texts[40][100], texts[41][150] = "one", "two"
    codes = common.byte_codes("space", True)
    data, offsets = common.utf8(pa.array([" ".join(words)]))
    h, _, _, word = common.word_hashes(data, offsets, codes)
    reference = setsketch.shingles(h, word)[0].tobytes()
    rows = [(1, 0, None, reference, " ".join(words))] + [
        (1, 0, b, None, " ".join(t)) for b, t in sorted(texts.items()) if b != 1]
    batch = pa.RecordBatch.from_arrays(
        [pa.array([r[k] for r in rows], t) for k, t in enumerate(
            (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.string()))],
        names=["a", "salt", "b", "reference", "text"])
    apart = spark.createDataFrame(pa.Table.from_batches(setsketch._differ([batch], 80)).to_pandas())
    sizes = apart.where("side = 0").groupBy("key").count().where("count > 1")
    comp = spark.createDataFrame([], "rep long, comp long")
    got = {(r.a, r.b) for r in setsketch._along(apart, sizes, comp, 80).collect()}
    sets = {b: B.shingle_set(" ".join(t)) for b, t in texts.items()}
    linked = {(x, y) for x in sets for y in sets if 1 < x < y
              and 100 * len(sets[x] & sets[y]) >= 80 * len(sets[x] | sets[y])}
    assert {(2, 40), (3, 41)} <= linked <= got and len(got) < 40
