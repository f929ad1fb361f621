"""Operators on vectors, pages and conversations; the pipeline; SQL twins."""

import base64
import hashlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline
from ortholake.llm import lattice, preferences, queries, site_style, warc
from tools.oracle_check import TABLES, rows_key

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = queries.QUERIES[name](spark, SF)
    cur = con.execute(queries.ORACLE[name])
    cols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(df.columns)
    assert rows_key(df.columns, [tuple(r) for r in df.collect()]) == rows_key(cols, cur.fetchall())


def test_all_queries_are_registered():
    assert set(queries.QUERIES) <= set(E.queries()) and len(queries.QUERIES) == 14


# 3 ------------------------------------------------------------------------------------
def test_e8_decoding_finds_the_nearest_point():
    rng = np.random.default_rng(0)
    y = rng.normal(size=(300, 8)) * 2
    p, roots = lattice.nearest_e8(y), lattice.e8_roots()
    assert len(roots) == 240
    mine = ((y - p) ** 2).sum(1)
    around = ((y[:, None] - p[:, None] - roots) ** 2).sum(2).min(1)
    assert (mine <= around + 1e-9).all() and (mine <= 1 + 1e-9).all()      # covering radius 1


def test_vectors_against_brute_force(spark):
    rng = np.random.default_rng(3)
    rows, vid = [], 0

    def add(x, label):
        nonlocal vid
        rows.append((vid, [float(v) for v in x], label))
        vid += 1

    for g in range(12):                                   # groups of near copies at several distances, two labels
        c = rng.normal(size=64)
        for _ in range(25):
            add(c / np.linalg.norm(c) + rng.normal(size=64) * rng.choice([0, 0.01, 0.02, 0.03, 0.04]), g % 2)
    for _ in range(300):
        add(rng.normal(size=64), int(rng.integers(3)))
    odd = [(9000, None, 1), (9001, [0.0] * 64, 1), (9002, rows[0][1][:63] + [float("nan")], 0), (9003, rows[0][1], None), (9004, rows[0][1][:63] + [None], 0),
           (9005, [], 0), (9006, rows[0][1][:8], 0), (9007, [v * 1e30 for v in rows[0][1]], 0), (9007, [v * 1e30 for v in rows[0][1]], 0)]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>, label int")
    out = lattice.near_duplicates(df).collect()
    got = {r["vec_id"]: r for r in out}
    assert len(out) == len(got) == len(rows) + 8
    assert all(got[i]["n_links"] == 0 and got[i]["kept"] for i in range(9000, 9007))
    use = [r for r in rows] + [odd[7]]
    x = np.array([r[1] for r in use])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    label = np.array([r[2] for r in use])
    near = (x @ x.T >= 0.93) & (label[:, None] == label) & ~np.eye(len(use), dtype=bool)
    want = near.sum(1)
    have = np.array([got[r[0]]["n_links"] for r in use])
    assert (have <= want).all() and have.sum() >= 0.97 * want.sum()
    assert lattice.near_duplicates(df.limit(0)).count() == 0


# 5 ------------------------------------------------------------------------------------
def test_preferences_prompt_completions_and_masks(spark):
    turns = [(1, 0, "user", "hi"), (1, 1, "assistant", "a"), (1, 2, "user", "more"), (1, 3, "assistant", "long answer"),
             (65, 0, "user", "hi"), (65, 1, "assistant", "a"), (65, 2, "user", "else"), (65, 3, "assistant", "b"),
             (3, 0, "user", "alone"), (3, 1, "assistant", None), (None, 0, "user", "x"), (4, None, None, None), (4, None, None, None)]
    t = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    c = preferences.conversations(t)
    rows = {r["chosen_id"]: r for r in preferences.format_pairs(preferences.pair_conversations(c), c).collect()}
    p = rows[1]
    assert p["rejected_id"] == 65 and p["n_shared"] == 2
    assert p["prompt"] == "<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\na<|im_end|>\n"
    a, b = map(int, p["chosen_spans"].split(":"))
    assert p["chosen"][a:b] == "long answer<|im_end|>" and p["rejected"].endswith("b<|im_end|>\n")
    assert rows[3]["rejected"] is None and rows[3]["n_shared"] == 1 and rows[4]["n_shared"] == 1
    assert sorted(rows) == [1, 3, 4]
    assert preferences.format_pairs(preferences.pair_conversations(c.limit(0)), c.limit(0)).count() == 0


def test_every_answered_conversation_gets_a_rejected_side(spark):
    turns = [(f"c{i}", t, ("user", "assistant")[t % 2], f"text {i} {t}" if i % 9 else "same") for i in range(200) for t in range(1 + i % 5)]
    turns += [("long", 0, "user", "x " * 100_000), ("long", 1, "assistant", "y")]
    df = spark.createDataFrame(turns, "conv_id string, turn long, role string, text string").repartition(7)
    df = df.withColumns({c: F.lit("x") for c in ("conv", "turns", "key", "part", "next", "k", "answer", "n")})
    rows = {r["chosen_id"]: r for r in preferences.format_sides(preferences.with_rejected(preferences.conversations(df))).collect()}
    convs = {}
    for c, _, role, text in sorted(turns, key=lambda x: (x[0], x[1])):
        convs.setdefault(c, []).append((role, text))
    order = sorted((c for c, t in convs.items() if any(r == "assistant" for r, _ in t)), key=lambda c: (hashlib.md5(c.encode()).hexdigest(), c))
    show = lambda ts: "".join(f"<|im_start|>{r}\n{x}<|im_end|>\n" for r, x in ts)
    assert set(rows) == set(convs)
    for c, ts in convs.items():
        r = rows[c]
        if c not in order:
            assert r["rejected"] is None and r["prompt"] == show(ts[:-1]) and r["chosen"] == show(ts[-1:])
            continue
        other = order[(order.index(c) + 1) % len(order)]
        answer = [x for role, x in convs[other] if role == "assistant"][-1]
        k = max(i for i, (role, _) in enumerate(ts) if role == "assistant")
        swapped = [*ts[:k], ("assistant", answer), *ts[k + 1:]]
        n = next((i for i, (a, b) in enumerate(zip(ts, swapped, strict=True)) if a != b), len(ts))
        assert (r["rejected_id"], r["n_shared"], r["prompt"], r["chosen"], r["rejected"]) == (other, n, show(ts[:n]), show(ts[n:]), show(swapped[n:]))
    one = preferences.with_rejected(preferences.conversations(df.filter("conv_id = 'c1'"))).collect()
    assert len(one) == 1 and one[0]["rejected"] is None


# 8 ------------------------------------------------------------------------------------
def test_main_text_of_articles(spark):
    page = ("<html><head><title>T</title><style>p{}</style><script>var t='</p>';</script></head><body><nav><a>menu</a></nav>"
            "<div class='ad'>buy</div><article><h1>Head &amp; shoulders</h1><p>One  <b>two<br>three<p>four&nbsp;x<aside>no</aside>"
            "<form>f</form><section class='comments'><p>c</p></section><ul><li>i<li>j</ul></article><footer>&copy;</footer>")
    rows = [(1, "http://h.example/1", page), (2, None, ""), (3, "x", None), (4, "http://h.example/4", "plain text"), (5, "http://h.example/5", "<p>a<"), (5, "http://h.example/5", "<p>a<")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    out = {r["page_id"]: r for r in site_style.main_text(df).collect()}
    assert out[1]["text"] == "Head & shoulders\nOne two three\nfour x\ni\nj" and out[1]["n_chars"] == len(out[1]["text"])
    assert out[2]["text"] == out[3]["text"] == "" and out[4]["text"] == "plain text"
    assert site_style.main_text(df).count() == 6 and site_style.main_text(df.limit(0)).count() == 0


@pytest.mark.parametrize(("page", "text"), [
    ('<article class="post comments-open"><p>Body</p></article>', "Body"), ('<div class="content has-sidebar"><p>Body</p></div>', "Body"),
    ('<main id="search"><p>Body</p></main>', "Body"), ('<article><p>Body</p><div class="related-work"><p>More</p></div></article>', "Body\nMore"),
    ("<article><header><h1>Title</h1><p>by A. Writer</p></header><p>Body</p></article>", "Title\nBody"), ("<article><label>Note</label> body</article>", "Note body"),
    ('<div class="comments"><p>All there is</p></div>', "All there is"), ("<header><h1>Site</h1></header><article><p>Body</p></article>", "Body"),
    ('<article><p>Body</p><div class="cookie-banner">c</div><div id="site-footer">f</div><section class="reader-comments"><article class="comment">hm</article></section>'
     '<div class="ad">buy</div><div role="navigation">n</div><div class="related-posts">r</div></article>', "Body"),
    (f'<article><p>{"long words " * 30_000}</p></article>', ("long words " * 30_000).strip()),
])
def test_names_rule_out_whole_names_only(page, text):
    assert "\n".join(b[0] for b in site_style.parse(f"<html><body>{page}</body></html>")) == text


def test_style_tree_equals_a_plain_version(spark, prose):
    import math
    from collections import Counter, defaultdict

    rows = []
    for h in range(4):
        for i in range(9):
            items = "".join(f"<div class='k{j % 3}'><p>{prose(j if j < 3 else 100 * h + i + j, 5)}</p>{'<ul><li>x</li></ul>' if (i + j) % 2 else ''}</div>" for j in range(1 + (i + h) % 6))
            wrap = ("<article>{}</article>", "<body><div>Follow us</div>{}</body>")[h % 2]
            rows.append((10 * h + i, f"http://h{h}.example/{i}", wrap.format(items)))
        rows.append((1000 + h, f"http://h{h}.example/copy", rows[-1][2]))
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({c: F.lit("x") for c in ("id", "host", "blocks", "low", "text")})
    got = {r["host"]: set(r["low"]) for r in site_style.low_nodes(site_style.page_blocks(df)).collect()}
    keys = {(r["host"], tuple(r["b"])): r["k"] for r in site_style.page_blocks(df).select("host", F.explode("blocks").alias("b")).select("host", "b", site_style.leaf(F.col("b")).alias("k")).collect()}
    pages = defaultdict(set)
    for _, url, html in rows:
        pages[url.split("/")[2]].add(tuple(site_style.parse(html)))
    for host, docs in pages.items():
        m, want = len(docs), set()
        styles, texts = defaultdict(list), defaultdict(list)
        for d in docs:
            of = defaultdict(list)
            for text, branch, style, _ in d:
                if branch:
                    of[branch].append(style)
                    texts[branch, text].append(d)
            for b, st in of.items():
                styles[b].append(tuple(st))
        for b, st in styles.items():
            if len(st) >= site_style.MIN_PAGES:
                looks = -sum(c / len(st) * math.log(c / len(st), m) for c in Counter(st).values())
                logs = [math.log(len(set(d))) for (x, _), d in texts.items() if x == b]
                reads = 1 - sum(logs) / len(logs) / math.log(len(st))
                if site_style.PRESENTATION_WEIGHT * looks + (1 - site_style.PRESENTATION_WEIGHT) * reads < site_style.LOW:
                    want.add(b)
        free = [{keys[host, b] for b in d} for d in docs if any(b[3] for b in d)]
        for node, k in Counter(x for d in free for x in d).items():
            if k >= site_style.MIN_PAGES and 2 * k > len(free) and (1 - site_style.PRESENTATION_WEIGHT) * (1 - math.log(k) / math.log(len(free))) < site_style.LOW:
                want.add(node)
        assert got.get(host, set()) == want, host
    assert sum(map(len, got.values())) >= 4


def test_archives_of_repeated_pages(spark, scratch):
    rows = [(7, "u", "same"), (7, "u", "same"), (5, "v", "same"), (8, "w", None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({c: F.lit("x") for c in ("id", "payload", "file", "offset", "length", "_refers_to")})
    out = sorted((r["id"], r["record_type"], r["refers_to"]) for r in warc.archive_and_read(df, f"{scratch}/w").collect())
    assert out == [(5, "revisit", "7"), (7, "response", None), (7, "response", None), (8, "response", None)]


def test_style_tree_removes_template_branches(spark, prose):
    rows = [(i, f"http://h.example/{i}", f"<article><h1>t{i}</h1><div class='x1'><p>Stay tuned for more</p></div><div class='x2'>{'<p>' * (i % 3)}{prose(i, 20)}</div><p>{prose(99, 5)}</p></article>") for i in range(12)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    for r in site_style.main_text(df).collect():
        assert "Stay tuned" not in r["text"] and prose(r["page_id"], 20) in r["text"] and prose(99, 5) in r["text"]


def test_copies_of_a_page_are_no_template(spark, prose):
    one = f"<article id='post-12'><h1>Title</h1><div class='body'><p>{prose(7, 30)}</p></div></article>"
    rows = [(i, f"http://mirror.example/{i}", one) for i in range(6)]                      # a host of copies only
    rows += [(100 + i, f"http://h.example/copy/{i}", one) for i in range(6)]
    rows += [(200 + i, f"http://h.example/{i}", f"<article><h1>t{i}</h1><div class='x1'><p>Stay tuned for more</p></div><p>{prose(i, 20)}</p></article>") for i in range(8)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    for r in site_style.main_text(df).collect():
        assert r["text"] == (f"Title\n{prose(7, 30)}" if r["page_id"] < 200 else f"t{r['page_id'] - 200}\n{prose(r['page_id'] - 200, 20)}")


def test_unmarked_notices_among_unclassed_siblings(spark, prose):
    def page(i):
        return f"<html><body><div>Menu words here</div><div>{prose(i, 30)}</div>{'<div>Extra ' + str(i) + '</div>' if i % 2 else ''}<div>Call us now</div><p>All of it</p></body></html>"

    rows = [(i, f"http://h.example/{i}", page(i)) for i in range(12)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    for r in site_style.main_text(df).collect():
        i = r["page_id"]
        assert r["text"] == prose(i, 30) + (f"\nExtra {i}" if i % 2 else "")


# 10 -----------------------------------------------------------------------------------
def test_archives_round_trip(spark, scratch):
    rows = [(i, f"http://h.example/{i}\n" if i % 3 else None, ["", None, "é" * 70_000, "same", f"p{i}\r\n\r\nx"][i % 5]) for i in range(60)] + [(7, "u", "same"), (None, "u", "lone")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    out = warc.archive_and_read(df, f"{scratch}/w").collect()
    assert len(out) == len(rows)
    last = {}
    for i, _, h in rows:
        if i is not None:
            last[h or ""] = max(last.get(h or "", i), i)
    html = {i: h for i, _, h in rows if i != 7}
    for r in out:
        if r["id"] in html and r["id"] is not None:
            raw = (html[r["id"]] or "").encode()
            to = last[raw.decode()]
            assert r["payload_bytes"] == len(raw) and r["payload_digest"] == base64.b32encode(hashlib.sha1(raw).digest()).decode()
            assert (r["record_type"], r["refers_to"]) == (("response", None) if to == r["id"] else ("revisit", str(to)))
            assert r["payload"] == (raw if to == r["id"] else None)
    assert warc.archive_and_read(df.limit(0), f"{scratch}/e").count() == 0
    assert all(r["record_type"] == "response" for r in warc.archive_and_read(df, f"{scratch}/m", min_bytes=1 << 20).collect())


def test_ranges_are_joined():
    rows = [("a", 0, 10), ("a", 10, 5), ("a", 20, 5), ("a", 200_000, 5), ("b", 0, 7)]
    got = list(warc.joined_ranges(rows))
    assert [g[:3] for g in got] == [("a", 0, 25), ("a", 200_000, 5), ("b", 0, 7)] and got[0][3] == [0, 1, 2]


# Pipeline -----------------------------------------------------------------------------
def test_pipeline_stages_on_odd_rows(spark, odd_docs):
    docs = odd_docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == odd_docs.columns, name
        assert stage(spark, odd_docs.limit(0), SF).count() == 0, name
        docs = out
    assert corpus_pipeline.STAGES[-1][1](spark, odd_docs, SF).count() == 10


def test_pipeline_keeps_clean_and_drops_junk(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    ids = {r["doc_id"] for r in rows}
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert rows and not [i for i in ids if labels.get(i) == 0]
