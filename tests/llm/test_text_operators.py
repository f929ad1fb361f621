"""Operators on documents against plain versions."""

import hashlib
import random
import re
import struct

import numpy as np
import pytest

from ortholake.llm import bpe, cotrain, license_rules, mixing, odd_sketch, quality_rules

SF = "/root/testdata/sf0.001"
SPACE = "[^\x20\x09-\x0d]+"


# 1 ------------------------------------------------------------------------------------
def test_cotrain_separates_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    model = cotrain.train(docs, labels.filter("doc_id % 3 != 0"))
    assert sum(model.pseudo) > 0                                # both views handed labels over
    held = cotrain.score(docs, model).join(labels.filter("doc_id % 3 = 0"), "doc_id").collect()
    right = np.mean([r["kept"] == (r["quality"] == 1) for r in held])
    assert len(held) > 100 and right > 0.95


def test_cotrain_odd_rows_and_labels(spark, odd_docs):
    labels = spark.createDataFrame([(1, 1), (7, 0), (9, 1), (9, 0), (3, None)], "doc_id long, quality int")
    rows = cotrain.score(odd_docs, cotrain.train(odd_docs, labels)).collect()
    assert len(rows) == 10 and all(0 <= r["score"] <= 1 for r in rows)
    assert len({r["score"] for r in rows if r["doc_id"] == 2}) == 1
    none = cotrain.train(odd_docs, labels.limit(0))
    assert none.constant == 1.0 and cotrain.keep_documents(odd_docs, labels.limit(0)).count() == 10
    kept = cotrain.keep_documents(odd_docs, labels)
    assert kept.columns == odd_docs.columns and kept.count() <= 10
    assert cotrain.keep_documents(odd_docs.limit(0), labels).count() == 0


def test_cotrain_uses_all_unlabelled_rows(spark, prose, monkeypatch):
    clean = lambda i: i % 2 == 0
    rows = [(i, prose(i, 30) if clean(i) else "### $$ &&& " * (9 + i % 7) + prose(i, 3), "en", f"{'good' if clean(i) else 'bad'}{i % 3}", 200) for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    own = spark.createDataFrame([(i, int(clean(i))) for i in range(300)], "doc_id long, quality int")
    model = cotrain.train(docs, own)
    assert min(model.pseudo) > 3000 and max(model.pseudo) <= 3700         # no cap on what a view hands over
    assert all(r["kept"] == clean(r["doc_id"]) for r in cotrain.score(docs, model).collect())
    monkeypatch.setattr(cotrain, "MAX_LABELLED", 100)
    foreign = spark.createDataFrame([(10_000 + i, i % 2) for i in range(20_000)], "doc_id long, quality int")
    assert cotrain.train(docs, own.unionByName(foreign)).constant is None  # labels without a document take no place


# 2 ------------------------------------------------------------------------------------
def shingles(text, n):
    w = re.findall(SPACE, (text or "").translate({c: c + 32 for c in range(65, 91)}))
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} - {()}


def plain_groups(rows, n, percent):
    sets = {i: shingles(t, n) for i, t in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


@pytest.mark.parametrize(("words", "percent"), [(3, 85), (5, 80)])
def test_near_duplicates_equal_all_pairs(spark, prose, words, percent):
    r = random.Random(4)
    rows, base = [], [prose(s, 130).split() for s in range(4)]
    for i in range(160):
        w = list(base[i % 4])
        for _ in range(r.randrange(5)):
            w[r.randrange(len(w))] = f"edit{r.randrange(30)}"
        rows.append((i, " ".join(w) if i % 7 else " ".join(w).upper()))
    rows += [(500 + i, prose(100 + i, 40)) for i in range(20)] + [(600, "a b"), (601, "A  b"), (602, ""), (603, None), (604, "\n")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {x["doc_id"]: (x["n_shingles"], x["component_id"]) for x in odd_sketch.near_duplicates(df, words, percent).collect()}
    assert got == plain_groups(rows, words, percent)


def test_near_duplicates_odd_rows(spark, odd_docs):
    rows = odd_sketch.near_duplicates(odd_docs).collect()
    by = {}
    for x in rows:
        by.setdefault(x["doc_id"], []).append((x["component_id"], x["kept"]))
    assert len(rows) == 10 and by[1] == [(1, True)] and by[2] == [(1, False)] * 2 and by[4] == [(4, True)] and by[None] == [(None, True)]
    kept = odd_sketch.keep_documents(odd_docs)
    assert kept.columns == odd_docs.columns and sorted(x["doc_id"] or 0 for x in kept.collect()) == [0, 1, 3, 4, 5, 6, 7, 9]
    assert odd_sketch.near_duplicates(odd_docs.limit(0)).count() == 0


def test_odd_sketch_estimates_and_bound():
    rng = np.random.default_rng(1)
    s = odd_sketch.Sketcher(*odd_sketch.plan_bands(0.85))
    for j in (0.8, 0.9, 0.95):
        shared = rng.integers(0, 1 << 63, 2000, dtype=np.uint64)
        own = round(2000 * (1 - j) / (2 * j))
        a, b = (np.unique(np.concatenate([shared, rng.integers(0, 1 << 63, own, dtype=np.uint64)])) for _ in "ab")
        _, bits = s.bands_and_bits(np.stack([s.signature(a), s.signature(b)]))
        d = sum(bin(int(x) & (1 << 64) - 1).count("1") for x in bits[0] ^ bits[1])
        assert abs(odd_sketch.estimate(d, s.bands * s.rows) - j) < 0.1
        one_sided = sum(bin(int(x) & (1 << 64) - 1).count("1") for x in odd_sketch.parity(a) ^ odd_sketch.parity(b))
        assert one_sided <= 2 * own
    bands, rows = odd_sketch.plan_bands(0.85)
    assert (1 - 0.85 ** rows) ** bands <= odd_sketch.MISS


# 4 ------------------------------------------------------------------------------------
def plain_base(text):
    w = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    at = sorted((i, label) for p, label in license_rules.BASE.items() for i in range(len(w)) if w[i:i + len(p.split())] == p.split())
    return len(w), len(at), at[0][0] if at else None, at[-1][0] if at else None, ",".join(sorted({x for _, x in at}))


def test_license_base_places_equal_a_plain_scan(spark, odd_docs):
    r = random.Random(2)
    bits = ["GNU", "General", "public", "LICENSE", "apache", "license", "cc", "by", "cc-by", "MIT", "\n", "é", "license.", "ccby", "x", "0"]
    rows = [(i, "".join(r.choice(bits) + r.choice([" ", "-", "", " \n"]) for _ in range(r.randrange(1, 60)))) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for d, src in ((df, dict(rows)), (odd_docs.drop("kept").filter("doc_id != 2"), {x["doc_id"]: x["text"] for x in odd_docs.collect()})):
        for x in license_rules.scan_licenses(d).collect():
            assert (x["n_words"], x["n_base"], x["first_word"], x["last_word"], x["base_labels"]) == plain_base(src[x["doc_id"]])
            assert set(x["base_labels"].split(",")) <= set(x["labels"].split(",")) | {""} and 0 <= x["score"] <= 1


def test_license_rules_and_suppression():
    s = license_rules.Scanner()
    assert len(s.rules) >= 200
    assert s.scan("Licensed under CC BY-NC 4.0.")[4:6] == ("cc-by", "cc-by,cc-by-nc-4.0")
    assert s.scan("under the Apache\nLicense, Version 2.0")[5] == "apache,apache-2.0"
    assert s.scan("SPDX-License-Identifier: BSD-3-Clause")[5] == "bsd-3-clause"
    found = s.detections(b"released under the mit license.")
    assert [(r.label, r.phrasing) for _, _, r in found] == [("mit", "grant")]       # the mention inside is suppressed
    assert s.scan("the committee met")[5] == ""


@pytest.mark.parametrize(("text", "label"), [
    ("License: MIT.", "mit"), ("License: Apache-2.0.", "apache-2.0"), ("SPDX-License-Identifier: GPL-2.0+", "gpl-2.0"),
    ("SPDX-License-Identifier: LGPL-2.1-or-later", "lgpl-2.1"), ("Creative Commons Attribution-ShareAlike 4.0 International", "cc-by-sa-4.0"),
    ("Creative Commons Attribution 3.0", "cc-by-3.0"), ("Creative Commons Attribution-NonCommercial-NoDerivs 2.5", "cc-by-nc-nd-2.5"),
    ("the GNU Lesser General Public License", "lgpl"), ("the GNU Affero General Public License", "agpl"), ("Mozilla Public License", "mpl"),
    ("Eclipse Public License", "epl"), ("under the BSD License.", "bsd"), ("GNU GPL v3", "gpl-3.0"), ("Mozilla Public License 2.0", "mpl-2.0"),
    ("Permission is hereby granted, free of charge, to any person\n * obtaining a copy of this software and associated documentation files", "mit"),
    ("Redistribution and use in source and binary forms, with or without\n# modification, are permitted provided that the following conditions are met", "bsd"),
    ("This software is provided ‘as-is’, without any express or implied\nwarranty. In no event will the authors be held liable", "zlib"),
    ("This is free and unencumbered software released into the public domain.", "unlicense"),
])
def test_license_notices_and_bodies(text, label):
    assert license_rules.Scanner().scan(text)[5] == label


def test_license_near_misses():
    s = license_rules.Scanner()
    for text in ("License: MIT-like", "License: MIT.txt", "SPDX-License-Identifier: Apache-2.0+x", "permission is hereby granted", "creative commons attribution"):
        assert s.scan(text)[5] == "", text
    for r, _ in s.rules:             # keywords are literal text
        assert re.fullmatch("[a-z0-9.,:/_+-]+", r.keyword), r


@pytest.mark.parametrize(("text", "labels"), [
    ("SPDX-License-Identifier: (MIT OR Apache-2.0)", "apache-2.0,mit"), ("SPDX-License-Identifier: MIT AND (ISC OR Zlib)", "isc,mit,zlib"),
    ("SPDX-License-Identifier:\tGPL-2.0-only WITH Classpath-exception-2.0", "gpl-2.0"), ("Dual licence, Apache-2.0 OR MIT", "apache-2.0,mit"),
    ("EUPL v1.2", "eupl-1.2"), ("Microsoft Public License", "ms-pl"), ("it is in the public domain", "public-domain"),
    ("it is not in the public domain", ""), ("never into the\npublic domain", ""), ("commit or permit, zlib and isc", ""), ("", ""),
    ("// Licensed under the Apache Licence.\n// Unless required by applicable law or agreed to in writing, software\n// distributed under the License is distributed on an “AS IS” BASIS", "apache-2.0"),
    ("under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License", "agpl-3.0"),
    ("Neither the name of Google Inc. nor the names of its\n * contributors may be used to endorse or promote products derived from this software", "bsd-3-clause"),
    ("Altered source versions must be plainly marked as such", "zlib"), ("the Software shall be used for Good, not Evil", "json"),
    ("Unauthorized copying of this file, via any medium is strictly prohibited", "proprietary"),
])
def test_license_expressions_notices_and_negation(text, labels):
    assert license_rules.Scanner().scan(text)[5] == labels


def plain_detections(scanner, low):
    """Every rule without the keyword gate; one detection after another against all accepted ones."""
    found = [d for i in range(len(scanner.rules)) for d in scanner.matches(i, low)]
    kept = []
    for d in sorted(found, key=lambda d: (-d[2].priority, d[0] - d[1], d[0], d[2].label, d[2].phrasing)):
        if all(d[1] <= k[0] or k[1] <= d[0] for k in kept):
            kept.append(d)
    return sorted(kept, key=lambda d: d[0])


def test_license_rules_equal_a_plain_version_without_gate(spark, odd_docs):
    """Texts out of the rules' own words, and the given documents: detections, labels and score."""
    s, r = license_rules.Scanner(), random.Random(4)
    words = sorted({w for rule, _ in s.rules for w in re.findall("[a-z0-9.-]{2,}", rule.keyword)}) + ["or", "and", "under the", "license", "license:", "gnu", "public",
             "cc", "by", "mit", "4.0", "apache", "version", "2.0", "\n", "spdx-license-identifier:", "general", "subject to", "(mit or", "https://", "é"]
    ids = [i for v in license_rules.LICENSES.values() for i in v[1]]
    names = [n.replace("(?:version |v)?", "v") for v in license_rules.LICENSES.values() for n in v[0] if "\\" not in n]
    texts = [" ".join(r.choice(r.choice([words, ids, names, words])) for _ in range(r.randrange(1, 40))) for _ in range(120)]
    texts += [x["text"] or "" for x in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()][:80]
    hits = 0
    for text in texts:
        low = text.encode().lower()
        want = plain_detections(s, low)
        assert s.detections(low) == want
        spans = [m.span() for p, *_ in s.base for m in p.finditer(low)]
        miss = 1.0
        for lo, hi, rule in want:
            miss *= 1 - max([rule.confidence] + [0.9 for a, b in spans if lo <= a and b <= hi])
        for a, b in spans:
            miss *= 1 if any(lo <= a and b <= hi for lo, hi, _ in want) else 0.1
        got = s.scan(text)
        assert got[5] == ",".join(sorted({x.label for *_, x in want} | {label for p, *_, label in s.base if p.search(low)}))
        assert abs(got[6] - (1 - miss)) < 1e-5
        hits += len(want)
    assert hits > 100


# 6 ------------------------------------------------------------------------------------
def plain_measures(text):
    text = text or ""
    w = re.findall(SPACE, text)
    windows = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
    count = {}
    for x in windows:
        count[x] = count.get(x, 0) + 1
    cover = {i + k for i, x in enumerate(windows) if count[x] > 1 for k in range(8)}
    lines = [x for x in text.split("\n") if re.search(SPACE, x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(cover),
            len(w) < 20 or 100 * len(cover) > 30 * len(w))


def test_quality_measures_equal_a_plain_version(spark, odd_docs):
    r = random.Random(3)
    texts = [" ".join(r.choice("abcd#") for _ in range(r.randrange(0, 80))).replace("d a", r.choice(["d\na", "\t", "\x0b", "é "])) for _ in range(300)]
    df = spark.createDataFrame([(i, t, "en", f"s{i % 5}", 1) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    for d in (df, odd_docs.filter("doc_id != 2 or doc_id is null")):
        src = {x["doc_id"]: x["text"] for x in d.collect()}
        rows = quality_rules.judge(d).collect()
        assert len(rows) == len(src)
        for x in rows:
            got = tuple(x[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"))
            assert got == plain_measures(src[x["doc_id"]]), x["doc_id"]
            assert not (x["base_failed"] and x["kept"])
    kept = quality_rules.keep_documents(odd_docs)
    assert kept.columns == odd_docs.columns
    want = sorted(x["doc_id"] or 0 for x in quality_rules.judge(odd_docs).filter("kept").collect())
    assert sorted(x["doc_id"] or 0 for x in kept.collect()) == want
    assert quality_rules.keep_documents(odd_docs.limit(0)).count() == 0


def test_hosts_shrink_and_spare_clean_documents(spark, prose):
    bad, soft, good = "spam " * 40, prose(1, 30) + " ### $$$ %%% &&& ***" * 20, prose(2, 40)
    rows = [(i, bad + str(i), "h1") for i in range(60)] + [(100, soft, "h1"), (101, good, "h1"), (200, soft, "h2")]
    rows += [(300 + i, prose(i, 40), f"g{i % 6}") for i in range(120)] + [(500, bad, "tiny")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = {x["doc_id"]: x for x in quality_rules.judge(df).collect()}
    assert not out[0]["kept"] and not out[100]["kept"] and out[101]["kept"]     # a distrusted host loses its soft failures only
    assert out[300]["kept"] and out[500]["host_rate"] < out[0]["host_rate"]     # one document alone is shrunk towards the corpus


def test_host_limit_follows_the_corpus(spark, prose):
    bad, good, symbols = "spam " * 40, prose(2, 40), prose(1, 30) + " ### $$$ %%% &&& ***" * 20
    twice = " ".join([prose(5, 10)] * 2 + [prose(6, 100)])                       # fails 'repeats' only
    rows = [(i, bad if i % 10 < 4 else good, "hot") for i in range(200)] + [(200, twice, "hot"), (201, symbols, "g0"), (202, twice, "g0")]
    rows += [(300 + i, bad if i % 20 == 0 else prose(i, 40), f"g{i // 40}") for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = {x["doc_id"]: x for x in quality_rules.judge(df).collect()}
    assert out[200]["host_rate"] < quality_rules.HOST_LIMIT and not out[200]["kept"]       # a third of the rows, 40 % of them junk
    assert out[202]["kept"] and not out[201]["kept"] and out[4]["kept"]                    # symbols count on any host, repeats do not
    assert {x["doc_id"] for x in quality_rules.keep_documents(df).select("doc_id").collect()} == {i for i, x in out.items() if x["kept"]}
    even = df.filter("source != 'hot' and doc_id != 201")
    hosts = quality_rules.host_verdicts(quality_rules.measure(even, "text", ["source"]).withColumn("soft_failed", quality_rules.soft_failed()), "source")
    assert hosts.filter("distrusted").count() == 0                                         # hosts that differ by chance only


# 7 ------------------------------------------------------------------------------------
def test_bpe_equals_tiktoken_and_round_trips(spark, odd_docs):
    import public_tokenizers
    import tiktoken

    tokens, pattern = bpe.vocabulary()
    ref = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks={t: i for i, t in enumerate(tokens)}, special_tokens={})
    r = random.Random(5)
    bits = ["a", "B", " ", "  ", "\n", " \n", "'s", "é", "漢", "😀", "12", "!", "▁", "\xa0", "\x1c", "the", " ing", "\t", "\r\n", "<|endoftext|>"]
    rows = [(i, "".join(r.choice(bits) for _ in range(r.randrange(40)))) for i in range(1500)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for d in (df, odd_docs.filter("doc_id != 2")):
        src = {x["doc_id"]: x["text"] or "" for x in d.collect()}
        for x in bpe.digest(d, tokens, pattern).collect():
            ids = ref.encode_ordinary(src[x["doc_id"]])
            assert x["n_tokens"] == len(ids)
            assert x["ids_sha256"] == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
            assert x["decoded_sha256"] == hashlib.sha256(src[x["doc_id"]].encode()).hexdigest()
    assert bpe.digest(odd_docs, tokens, pattern).count() == 10


# 9 ------------------------------------------------------------------------------------
def fill(budget, children):
    """Water-filling by repetition: children {name: (capacity, weight)} -> {name: share}."""
    share, open_ = {}, dict(children)
    while open_:
        level = budget / sum(w for _, w in open_.values())
        full = {k: c for k, (c, w) in open_.items() if c < level * w}
        if not full:
            return share | {k: level * w for k, (_, w) in open_.items()}
        share |= full
        budget -= sum(full.values())
        open_ = {k: v for k, v in open_.items() if k not in full}
    return share


def test_budgets_equal_repeated_filling(spark):
    r = random.Random(6)
    leaves = [(f"d{r.randrange(3)}", f"l{j % 4}", f"s{j}", r.randrange(1, 500)) for j in range(40)]
    weights = {"domain": {"d0": 5.0, "d1": 1.0}, "language": {"l0": 3.0}, "source": {"s3": 9.0}}
    df = spark.createDataFrame(leaves, "domain string, language string, source string, tokens long")
    got = {(x["domain"], x["language"], x["source"]): x["budget"] for x in mixing.leaf_budgets(df, mixing.LEVELS, weights, 1.5, 2).collect()}
    cap = lambda p: 2.0 * sum(x[3] for x in leaves if x[:len(p)] == p)
    want, todo = {}, {(): float(int(1.5 * sum(x[3] for x in leaves)))}
    for k, level in enumerate(mixing.LEVELS):
        below = {}
        for p, b in todo.items():
            kids = {x[:k + 1] for x in leaves if x[:k] == p}
            below |= fill(b, {c: (cap(c), weights[level].get(c[-1], 1.0)) for c in kids})
        todo = below
    want = todo
    assert set(got) == set(want) and all(abs(got[k] - want[k]) <= 1 for k in got)
    assert abs(sum(got.values()) - int(1.5 * sum(x[3] for x in leaves))) <= len(got)


def test_mixture_odd_rows(spark, odd_docs):
    out = mixing.select_mixture(odd_docs, mixing.tree())
    assert out.columns == [*odd_docs.columns, "epoch"] and out.count() > 0
    again = mixing.select_mixture(odd_docs, mixing.tree())
    assert sorted(map(repr, out.collect())) == sorted(map(repr, again.collect()))
    assert mixing.select_mixture(odd_docs.limit(0), mixing.tree()).count() == 0
