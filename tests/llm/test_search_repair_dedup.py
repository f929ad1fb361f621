"""Ranked search, conversation repair and exact duplicates against plain versions."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ortholake.llm import lexical_search, quotient_filter, turn_repair

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


# 11 -----------------------------------------------------------------------------------
def plain_terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain_search(docs, items, k=20):
    held = [(i, Counter(plain_terms(t))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    n, total = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in set(items):
        query, scores = Counter(plain_terms(text)), []
        for i, c in held:
            m = 75 + (25 * sum(c.values()) * n) // total
            s = sum(times * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 12 * m))
                    for t, times in query.items() if t in c)
            if s > 0:
                scores.append((-s, i is None, i or 0, i))
        out += [(item, r, x[3], -x[0]) for r, x in enumerate(sorted(scores)[:k], 1)]
    return sorted(map(repr, out))


def random_text(r, n):
    # a few words that nearly every text holds, and many rare ones
    return " ".join(r.choice(["the", "of", "a"]) if r.random() < 0.5 else f"w{int(r.paretovariate(0.6)) % 3000}" for _ in range(n))


def test_terms_follow_the_pattern():
    for t in ("A-b_c d9É漢 x[y]z{w}~`@", "", "é É\x7fA", " a b", "x" * 100_000):
        assert [x.decode() for x in lexical_search.terms(t)] == plain_terms(t)


@pytest.mark.parametrize(("postings", "block", "share"), [(1 << 21, 128, 16), (3000, 8, 16), (500, 2, 2), (5000, 16, 10**6)])
def test_search_equals_a_plain_version(spark, monkeypatch, postings, block, share):
    r = random.Random(11)
    docs = [(i, random_text(r, r.randrange(1, 120))) for i in range(900)]
    docs += [(2000, None), (2001, ""), (2002, "-- !"), (None, docs[5][1]), (5, docs[5][1]), (2003, random_text(r, 20_000)), (2004, "The THE the")]
    docs += [(3000 + i, "tie word here") for i in range(60)]                     # more equal scores than ranks
    items = [(i, random_text(r, r.randrange(1, 40))) for i in range(25)] + [(100, "tie"), (100, "tie"), (101, None), (102, "nowhere"), (103, "the the of a"), (104, "w1 w1 w2"), (104, "tie of")]
    for name, value in (("SHARD_POSTINGS", postings), ("BLOCK", block), ("SHORT_SHARE", share)):
        monkeypatch.setattr(lexical_search, name, value)
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumns({c: F.lit("x") for c in ("id", "n", "terms", "query", "score", "rank")}).repartition(3)
    q = spark.createDataFrame(items, "item_id long, text string").withColumn("key", F.lit(1))
    rows = lexical_search.ranked_search(d, q, query_bytes=300).collect()
    assert sorted(map(repr, map(tuple, rows))) == plain_search(docs, items)
    if postings == 3000:
        assert lexical_search.ranked_search(d.limit(0), q).count() == 0 and lexical_search.ranked_search(d, q.limit(0)).count() == 0


def test_blocks_are_skipped_and_scores_stay():
    rng = np.random.default_rng(4)
    size, lists = 20_000, {t: np.sort(rng.choice(20_000, n, replace=False)) for t, n in enumerate((12_000, 9_000, 4_000, 300, 60, 25))}
    owner = np.concatenate(list(lists.values()))
    term = np.concatenate([np.full(len(p), t) for t, p in lists.items()])
    gain = rng.integers(1, 30, len(owner)) * np.array([1, 2, 5, 40, 90, 120])[term]
    shard, stats = lexical_search.Shard(size, owner, term, gain), Counter()
    total = np.zeros(size, np.int64)
    for t in lists:
        total[shard.postings(t)[0]] += shard.postings(t)[1] * (1 + t % 2)
    place, score = lexical_search.search_shard(shard, {t: 1 + t % 2 for t in lists}, 20, 0, stats)
    last = np.sort(total)[-20]
    assert sorted(place) == list(np.flatnonzero(total >= last)) and (total[place] == score).all()
    assert stats["skipped"] > 0.5 * stats["blocks"] and stats["looked_up"] < 0.2 * size


# 12 -----------------------------------------------------------------------------------
SPACES = " \t\n\x0b\x0c\r"


def plain_repair(codes):
    """Cheapest (cost, audit) by trying all edits in order of cost."""
    import heapq

    queue, seen = [(0, "", 0, 0)], {}
    best = None
    while queue:
        cost, audit, i, state = heapq.heappop(queue)
        if best is not None and cost > best[0]:
            break
        if i == len(codes) and state in (0, 3):
            best = best or (cost, audit)          # equal costs leave the queue in order of their audits
            continue
        if seen.get((i, state), (cost, audit)) < (cost, audit):
            continue
        seen[(i, state)] = (cost, audit)
        nxt = {0: 2, 1: 2, 2: 3, 3: 2}[state]
        if len(audit) < 3 * len(codes) + 4:
            heapq.heappush(queue, (cost + 2, audit + "I", i, nxt))
        if i < len(codes):
            heapq.heappush(queue, (cost + 3, audit + "D", i + 1, state))
            initial, must_go, cut = codes[i]
            if not must_go:
                heapq.heappush(queue, (cost + 2 + cut, audit + "R", i + 1, nxt))
                to = {"s": 1, "u": 2, "a": 3}.get(initial)
                if to == nxt or (to == 1 and state == 0):
                    heapq.heappush(queue, (cost + cut, audit + "K", i + 1, to))
    return best


def test_repair_equals_all_edits():
    kinds = [(c, g, t) for c in "suax" for g, t in ((0, 0), (1, 0), (0, 1))]
    for n in range(3):
        for rows in itertools.product(kinds, repeat=n):
            assert turn_repair.repair(bytes(turn_repair.code(*x) for x in rows)) == plain_repair(rows), rows
    r = random.Random(12)
    for _ in range(400):
        rows = [r.choice(kinds) for _ in range(r.randrange(3, 12))]
        assert turn_repair.repair(bytes(turn_repair.code(*x) for x in rows)) == plain_repair(rows), rows


def test_long_repairs_keep_few_vectors():
    rows = bytes([0] + [1, 2] * 50_000 + [1, 1, 2])
    assert turn_repair.repair(rows) == (2, "K" * 100_002 + "IKK")


def plain_conversations(turns):
    out = []
    for conv in {x[0] for x in turns}:
        rows = []
        for c, turn, role, text in turns:
            if c != conv:
                continue
            key = f"{' ' if c is None else c}:{' ' if turn is None else turn}"
            role, text, h = " " if role is None else role, " " if text is None else text, zlib.crc32(key.encode()) % 20
            if h == 0:
                continue
            text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
            rows += [(turn is not None, turn or 0, "user" if h == 4 else role, text, turn)] * (2 if h == 3 else 1)
        rows.sort(key=lambda x: (*x[:3], hashlib.md5(x[3].encode()).hexdigest()))
        seen, codes, count = set(), [], Counter()
        for x in rows:
            solid = x[3].strip(SPACES)
            fault = "blank" if not solid else "duplicate" if x[2:4] in seen else "truncated" if solid[-1] not in ".!?" else ""
            seen.add(x[2:4])
            count[fault] += 1
            codes.append((x[2][:1], fault in ("blank", "duplicate"), fault == "truncated"))
        numbers = [x[4] for x in rows if x[4] is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(codes, codes[1:], strict=False))
        cost, audit = plain_repair(codes)
        lines, state, i = [], 0, 0
        for e in audit:
            to = {0: 2, 1: 2, 2: 3, 3: 2}[state]
            if e == "I":
                lines.append(("user:", "assistant:")[to - 2])
                state = to
                continue
            if e == "K":
                state = {"s": 1, "u": 2, "a": 3}[codes[i][0]]
                lines.append(f"{rows[i][2]}:{rows[i][3]}")
            elif e == "R":
                state = to
                lines.append(("user", "assistant")[to - 2] + ":" + rows[i][3])
            i += 1
        out.append((conv, gaps, count["blank"], count["duplicate"], count["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(map(repr, out))


def test_conversations_equal_a_plain_version(spark):
    r = random.Random(13)
    texts = ["Yes.", "No!", "and so", "é?", " \n", "", "Why? ", "fine", None, "ok."]
    turns = [(c if c else None, r.choice([t, t, t, r.randrange(9), None]), r.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None]), r.choice(texts))
             for c in range(120) for t in range(r.randrange(1, 9))]
    turns += [(500, t, ("user", "assistant")[t % 2], f"turn {t}" + "." * (t % 3)) for t in range(700)] + [(501, 0, "user", "x " * 50_000)]
    turns += [(502, 3, "user", "same.")] * 5
    lost = next(c for c in range(1000, 9999) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    turns += [(lost, 0, "user", "gone.")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").withColumns({c: F.lit(1) for c in ("conv", "h", "uid", "tie", "kind", "code", "first")})
    rows = turn_repair.repair_rows(turn_repair.damaged(df.repartition(5)), df.select(F.col("conv_id").alias("conv")).distinct()).collect()
    short = [t for t in turns if t[0] != 500]
    assert sorted(repr(tuple(x)) for x in rows if x["conv"] != 500) == plain_conversations(short)
    long_ = [x for x in rows if x["conv"] == 500]
    assert len(long_) == 1 and set(long_[0]["audit"]) <= set("KDIR") and long_[0]["cost"] > 0
    gone = [x for x in rows if x["conv"] == lost]
    assert gone[0]["audit"] == "" and gone[0]["repaired_sha256"] == hashlib.sha256(b"").hexdigest()
    assert turn_repair.repair_conversations(df.limit(0)).count() == 0


# 13 -----------------------------------------------------------------------------------
def test_filters_merge_without_loss():
    rng = np.random.default_rng(5)
    values = rng.integers(0, 1 << 63, 4000, dtype=np.uint64) * np.uint64(2) + rng.integers(0, 2, 4000, dtype=np.uint64)
    values = np.concatenate([values, values[:500], np.full(900, values[7]), [np.uint64(0), np.uint64((1 << 64) - 1)]])
    parts = [quotient_filter.QuotientFilter.of(13, p) for p in np.array_split(rng.permutation(values), 7)]
    whole = parts[0].merged(*parts[1:])
    want = Counter(values.tolist())
    assert dict(zip(whole.fingerprints().tolist(), whole.count.tolist(), strict=True)) == want
    again = quotient_filter.QuotientFilter.from_bytes(whole.to_bytes())
    assert (again.fingerprints() == whole.fingerprints()).all() and (again.count == whole.count).all()
    cut = list(whole.blocks(4))
    assert len(cut) == 16 and [b for b, _ in cut] == list(range(16))
    back = [quotient_filter.QuotientFilter.from_bytes(f.to_bytes()) for _, f in cut]
    assert dict(zip(back[0].merged(*back[1:]).fingerprints().tolist(), back[0].merged(*back[1:]).count.tolist(), strict=True)) == want
    assert dict(zip(*(x.tolist() for x in whole.above(1)), strict=True)) == {k: n for k, n in want.items() if n > 1}
    assert len(quotient_filter.QuotientFilter.from_bytes(quotient_filter.QuotientFilter.of(8, values[:0]).to_bytes()).count) == 0


def test_exact_duplicates_equal_a_plain_version(spark, prose, monkeypatch):
    r = random.Random(14)
    base = [prose(i, r.randrange(1, 30)) for i in range(60)] + ["", None, " ", "\n\t", " a", "a", "a ", "A", " ", "x" * 300_000]
    rows = [(i if i % 50 else None, t and r.choice([" ", "  ", "\n"]).join(t.split(" "))) for i in range(1500) for t in [r.choice(base)]]
    rows += [(7, "twice"), (7, "twice"), (8, "twice"), (None, "nobody"), (None, "nobody")]
    norm = lambda t: re.sub("[\x20\x09-\x0d]+", " ", t or "")
    ids = {}
    for i, t in rows:
        ids.setdefault(norm(t), []).append(i)
    low = {t: min((i for i in v if i is not None), default=None) for t, v in ids.items()}
    want = sorted(repr((i, low[norm(t)], len(ids[norm(t)]), i == low[norm(t)], hashlib.sha256(norm(t).encode()).hexdigest())) for i, t in rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("x") for c in ("id", "fp", "sha", "keep", "n", "block", "kept", "row", "_key", "k")})
    df = df.repartition(6)
    assert sorted(repr(tuple(x)) for x in quotient_filter.exact_duplicates(df).collect()) == want
    for name, value in (("BLOCK_ROWS", 64), ("FILTER_ROWS", 100)):
        monkeypatch.setattr(quotient_filter, name, value)
    assert sorted(repr(tuple(x)) for x in quotient_filter.exact_duplicates(df).collect()) == want
    left = quotient_filter.distinct_documents(df)
    assert left.columns == df.columns and sorted((norm(x["text"]), x["doc_id"] or -1) for x in left.collect()) == sorted((t, i or -1) for t, i in low.items())
    assert quotient_filter.exact_duplicates(df.limit(0)).count() == 0


def test_equal_fingerprints_of_other_texts_are_told_apart(spark, monkeypatch):
    monkeypatch.setattr(quotient_filter.F, "xxhash64", lambda c: F.lit(42).cast("long"))
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a")], "doc_id long, text string")
    got = {x["doc_id"]: (x["keep_id"], x["group_size"], x["kept"]) for x in quotient_filter.exact_duplicates(df).collect()}
    assert got == {1: (1, 2, True), 2: (2, 1, True), 3: (1, 2, False)}
