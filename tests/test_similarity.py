"""Clustering with verified identity, the kept index, depths by minimizers and strand-neutral k-mers."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ortholake.operators import kmer_depth, strands
from ortholake.operators import seqsets as ss
from ortholake.operators.cluster_index import ClusterIndex
from ortholake.sinks.manifest import VersionedTables


def shingles(text, n=3):
    w = text.lower().split()
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)}


def plain_links(rows, percent=80):
    sets = {i: shingles(t) for i, t in rows}
    ids = sorted(sets)
    out = {i: set() for i in ids}
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                out[a].add(b)
                out[b].add(a)
    return out


def plain_clusters(rows, percent=80):
    links, text, seen, out = plain_links(rows, percent), dict(rows), set(), {}
    for i in sorted(text):
        if i in seen:
            continue
        group, todo = set(), [i]
        while todo:
            x = todo.pop()
            if x not in group:
                group.add(x)
                todo += links[x]
        seen |= group
        best = min(group, key=lambda x: (-len(text[x]), x))
        out |= {x: best for x in group}
    return out


def prose(r, n, names="abcdefgh"):
    return " ".join(r.choice(names) + str(r.randrange(400)) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    """Groups of near copies, a part that many texts share, chains, short and empty texts."""
    r = random.Random(21)
    rows, common = [], prose(r, 40)
    for g in range(5):
        base = prose(r, 90).split()
        for _ in range(30):
            w = list(base)
            for _ in range(r.randrange(6)):
                w[r.randrange(90)] = f"edit{r.randrange(50)}"
            rows.append(" ".join(w))
    rows += [f"{common} {prose(r, 33)}" for _ in range(60)]            # similarity of about 0.38 to each other
    chain = prose(r, 60).split()
    for k in range(8):                                                # each one near the next only
        rows.append(" ".join(chain))
        chain = chain[4:] + prose(r, 4).split()
    rows += [rows[0], rows[0].upper(), "a b", "a b", "", "one two three", "one two three"]
    return list(enumerate(rows))


def test_clusters_equal_all_pairs(spark, texts):
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: r["representative"] for r in ss.cluster_sequences(df).collect()}
    assert got == plain_clusters(texts)
    assert len(set(got.values())) > 60 and ss.cluster_sequences(df.limit(0)).count() == 0


def test_index_takes_batches_and_reads_new_texts_only(spark, scratch, texts, monkeypatch):
    cut = [texts[:60], texts[60:140], texts[140:]]
    frames = []
    for i, rows in enumerate(cut):
        spark.createDataFrame(rows, "id long, text string").write.parquet(f"{scratch}/batch{i}")
        frames.append(spark.read.parquet(f"{scratch}/batch{i}"))
    want = plain_clusters(cut[0])
    index = ClusterIndex(spark, f"{scratch}/index")
    index.start(ss.cluster_sequences(frames[0].withColumnRenamed("id", "doc_id")).withColumnRenamed("doc_id", "id").join(frames[0], "id"))
    for i in (1, 2):
        reps = {x for x in want.values()}
        links = plain_links([x for x in texts if x[0] in reps] + cut[i])
        old = {x: min(links[x] & reps) for x, _ in cut[i] if links[x] & reps}
        want |= old | plain_clusters([x for x in cut[i] if x[0] not in old])
        read = []
        with monkeypatch.context() as m:
            commit = VersionedTables.commit

            def watched(self, changes, tag=None):
                for c in changes.values():
                    read.extend((c.rows if hasattr(c, "rows") else c).inputFiles())
                return commit(self, changes, tag)

            m.setattr(VersionedTables, "commit", watched)
            assert index.add(frames[i], f"b{i}")
        assert not [f for f in read if "/batch" in f and f"/batch{i}" not in f]
        assert not index.add(frames[i], f"b{i}")                      # a replay
        assert {r["id"]: r["representative"] for r in index.members().collect()} == want
    before = sorted(index.members().collect())
    assert index.reorder("order") and not index.reorder("order")
    again = spark.createDataFrame([(1000 + i, t) for i, t in cut[1][:5]], "id long, text string")
    index.add(again, "more")
    got = {r["id"]: r["representative"] for r in index.members().collect()}
    assert sorted(index.members().filter("id < 1000").collect()) == before
    links = plain_links([x for x in texts if x[0] in set(want.values())] + [(1000 + i, t) for i, t in cut[1][:5]])
    near = {1000 + i: links[1000 + i] & set(want.values()) for i, _ in cut[1][:5]}
    assert any(near.values()) and all(got[i] == min(x) if x else got[i] >= 1000 for i, x in near.items())


def plain_depths(reads, n, cut):
    count = Counter(g for t in reads.values() for g in cut(t, n))
    out = {}
    for i, t in reads.items():
        c = sorted(count[g] for g in cut(t, n))
        if c:
            out[i] = c[(len(c) - 1) // 2]
    return out


PAIR = str.maketrans("ACGT", "TGCA")
CUTS = {"word": lambda t, n: [tuple(w[i:i + n]) for w in [t.lower().split()] for i in range(len(w) - n + 1)],
        "char": lambda t, n: [t.upper()[i:i + n] for i in range(len(t) - n + 1)],
        "dna": lambda t, n: [min(g, g.translate(PAIR)[::-1]) for i in range(len(t) - n + 1) for g in [t[i:i + n]]]}


@pytest.mark.parametrize(("unit", "n", "hot"), [("word", 3, 1 << 18), ("word", 1, 20), ("char", 12, 50), ("dna", 13, 1 << 18), ("dna", 9, 30), ("dna", 21, 0)])
def test_depths_equal_a_plain_count(spark, monkeypatch, unit, n, hot):
    r = random.Random(n)
    if unit == "word":
        reads = [" ".join(r.choice(["x", "y1", "ZZ", "word", "longer-word9"]).replace("-", "") for _ in range(r.randrange(0, 30))) for _ in range(150)]
    else:
        genome = "".join(r.choice("ACGT") for _ in range(400)) + "A" * 60
        reads = [genome[a:a + r.randrange(1, 70)] for a in (r.randrange(430) for _ in range(150))]
        reads = [t.translate(PAIR)[::-1] if unit == "dna" and r.random() < 0.5 else t for t in reads] + ["ACGN" * 9, "acgt" if unit == "char" else "ACGT"]
    rows = {i: t for i, t in enumerate(reads + ["", ""])}
    df = spark.createDataFrame(list(rows.items()), "doc_id long, text string").repartition(3)
    monkeypatch.setattr(kmer_depth, "HOT", hot)
    got = {x["read"]: x["depth"] for x in kmer_depth.depths(df, "doc_id", "text", n, unit).collect()}
    assert got == plain_depths(rows, n, CUTS[unit])


def test_minimizers_are_shared_by_strands_and_neighbours():
    r = random.Random(3)
    seq = "".join(r.choice("ACGT") for _ in range(500))
    own, other = kmer_depth.minimizers(seq, 25, True), kmer_depth.minimizers(kmer_depth.complement(seq), 25, True)
    assert (own == other[::-1]).all()
    stretches = list(kmer_depth.runs(seq, 25, True))
    assert sum(n for _, n, _ in stretches) == 476 and len(stretches) < 120
    assert "".join(s[:n] for _, n, s in stretches) == seq[:476]


def test_packed_kmers_and_their_filter(spark):
    r = random.Random(4)
    for k in (1, 5, 31):
        seq = "".join(r.choice("ACGTacgtN" if k == 5 else "ACGT") for _ in range(300))
        want = {min(g, g.translate(PAIR)[::-1]) for i in range(300 - k + 1) for g in [seq.upper()[i:i + k]] if set(g) <= set("ACGT")}
        number = {int("".join("0123"["ACGT".index(c)] for c in g), 4) for g in want}
        assert strands.canonical_kmers(f" {seq[:100]}\n{seq[100:]}", k).tolist() == sorted(number)
    kmers = spark.range(5000).select((F.col("id") * 7919 * 104729 + 1).alias("kmer"))
    f = strands.KmerFilter(kmers)
    inside = np.array([x["kmer"] for x in kmers.collect()])
    assert f(inside).all() and f(inside + 1).mean() < 0.02


def test_reads_of_either_strand_are_screened(spark):
    r = random.Random(5)
    ref = "".join(r.choice("ACGT") for _ in range(200))
    own = "".join(r.choice("ACGT") for _ in range(200))
    part = ref[20:90]
    reads = [(1, own[:50] + part), (2, own[:50] + part.translate(PAIR)[::-1]), (3, own), (4, ""), (5, None), (6, part[::-1]), (7, part[:30])]
    # one k-mer that every read and reference holds
    reads += [(100 + i, "A" * 31 + own[i:i + 60]) for i in range(50)]
    df = spark.createDataFrame(reads, "doc_id long, text string")
    refs = spark.createDataFrame([(9, ref), (10, "A" * 40)], "item_id long, text string")
    got = {(x["doc_id"], x["item_id"]): x["shared"] for x in ss.contaminant_pairs(df, refs, n=31, unit="dna").collect()}
    assert got == {(1, 9): 40, (2, 9): 40} | {(100 + i, 10): 1 for i in range(50)}
    clean = ss.contaminant_screen(df, refs, n=31, unit="dna")
    assert sorted(x["doc_id"] for x in clean.collect()) == [3, 4, 5, 6, 7]


@pytest.mark.parametrize("hot", [0, 3, 60, 10_000])
def test_search_equals_a_plain_ranking(spark, hot):
    """A gram in every target, queries of hot grams only, ties, targets that only hot grams reach."""
    r = random.Random(6)
    word = lambda: f"w{int(r.paretovariate(0.7)) % 60}"
    targets = [(i, "same old words " + " ".join(word() for _ in range(r.randrange(0, 60)))) for i in range(150)]
    queries = [(i, " ".join(word() for _ in range(r.randrange(1, 25)))) for i in range(20)] + [(50, "same old words"), (51, ""), (52, "no such thing here")]
    queries += [(60 + i, "same old words " + targets[i][1][15:120]) for i in range(10)]
    want, sets = [], {i: shingles(t, 2) for i, t in targets}
    for q, text in queries:
        own = shingles(text, 2)
        found = sorted((-len(own & x), i) for i, x in sets.items() if own & x)[:5]
        want += [(q, i, -c, n, 100.0 * -c / len(own), -c / len(own | sets[i])) for n, (c, i) in enumerate(found, 1)]
    df = ss.homology_search(spark.createDataFrame(queries, "query long, text string"), spark.createDataFrame(targets, "target long, text string").repartition(4),
                            n=2, hot=hot, target_text=False)
    got = [(x["query"], x["target"], x["shared_kmers"], x["rank"], x["pident"], x["jaccard"]) for x in df.collect()]
    assert sorted(got) == [tuple(pytest.approx(v) if isinstance(v, float) else v for v in w) for w in sorted(want)]
