"""SimHash, sharding and quality rules against plain Python."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from attestra.llm import components as cc
from attestra.llm import simhash
from attestra.llm.quality import COUNTS, SYMBOLS, Rules, judge, keep_good, measures
from attestra.llm.sharding import LOWEST, shard


def signed(value):
    return value - (1 << 64) if value >> 63 else value


def plain_fingerprint(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in "".join(" " if c in " \t\n\v\f\r" else c for c in lowered).split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(nodes, linked):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a in nodes:
        for b in nodes:
            if a < b and linked(a, b):
                parent[find(a)] = find(b)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("name", ["awkward", "sample"])
def test_near_duplicates(name, request):
    docs = request.getfixturevalue(name)
    rows = [(r.doc_id, plain_fingerprint(r.text)) for r in docs.select("doc_id", "text").collect() if len(r.text or "") < 20_000]
    small = docs.where("text is null or length(text) < 20000")
    root = roots({f for _, f in rows}, lambda a, b: (a ^ b).bit_count() <= 2)
    least = defaultdict(list)
    for d, f in rows:
        least[root[f]] += [d] if d is not None else []
    want = Counter((d, signed(f), min(least[root[f]], default=None)) for d, f in rows)
    assert Counter((r.doc_id, r.fp, r.component_id) for r in simhash.near_duplicates(small).collect()) == want


def test_links_are_those_of_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 7)
    rng = random.Random(3)
    seeds = [rng.getrandbits(64) for _ in range(12)] + [0, 1, (1 << 64) - 1]
    fps = {s ^ sum({1 << rng.randrange(64) for _ in range(rng.randint(0, 2))}) for s in seeds for _ in range(25)}
    distinct = spark.createDataFrame([(signed(f),) for f in fps], "fp long")
    found = cc.components(simhash.near_links(distinct, 2)).collect()
    got = {r.node: r.root for r in found}
    want = roots({signed(f) for f in fps}, lambda a, b: ((a ^ b) & ((1 << 64) - 1)).bit_count() <= 2)
    groups = lambda m: {frozenset(k for k in m if m[k] == v) for v in m.values()}
    assert {g for g in groups(got) if len(g) > 1} == {g for g in groups(want) if len(g) > 1}


def test_dense_blocks_give_a_forest():
    a = np.array([k for k in range(1 << 9)], np.uint64)
    edges = simhash.links(a, a, 2)
    assert len(edges) == len(a) - 1 and len({x for e in edges for x in e}) == len(a)


def test_components_of_a_path_and_a_star(spark):
    edges = [(k, k + 1) for k in range(200)] + [(1000, k) for k in range(1001, 1500)] + [(7, 7)]
    got = {r.node: r.root for r in cc.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(201)} | {k: 1000 for k in range(1000, 1500)}
    assert cc.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_one_of_each_group_stays(awkward, nothing):
    small = awkward.where("text is null or length(text) < 20000")
    kept = simhash.one_of_each(small)
    assert kept.columns == small.columns
    got = [(r.doc_id, r.text) for r in kept.collect()]
    rows = [(r.doc_id, r.text) for r in small.collect()]
    root = roots({plain_fingerprint(t) for _, t in rows}, lambda a, b: (a ^ b).bit_count() <= 2)
    groups = defaultdict(list)
    for d, t in rows:
        groups[root[plain_fingerprint(t)]].append((d is None, d or 0))
    assert sorted((d is None, d or 0) for d, _ in got) == sorted(min(g) for g in groups.values())
    assert simhash.one_of_each(nothing).count() == 0 and simhash.near_duplicates(nothing).count() == 0


@pytest.mark.parametrize("name", ["awkward", "sample"])
def test_shards(name, request):
    docs = request.getfixturevalue(name)
    rows = []
    for r in docs.select("doc_id", "text").collect():
        raw = (r.text or "").encode()
        h = signed(xxhash.xxh64_intdigest(raw, 42))
        rows.append((h, LOWEST if r.doc_id is None else r.doc_id, r.doc_id, len(raw) + 8))
    rows.sort(key=lambda r: r[:2])
    total, at, want, slots = sum(r[3] for r in rows), 0, [], Counter()
    for _, _, doc, size in rows:
        number = min(23, (2 * at + size) * 24 // (2 * total))
        want.append((doc, size, number, slots[number]))
        slots[number] += 1
        at += size
    got = Counter((r.doc_id, r.size, r.shard, r.slot) for r in shard(docs).collect())
    assert got == Counter(want)


def test_shards_of_nothing(nothing):
    assert shard(nothing).count() == 0


def plain_measures(text):
    words = [w for w in "".join(" " if c in "\t\n\v\f\r" else c for c in text or "").split(" ") if w]
    windows = [tuple(words[k : k + 8]) for k in range(len(words) - 7)]
    often = Counter(windows)
    inside = {k + d for k, w in enumerate(windows) if often[w] > 1 for d in range(8)}
    lines = [line for line in (text or "").split("\n") if line.strip(" \t\v\f\r")]
    return (
        len(words), sum(map(len, words)), sum(c in SYMBOLS for c in text or ""), len(lines) - len(set(lines)), len(inside),
        sum(a == b for a, b in zip(words, words[1:], strict=False)),
    )


@pytest.mark.parametrize("name", ["awkward", "sample"])
def test_measures(name, request):
    docs = request.getfixturevalue(name)
    rules = Rules(least_documents=1_000_000)  # no fences: the base rules alone
    got = Counter(tuple(r) for r in judge(docs, rules).select("doc_id", *COUNTS, "base_failed", "kept").collect())
    want = Counter()
    for r in docs.select("doc_id", "text").collect():
        m = plain_measures(r.text)
        failed = m[0] < 20 or 100 * m[4] > 30 * m[0]
        want[(r.doc_id, *m, failed, not failed)] += 1
    assert got == want


def test_repeats_at_the_edges():
    w = [f"a{k}" for k in range(9)]
    for text in ("a " * 9, "a " * 8, " ".join(w[:8] + ["x"] + w[:8]), " ".join(w + w), " ".join(w[:8] * 2), "  a b \x1c"):
        assert measures(text) == plain_measures(text)


def test_fences_follow_the_group(spark):
    plain = [(k, "word " * 5 + " ".join(f"t{k}q{j}" for j in range(30 + k % 5)), "en", "prose") for k in range(300)]
    code = [(1000 + k, " ".join(f"<{k}q{j}>" for j in range(40 + k % 5)), "en", "code") for k in range(300)]
    odd = [(5000, " ".join(f"#{j}#$" for j in range(60)), "en", "prose"), (5001, " ".join(f"<777q{j}>" for j in range(40)), "en", "code")]
    docs = spark.createDataFrame(plain + code + odd, "doc_id long, text string, lang string, source string")
    kept = {r.doc_id for r in judge(docs).where("kept").collect()}
    assert kept == {r[0] for r in plain + code} | {5001}
    assert {r.doc_id for r in keep_good(docs).collect()} == kept


def test_labels(sample, spark, nothing):
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").where("quality is not null")
    judged = judge(spark.read.parquet("/root/testdata/sf0.1/documents.parquet")).where("not base_failed")
    rows = judged.join(labels, "doc_id").groupBy("quality", "kept").count().collect()
    counts = {(r.quality, r.kept): r["count"] for r in rows}
    assert counts.get((0, True), 0) <= 0.02 * counts[0, False] and counts.get((1, False), 0) <= 0.005 * counts[1, True]
    assert judge(nothing).count() == 0 and keep_good(nothing).columns == nothing.columns


def test_keep_good_keeps_what_judge_keeps(awkward):
    want = Counter(r.doc_id for r in judge(awkward).where("kept").collect())
    kept = keep_good(awkward)
    assert kept.columns == awkward.columns and Counter(r.doc_id for r in kept.collect()) == want
