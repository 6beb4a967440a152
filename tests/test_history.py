"""Histories, carries over order ranges, and drift without arrays, against plain loops."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from attestra.operators import drift, history, ordering, registry
from attestra.plans import normalise
from attestra.plans.lake import Lake
from tests import corpus


@pytest.mark.parametrize("ranges", [1, 3, 16])
@pytest.mark.parametrize("after", [False, True])
def test_beside(spark, ranges, after):
    rng = random.Random(ranges)
    rows = [(rng.choice(["hot", "hot", "hot", "a", "b", None]), k, rng.choice(["x", None, "y"])) for k in range(300)]
    rng.shuffle(rows)
    got = ordering.beside(spark.createDataFrame(rows, "g string, n int, v string"), ["g"], ["n"], {"near": F.col("v"), "at": F.col("n")}, after, ranges)
    groups = defaultdict(list)
    for g, n, v in sorted(rows, key=lambda r: r[1], reverse=after):
        groups[g].append((n, v))
    want = {n: (g, v, x[k - 1][1] if k else None, x[k - 1][0] if k else None) for g, x in groups.items() for k, (n, v) in enumerate(x)}
    assert {r.n: (r.g, r.v, r.near, r.at) for r in got.collect()} == want


def plain_history(versions):
    """``{(key, valid_from): (content, valid_to)}`` of changes, from ``(key, time, content, landed)``."""
    best = {}
    for key, time, content, landed in versions:
        if key is not None and time is not None:
            best[key, time] = max(best.get((key, time), (-1, "")), (landed, content))
    out, last = {}, {}
    for key, time in sorted(best):
        content = best[key, time][1]
        if key in last and out[key, last[key]][0] == content:
            continue
        if key in last:
            out[key, last[key]] = (out[key, last[key]][0], time)
        out[key, time] = (content, None)
        last[key] = time
    return out


@pytest.mark.parametrize("seed", range(3))
def test_merges_in_any_order_give_one_history(spark, seed):
    rng = random.Random(seed)
    rows = [(rng.choice(["hot", "hot", "hot", "a", "b", "c", None]), rng.randrange(40) or None, rng.choice("pqr"), k) for k in range(150)]
    table, given = None, []
    for turn in range(3):
        part = rows[turn * 50 : turn * 50 + 50]
        given += part
        arriving = history.versions(spark.createDataFrame(part, "k string, t int, v string, n int"), "k", F.col("t"), ["v"], F.col("n"))
        if table is None:
            table = history.intervals(arriving, "k", 3).withColumn("generation", F.lit(0))
        else:
            merged, replaced = history.merge(table, arriving, "k", 3)
            kept = table.join(replaced, ["k", "generation"], "left_anti")
            table = kept.unionByName(merged.withColumn("generation", F.lit(turn)))
        want = plain_history(given)
        changed = table.where("changed").collect()
        assert {(r.k, r.valid_from): (r.v, r.valid_to) for r in changed} == want and len(changed) == len(want)
        for time in (0, 7, 20, 100):
            held = {r.k: r.v for r in history.as_of(table, F.lit(time)).collect()}
            assert held == {k: c for (k, f), (c, to) in want.items() if f <= time and (to is None or to > time)}


def test_a_merge_writes_touched_keys_only(spark):
    first = history.versions(spark.range(100).selectExpr("id", "0 AS t", "'a' AS v"), "id", F.col("t"), ["v"], F.lit(0))
    table = history.intervals(first, "id").withColumn("generation", F.lit(0))
    again = history.versions(spark.range(100).selectExpr("id", "0 AS t", "'a' AS v"), "id", F.col("t"), ["v"], F.lit(1))
    merged, replaced = history.merge(table, again, "id")
    assert merged.count() == replaced.count() == 0  # what the history holds touches nothing
    new = history.versions(spark.createDataFrame([(5, 3, "b")], "id long, t int, v string"), "id", F.col("t"), ["v"], F.lit(1))
    merged, replaced = history.merge(table, new, "id")
    assert sorted((r.id, r.valid_from, r.valid_to) for r in merged.collect()) == [(5, 0, 3), (5, 3, None)] and replaced.count() == 1


def test_history_job_survives_a_broken_merge(spark, tmp_path):
    from attestra.plans import ingest

    first, second = corpus.write_documents(tmp_path / "in")
    lake = Lake(str(tmp_path / "lake"))
    ingest.ingest(spark, lake, first, "2026-01-05T10:00:00.000Z")
    normalise.normalise(spark, lake, corpus.ALIASES)
    normalise.update_history(spark, lake, "2026-01-05")
    before = normalise.silver_history(spark, lake).count()
    ingest.ingest(spark, lake, second, "2026-01-06T10:00:00.000Z")
    normalise.normalise(spark, lake, corpus.ALIASES)
    # A merge that broke off before its last write counts for nothing.
    rows = lake.read(spark, "silver_history", normalise.HISTORY).limit(3).withColumn("generation", F.lit(2).cast("bigint"))
    rows.write.mode("append").partitionBy("generation").parquet(lake.path("silver_history"))
    assert normalise.silver_history(spark, lake).count() == before
    done = normalise.update_history(spark, lake, "2026-01-06").where("changed")
    silver = spark.read.parquet(lake.path("silver"))
    assert done.where("valid_to is null").count() == silver.select("clause_id").distinct().count()
    written = lake.read(spark, "silver_history", normalise.HISTORY).where("generation = 2").count()
    assert written == silver.where("_lineage.run_id like 'batch_2%'").count()
    normalise.update_history(spark, lake, "2026-01-07")
    assert lake.read(spark, "silver_history", normalise.HISTORY).where("generation = 3").count() == 0


def test_a_million_landings_follow_each_other(spark):
    batches = spark.range(100_000).selectExpr("'one' AS source", "cast(id % 3 as string) AS api_version", "'f' AS fingerprint", "concat('r', id) AS run_id", "id AS seq")
    known = spark.createDataFrame([("one", "9", "f", "t", "t", "old", 1, True)], "source string, api_version string, fingerprint string, first_seen string, last_seen string, last_run_id string, record_count bigint, is_latest boolean")
    found = registry.baseline(batches, known)
    assert found.where("seq = 0").first().previous_run_id == "old" and found.where("seq = 0").first().from_registry
    wrong = found.where("seq > 0 AND NOT (previous_run_id = concat('r', seq - 1))").count()
    assert wrong == 0 and found.count() == 100_000
    assert {r.baseline_kind for r in found.collect()} == {"diff"}


def plain_matches(pairs):
    taken, done, out = set(), set(), set()
    for removed, score, added in sorted(pairs, key=lambda p: (p[0], -p[1], p[2])):
        if removed not in done and added not in taken:
            done.add(removed)
            taken.add(added)
            out.add((removed, added))
    return out


def test_greedy_matching(spark):
    rng = random.Random(9)
    ddl = "k int, removed string, added string, score double, removed_values array<string>, added_values array<string>"
    pairs = {(k, f"r{rng.randrange(n):05}", f"a{rng.randrange(n):05}"): rng.choice([0.5, 0.6, 0.75, 1.0]) for k, n in ((1, 3000), (2, 12), (3, 12)) for _ in range(50_000 if k == 1 else 60)}
    rows = [(k, r, a, s, ["x"], ["x"]) for (k, r, a), s in pairs.items()] + [(1, "r", "a", 0.49, ["x"], ["y"])]
    found = drift.match_renames(spark.createDataFrame(rows, ddl).repartition(5), ["k"]).collect()
    for k in (1, 2, 3):
        assert {(x.removed, x.added) for x in found if x.k == k} == plain_matches([(r, s, a) for (j, r, a), s in pairs.items() if j == k])
    alone = drift.match_renames(spark.createDataFrame([r[1:] for r in rows if r[0] == 2], ddl.partition(", ")[2]))
    assert alone.columns == ["removed", "added", "score", "removed_values", "added_values"] and alone.count() == len(plain_matches([(r, s, a) for (j, r, a), s in pairs.items() if j == 2]))


def test_subtree_roots_of_many_paths(spark):
    paths = ["a", "a.b", "a.b[]", "a.b[].c", "ab", "x[]", "x[].y", "x[][]", "q.r.s", "", ".z"] + [f"wide.p{k}" for k in range(20_000)] + ["wide"]
    schema = "path string, types array<string>, present_count bigint, null_count bigint, values array<string>"
    new = spark.createDataFrame([(p, ["str"], 1, 0, None) for p in paths], schema)
    events = {r.path: r.evidence for r in drift.diff_inventories(spark.createDataFrame([], schema), new).collect()}
    below = lambda c, p: c.startswith(p + ".") or c.startswith(p + "[]")
    few = [p for p in paths if not p.startswith("wide")]
    assert set(events) == {p for p in few if not any(below(p, q) for q in few)} | {"wide"}
    assert '"a.b[].c"' in events["a"] and events["wide"].count("wide.p") == 20_000 and events["ab"] is None
