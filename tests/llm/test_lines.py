"""Line dedup, decontamination and license scan against brute force and SQL."""

import random
from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from attestra.llm import line_dedup, words
from attestra.llm.decontamination import MASKS, SPAN, WINDOW, needed, overlaps, short_masks, without_benchmark
from attestra.llm.licenses import TEMPLATES, scan
from attestra.llm.line_dedup import Similarity, line_report, without_similar_lines
from attestra.llm.queries import ORACLE, QUERIES
from tests.llm.conftest import SF_DIR


def plain_lines(rows, how):
    """Removed lines of each (doc_id, text): similar to any earlier line of another place."""
    key = lambda r: (r[0] is not None, r[0] or 0, signed(xxhash.xxh64_intdigest((r[1] or "").encode(), 42)))
    places = []
    for doc in sorted({*rows}, key=key):
        for k, line in enumerate((doc[1] or "").split("\n") if doc[1] is not None else []):
            lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in line)
            words = frozenset(w for w in "".join(" " if c in "\t\v\f\r" else c for c in lowered).split(" ") if w)
            if words:
                places.append((doc, k, words))
    removed: dict = {}
    seen: list[frozenset] = []
    for doc, k, words in places:
        short = len(words) < how.least_words
        if any(words == s if short else how.q * len(words & s) >= how.p * len(words | s) for s in seen if short or len(s) >= how.least_words):
            removed.setdefault(doc, []).append(k)
        seen.append(words)
    return removed


def signed(value):
    return value - (1 << 64) if value >> 63 else value


def check(docs, how):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    removed = plain_lines(rows, how)
    want = Counter(
        (d, 0 if t is None else t.count("\n") + 1, len(removed.get((d, t), [])), tuple(removed.get((d, t), []))) for d, t in rows
    )
    got = Counter((r.doc_id, r.n_lines, r.n_removed, tuple(r.removed)) for r in line_report(docs, how).collect())
    assert got == want
    return removed


@pytest.mark.parametrize("block", [2048, 3])
def test_lines_of_awkward_texts(awkward, block):
    check(awkward.where("text is null or length(text) < 5000"), Similarity(block=block))


@pytest.mark.parametrize("block,least,p,q", [(2048, 5, 4, 5), (4, 1, 4, 5), (2, 2, 1, 2), (5, 1, 9, 10)])
def test_many_similar_lines(spark, block, least, p, q):
    """Variants of few lines, short lines of frequent words, and blocks that are much smaller than the groups."""
    rng = random.Random(block)
    words = [f"w{k}" for k in range(25)]
    base = [[rng.choice(words) for _ in range(rng.randint(1, 14))] for _ in range(12)]

    def line():
        got = list(rng.choice(base))
        for _ in range(rng.randint(0, 3)):
            got[rng.randrange(len(got))] = rng.choice(words)
        return " ".join(got)

    docs = [(rng.randrange(150), "\n".join(line() for _ in range(rng.randint(0, 4)))) for _ in range(220)]
    frame = spark.createDataFrame([*docs, (None, line()), (3, None)], "doc_id long, text string").repartition(6)
    assert check(frame, Similarity(block=block, least_words=least, p=p, q=q))


def test_second_round_finds_what_the_first_misses(spark):
    """The earliest partner passes all filters but is dissimilar; a later one is similar."""
    how = Similarity(least_words=1)
    found = 0
    rng = random.Random(1)
    for trial in range(2):
        rows = [(k, " ".join(f"v{rng.randrange(14)}" for _ in range(rng.randint(6, 12)))) for k in range(250)]
        found += len(check(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), how))
    assert found


def test_rows_of_words_are_dealt_many_at_once():
    """A task gives one row a bucket, which holds every set and word of its prefix once, or once for each pair of blocks."""
    how = Similarity(bits=4)
    rng = np.random.default_rng(3)
    lengths = rng.integers(0, 9, 3000)
    prefix = line_dedup._binary(rng.integers(0, 1 << 32, lengths.sum(), dtype=np.uint32), lengths)
    columns = [np.arange(3000), np.full(3000, 9, np.int32), *rng.integers(-9, 9, (2, 3000))]
    sets = pa.RecordBatch.from_arrays([*map(pa.array, columns), prefix], ["id", "size", "s1", "s2", "prefix"])

    class Blocks:
        value = np.zeros(16, np.uint16)

    Blocks.value[5] = 3
    plain = np.concatenate([np.stack([c.to_numpy() for c in b.columns]) for b in line_dedup._word_rows(iter([sets]), Blocks, how)], axis=1)
    dealt = [r for b in line_dedup._bucket_rows(iter([sets.slice(0, 1000), sets.slice(1000)]), Blocks, 3, how) for r in b.to_pylist()]
    assert len(dealt) == len({r["bucket"] for r in dealt}) == 8
    rows = np.concatenate([np.frombuffer(r["rows"], np.int64).reshape(5, -1) for r in dealt], axis=1)
    assert sorted(rows.T.tolist()) == sorted(plain.T.tolist())
    hot = (plain[0].view(np.uint64) >> np.uint64(60)) == 5
    assert hot.sum() % 3 == 0 and (~hot).sum() + hot.sum() // 3 == lengths.sum()


def test_words_and_lines_of_chunks(monkeypatch):
    texts = ["Word w\nw b", None, "", "\n\n", "c" * 70 + " d\n" + "e f\n" * 40, "end\n", "next"]
    for chunk in (16, 1 << 18):
        monkeypatch.setattr(words, "CHUNK", chunk)
        monkeypatch.setattr(words, "_powers", {})
        column = pa.array(texts)
        told = [len(t.split()) if t else 0 for t in texts]
        assert sum(map(len, words.hashes(column))) == sum(told)
        assert words.line_counts(column).tolist() == [0 if t is None else t.count("\n") + 1 for t in texts]
        assert words.line_counts(column.slice(1, 3)).tolist() == [0, 1, 3]
        found = [(int(t), int(n), int(s)) for x in words.lines(column) for t, n, s in zip(x.text, x.number, x.sizes, strict=True)]
        assert found == [(k, n, len(set(w.lower().split()))) for k, t in enumerate(texts) for n, w in enumerate((t or "").split("\n")) if w.split()]


def test_texts_lose_their_lines(awkward, nothing):
    small = awkward.where("text is null or length(text) < 5000")
    removed = plain_lines([(r.doc_id, r.text) for r in small.collect()], line_dedup.DEFAULT)
    want = Counter()
    for r in small.collect():
        gone = removed.get((r.doc_id, r.text))
        text = r.text if gone is None else "\n".join(x for k, x in enumerate(r.text.split("\n")) if k not in gone)
        want[(r.doc_id, text, None if text is None else len(text))] += 1
    kept = without_similar_lines(small)
    assert kept.columns == small.columns
    assert Counter((r.doc_id, r.text, r.n_chars) for r in kept.collect()) == want
    assert line_report(nothing).count() == 0 and without_similar_lines(nothing).count() == 0


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_queries_with_sql(spark, name):
    from tests import oracle

    con = oracle.connect(SF_DIR)
    df = QUERIES[name](spark, SF_DIR)
    assert oracle.compare(df, con, ORACLE[name]) is None and oracle.compare_types(df, con, ORACLE[name]) is None


def test_masks_meet_any_three_substitutions():
    places = [[o + k for k, c in enumerate(m) if c == "1"] for m in MASKS for o in range(WINDOW - SPAN + 1)]
    assert all(any(not set(p) & set(s) for p in places) for s in combinations(range(WINDOW), 3))


def plain_words(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [w.strip(".,;:!?\"'()[]") for w in "".join(" " if c in "\t\n\v\f\r" else c for c in lowered).split(" ") if w]


def plain_overlaps(docs, items):
    first: dict[tuple, int | None] = {}
    for item_id, text in items:
        words = tuple(plain_words(text))
        if len(words) >= 5:
            ids = [i for i in (first.get(words, item_id), item_id) if i is not None]
            first[words] = min(ids) if ids else None
    codes: dict[str, int] = {}
    code = lambda ws: np.array([codes.setdefault(w, len(codes)) for w in ws])
    coded = [(code(w), i) for w, i in first.items()]
    out = set()
    for doc_id, text in docs:
        words = code(plain_words(text))
        for item, item_id in coded:
            window = min(WINDOW, len(item))
            need = -(-window * 12 // 15)
            for shift in range(window - len(item), len(words) - window + 1):
                lo, hi = max(0, shift), min(len(words), shift + len(item))
                if hi - lo >= window:
                    sums = np.concatenate([[0], np.cumsum(words[lo:hi] == item[lo - shift : hi - shift])])
                    if (sums[window:] - sums[:-window]).max() >= need:
                        out.add((doc_id, item_id))
                        break
    return out


def leaky(spark):
    rng = random.Random(5)
    words = [f"u{k}" for k in range(300)]
    prose = lambda n: [rng.choice(words) for _ in range(n)]
    items = [(k, " ".join(prose(rng.randint(15, 50)))) for k in range(12)]
    items += [(50, items[3][1].upper()), (51, " ".join(prose(7))), (52, "only three words"), (53, ""), (54, None), (55, "la " * 30)]
    docs = []
    for k in range(60):
        item = items[k % 12][1].split()
        part = item[: rng.randint(15, len(item))]
        for place in rng.sample(range(len(part)), len(part) // 8):
            part[place] = "changed"
        docs.append((k, " ".join(prose(rng.randint(0, 200)) + part + prose(rng.randint(0, 30)))))
    docs += [(100 + k, " ".join(prose(300))) for k in range(10)] + [(200, items[13][1] + ", and more"), (201, "La, " * 400)]
    docs += [(202, (items[2][1] + " ") * 30), (300, None), (301, ""), (None, items[1][1]), (7, docs[7][1]), (7, docs[7][1])]
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")


def test_overlaps_against_all_alignments(spark):
    docs, items = leaky(spark)
    got = {(r.doc_id, r.item_id) for r in overlaps(docs.repartition(4), items).collect()}
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert got == plain_overlaps(rows, [(r.item_id, r.text) for r in items.collect()])
    gone = {d for d, _ in got}
    assert Counter(r.doc_id for r in without_benchmark(docs, items).collect()) == Counter(d for d, _ in rows if d not in gone)
    assert 100 not in gone and {200, 202, None} <= gone


def test_short_masks_meet_all_that_may_differ():
    for size in range(5, WINDOW):
        masks = [set(m.tolist()) for m in short_masks(size)]
        assert all(any(not m & set(s) for m in masks) for s in combinations(range(size), size - needed(size)))
        assert min(map(len, masks)) >= 3


def test_short_items_with_changed_words(spark):
    rng = random.Random(8)
    words = [f"s{k}" for k in range(80)]
    prose = lambda n: [rng.choice(words) for _ in range(n)]
    items = [(n, prose(n)) for n in range(3, 16)]
    docs = []
    for n, item in items:
        for wrong in range(4):
            for k in range(3):
                part = list(item)
                for place in rng.sample(range(n), min(wrong, n)):
                    part[place] = "changed"
                docs.append((n * 100 + wrong * 10 + k, " ".join(prose(rng.randint(0, 9)) + part + prose(rng.randint(0, 9)))))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    benchmark = spark.createDataFrame([(n, " ".join(w)) for n, w in items], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in overlaps(frame, benchmark).collect()}
    assert got == plain_overlaps(docs, [(n, " ".join(w)) for n, w in items])
    assert {(1420 + k, 14) for k in range(3)} <= got and not any(i < 5 for _, i in got)


def test_overlaps_in_the_sample(sample, spark):
    items = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    got = {(r.doc_id, r.item_id) for r in overlaps(sample, items).collect()}
    want = plain_overlaps([(r.doc_id, r.text) for r in sample.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert got == want


def test_overlaps_of_awkward_texts_and_of_nothing(awkward, nothing, spark):
    items = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    assert overlaps(awkward, items).count() == 0 and overlaps(nothing, items).count() == 0
    empty = spark.createDataFrame([], "item_id long, text string")
    kept = without_benchmark(awkward, empty)
    assert kept.count() == awkward.count() and kept.columns == awkward.columns


def test_every_template_is_found_in_its_place(spark, nothing, awkward):
    rng = random.Random(2)
    prose = lambda n: " ".join(f"p{rng.randrange(500)}" for _ in range(n))
    docs = [(k * 40 + pad, f"{prose(pad)} {text.upper() if pad % 2 else text}\n{prose(3)}") for k, (_, text) in enumerate(TEMPLATES) for pad in range(0, 13, 3)]
    docs += [(9000, prose(400)), (9001, None), (9002, ""), (9003, "All rights"), (9004, "<<Released>> under the 'MIT' license")]
    found = scan(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {(r.doc_id // 40, r.template) for r in found if r.doc_id < 9000} >= {(k, k) for k in range(len(TEMPLATES))}
    assert all((k * 40 + pad, k) in {(r.doc_id, r.template) for r in found} for k in range(len(TEMPLATES)) for pad in range(0, 13, 3))
    assert {(r.doc_id, r.license) for r in found if r.doc_id >= 9000} == {(9004, "MIT")}
    assert scan(nothing).count() == 0 and scan(awkward).count() == 0


def test_a_notice_in_two_parts_counts_as_a_whole(spark):
    words = max((t for _, t in TEMPLATES), key=len).split()
    template = next(k for k, (_, t) in enumerate(TEMPLATES) if t.split() == words)
    cut = 6 * len(words) // 10
    other = " ".join(f"o{k}" for k in range(300))
    docs = spark.createDataFrame([(1, f"{' '.join(words[:cut])} {other} {' '.join(words[cut:])}"), (2, " ".join(words[:cut]))], "doc_id long, text string")
    assert {(r.doc_id, r.template) for r in scan(docs).collect()} == {(1, template)}


def test_a_long_template_with_changes(spark):
    words = TEMPLATES[2][1].split()
    near, far = list(words), list(words)
    near[10] = "changed"
    for k in range(4, len(far), 6):
        far[k] = "changed"
    docs = spark.createDataFrame([(1, " ".join(near)), (2, " ".join(far))], "doc_id long, text string")
    assert {(r.doc_id, r.template) for r in scan(docs).collect()} == {(1, 2)}
    assert scan(docs.where(F.lit(False))).count() == 0
