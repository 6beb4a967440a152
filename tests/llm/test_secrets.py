"""The secret scan against a plain scan, one string and one decoy at a time."""

import math
import random
import re
import string
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from attestra.llm import secret_scan as s
from attestra.llm.queries import QUERIES
from tests.llm.conftest import SF_DIR, row

LOWER = string.ascii_lowercase
ASSIGN = re.compile(r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']? *[:=] *["']?([A-Za-z0-9+/_.=-]+)""")


def plain_level(values, size):
    n = len(values)
    counts = Counter(values)
    chi = size / n * sum(c * c for c in counts.values()) - n
    zs = [(chi - (size - 1)) / math.sqrt(2 * (size - 1) * (n - 1) / n)]
    crossings = sum((a >= size // 2) != (b >= size // 2) for a, b in zip(values, values[1:]))
    zs.append((crossings - (n - 1) / 2) / math.sqrt((n - 1) / 4))
    mean, variance = (size - 1) / 2, (size * size - 1) / 12
    zs.append(sum((a - mean) * (b - mean) for a, b in zip(values, values[1:])) / variance / math.sqrt(n - 1))
    steps = [min(int(abs(z) * 256), 30 * 256 - 1) / 256 for z in zs]
    half = sum(-math.log(max(math.erfc(z / math.sqrt(2)), 1e-300)) for z in steps)
    bits = (half - math.log(1 + half + half * half / 2)) / math.log(2)
    return max(0, min(255, math.floor(4 * bits)))


def plain_base(text):
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m.group(1)) >= 12]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m.group()) >= 18]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m.group()) >= 16]
    return sorted(out)


def plain_candidates(text, base):
    for m in re.finditer(r"((?<![A-Za-z0-9+/])[A-Za-z0-9+/]{16,}(?![A-Za-z0-9+/_-])|[A-Za-z0-9_-]{16,})={0,2}", text):
        if any(a < m.end() and b > m.start() for a, _, b in base):
            continue
        token = m.group(1).lower() if m.group(1).isalpha() else m.group(1)
        symbols = next(a for a in s.ALPHABETS if set(token) <= set(a))
        yield m.span(), s.stratum(len(symbols), len(token)), plain_level([symbols.index(c) for c in token], len(symbols)), m.group(1)


def plain_decoys(text):
    """``stratum, level`` of the pieces of a text."""
    kept = [c for c in text if c in s.ORDINARY]
    at = 0
    while True:
        for n in s.LENGTHS:
            if at + n > len(kept):
                return
            for size in s.SIZES:
                symbols = next(a for a in s.ALPHABETS if len(a) == size)
                piece = [next((symbols.index(x) for x in (c, c.lower(), c.upper()) if x in symbols), (string.digits + LOWER).index(c.lower()) % size) for c in kept[at : at + n]]
                yield s.stratum(size, n), plain_level(piece, size)
            at += n


def plain_scan(texts, rate):
    texts = [t or "" for t in texts]
    ordinary = Counter(x for t in texts for x in plain_decoys(t))
    base = [plain_base(t) for t in texts]
    found = [list(plain_candidates(t, b)) for t, b in zip(texts, base)]
    tested = {(g, level, word) for f in found for _, g, level, word in f}
    highest = {}
    for g in {g for g, _, _ in tested}:
        decoys = {level: n for (k, level), n in ordinary.items() if k == g}
        levels = [level for k, level, _ in tested if k == g]
        for level in range(256):
            upto = sum(x <= level for x in levels)
            chance = (sum(n for x, n in decoys.items() if x <= level) + 1) / (sum(decoys.values()) + 1)
            if upto and chance * len(levels) <= rate * upto:
                highest[g] = level
    return [(b, [span for span, g, level, _ in f if level <= highest.get(g, -1)]) for b, f in zip(base, found)]


def texts_with_secrets():
    rng = random.Random(11)
    words = ["".join(rng.choice("etaoinshrdlucmfwyp") for _ in range(rng.randint(2, 9))) for _ in range(300)]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    url64 = LOWER.upper() + LOWER + string.digits + "-_"
    tokens = ["".join(rng.choice(url64) for _ in range(rng.choice([32, 40, 64]))) for _ in range(40)]
    texts = [prose(rng.randint(50, 400)) for _ in range(150)]
    texts += [prose(20) + " " + t + " " + prose(20) for t in tokens]
    texts += ["password: token: abcdefghijklmn", "PassWord = 'abcDEF123456789' end", "apikey=abcdefghijkl", "paſſword=abcdefghijklmno", "tokeN=abcdefghijklmn"]
    texts += ["AKIAABCDEFGHIJKLMN AKIA1234567890123", "deadbeefdeadbeefdeadbeef ä 0123456789abcdef", "the" * 40, "a-" * 30, "x" * 5000, None, "", "😀 secret=0123456789abcdef0123"]
    return texts, tokens


@pytest.fixture(scope="module")
def planted(spark):
    texts, tokens = texts_with_secrets()
    texts = [t.encode("utf-16", "surrogatepass").decode("utf-16") if t else t for t in texts]
    rows = [row(k, t) for k, t in enumerate(texts)] + [row(None, texts[160]), row(160, texts[160])]
    from attestra.llm.common import prepared
    from tests.llm.conftest import SCHEMA

    return prepared(spark).createDataFrame(rows, SCHEMA).repartition(3), [r[1] for r in rows], tokens


def test_levels_are_those_of_single_strings():
    import numpy as np

    rng = np.random.default_rng(5)
    for size in s.SIZES:
        for n in (16, 37, 300):
            rows = np.concatenate([rng.integers(0, size, (20, n)), rng.integers(0, 3, (20, n))]).astype(np.uint8)
            assert s.levels(rows, size).tolist() == [plain_level(r, size) for r in rows.tolist()]


def test_random_symbols_are_level_by_level_as_frequent_as_they_should_be():
    import numpy as np

    rows = np.random.default_rng(6).integers(0, 64, (20_000, 64)).astype(np.uint8)
    found = s.levels(rows, 64)
    assert 0.40 < (found < 4).mean() < 0.60 and (found < 32).mean() > 0.98


def test_scan_against_a_plain_scan(planted):
    docs, texts, tokens = planted
    how = s.Discovery(rate=0.05)
    want = Counter((b_a[0].__repr__(), b_a[1].__repr__()) for b_a in plain_scan(texts, how.rate))
    rows = s.scan(docs, how).collect()
    got = Counter((repr([tuple(x) for x in r.base]), repr([(x.start, x.end) for x in r.added])) for r in rows)
    assert got == want
    held = {(t[x.start : x.end]) for r in rows if r.doc_id is not None and (t := texts[r.doc_id]) for x in r.added}
    assert len(held & set(tokens)) > 30 and held <= set(tokens)


def test_redacted(planted):
    docs, texts, tokens = planted
    how = s.Discovery(rate=0.05)
    clean = {r.doc_id: r.text for r in s.redacted(docs, how).collect()}
    assert s.redacted(docs, how).columns == docs.columns
    assert clean[texts.index("PassWord = 'abcDEF123456789' end")] == "[assign]' end"
    assert sum(t in (clean[k] or "") for k, x in enumerate(texts[:-2]) for t in tokens if x and t in x) < 10
    assert clean[texts.index(None)] is None and clean[texts.index("")] == ""


@pytest.mark.parametrize("name", ["awkward", "nothing"])
def test_awkward_rows(name, request):
    docs = request.getfixturevalue(name)
    texts = [r.text for r in docs.collect()]
    got = Counter(repr([tuple(x) for x in r.base]) for r in s.scan(docs).collect())
    assert got == Counter(repr(plain_base(t or "")) for t in texts)


def test_query(spark):
    import hashlib

    found = QUERIES["op11_randomness"](spark, SF_DIR)
    assert found.dtypes[:6] == [("doc_id", "bigint"), ("n_assign", "bigint"), ("n_access", "bigint"), ("n_hex", "bigint"), ("base_sha256", "string"), ("spans", "string")]
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    rows = found.collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        base = plain_base(texts[r.doc_id])
        joined = ",".join(f"{s.KINDS[k]}:{a}:{b}" for a, k, b in base)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == x for _, k, _ in base) for x in range(3))
        assert set(joined.split(",")) - {""} <= set(r.spans.split(","))
    assert found.agg(F.countDistinct("doc_id")).first()[0] == len(texts) and xxhash.xxh64_intdigest("") > 0
