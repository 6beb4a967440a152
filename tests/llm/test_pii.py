"""Identifiers against the plain patterns, and disclosures against counts in plain Python."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import regex
from pyspark.sql import functions as F

from attestra.llm.pii import DEFAULT, KINDS, Disclosure, find, sanitised, told

# The patterns as they are published, without what spares Java the search.
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        total += sum(map(int, str(int(c) * (1 + k % 2))))
    return total % 10 == 0


def plain_base(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card" and not (16 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            entity = m.group().lower() if kind == "email" else m.group() if kind == "ip" else digits
            out.append((kind, m.start(), m.end(), entity))
    return out


def plain_added(texts, how):
    """Spans of each distinct text, from the windows around the mentions and the contexts of all texts."""
    total, n_c, n_t, n_ct, where, spans, held = 0, Counter(), Counter(), Counter(), defaultdict(set), {}, {}
    for text in texts:
        if text is None:
            continue
        runs = [(m.start(), m.end(), m.group().lower()) for m in regex.finditer(r"[\p{L}\p{N}]+", text)]
        total += max(1, -(-len(runs) // 64))
        for k in range(0, len(runs), 64):
            n_t.update({t for _, _, t in runs[k : k + 64]})
        base = plain_base(text)
        mentions = {(sum(s < start for s, _, _ in runs), (kind, entity)) for kind, start, _, entity in base}
        free = [(k, s, e, t) for k, (s, e, t) in enumerate(runs) if e - s >= 2 and not any(a <= s < b for _, a, b, _ in base)] if base else []
        for index, c in mentions:
            n_c[c] += 1
            for t in {t for k, _, _, t in free if abs(k - index) <= 32}:
                n_ct[c, t] += 1
                where[c, t].add((text, index))
        spans[text], held[text] = free, {c for _, c in mentions}
    share = {}
    for (c, t), n in n_ct.items():
        if n >= how.least_contexts and len(where[c, t]) > 1:
            content = math.log2(total / n_c[c])
            share[c, t] = math.log2(total * n / (n_c[c] * n_t[t])) / content if content > 0 else 0.0
    out = {}
    for text, found in spans.items():
        rows = []
        for _, start, end, term in found:
            best = max((share.get((c, term), 0) for c in held[text]), default=0)
            if best >= how.generalise:
                rows.append(("removed" if best >= how.remove else "general", start, end))
        out[text] = sorted(rows, key=lambda r: (KINDS.index(r[0]), r[1]))
    return out


def check(docs, how=DEFAULT):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    added = plain_added([t for _, t in rows], how)
    want = Counter()
    for d, t in rows:
        base = ",".join(f"{k}:{a}:{b}" for k, a, b, _ in plain_base(t))
        more = ",".join(f"{k}:{a}:{b}" for k, a, b in added.get(t, []))
        want[(d, base, more, hashlib.sha256(base.encode()).hexdigest())] += 1
    found = find(docs, how).select("doc_id", told(F.col("base")).alias("b"), told(F.col("added")).alias("a"))
    got = Counter((r.doc_id, r.b, r.a, hashlib.sha256(r.b.encode()).hexdigest()) for r in found.collect())
    assert got == want
    return added


def test_sample(sample):
    check(sample)


def test_awkward(awkward, nothing):
    check(awkward.where("text is null or length(text) < 100000"))
    assert find(nothing).count() == 0 and sanitised(nothing).count() == 0


CARD = "4012 8888 8888 1881"
TEXTS = [
    "a@b.c_d@e.f a@b@c.d x.@y.z. é@a.b %+@-.-", "1.2.3.4.5.6.7.8 256.1.1.1 0.0.0.00255 1.2.3 01.02.03.04", f"{CARD} 4012888888881881 4012-8888-8888-1882",
    "+1 (2) 3 4567-89 +1234567 +12345678901234567 ++1 234 567 89(", f"😀 é{CARD}é 😀 +49 (0) 170-1234567.", "1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 7 8 9 0",
    "", None, "   a@b.cc  \n\t+1 222 333 4444\n", "123456789012345678901234567890", "a" * 3000 + "@" + "b" * 3000 + ".c" * 1000,
]


def test_odd_matches(spark):
    check(spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string"))


def test_long_runs_end_soon(spark):
    runs = ["a" * 300_000, "7" * 300_000, "1." * 30_000, "1 " * 150_000, "+1" + "(" * 200_000, "a@" * 100_000, "a@b" + ".c" * 150_000, "+1-" * 80_000]
    docs = spark.createDataFrame(list(enumerate(runs)), "doc_id long, text string").repartition(8)
    found = {r.doc_id: r.b for r in find(docs).select("doc_id", told(F.col("base")).alias("b")).collect()}
    ips = ",".join(f"ip:{8 * k}:{8 * k + 7}" for k in range(7500))
    assert found == {k: ips if k == 2 else f"email:0:{len(t)}" if k == 6 else "" for k, t in enumerate(runs)}


def test_terms_that_reveal(spark):
    rng = random.Random(4)
    words = [f"word{'abcdefghij'[k % 10]}{'abcdefghij'[k // 10 % 10]}" for k in range(100)]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    docs = [(k, f"{prose(10)} Zebulon{'' if k % 2 else ','} {prose(5)} zeb@mail.example.org {prose(9)}\n{prose(70)}") for k in range(6)]
    docs += [(100 + k, f"{prose(rng.randint(20, 200))}") for k in range(150)] + [(300, "the Zebulon elsewhere " + prose(20))]
    docs += [(400 + k, "Copied Xerxes text with xer@mail.example.org " + "same " * 9) for k in range(5)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    added = check(frame)
    told_terms = {t[a:b] for t, spans in added.items() for _, a, b in spans}
    assert told_terms == {"Zebulon"}  # "Xerxes" occurs in copies of one context only
    texts = {r.doc_id: r.text for r in sanitised(frame).collect()}
    assert all("[EMAIL]" in texts[k] and "Zebulon" not in texts[k] and "example" not in texts[k] for k in range(6))
    assert texts[300] == docs[156][1]
    check(frame, Disclosure(generalise=0.2, remove=0.5, least_contexts=2))


def test_windows_cross_blocks_and_marks_reach_the_whole_text(spark):
    """A name across any block edge, a user name with digits, both halves of a double name, and a second place far away."""
    rng = random.Random(6)
    words = [f"w{a}{b}" for a in "abcdefghij" for b in "abcdefghij"]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    docs = [(k, f"{prose(50 + 2 * k)} Smith-Jones {prose(4)} jsmith42 {prose(3)} smi@mail.example.org {prose(200)} Jones {prose(5)}") for k in range(8)]
    docs += [(100 + k, prose(rng.randint(50, 400))) for k in range(120)]
    added = check(spark.createDataFrame(docs, "doc_id long, text string").repartition(4))
    for _, text in docs[:8]:
        assert Counter(text[a:b] for _, a, b in added[text]) == {"Smith": 1, "Jones": 2, "jsmith42": 1}
