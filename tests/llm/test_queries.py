"""The registered queries themselves: columns in their order, types, and laws over the smallest tables."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from attestra.llm.queries import ORACLE, QUERIES
from tests.llm.conftest import SF_DIR

COLUMNS = {
    "op1_disclosure": [("doc_id", "bigint"), ("n_email", "bigint"), ("n_ip", "bigint"), ("n_card", "bigint"), ("n_phone", "bigint"), ("base_sha256", "string"), ("spans", "string")],
    "op2_token_files": [("doc_id", "bigint"), ("start", "bigint"), ("n_tokens", "bigint"), ("ids_crc32", "bigint")],
    "op3_sampled_splitters": [("doc_id", "bigint"), ("size", "bigint"), ("text_crc32", "bigint"), ("law", "string"), ("shard", "int"), ("slot", "bigint"), ("grown_shard", "int")],
    "op4_token_counts": [("doc_id", "bigint"), ("n_bytes", "bigint"), ("n_tokens", "bigint"), ("over_limit", "boolean")],
    "op5_power_of_two_packing": [("doc_id", "bigint"), ("start", "bigint"), ("length", "bigint"), ("ids_crc32", "bigint"), ("doc_tokens", "bigint"), ("sequence_id", "bigint"), ("offset", "bigint")],
    "op8_adaptive_quality": [("doc_id", "bigint"), ("n_words", "bigint"), ("word_chars", "bigint"), ("n_symbols", "bigint"), ("n_dup_lines", "bigint"), ("n_repeat_words", "bigint"), ("base_failed", "boolean"), ("kept", "boolean")],
    "op9_simhash_components": [("doc_id", "bigint"), ("fingerprint", "string"), ("component_id", "bigint")],
}


@pytest.fixture(scope="module")
def found(spark):
    out = {}

    def rows(name):
        if name not in out:
            df = QUERIES[name](spark, SF_DIR)
            assert df.dtypes[: len(COLUMNS[name])] == COLUMNS[name]
            out[name] = df.collect()
        return out[name]

    return rows


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}


def crc(ids):
    return zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))


def test_op1(found, texts):
    email = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
    rows = found("op1_disclosure")
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        assert r.n_email == len(list(email.finditer(texts[r.doc_id])))
        base = [s for s in r.spans.split(",") if s.split(":")[0] in ("email", "ip", "card", "phone")]
        assert hashlib.sha256(",".join(base).encode()).hexdigest() == r.base_sha256
        assert Counter(s.split(":")[0] for s in base) == Counter({k: v for k in ("email", "ip", "card", "phone") if (v := r[f"n_{k}"])})


def test_op2(found, texts):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    start = 0
    for r in sorted(found("op2_token_files"), key=lambda r: r.doc_id):
        ids = [*tokenizer.encode(texts[r.doc_id], add_special_tokens=False).ids, 1]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), crc(ids))
        start += len(ids)


def test_op3(found, texts):
    rows = found("op3_sampled_splitters")
    assert {r.law for r in rows} == {"bytes"} and {r.grown_shard for r in rows} == {None}
    assert all(r.size == len(texts[r.doc_id].encode()) + 8 and r.text_crc32 == zlib.crc32(texts[r.doc_id].encode()) for r in rows)
    shards = defaultdict(list)
    for r in rows:
        shards[r.shard].append(r)
    assert all(sorted(r.slot for r in s) == list(range(len(s))) for s in shards.values()) and set(shards) <= set(range(24))
    sizes = [sum(r.size for r in s) for s in shards.values()]
    assert max(sizes) - min(sizes) <= 2 * max(r.size for r in rows)


def test_op4_and_op5(found, texts):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {d: tokenizer.encode(t, add_special_tokens=False).ids for d, t in texts.items()}
    assert {(r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in found("op4_token_counts")} == {(d, len(texts[d].encode()), len(i), len(i) > 512) for d, i in ids.items()}
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in found("op5_power_of_two_packing"):
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    for d, i in ids.items():
        whole, at = [*i, 0], 0
        for r in sorted(pieces[d], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(whole) and r.ids_crc32 == crc(whole[at : at + r.length])
            at += r.length
        assert at == len(whole)
    assert all(len(s) == 1 and s[0].offset == 0 and s[0].length & (s[0].length - 1) == 0 and s[0].length <= 1024 for s in sequences.values())


def test_op8(found, texts):
    for r in found("op8_adaptive_quality"):
        words = re.findall(r"[^\x20\x09-\x0D]+", texts[r.doc_id])
        windows = Counter(tuple(words[k : k + 8]) for k in range(len(words) - 7))
        repeated = {k + i for k in range(len(words) - 7) if windows[tuple(words[k : k + 8])] > 1 for i in range(8)}
        lines = [x for x in texts[r.doc_id].split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        symbols = len(re.findall(r"[#*$%&|<>]", texts[r.doc_id]))
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(repeated))
        assert r.base_failed == (len(words) < 20 or 100 * len(repeated) > 30 * len(words)) and not (r.kept and r.base_failed)


def test_op9(found, texts):
    rows = found("op9_simhash_components")
    assert all(re.fullmatch("[0-9a-f]{16}", r.fingerprint) for r in rows) and len(rows) == len(texts)
    least = {}
    for r in sorted(rows, key=lambda r: r.doc_id):
        least.setdefault(r.component_id, r.doc_id)
        assert least[r.component_id] == r.component_id
    prints = {r.fingerprint: r.component_id for r in rows}
    for a, ca in prints.items():
        for b, cb in prints.items():
            assert ca == cb or (int(a, 16) ^ int(b, 16)).bit_count() > 2


def test_every_query_has_sql_or_a_test_here():
    tested = {*COLUMNS, "op6_spaced_seeds", "op11_randomness"}  # test_lines, test_secrets
    assert set(QUERIES) == tested | set(ORACLE)


def test_pipeline(spark, texts):
    rows = corpus_pipeline.run(spark, SF_DIR).collect()
    pieces = defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        assert zlib.crc32(bytes(r.ids)) == r.ids_crc32 and len(r.ids) == 4 * r.length
    assert set(pieces) < set(texts)
    for d, parts in pieces.items():
        parts.sort(key=lambda r: r.start)
        assert sum(r.length for r in parts) == parts[0].doc_tokens and [r.start for r in parts] == [sum(p.length for p in parts[:k]) for k in range(len(parts))]
    assert {len({r.sequence_id for r in rows}), len(rows)} == {len(rows)}
    # Of equal texts one is left; the lines of the others are gone, or the whole text is.
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {d: [int.from_bytes(bytes(p.ids)[k : k + 4], "little") for p in parts for k in range(0, len(p.ids), 4)] for d, parts in pieces.items()}
    copies = Counter(texts[d] for d, found in ids.items() if tokenizer.decode(found[:-1]).strip())
    assert max(copies.values()) == 1


def test_pipeline_of_nothing(spark, nothing):
    docs = nothing.select("doc_id", "text", "lang", "source", "n_chars")
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.written(stage(spark, docs, SF_DIR), f"empty-{name}")
    assert docs.count() == 0
