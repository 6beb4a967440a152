"""Malformed documents and records: what is landed, what is refused, and what becomes of it."""

import json
import random

import pytest
from pyspark.sql import functions as F

from attestra import schemas
from attestra.operators import quarantine
from attestra.plans import ingest
from attestra.plans.lake import Lake
from attestra.sources.documents import checked_records, records_only, split_documents
from attestra.sources.splitting import pieces

TIME = "2026-01-05T10:00:00.000Z"


def split(spark, *contents):
    rows = [(k, c if c is None or isinstance(c, bytes) else c.encode()) for k, c in enumerate(contents)]
    return checked_records(split_documents(spark.createDataFrame(rows, "doc int, content binary"), ("doc",)))


@pytest.mark.parametrize(
    "text, want",
    [
        ('{"clauses":[{"a":1},{"a":2}]}', [(0, '{"a":1}', None), (1, '{"a":2}', None)]),
        ('{"clauses": [ ]}', []),
        ("{}", []),
        ('{"clauses":null}', []),
        ('{"clauses":[{"a":1}{"a":2}]}', [(0, '{"a":1}', None), (None, "", "missing_comma"), (1, '{"a":2}', None)]),
        ('{"clauses":[{"a":1},]}', [(0, '{"a":1}', None), (None, ",", "trailing_comma")]),
        ('{"clauses":[{"a":1}', [(0, '{"a":1}', None), (None, "", "malformed_document")]),
        ('{"clauses":[{"a":1', [(0, '{"a":1', "unclosed_record")]),
        ('{"clauses":{"a":1}}', [(None, '{"a":1}', "records_not_a_list")]),
        ("[1]", [(None, "[1]", "not_an_object")]),
        ("", [(None, "", "not_an_object")]),
        ('{"clauses":[]} x', [(None, "x", "trailing_text")]),
        ('{"x":"\\"]}","clauses":[{"q":"}\\\\"},{"q":"{["}]}', [(0, '{"q":"}\\\\"}', None), (1, '{"q":"{["}', None)]),
        (
            '{"clauses":[{"id":1,"x":[{"y":1},{"y":2}]},{"id":2,"x":[{"y":1},{"id":3},{"id":4,"n":"open},{"id":5}],"metadata":{"source":"s"}}',
            [(0, '{"id":1,"x":[{"y":1},{"y":2}]}', None), (1, '{"id":2,"x":[{"y":1}', "unclosed_record"), (2, '{"id":3}', None)]
            + [(3, '{"id":4,"n":"open}', "unclosed_record"), (4, '{"id":5}', None)],
        ),
    ],
)
def test_pieces(text, want):
    _, found = pieces(text, "clauses")
    assert [(p.index, text[p.start : p.end], p.reason) for p in found] == want


def test_well_formed_documents_are_cut_as_json_reads_them():
    rng = random.Random(4)

    def value(depth):
        kind = rng.randrange(7 if depth else 5)
        if kind == 5:
            return [value(depth - 1) for _ in range(rng.randrange(4))]
        if kind == 6:
            return {rng.choice('ab{"}]\\ü\n'): value(depth - 1) for _ in range(rng.randrange(4))}
        return [rng.randint(-9, 9), rng.random(), rng.choice(["", '"', "\\", "{[", "]}", "ü\t", ", {"]), None, True][kind]

    for seed in range(200):
        records = [value(4) for _ in range(rng.randrange(6))]
        text = json.dumps({"metadata": value(2), "more": value(3), "clauses": records, "z": 1}, indent=rng.choice([None, 2]), ensure_ascii=seed % 2 == 0)
        _, found = pieces(text, "clauses")
        assert [json.loads(text[p.start : p.end]) for p in found] == records and all(p.reason is None for p in found)


def test_outcomes(spark):
    doc = b'{"clauses":[{"a":1.10},{"a":nil},{"a":1,"a":2},[1],7,{"b":"\xff"},{"big":1e400},{"c":"\xc3\xbc"}],"metadata":{"source":"s","api_version":2.10}}'
    rows = {r.record_index: r for r in split(spark, doc, None).where("doc = 0").collect()}
    assert (rows[None].source, rows[None].source_api_version, rows[None].records_in_source) == ("s", "2.1", 8)
    reasons = [rows[k].reason for k in range(8)]
    assert reasons == [None, "malformed_record", "duplicate_fields", "not_an_object", "not_an_object", "invalid_utf8", None, None]
    assert rows[0].payload == '{"a":1.10}' and rows[6].payload == '{"big":1e400}'  # exact texts
    for k in range(8):
        assert doc[rows[k].byte_offset : rows[k].byte_offset + rows[k].bytes] == (bytes(rows[k].raw) if rows[k].raw is not None else rows[k].payload.encode())
    assert [r.reason for r in split(spark, doc, None).where("doc = 1 and reason is not null").collect()] == ["not_an_object"]


def test_large_documents_and_records(spark):
    """A document of 140 MB gives the records that small ones give; a record beyond a VARIANT is a reject."""
    row = {"text": "x" * 1_000_000, "n": 1}
    many = '{"clauses":[' + ",".join(json.dumps({"id": k, **row}) for k in range(140)) + "]}"
    huge = '{"clauses":[{"id":0,"text":"' + "y" * 140_000_000 + '"},{"id":1}]}'
    found = split(spark, many, huge).select("doc", "record_index", "bytes", "reason", "record_hash")
    rows = found.collect()
    assert sum(r.reason is None and r.record_index is not None for r in rows if r.doc == 0) == 140
    small = split(spark, json.dumps({"clauses": [{"id": 3, **row}]})).where("record_index = 0").first()
    assert {r.record_index: r.record_hash for r in rows if r.doc == 0}[3] == small.record_hash
    assert {r.record_index: r.reason for r in rows if r.doc == 1} == {None: None, 0: "too_large", 1: None}


@pytest.fixture()
def landed(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    good = [{"clause_id": f"C{k}", "v": k} for k in range(4)]
    (folder / "good.json").write_text(json.dumps({"metadata": {"source": "s", "api_version": "1", "note": "n"}, "clauses": good}))
    (folder / "mixed.json").write_text('{"metadata":{"source":"s"},"clauses":[{"clause_id":"M0"},{"clause_id":"M1","v":nil},{"clause_id":"M2"]},{"clause_id":"M3"}]}')
    (folder / "lost.json").write_bytes(b"\xff\xfe no document")
    lake = Lake(str(tmp_path / "lake"))
    ingest.ingest(spark, lake, str(folder), TIME)
    return lake, folder


def test_one_bad_record_stops_nothing(spark, landed):
    lake, folder = landed
    runs = {r.source_file: r for r in lake.runs(spark).collect()}
    assert {n: (r.status, r.records_in_source, r.records_written, r.records_rejected) for n, r in runs.items()} == {
        "good.json": ("complete", 4, 4, 0), "mixed.json": ("complete", 4, 2, 2), "lost.json": ("quarantined", 0, 0, 0)
    }
    good = runs["good.json"]
    assert json.loads(good.source_metadata)["note"] == "n" and good.completed_at == TIME and good.contract_version == "1.0.0"
    assert good.delivery_guarantee.startswith("at-least-once") and runs["mixed.json"].source_api_version == "unknown"
    refused = {(r.source_file, r.record_index): (r.reason, bytes(r.raw)) for r in lake.read(spark, "rejects", schemas.REJECTS).collect()}
    assert refused == {
        ("mixed.json", 1): ("malformed_record", b'{"clause_id":"M1","v":nil}'),
        ("mixed.json", 2): ("unclosed_record", b'{"clause_id":"M2"]}'),
        ("lost.json", None): ("not_an_object", b"\xff\xfe no document"),
    }
    counts = quarantine.reject_counts(lake.read(spark, "rejects", schemas.REJECTS), "source_file")
    assert {(r.source_file, r.reason): (r.records, r.parts) for r in counts.collect()}[("lost.json", "not_an_object")] == (0, 1)
    # Nothing arrives twice, neither whole nor in part, and nothing was written once more.
    assert ingest.ingest(spark, lake, str(folder), "2026-01-06T10:00:00.000Z").count() == 0
    assert lake.read(spark, "bronze", ingest.BRONZE_TABLE).count() == 6 and lake.runs(spark).count() == 3


def test_resubmission(spark, landed):
    lake, _ = landed
    ids = {(r.source_file, r.record_index): r.reject_id for r in ingest.open_rejects(spark, lake).collect()}
    one, two, part = ids[("mixed.json", 1)], ids[("mixed.json", 2)], ids[("lost.json", None)]
    tries = [(one, '{"clause_id":"M1","v":1}', "ann"), (two, '{"clause_id":', "ann"), (part, "{}", "ann"), ("unknown", "{}", "ann"), (one, '{"z":0}', "bob")]
    out = {r.reject_id: (r.outcome, r.reason) for r in ingest.resubmit(spark, lake, spark.createDataFrame(tries, schemas.CORRECTIONS), TIME).collect()}
    assert out == {one: ("landed", None), two: ("rejected", "malformed_record")}
    rows = lake.read(spark, "bronze", ingest.BRONZE_TABLE).where("run_id like 'mixed%'")
    assert sorted((r._bronze.record_index, r.payload) for r in rows.collect())[1] == (1, '{"clause_id":"M1","v":1}')
    prints = {r._bronze.schema_fingerprint for r in rows.collect()}
    assert len(prints) == 1 and None not in prints
    assert {r.reject_id for r in ingest.open_rejects(spark, lake).collect()} == {two, part}
    # The same correction again finds nothing open.
    assert ingest.resubmit(spark, lake, spark.createDataFrame(tries[:1], schemas.CORRECTIONS), TIME).count() == 0
    assert lake.read(spark, "bronze", ingest.BRONZE_TABLE).count() == 7


def test_records_only_keeps_columns(spark):
    rows = records_only(split(spark, '{"clauses":[{"a":1},{"a":nil}]}'))
    assert rows.count() == 1 and "record_hash" in rows.columns and rows.select(F.col("record_index")).first()[0] == 0
