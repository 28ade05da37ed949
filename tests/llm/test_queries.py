"""The registered queries: SQL where there is some, else plain versions, on whole tables."""

import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as registry
from lakeshelf.llm import queries

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in ("documents", "embeddings", "labels"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF_DIR}/{table}.parquet')")
    return connection


def table(name):
    return pq.read_table(f"{SF_DIR}/{name}.parquet").to_pylist()


def test_all_are_registered():
    assert {k.split("_")[0] for k in queries.QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert set(queries.QUERIES) | {"pipeline"} <= set(registry.queries())
    assert set(queries.SQL) <= set(registry.oracle_sql())


@pytest.mark.parametrize("key", sorted(queries.SQL))
def test_same_rows_as_sql(spark, duck, key):
    df = queries.QUERIES[key](spark, SF_DIR)
    expected = duck.sql(queries.SQL[key])
    order = [expected.columns.index(c) for c in df.columns]
    want = Counter(tuple(row[i] for i in order) for row in expected.fetchall())
    assert want and Counter(map(tuple, df.collect())) == want


def test_op2_recall(spark):
    rows = table("embeddings")
    ids = np.array([r["vec_id"] for r in rows])
    x = np.array([r["embedding"] for r in rows], np.float64)
    found = defaultdict(list)
    for r in queries.QUERIES["op2_vector_search"](spark, SF_DIR).collect():
        found[r.query_id].append((r["rank"], r.vec_id, r.score))
    assert set(found) == set(ids[ids % 20 == 0].tolist())
    hits = 0
    for q, got in found.items():
        got.sort()
        scores = x @ x[ids == q][0]
        assert [g[0] for g in got] == list(range(1, 21))
        assert all(abs(scores[ids == v][0] - s) < 1e-12 for _, v, s in got)
        assert sorted(got, key=lambda g: (-g[2], g[1])) == got
        best = sorted((-s, i) for s, i in zip(scores, ids) if i != q)[:20]
        hits += len({i for _, i in best} & {g[1] for g in got})
    assert hits >= 0.98 * 20 * len(found)


def test_op3_round_trip(spark):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    docs = table("documents")
    ids = {r["doc_id"]: [*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 1] for r in docs}
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in queries.QUERIES["op3_pack_windows"](spark, SF_DIR).collect():
        own = np.array(ids[r.doc_id][r.start : r.start + r.length], "<u4")
        assert len(own) == r.length and zlib.crc32(own.tobytes()) == r.ids_crc32 and r.doc_tokens == len(ids[r.doc_id])
        pieces[r.doc_id].append((r.start, r.length))
        sequences[r.sequence_id].append((r.offset, r.length))
    assert pieces.keys() == ids.keys()
    for parts, total in [(p, len(ids[d])) for d, p in pieces.items()] + [(s, None) for s in sequences.values()]:
        end = 0
        for start, length in sorted(parts):
            assert start == end and length > 0
            end += length
        assert end == total if total else end <= 2048
    assert sum(map(len, ids.values())) >= 0.97 * 2048 * len(sequences)


def test_op4_held_out_accuracy(spark):
    langs = {r["doc_id"]: r["lang"] for r in table("documents")}
    rows = queries.QUERIES["op4_language"](spark, SF_DIR).collect()
    assert sorted(r.doc_id for r in rows) == sorted(langs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert np.mean([r.lang_pred == langs[r.doc_id] for r in held]) > 0.98


def test_op5_held_out_accuracy(spark):
    quality = {r["doc_id"]: r["quality"] for r in table("labels")}
    rows = queries.QUERIES["op5_quality"](spark, SF_DIR).collect()
    assert len(rows) == len(table("documents"))
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == int(r.score >= 0.3) for r in rows)
    held = [(r.predicted, quality[r.doc_id]) for r in rows if r.held_out and r.doc_id in quality]
    assert np.mean([p == q for p, q in held]) > 0.95
