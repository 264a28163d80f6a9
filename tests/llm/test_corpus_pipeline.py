"""The pipeline against the plain versions of its stages, and the queries' result columns."""

from collections import Counter, defaultdict

import pytest
from test_lines import plain as plain_lines
from test_packing import plain_ids
from test_simhash import plain_components, plain_fingerprint
from test_spans import plain_pii

import __spark_entry__ as E
import corpus_pipeline
from murmur.llm import pii, rules

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_simhash": ["doc_id", "fingerprint", "component_id"],
    "op2_packing": ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
    "op3_lm_scoring": ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
    "op4_quality_classifier": ["doc_id", "held_out", "score", "predicted"],
    "op5_secrets": ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
    "op6_sentencepiece": ["doc_id", "n_ids", "ids_crc32", "lossless"],
    "op7_pii": ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"],
    "op8_embedding_itq": ["vec_id", "n_links", "component_id", "kept"],
    "op9_line_dedup": ["doc_id", "n_lines", "n_deleted", "text_sha256"],
    "op11_phrases": ["lang", "rank", "phrase", "a", "l", "r", "n", "score"],
    "op12_toxicity": ["doc_id", "held_out", "score", "predicted"],
    "op13_divergence": ["lang", "source", "part", "item", "value", "rank"],
    "op10_quality_rules": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
}


def test_registered():
    assert {q for q in E.queries() if q.startswith("op") and "_" in q and q[2].isdigit()} == set(COLUMNS)
    assert E.queries()["pipeline"] is corpus_pipeline.run
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "near_dedup", "personal_data", "packing"]


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns_and_types(spark, name):
    df = E.queries()[name](spark, SF)
    assert df.columns == COLUMNS[name]
    types = dict(df.dtypes)
    assert not {"doc_id", "vec_id", "component_id"} & {c for c, t in types.items() if t != "bigint"}
    assert all(t in ("bigint", "string", "boolean", "double", "int") for t in types.values())
    if name not in ("op2_packing", "op11_phrases", "op13_divergence"):
        assert df.count() == (500 if name == "op8_embedding_itq" else 200)


def redact(text):
    spans = sorted((s, e, k) for s, k, e in plain_pii(text))
    out, at = [], 0
    for s, e, k in spans:
        if s >= at:
            out += [text[at:s], f"[{pii.KINDS[k].upper()}]"]
        at = max(at, e)
    return "".join(out) + text[at:]


def test_run_is_its_stages(spark):
    """Each stage by its definition, from what the quality rules keep."""
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    verdict = {r.doc_id: r.kept for r in rules.quality_verdicts(docs, labels).collect()}
    left = [(r.doc_id, r.text) for r in docs.collect() if verdict[r.doc_id]]
    cleaned, _ = plain_lines(left, 50)
    left = [(i, cleaned[i, t]) for i, t in left]
    groups = plain_components([(i, plain_fingerprint(t)) for i, t in left])
    stay = {i for i, _, low in groups if i == low}
    want = {i: plain_ids(redact(t)) for i, t in left if i in stay}
    pieces = defaultdict(list)
    for r in corpus_pipeline.run(spark, SF).collect():
        pieces[r.doc_id].append(r)
    assert set(pieces) == set(want)
    for i, ids in want.items():
        got = sorted(pieces[i], key=lambda r: r.start)
        assert {r.doc_tokens for r in got} == {len(ids)} and sum(r.length for r in got) == len(ids)


def test_stages_keep_columns_and_take_odd_rows(spark, make, odd):
    docs = make(odd)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        if name != "packing":
            assert out.columns == docs.columns, name
            assert all(r.n_chars is None or r.n_chars == len(r.text) for r in out.select("text", "n_chars").collect())
        assert stage(spark, docs.limit(0), SF).count() == 0


def test_line_dedup_keeps_every_document(spark, make, odd):
    out = corpus_pipeline.line_dedup(spark, make(odd), SF)
    assert Counter(r.doc_id for r in out.collect()) == Counter(i for i, _ in odd)


def test_line_dedup_query_against_its_sql(spark):
    import duckdb
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    want = con.sql(E.oracle_sql()["op9_line_dedup"])
    got = E.queries()["op9_line_dedup"](spark, SF)
    at = [want.columns.index(c) for c in got.columns]
    assert Counter(map(tuple, got.collect())) == Counter(tuple(r[i] for i in at) for r in want.fetchall())
