"""Every query of the operators on the smallest tables: its columns, its rows, its SQL where it has one."""

import duckdb
import pytest

from flowtide.llm import queries as q

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1": {"doc_id", "n_tokens"}, "op2": {"doc_id", "keep_id", "group_size", "kept", "text_sha256"}, "op3": {"page_id", "host", "path", "rule", "verdict"},
    "op4": {"doc_id", "n_words", "n_removed", "kept_sha256"}, "op5": {"doc_id", "ids", "n_ids", "decoded_sha256", "round_trip"}, "op6": {"doc_id", "source_level", "lang_level", "topic", "n_tokens", "weight", "p", "kept"},
    "op7": {"doc_id", "class_id", "n_links"}, "op8": {"doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"},
    "op9": {"doc_id", "n_lines", "n_removed", "kept_sha256"}, "op10": {"doc_id", "held_out", "lang_pred", "score"},
}


@pytest.mark.parametrize("name", sorted(q.QUERIES))
def test_query(spark, name):
    df = q.QUERIES[name](spark, SF)
    rows = df.collect()
    assert COLUMNS[name.split("_")[0]] <= set(df.columns)
    source = "pages" if name.startswith("op3") else "documents"
    key = "page_id" if source == "pages" else "doc_id"
    want = [r[0] for r in spark.read.parquet(f"{SF}/{source}.parquet").select(key).collect()]
    assert sorted(r[key] for r in rows) == sorted(want)
    if name in q.ORACLES:
        duck = duckdb.connect()
        duck.execute(f"create view documents as select * from '{SF}/documents.parquet'")
        oracle = duck.sql(q.ORACLES[name])
        order = sorted(df.columns)
        assert order == sorted(oracle.columns)
        rows = sorted((tuple(r[c] for c in order) for r in rows), key=str)
        at = [oracle.columns.index(c) for c in order]
        assert rows == sorted((tuple(r[k] for k in at) for r in oracle.fetchall()), key=str)


def test_all_ten_and_the_pipeline():
    assert sorted(int(k[2:].split("_")[0]) for k in q.queries() if k != "pipeline") == list(range(1, 11))
    assert set(q.oracle_sql()) <= set(q.queries())


def test_near_copies_of_whole_documents_are_found(spark):
    """Recall against brute force: every document with an id divisible by 100, against all."""
    from flowtide.llm import ngram_join

    sf = "/root/testdata/sf0.01"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    sets = {i: set(ngram_join.shingles(t).tolist()) for i, t in docs}
    got = {r.doc_id: r for r in q.op7_ngram_join(spark, sf).collect()}
    pairs = [(i, j) for i in sets if i % 100 == 0 and sets[i] for j in sets if j != i and sets[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    assert all(got[i].class_id == got[j].class_id for i, j in pairs)
