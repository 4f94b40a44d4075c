"""Every query of the part runs over its whole table and keeps its columns."""

from __future__ import annotations

import duckdb
import pytest

from kinetra.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_quality": "doc_id held_out score predicted",
    "op2_simhash": "doc_id fingerprint component_id",
    "op3_chat": "conv_id n_turns turns_sha256 loss_chars loss_sha256 formatted_chars",
    "op4_embeddings": "vec_id n_links component_id kept",
    "op5_warc": "page_id payload_bytes payload_digest record_type refers_to",
    "op6_ppm": "doc_id held_out n_tokens n_known train_tokens base_score score",
    "op7_packing": "doc_id start length ids_crc32 doc_tokens sequence_id offset",
    "op8_decontam": "doc_id item_id start_word n_words distance similarity",
    "op9_pii": "doc_id n_email n_ip n_card n_phone base_sha256 spans",
    "op10_suffix": "doc_id n_bytes n_removed n_spans kept_sha256",
    "op11_sharding": "doc_id size text_crc32 law shard slot grown_shard",
    "op12_spelling": "word n n_near form form_n root",
    "op13_filters": "part filter_order step kept removed redundant unique_fails good_lost toxic_lost shapley",
}
TABLE = {"op4_embeddings": "embeddings", "op5_warc": "pages"}


@pytest.mark.parametrize("name", COLUMNS)
def test_query(spark, name):
    df = QUERIES[name](spark, SF)
    assert df.columns == COLUMNS[name].split()
    if name == "op13_filters":
        assert df.count() == 600 * spark.read.parquet(f"{SF}/documents.parquet").select("source").distinct().count()
    elif name in ("op3_chat", "op7_packing", "op8_decontam", "op12_spelling"):
        assert df.count() > 0
    else:
        assert df.count() == spark.read.parquet(f"{SF}/{TABLE.get(name, 'documents')}.parquet").count()


@pytest.mark.parametrize("name", ORACLE)
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in ("conversations", "documents", "embeddings", "labels", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = QUERIES[name](spark, SF)
    want = con.execute(ORACLE[name])
    columns = [d[0] for d in want.description]
    assert sorted(columns) == sorted(df.columns)
    assert sorted(map(tuple, df.select(*columns).collect())) == sorted(want.fetchall())
