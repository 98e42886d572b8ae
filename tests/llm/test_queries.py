"""The registered queries: columns of their contracts, one row for each row, the SQL oracle."""

import duckdb
import pytest

from airwave.llm.common import table
from airwave.llm.queries import ORACLES, REGISTRY

SF = "/root/testdata/sf0.001"
CONTRACTS = {
    "op1_substring_dedup": ("documents", {"doc_id": "bigint", "n_words": "bigint", "n_removed": "bigint",
                                          "kept_sha256": "string"}),
    "op2_simhash": ("documents", {"doc_id": "bigint", "fingerprint": "string", "component_id": "bigint"}),
    "op3_ann": (None, {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "double"}),
    "op4_warc": ("pages", {"page_id": "bigint", "payload_bytes": "bigint", "payload_digest": "string",
                           "record_type": "string", "refers_to": "bigint"}),
    "op5_html_extract": ("pages", {"page_id": "bigint", "url": "string", "text": "string", "n_chars": "bigint"}),
    "op6_language_id": ("documents", {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string",
                                      "score": "double"}),
    "op7_decontamination": (None, {"doc_id": "bigint", "item_id": "bigint"}),
    "op8_bpe": ("documents", {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string",
                              "decoded_sha256": "string"}),
    "op9_feistel_sharding": ("documents", {"doc_id": "bigint", "size": "bigint", "text_crc32": "bigint",
                                           "law": "string", "shard": "int", "slot": "bigint", "grown_shard": "int"}),
    "op10_quality": ("documents", {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"}),
    "op11_prefix_trie": (None, {"conv_id": "bigint", "depth": "bigint", "parent_conv_id": "bigint", "n_convs": "bigint",
                                "n_children": "bigint", "n_leaves": "bigint", "saved_tokens": "bigint",
                                "ends_sha256": "string"}),
    "op12_fill_in_middle": ("documents", {"doc_id": "bigint", "n": "bigint", "form": "string", "prefix_chars": "bigint",
                                          "middle_chars": "bigint", "output_sha256": "string",
                                          "restored_sha256": "string"}),
    "op13_lm_scoring": ("documents", {"doc_id": "bigint", "held_out": "boolean", "n_tokens": "bigint", "n_known": "bigint",
                                      "train_tokens": "bigint", "base_score": "double", "score": "double"}),
}


def test_all_are_registered():
    assert set(REGISTRY) == set(CONTRACTS)


@pytest.mark.parametrize("name", CONTRACTS)
def test_contract(spark, name):
    over, columns = CONTRACTS[name]
    got = REGISTRY[name](spark, SF)
    kinds = dict(got.dtypes)
    assert {c: kinds[c] for c in columns} == columns
    n = got.count()
    assert n == table(spark, SF, over).count() if over else n > 0


@pytest.mark.parametrize("name", ORACLES)
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    found = con.execute(ORACLES[name])
    columns = [d[0] for d in found.description]
    got = REGISTRY[name](spark, SF).select(*columns).collect()
    assert sorted(map(tuple, got), key=str) == sorted(found.fetchall(), key=str)
