"""The registered queries over a small folder of tables: names, types and digests."""

import hashlib
import random
import zlib

import pytest

from corvine.llm import fingerprints, queries, simhash_dedup

pytest.importorskip("tokenizers")
COLUMNS = {
    "op1_simhash_near_dedup": "doc_id bigint,fingerprint string,component_id bigint",
    "op2_document_fingerprints": "doc_id bigint,n_chars bigint,edited_sha256 string,fingerprint string,edited_fingerprint string,near_edited double,near_next double,"
    "class_id bigint,n_within_3 bigint,near_classes array<bigint>",
    "op3_benchmark_decontamination": "doc_id bigint,item_id bigint,n_items bigint,similarity double,first_word bigint,n_words bigint,differing_bits int",
    "op4_substring_dedup": "doc_id bigint,n_words bigint,n_removed bigint,kept_sha256 string",
    "op5_language_id": "doc_id bigint,held_out boolean,lang_pred string,score double,rejected boolean",
    "op6_line_dedup": "doc_id bigint,n_lines bigint,n_dropped bigint,kept_sha256 string",
    "op7_bpe": "doc_id bigint,n_tokens bigint,ids_sha256 string,decoded_sha256 string",
    "op8_sharding": "doc_id bigint,size bigint,text_crc32 bigint,law string,shard int,slot bigint,grown_shard int",
    "op9_license_scan": "doc_id bigint,n_words bigint,n_base bigint,first_word bigint,last_word bigint,base_labels string,labels string,score double",
    "op10_lm_scoring": "doc_id bigint,held_out boolean,n_tokens bigint,n_known bigint,train_tokens bigint,base_score double,score double",
}


def test_queries(spark, tmp_path):
    rnd = random.Random(6)
    texts = [" ".join(rnd.choice("the of and le la der die words licence".split()) for _ in range(rnd.randrange(3, 50))) for _ in range(60)]
    rows = [(i * 4, t, "en") for i, t in enumerate(texts)] + [(1000 + k, texts[k], "fr") for k in range(10)] + [(2000, None, None), (2020, "", "en")]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, texts[3])], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = {}
    for name, query in queries.QUERIES.items():
        out = query(spark, str(tmp_path))
        assert ",".join(f"{a} {b}" for a, b in out.dtypes) == COLUMNS[name]
        got[name] = out.collect()
        if name != "op3_benchmark_decontamination":
            assert sorted(r.doc_id for r in got[name]) == sorted(r[0] for r in rows), name
    assert {12, 1003} <= {r.doc_id for r in got["op3_benchmark_decontamination"]}
    by = {r[0]: r[1] or "" for r in rows}
    assert all(r.fingerprint == f"{simhash_dedup.fingerprint(by[r.doc_id]):016x}" for r in got["op1_simhash_near_dedup"])
    assert all((r.size, r.text_crc32, r.law) == (len(by[r.doc_id].encode()) + 1, zlib.crc32(by[r.doc_id].encode()), "rows") for r in got["op8_sharding"])
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got["op5_language_id"])
    assert all(r.n_removed or r.kept_sha256 == hashlib.sha256(" ".join(by[r.doc_id].split()).encode()).hexdigest() for r in got["op4_substring_dedup"])
    prints = {r.doc_id: int(r.fingerprint, 16) for r in got["op2_document_fingerprints"]}
    for r in got["op2_document_fingerprints"]:
        near = [d for d, fp in prints.items() if bin(fp ^ prints[r.doc_id]).count("1") <= fingerprints.RADIUS]
        assert r.class_id == min(d for d, fp in prints.items() if fp == prints[r.doc_id])
        if r.doc_id % 20:
            assert r.n_within_3 is None and r.near_classes is None
        else:
            assert r.n_within_3 == len(near) and r.near_classes == sorted({min(e for e, fp in prints.items() if fp == prints[d]) for d in near})
